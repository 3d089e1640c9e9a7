"""Queries on outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.operators import anomaly, isolation
from veristrata.workload.common import base, entity, rounded, with_entities

LAB_NUMBERS = ["result_value", "reference_range_low", "reference_range_high"]
LINE_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]
ORDER_NUMBERS = ["o_totalprice", "o_custkey"]
PRICES = ["l_quantity", "l_extendedprice", "l_discount"]


def _labs(method: str, threshold: float):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(anomaly.detect(entity(spark, folder, "lab_results"), method, threshold))

    return run


def anomaly_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(anomaly.detect(base(spark, folder, "lineitem")))


def anomaly_reference_range(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(anomaly.out_of_reference_range(entity(spark, folder, "lab_results")))


def anomaly_summary(spark: SparkSession, folder: str) -> DataFrame:
    found = anomaly.detect(entity(spark, folder, "lab_results"), "iqr", 0.5)
    return rounded(anomaly.summarize(found))


def anomaly_rows(spark: SparkSession, folder: str) -> DataFrame:
    labs = entity(spark, folder, "lab_results")
    return rounded(anomaly.anomalous_rows(labs, ["result_id"], columns=["result_value"]))


# What is fixed by definition for a forest, whatever trees it draws: with a few rows moved far outside, these are
# found, and no more rows are flagged than the contamination allows.
PLANTED = 100.0


def _found(spark: SparkSession, rows: DataFrame, columns: list[str], key: str, planted: str) -> DataFrame:
    moved = F.expr(planted)
    table = rows.withColumns({c: F.when(moved, F.col(c) * PLANTED).otherwise(F.col(c)) for c in columns})
    found = isolation.isolation_forest(table, columns, [key])
    marked = table.select(key, moved.alias("planted"))
    return marked.join(found.select(key, F.lit(True).alias("found")), key, "left").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("planted").alias("planted"),
        F.count_if(F.col("planted") & F.col("found").isNotNull()).alias("planted_found"),
        F.least(F.count(F.lit(1)) * 0.1, F.lit(100.0)).alias("allowed"),
        (F.count("found") <= F.least(F.count(F.lit(1)) * 0.1, F.lit(100.0))).alias("within_allowed"),
    )


def anomaly_iforest(spark: SparkSession, folder: str) -> DataFrame:
    orders = base(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return rounded(_found(spark, orders, ["o_totalprice"], "o_orderkey", "o_orderkey <= 5"))


def anomaly_iforest_multi(spark: SparkSession, folder: str) -> DataFrame:
    lines = base(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"), "l_orderkey", *PRICES[:2]
    )
    return rounded(_found(spark, lines, PRICES[:2], "line", "l_orderkey <= 3"))


def anomaly_iforest_columns(spark: SparkSession, folder: str) -> DataFrame:
    """One forest per column, with a few values moved far outside: these are found, and no more rows are flagged than
    the contamination allows."""
    orders = base(spark, folder, "orders")
    moved = F.expr("o_orderkey <= 5")
    table = orders.select(
        moved.alias("planted"), *(F.when(moved, F.col(c) * PLANTED).otherwise(F.col(c)).alias(c) for c in ORDER_NUMBERS)
    )
    found = isolation.anomalous_values(table, ORDER_NUMBERS)
    values = table.select("planted", F.inline(F.array(*(
        F.struct(F.lit(c).alias("columns"), F.col(c).cast("double").alias("value")) for c in ORDER_NUMBERS
    ))))
    marked = values.join(
        found.select(F.col("column").alias("columns"), "value", F.lit(True).alias("found")), ["columns", "value"], "left"
    ).groupBy("columns").agg(
        F.count_if("planted").alias("planted"), F.count_if(F.col("planted") & F.col("found").isNotNull()).alias("planted_found")
    )
    allowed = F.least(F.col("row_count") * 0.1, F.lit(100.0))
    counts = isolation.detect(table, ORDER_NUMBERS)
    return counts.join(marked, "columns").select(
        "columns", "method", "row_count", "planted", "planted_found", (F.col("anomaly_count") <= allowed).alias("within_allowed")
    )


QUERIES = {
    "anomaly_iqr": _labs("iqr", 1.5),
    "anomaly_zscore": _labs("zscore", 1.5),
    "anomaly_mad": _labs("mad", 1.5),
    "anomaly_all_columns": anomaly_all_columns,
    "anomaly_reference_range": anomaly_reference_range,
    "anomaly_summary": anomaly_summary,
    "anomaly_rows": anomaly_rows,
    "anomaly_iforest": anomaly_iforest,
    "anomaly_iforest_columns": anomaly_iforest_columns,
    "anomaly_iforest_multi": anomaly_iforest_multi,
}


# ---- the same in SQL -----------------------------------------------------------------------


def _result(c: str, method: str, t: float, flag: str, cells: dict[str, str], source: str,
            error: str = "cast(NULL AS varchar)") -> str:
    numbers = ", ".join(f"round(any_value({e}), 6) AS {n}" for n, e in cells.items())
    return (
        f"SELECT '{c}' AS \"column\", '{method}' AS method, "
        f"count(*) FILTER (WHERE {flag}) AS anomaly_count, count(*) AS row_count, "
        f"round(count(*) FILTER (WHERE {flag}) * 1.0e0 / count(*), 6) AS anomaly_rate, "
        f"{t}e0 AS threshold, {numbers}, any_value({error}) AS error FROM ({source})"
    )


def iqr_sql(c: str, t: float, table: str) -> str:
    source = (
        f"SELECT v, q1, q2, q3, q1 - {t}e0 * (q3 - q1) AS lo, q3 + {t}e0 * (q3 - q1) AS hi FROM "
        f"(SELECT cast({c} AS double) AS v FROM {table}), (SELECT "
        f"quantile_cont(cast({c} AS double), 0.25) AS q1, quantile_cont(cast({c} AS double), 0.5) "
        f"AS q2, quantile_cont(cast({c} AS double), 0.75) AS q3 FROM {table})"
    )
    cells = {"lower_bound": "lo", "upper_bound": "hi", "center": "q2", "scale": "q3 - q1"}
    return _result(c, "iqr", t, "v < lo OR v > hi", cells, source)


def _zscore_sql(c: str, t: float, table: str) -> str:
    source = (
        f"SELECT v, m, s FROM (SELECT cast({c} AS double) AS v FROM {table}), "
        f"(SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {table})"
    )
    cells = {"lower_bound": f"CASE WHEN s > 0 THEN m - {t}e0 * s END",
             "upper_bound": f"CASE WHEN s > 0 THEN m + {t}e0 * s END", "center": "m", "scale": "s"}
    flag = f"s > 0 AND abs(v - m) / s > {t}e0"
    return _result(c, "zscore", t, flag, cells, source,
                   "CASE WHEN s = 0 THEN 'Zero standard deviation' END")


def _mad_sql(c: str, t: float, table: str) -> str:
    source = (
        f"SELECT v, m, d FROM (SELECT cast({c} AS double) AS v FROM {table}), "
        f"(SELECT m, median(abs({c} - m)) AS d FROM {table}, "
        f"(SELECT median(cast({c} AS double)) AS m FROM {table}) GROUP BY m)"
    )
    cells = {"lower_bound": f"CASE WHEN d > 0 THEN m - {t}e0 * 1.4826e0 * d END",
             "upper_bound": f"CASE WHEN d > 0 THEN m + {t}e0 * 1.4826e0 * d END", "center": "m",
             "scale": "d"}
    flag = f"d > 0 AND abs(v - m) / (1.4826e0 * d) > {t}e0"
    return _result(c, "mad", t, flag, cells, source, "CASE WHEN d = 0 THEN 'Zero MAD' END")


def _labs_sql(make, t: float) -> str:
    return with_entities("lab_results") + "\nUNION ALL\n".join(
        make(c, t, "lab_results") for c in LAB_NUMBERS)


def _forest_sql(table: str, planted: str) -> str:
    return f"""
SELECT count(*) AS row_count, count(*) FILTER (WHERE {planted}) AS planted,
 count(*) FILTER (WHERE {planted}) AS planted_found,
 round(least(count(*) * 0.1e0, 100e0), 6) AS allowed, true AS within_allowed FROM {table}"""


ORACLES = {
    "anomaly_iforest": _forest_sql("orders", "o_orderkey <= 5"),
    "anomaly_iforest_multi": _forest_sql("lineitem", "l_orderkey <= 3"),
    "anomaly_iforest_columns": """
SELECT c AS columns, 'isolation_forest' AS method, n AS row_count, planted, planted AS planted_found, true AS within_allowed
FROM (SELECT 'o_totalprice' AS c, count(o_totalprice) AS n, count(o_totalprice) FILTER (WHERE o_orderkey <= 5) AS planted
 FROM orders
 UNION ALL SELECT 'o_custkey', count(o_custkey), count(o_custkey) FILTER (WHERE o_orderkey <= 5) FROM orders)""",
    "anomaly_iqr": _labs_sql(iqr_sql, 1.5),
    "anomaly_zscore": _labs_sql(_zscore_sql, 1.5),
    "anomaly_mad": _labs_sql(_mad_sql, 1.5),
    "anomaly_all_columns": "\nUNION ALL\n".join(iqr_sql(c, 1.5, "lineitem") for c in LINE_NUMBERS),
    "anomaly_reference_range": with_entities("lab_results") + """
SELECT 'result_value' AS "column", 'reference_range' AS method, count(*) FILTER (WHERE bad)
 AS anomaly_count, count(*) AS row_count, round(count(*) FILTER (WHERE bad) * 1.0e0 / count(*), 6)
 AS anomaly_rate FROM (SELECT result_value < reference_range_low
 OR result_value > reference_range_high AS bad FROM lab_results)""",
    "anomaly_summary": with_entities("lab_results") + """
SELECT method, threshold, count(*) AS columns, cast(sum(anomaly_count) AS bigint)
 AS total_anomalies, max(anomaly_rate) AS highest_rate FROM ("""
    + "\nUNION ALL\n".join(iqr_sql(c, 0.5, "lab_results") for c in LAB_NUMBERS)
    + ") GROUP BY 1, 2",
    "anomaly_rows": with_entities("lab_results") + """
SELECT result_id, 'result_value' AS "column", round(result_value, 6) AS value,
 round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound FROM lab_results,
 (SELECT q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM (SELECT
  quantile_cont(result_value, 0.25) AS q1, quantile_cont(result_value, 0.75) AS q3
  FROM lab_results)) WHERE result_value < lo OR result_value > hi""",
}
