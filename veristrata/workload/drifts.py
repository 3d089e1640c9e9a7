"""Queries on drift. Reference: orders before 1998; current: later orders, two percent dearer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.operators import drift
from veristrata.workload.common import base, rounded

SPLIT = "1998-01-01 00:00:00"
NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


def order_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = base(spark, folder, "orders")
    split = F.lit(SPLIT).cast("timestamp_ntz")
    later = orders.filter(F.col("o_orderdate") >= split).withColumn(
        "o_totalprice", F.col("o_totalprice") * 1.02
    )
    return orders.filter(F.col("o_orderdate") < split), later


def _changed_schema(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    reference, current = order_versions(spark, folder)
    current = current.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    channel = F.when(F.col("o_orderkey") % 3 == 0, "web")
    return reference, current.withColumn("o_channel", channel).drop("o_orderpriority")


def drift_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The report on the schema, and the changed columns with how often each is missing in either version."""
    versions = _changed_schema(spark, folder)
    report = drift.schema_drift(*versions)
    changes = drift.schema_changes(*versions).withColumn("drift_type", F.lit("schema"))
    return rounded(report.join(F.broadcast(changes), "drift_type"))  # a handful of rows


def drift_ks(spark: SparkSession, folder: str) -> DataFrame:
    found = drift.distribution_drift(*order_versions(spark, folder))
    return rounded(found, 9)


def drift_ks_same(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of one table: distances near zero, nothing detected."""
    lines = base(spark, folder, "lineitem")
    half = (F.col("l_orderkey") + F.col("l_linenumber")) % 2
    found = drift.distribution_drift(lines.where(half == 0), lines.where(half == 1), HALVED)
    return rounded(found, 9)


def drift_statistical(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.statistical_drift(*order_versions(spark, folder)))


def drift_compare(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.compare(*_changed_schema(spark, folder)), 9)


HALVED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

QUERIES = {
    "drift_schema": drift_schema,
    "drift_ks": drift_ks,
    "drift_ks_same": drift_ks_same,
    "drift_statistical": drift_statistical,
    "drift_compare": drift_compare,
}


# ---- the same in SQL -----------------------------------------------------------------------

SIDES = f"""WITH r AS (SELECT * FROM orders WHERE o_orderdate < timestamp '{SPLIT}'),
u AS (SELECT o_orderkey, o_custkey, o_totalprice * 1.02e0 AS o_totalprice FROM orders
 WHERE o_orderdate >= timestamp '{SPLIT}')
"""


def _ks_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", d, n1, n2, d * sqrt(n1 * 1.0e0 * n2 / (n1 + n2)) AS lam FROM (
 SELECT max(abs(f1 - f2)) AS d, any_value(n1) AS n1, any_value(n2) AS n2 FROM (
  SELECT sum(sum(a)) OVER w * 1.0e0 / (SELECT count(*) FROM r) AS f1,
   sum(sum(b)) OVER w * 1.0e0 / (SELECT count(*) FROM u) AS f2,
   (SELECT count(*) FROM r) AS n1, (SELECT count(*) FROM u) AS n2
  FROM (SELECT cast({c} AS double) AS v, 1 AS a, 0 AS b FROM r
        UNION ALL SELECT cast({c} AS double), 0, 1 FROM u)
  GROUP BY v WINDOW w AS (ORDER BY v)))"""


def _ks_all(columns: list[str]) -> str:
    listed = "\nUNION ALL\n".join(_ks_sql(c) for c in columns)
    return f"""
SELECT "column", 'distribution' AS drift_type, round(d, 9) AS drift_score,
 round(p, 9) AS p_value, p < 0.1 AS drift_detected, n1 AS reference_count, n2 AS current_count
FROM (SELECT *, CASE WHEN lam < 0.2 THEN 1.0e0 ELSE least(1.0e0, greatest(0.0e0, 2.0e0 * (
 SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0e0 ELSE -1.0e0 END * exp(-2.0e0 * k * k * lam * lam))
 FROM range(1, 101) t(k)))) END AS p FROM ({listed}))"""


def _stats_sql(c: str) -> str:
    def side(t: str, name: str) -> str:
        return (
            f"(SELECT avg({c}) AS {name}_mean, stddev_samp({c}) AS {name}_std, "
            f"cast(min({c}) AS double) AS {name}_min, cast(max({c}) AS double) AS {name}_max, "
            f"quantile_cont(cast({c} AS double), 0.5) AS {name}_median FROM {t})"
        )

    cells = ", ".join(
        f"round({s}_{k}, 6) AS {s}_{k}"
        for s in ("reference", "current") for k in ("mean", "std", "min", "max", "median"))
    return f"""
SELECT '{c}' AS "column", 'statistical' AS drift_type, round((dm + ds) / 2, 6) AS drift_score,
 (dm + ds) / 2 > 0.1e0 AS drift_detected, round(dm, 6) AS mean_diff_pct,
 round(ds, 6) AS std_diff_pct, {cells} FROM (SELECT *,
 abs(reference_mean - current_mean) / (abs(reference_mean) + 1e-10) AS dm,
 abs(reference_std - current_std) / (abs(reference_std) + 1e-10) AS ds
 FROM {side('r', 'reference')}, {side('u', 'current')})"""


_SCHEMA_SCORE = "0.5e0"
_REPORT = """'schema' AS drift_type, 0.5e0 AS drift_score, true AS drift_detected,
 'o_channel' AS columns_added, 'o_orderpriority' AS columns_removed,
 'o_custkey:bigint->string' AS type_changes, 6 AS reference_column_count, 6 AS current_column_count"""
_VERSIONS = f"""WITH r AS (SELECT * FROM orders WHERE o_orderdate < timestamp '{SPLIT}'),
u AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'web' END AS o_channel FROM orders
 WHERE o_orderdate >= timestamp '{SPLIT}')
"""


def _missing(c: str, table: str) -> str:
    return f"(SELECT count(*) - count({c}) FROM {table})"


ORACLES = {
    "drift_schema": _VERSIONS + f"""
SELECT {_REPORT}, 'o_channel' AS "column", 'added' AS change, cast(NULL AS varchar) AS reference_type,
 'string' AS current_type, cast(NULL AS bigint) AS reference_nulls, {_missing('o_channel', 'u')} AS current_nulls
UNION ALL SELECT {_REPORT}, 'o_orderpriority', 'removed', 'string', NULL, {_missing('o_orderpriority', 'r')}, NULL
UNION ALL SELECT {_REPORT}, 'o_custkey', 'retyped', 'bigint', 'string', {_missing('o_custkey', 'r')},
 {_missing('o_custkey', 'u')}""",
    "drift_ks": SIDES + _ks_all(NUMBERS),
    "drift_ks_same": "WITH " + ", ".join(
        f"{s} AS (SELECT * FROM lineitem WHERE (l_orderkey + l_linenumber) % 2 = {i})" for i, s in enumerate("ru")
    ) + _ks_all(HALVED),
    "drift_statistical": SIDES + "\nUNION ALL\n".join(_stats_sql(c) for c in NUMBERS),
    "drift_compare": SIDES + f"""
SELECT *, bool_or(drift_detected) OVER () AS any_drift FROM (
SELECT drift_type, "column", drift_score, p_value, drift_detected FROM
 ({_ks_all(['o_orderkey', 'o_totalprice'])})
UNION ALL SELECT 'schema', NULL, {_SCHEMA_SCORE}, NULL, {_SCHEMA_SCORE} > 0)""",
}
