"""Queries on profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.operators import profile as P
from veristrata.operators import report, sketches
from veristrata.session import stored
from veristrata.workload.common import base, entity, rounded, with_entities

# Columns of the entity views by type class, for the SQL side.
TEXTS = {
    "patients": [
        "patient_id", "mrn", "first_name", "last_name", "gender", "race", "ethnicity",
        "address_line1", "city", "state", "zip_code", "phone", "email", "primary_diagnosis_code",
        "cancer_type", "cancer_stage",
    ],
    "treatments": [
        "treatment_id", "patient_id", "treatment_type", "treatment_name", "drug_code", "drug_name",
        "dosage_unit", "route", "status", "treating_physician", "facility_name", "notes",
    ],
    "lab_results": [
        "result_id", "patient_id", "test_code", "test_name", "test_category", "result_unit",
        "result_text", "specimen_type", "performing_lab", "ordering_physician",
    ],
}
NUMBERS = {
    "patients": {"balance": "double"},
    "treatments": {"dosage": "double", "cycles_planned": "int", "cycles_completed": "int"},
    "lab_results": {
        "result_value": "double", "reference_range_low": "double", "reference_range_high": "double",
    },
}
FLAGS = {"patients": [], "treatments": [], "lab_results": ["is_abnormal", "is_critical"]}
MOMENTS = {
    "patients": {
        "date_of_birth": "date", "primary_diagnosis_date": "date", "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    "treatments": {
        "start_date": "date", "end_date": "date", "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    "lab_results": {
        "collection_datetime": "timestamp_ntz", "result_datetime": "timestamp_ntz",
        "created_at": "timestamp_ntz",
    },
}


def _on(name: str, function, *args):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(function(entity(spark, folder, name), *args))

    return run


def _moments_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in ("min_ts", "max_ts")})


def profile_datetime(spark: SparkSession, folder: str) -> DataFrame:
    return _moments_as_text(P.datetime_profile(entity(spark, folder, "lab_results")))


def profile_string(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(P.string_profile(base(spark, folder, "documents")))


def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_moments_as_text(P.column_profile(entity(spark, folder, "lab_results"))))


def profile_top_values(spark: SparkSession, folder: str) -> DataFrame:
    top = P.top_value_profile(entity(spark, folder, "patients"))
    return top.select("column", "value", "occurrences", "rank")


def sample_n_profile(spark: SparkSession, folder: str) -> DataFrame:
    sample = P.sample_rows(base(spark, folder, "orders"), 500, ["o_orderkey"], stored=True)
    return rounded(P.numeric_profile(sample))


def profile_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of the orders profiled alone, stored and combined, against the whole: the exact numbers, and whether
    the sketches are within their error."""
    orders = base(spark, folder, "orders")
    halves = [orders.where(F.col("o_orderkey") % 2 == i) for i in range(2)]
    combined = stored(sketches.combine(*(stored(sketches.sketch_profile(h), "half") for h in halves)), "profile")
    found = sketches.report(combined)
    numbers = ["o_orderkey", "o_custkey", "o_totalprice"]
    medians = {r["column"]: r["q50"] for r in found.collect() if r["column"] in numbers}  # a row for each column
    counts = orders.agg(
        *(F.countDistinct(c).alias(f"d_{c}") for c in orders.columns),
        *(F.avg((F.col(c) <= F.lit(medians[c])).cast("double")).alias(f"r_{c}") for c in numbers),
    ).select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(f"d_{c}").alias("exact"),
                 (F.col(f"r_{c}") if c in numbers else F.lit(None).cast("double")).alias("rank")) for c in orders.columns
    ))))
    near = F.abs(F.col("unique_count") - F.col("exact")) <= F.greatest(F.col("exact") * sketches.HLL_ERROR, F.lit(1))
    # Of a number with few values a rank may be off by the rows of one.
    middle = F.abs(F.col("rank") - 0.5) <= sketches.KLL_ERROR + F.try_divide(F.lit(1.0), F.col("exact"))
    return rounded(found.join(counts, "column").select(
        "column", "count", "null_count", "mean", "std", "min", "max", near.alias("distinct_within"),
        F.coalesce(middle, F.lit(True)).alias("median_within"),
    ), 4)


def profile_report(spark: SparkSession, folder: str) -> DataFrame:
    """The whole profile of the documents; long values as their digest, correlations in millionths."""
    found = _moments_as_text(report.profile(base(spark, folder, "documents"), "documents"))
    shown = lambda v: F.when(F.octet_length(v) > 64, F.md5(v.cast("binary"))).otherwise(v)
    top = F.transform("top_values", lambda x: F.concat(shown(x["value"]), F.lit(" "), x["occurrences"].cast("string")))
    related = F.transform(
        "correlations", lambda x: F.concat(x["column"], F.lit(" "), F.round(x["r"] * 1_000_000).cast("bigint").cast("string"))
    )
    return rounded(found.withColumns({
        "top_values": F.array_join(top, "\n"), "correlations": F.array_join(related, "\n"),
    }))


QUERIES = {
    "profile_report": profile_report,
    "profile_sketches": profile_sketches,
    "profile_table": _on("lab_results", P.table_profile, "lab_results"),
    "profile_nulls": _on("treatments", P.null_profile),
    "profile_unique": _on("patients", P.unique_profile),
    "profile_top_values": profile_top_values,
    "profile_numeric": _on("lab_results", P.numeric_profile),
    "profile_shape": _on("lab_results", P.shape_profile),
    "profile_datetime": profile_datetime,
    "profile_string": profile_string,
    "profile_correlations": _on("lab_results", P.correlations),
    "profile_bytes": _on("treatments", P.byte_profile),
    "profile_columns": profile_columns,
    "profile_summary": _on("treatments", P.profile_summary, "treatments"),
    "profile_overview": _on("treatments", P.overview),
    "sample_n_profile": sample_n_profile,
}


# ---- the same in SQL -----------------------------------------------------------------------


def columns_of(name: str) -> list[str]:
    return [*TEXTS[name], *NUMBERS[name], *FLAGS[name], *MOMENTS[name]]


def types_of(name: str) -> dict[str, str]:
    return (
        {c: "string" for c in TEXTS[name]} | NUMBERS[name]
        | {c: "boolean" for c in FLAGS[name]} | MOMENTS[name]
    )


def _union(name: str, parts: list[str], *more: str) -> str:
    return with_entities(name, *more) + "\nUNION ALL\n".join(parts)


def _numeric_cells(c: str) -> str:
    return (
        f"round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, "
        "round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, "
        "round(quantile_cont(v, 0.75), 6) AS q75, round(max(v), 6) AS max"
    )


def _as_number(name: str, c: str) -> str:
    return f"cast({c}::int AS double)" if c in FLAGS.get(name, []) else f"cast({c} AS double)"


def _numbers(name: str) -> list[str]:
    return [*NUMBERS[name], *FLAGS[name]]


def _shape(v: str, function: str) -> str:
    return (
        f"round(CASE WHEN isnan({function}({v})) THEN NULL ELSE {function}({v}) END, 6)"
    )


def _column_sql(name: str, c: str) -> str:
    numeric, moment, text = c in _numbers(name), c in MOMENTS[name], c in TEXTS[name]
    v = _as_number(name, c)

    def when(kind: bool, expression: str, data_type: str) -> str:
        return expression if kind else f"cast(NULL AS {data_type})"

    d = "double"
    cells = {
        "dtype": f"'{types_of(name)[c]}'",
        "count": "count(*)",
        "null_count": f"count(*) - count({c})",
        "null_rate": f"round((count(*) - count({c})) * 1.0e0 / count(*), 6)",
        "unique_count": f"count(DISTINCT {c})",
        "unique_rate": f"round(count(DISTINCT {c}) * 1.0e0 / count(*), 6)",
        "mean": when(numeric, f"round(avg({v}), 6)", d),
        "std": when(numeric, f"round(stddev_samp({v}), 6)", d),
        "min": when(numeric, f"round(min({v}), 6)", d),
        "q25": when(numeric, f"round(quantile_cont({v}, 0.25), 6)", d),
        "q50": when(numeric, f"round(quantile_cont({v}, 0.5), 6)", d),
        "q75": when(numeric, f"round(quantile_cont({v}, 0.75), 6)", d),
        "max": when(numeric, f"round(max({v}), 6)", d),
        "skewness": when(numeric, _shape(v, "skewness"), d),
        "kurtosis": when(numeric, _shape(v, "kurtosis"), d),
        "min_ts": when(moment, f"cast(cast(min({c}) AS timestamp) AS varchar)", "varchar"),
        "max_ts": when(moment, f"cast(cast(max({c}) AS timestamp) AS varchar)", "varchar"),
        "range_days": when(
            moment, f"date_sub('day', cast(min({c}) AS timestamp), cast(max({c}) AS timestamp))",
            "bigint"),
        "avg_length": when(text, f"round(avg(length({c})), 6)", d),
        "min_length": when(text, f"cast(min(length({c})) AS int)", "int"),
        "max_length": when(text, f"cast(max(length({c})) AS int)", "int"),
    }
    listed = ", ".join(f"{e} AS \"{n}\"" for n, e in cells.items())
    return f"SELECT '{c}' AS \"column\", {listed} FROM {name}"


def _bytes(name: str, c: str) -> str:
    widths = {"date": 4, "timestamp": 8, "timestamp_ntz": 8, "double": 8, "int": 4, "boolean": 1}
    if c in TEXTS[name]:
        return f"coalesce(cast(sum(octet_length({c}::BLOB)) AS bigint), 0)"
    return f"count(*) * {widths[types_of(name)[c]]}"


def _pair(a: str, b: str) -> str:
    return (
        f"SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN isnan(corr({a}, {b})) THEN NULL "
        f"ELSE corr({a}, {b}) END, 6) AS r FROM lab_results"
    )


_DOCUMENT_TEXTS = ["text", "lang", "source"]
_DOCUMENT_NUMBERS = {"doc_id": "bigint", "n_chars": "bigint"}


def _report_sql(c: str) -> str:
    """The whole profile of a column of the documents."""
    number = c in _DOCUMENT_NUMBERS
    cells = {"null_count": f"count(*) - count({c})", "unique_count": f"count(DISTINCT {c})"}
    rates = ", ".join(f"round(({e}) * 1.0e0 / count(*), 6) AS {n[:-5]}rate" for n, e in cells.items())
    plain = ", ".join(f"{e} AS {n}" for n, e in cells.items())
    shape = ", ".join(f"{_shape(c, f) if number else 'cast(NULL AS double)'} AS {f}" for f in ("skewness", "kurtosis"))
    length = "cast(NULL AS int)" if number else f"length({c})"
    size = "count(*) * 8" if number else f"coalesce(cast(sum(strlen({c})) AS bigint), 0)"
    listed = " || chr(10) || ".join(
        f"'{o} ' || (SELECT cast(round(corr({c}, {o}) * 1000000) AS bigint) FROM documents)" for o in sorted(_DOCUMENT_NUMBERS)
    ) if number else "cast(NULL AS varchar)"
    return f"""SELECT 'documents' AS name, count(*) AS row_count, '{c}' AS "column", '{_DOCUMENT_NUMBERS.get(c, "string")}' AS dtype,
      {plain}, {rates}, {_numeric_cells(c).replace("(v", f"({c}") if number else _no_numbers()}, {shape},
      cast(NULL AS varchar) AS min_ts, cast(NULL AS varchar) AS max_ts, cast(NULL AS bigint) AS range_days,
      round(avg({length}), 6) AS avg_length, cast(min({length}) AS int) AS min_length, cast(max({length}) AS int) AS max_length, {size} AS data_bytes,
      coalesce((SELECT string_agg(CASE WHEN strlen(v) > 64 THEN md5(v) ELSE v END || ' ' || n, chr(10) ORDER BY n DESC, mark)
        FROM (SELECT cast({c} AS varchar) AS v, count(*) AS n,
                CASE WHEN strlen(v) > 64 THEN '#' || sha256(v) ELSE v END AS mark
              FROM documents WHERE {c} IS NOT NULL GROUP BY v ORDER BY n DESC, mark LIMIT 5)), '') AS top_values,
      {listed} AS correlations
    FROM documents"""


def _no_numbers() -> str:
    return ", ".join(f"cast(NULL AS double) AS {n}" for n in P.NUMERIC[1:])


_DIGEST = "md5(concat('42:', cast(o_orderkey AS varchar)))"
def _sketched_sql(c: str, number: bool) -> str:
    cells = f"avg({c}), stddev_samp({c}), min({c}), max({c})".split(", ") if number else ["NULL"] * 4
    listed = ", ".join(
        f"round(cast({e} AS double), 4) AS {n}" for e, n in zip(cells, ("mean", "std", "min", "max"), strict=True)
    )
    return (
        f"SELECT '{c}' AS \"column\", count(*) AS count, count(*) - count({c}) AS null_count, {listed}, "
        "true AS distinct_within, true AS median_within FROM orders"
    )


ORACLES = {
    "profile_report": "\nUNION ALL\n".join(_report_sql(c) for c in (*_DOCUMENT_NUMBERS, *_DOCUMENT_TEXTS)),
    "profile_sketches": "\nUNION ALL\n".join(
        _sketched_sql(c, c in ("o_orderkey", "o_custkey", "o_totalprice")) for c in (
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")),
    "profile_table": with_entities("lab_results")
    + "SELECT 'lab_results' AS name, count(*) AS row_count, 18 AS column_count FROM lab_results",
    "profile_nulls": _union("treatments", [
        f"SELECT '{c}' AS \"column\", count(*) AS count, count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) * 1.0e0 / count(*), 6) AS null_rate FROM treatments"
        for c in columns_of("treatments")]),
    "profile_unique": _union("patients", [
        f"SELECT '{c}' AS \"column\", count(*) AS count, count(DISTINCT {c}) AS unique_count, "
        f"round(count(DISTINCT {c}) * 1.0e0 / count(*), 6) AS unique_rate FROM patients"
        for c in columns_of("patients")]),
    "profile_top_values": with_entities("patients")
    + "SELECT * FROM (SELECT *, cast(row_number() OVER (PARTITION BY \"column\" "
    "ORDER BY occurrences DESC, value) AS int) AS rank FROM ("
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", cast({c} AS varchar) AS value, count(*) AS occurrences "
        f"FROM patients WHERE {c} IS NOT NULL GROUP BY 2" for c in columns_of("patients"))
    + ")) WHERE rank <= 5",
    "profile_numeric": _union("lab_results", [
        f"SELECT '{c}' AS \"column\", {_numeric_cells(c)} FROM "
        f"(SELECT {_as_number('lab_results', c)} AS v FROM lab_results)"
        for c in _numbers("lab_results")]),
    "profile_shape": _union("lab_results", [
        f"SELECT '{c}' AS \"column\", {_shape('v', 'skewness')} AS skewness, "
        f"{_shape('v', 'kurtosis')} AS kurtosis FROM "
        f"(SELECT {_as_number('lab_results', c)} AS v FROM lab_results)"
        for c in _numbers("lab_results")]),
    "profile_datetime": _union("lab_results", [
        f"SELECT '{c}' AS \"column\", cast(min({c}) AS varchar) AS min_ts, "
        f"cast(max({c}) AS varchar) AS max_ts, date_sub('day', min({c}), max({c})) AS range_days "
        "FROM lab_results" for c in MOMENTS["lab_results"]]),
    "profile_string": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", round(avg(length({c})), 6) AS avg_length, "
        f"cast(min(length({c})) AS int) AS min_length, cast(max(length({c})) AS int) AS max_length "
        "FROM documents" for c in _DOCUMENT_TEXTS),
    "profile_correlations": _union("lab_results", [
        _pair(a, b) for a in NUMBERS["lab_results"] for b in NUMBERS["lab_results"]]),
    "profile_bytes": _union("treatments", [
        f"SELECT '{c}' AS \"column\", {_bytes('treatments', c)} AS data_bytes FROM treatments"
        for c in columns_of("treatments")]),
    "profile_columns": _union(
        "lab_results", [_column_sql("lab_results", c) for c in columns_of("lab_results")]),
    "profile_summary": with_entities("treatments") + "SELECT 'treatments' AS name, "
    "count(*) AS row_count, 19 AS column_count, "
    + " + ".join(_bytes("treatments", c) for c in columns_of("treatments")) + " AS data_bytes, "
    + " + ".join(f"(count({c}) < count(*))::int" for c in columns_of("treatments"))
    + " AS columns_with_nulls, round(("
    + " + ".join(f"(count(*) - count({c}))" for c in columns_of("treatments"))
    + ") * 1.0e0 / count(*) / 19, 6) AS avg_null_rate FROM treatments",
    "profile_overview": _union("treatments", [
        f"SELECT '{c}' AS \"column\", '{types_of('treatments')[c]}' AS dtype, "
        f"count({c}) AS non_null, round(100.0e0 * (count(*) - count({c})) / count(*), 6) "
        f"AS null_percent, count(DISTINCT {c}) AS unique_count FROM treatments"
        for c in columns_of("treatments")]),
    "sample_n_profile": f"WITH s AS (SELECT * FROM orders ORDER BY {_DIGEST}, o_orderkey LIMIT 500)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", {_numeric_cells(c)} FROM "
        f"(SELECT cast({c} AS double) AS v FROM s)"
        for c in ("o_orderkey", "o_custkey", "o_totalprice")),
}
