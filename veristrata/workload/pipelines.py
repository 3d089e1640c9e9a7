"""Queries on pipelines, checkpoints, fault injection and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.operators.faults import inject_faults
from veristrata.operators.summary import category_distribution, dataset_summary
from veristrata.operators.validate import validate
from veristrata.plans import catalog, checkpoints, quality
from veristrata.plans.etl import Pipeline, Step, add_metadata_columns, has_columns
from veristrata.plans.suite import Suite
from veristrata.session import scratch_path
from veristrata.streaming.microbatch import file_stream, stream_totals, validate_stream
from veristrata.workload.anomalies import LAB_NUMBERS, iqr_sql
from veristrata.workload.common import AS_OF, base, entities, entity, rounded, with_entities
from veristrata.workload.profiles import columns_of
from veristrata.workload.validation import ENTITIES, suite_sql

RUN = "run_2025_01_01"
FAULT_RATE = 0.05


def quality_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.quality_report(entities(spark, folder)))


def quality_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.quality_score(entities(spark, folder)))


def quick_check(spark: SparkSession, folder: str) -> DataFrame:
    results = quality.quick_check(entity(spark, folder, "treatments"), "treatments")
    return results.select("suite", "idx", "expectation_type", "unexpected_count", "success")


def completed_treatments(source: DataFrame, target: str) -> Pipeline:
    """Treatments with status completed, as a table of their own."""
    name, gate = "completed_treatments", has_columns(["treatment_id", "status"])
    steps = [
        Step("read", lambda _: source, gate),
        Step("select", lambda df: add_metadata_columns(df.filter("status = 'completed'"), name, AS_OF), gate),
    ]
    return Pipeline(name, steps, lambda df: df.write.mode("overwrite").parquet(target), count_source=True)


def etl_run(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "completed")
    record = completed_treatments(entity(spark, folder, "treatments"), target).run()
    stored = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("stored_rows"))
    return record.to_frame(spark).join(
        stored, F.col("records_processed") == F.col("stored_rows"), "left"
    )


def etl_metadata_columns(spark: SparkSession, folder: str) -> DataFrame:
    marked = add_metadata_columns(entity(spark, folder, "patients"), "patients_load", AS_OF)
    return marked.select(
        "patient_id", "_pipeline_name", F.col("_processed_at").cast("string").alias("_processed_at")
    )


_STORED = [
    "checkpoint", "run_name", "suite", "idx", "expectation_type", "unexpected_count", "success",
    "success_declared",
]


def checkpoint_run(spark: SparkSession, folder: str) -> DataFrame:
    check = checkpoints.standard_checkpoints()["patient_checkpoint"]
    store = scratch_path(spark, "checkpoints")
    patients = entity(spark, folder, "patients")
    results = checkpoints.run_checkpoint(check, patients, RUN, AS_OF, store)
    return results.select(*_STORED, F.col("run_time").cast("string").alias("run_time"))


def checkpoint_run_all(spark: SparkSession, folder: str) -> DataFrame:
    t = entities(spark, folder)
    tables = {
        "patient_checkpoint": t["patients"], "treatment_checkpoint": t["treatments"],
        "lab_results_checkpoint": t["lab_results"],
    }
    store = scratch_path(spark, "checkpoints")
    runs = checkpoints.run_all(checkpoints.standard_checkpoints(), tables, RUN, AS_OF, store)
    return rounded(checkpoints.outcomes(runs))


def inject_faults_query(spark: SparkSession, folder: str) -> DataFrame:
    broken = inject_faults(
        entity(spark, folder, "treatments"), "treatments", "treatment_id", FAULT_RATE, AS_OF
    )
    return rounded(
        broken.filter("fault IS NOT NULL").select(
            "treatment_id", "fault", "dosage", F.col("end_date").cast("string").alias("end_date")
        )
    )


def injected_faults_found(spark: SparkSession, folder: str) -> DataFrame:
    broken = inject_faults(
        entity(spark, folder, "lab_results"), "lab_results", "result_id", FAULT_RATE, AS_OF
    )
    results = validate(broken, catalog.lab_results())
    return results.select("idx", "expectation_type", "unexpected_count", "success")


def dataset_summary_query(spark: SparkSession, folder: str) -> DataFrame:
    t = entities(spark, folder)
    return rounded(dataset_summary(t["patients"], t["treatments"], t["lab_results"]))


def category_distribution_query(spark: SparkSession, folder: str) -> DataFrame:
    t = entities(spark, folder)
    return category_distribution(t["patients"], ["cancer_type"]).unionByName(
        category_distribution(t["treatments"], ["treatment_type"])
    )


EVENT_SUITE = (
    Suite("events").not_null("event_id").in_set("event_type", ["click", "view", "purchase"])
    .between("value", 10, 90).regex("props", r"^\{.*\}$").row_count(1)
)


def stream_validate(spark: SparkSession, folder: str) -> DataFrame:
    events = base(spark, folder, "events")
    results, source = scratch_path(spark, "batches"), scratch_path(spark, "events")
    events.repartition(4, "event_id").write.parquet(source)
    stream = file_stream(spark, source, events.schema, name_pattern="*.parquet")
    query = validate_stream(stream, EVENT_SUITE, results, scratch_path(spark, "stream"))
    query.awaitTermination()
    return stream_totals(spark, results).select(
        "suite", "idx", "expectation_type", "column", "element_count", "null_count",
        "unexpected_count", "success",
    )


KEY_SUITE = Suite("keys").unique("event_id").not_null("event_id").between("value", 10, 90)


def stream_unique_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Events of which one in fifty comes again in a later file: found over the batches, though unique in each."""
    events = base(spark, folder, "events")
    results, keys, source = scratch_path(spark, "batches"), scratch_path(spark, "keys"), scratch_path(spark, "events")
    events.coalesce(2).write.parquet(source)
    events.where("event_id % 50 = 0").coalesce(1).write.mode("append").parquet(source)
    stream = file_stream(spark, source, events.schema, name_pattern="*.parquet")
    validate_stream(stream, KEY_SUITE, results, scratch_path(spark, "stream"), keys=keys).awaitTermination()
    return stream_totals(spark, results, keys).select(
        "suite", "idx", "expectation_type", "column", "element_count", "null_count", "unexpected_count", "success"
    )


QUERIES = {
    "quality_pipeline": quality_pipeline,
    "quality_score": quality_score,
    "quick_check": quick_check,
    "etl_run": etl_run,
    "etl_metadata_columns": etl_metadata_columns,
    "checkpoint_run": checkpoint_run,
    "checkpoint_run_all": checkpoint_run_all,
    "inject_faults": inject_faults_query,
    "inject_faults_found": injected_faults_found,
    "dataset_summary": dataset_summary_query,
    "category_distribution": category_distribution_query,
    "stream_validate": stream_validate,
    "stream_unique_keys": stream_unique_keys,
}


# ---- the same in SQL -----------------------------------------------------------------------

_STANDARD = {n: catalog.STANDARD[s]() for n, s in catalog.DATASET_SUITES.items()}
_BINDINGS = {
    "patient_checkpoint": "patients", "treatment_checkpoint": "treatments",
    "lab_results_checkpoint": "lab_results",
}


def _statistics_sql(name: str) -> str:
    return f"""SELECT '{name}' AS dataset, count(*) AS evaluated,
 count(*) FILTER (WHERE success) AS successful, count(*) FILTER (WHERE NOT success) AS unsuccessful,
 100.0e0 * count(*) FILTER (WHERE success) / count(*) AS success_percent,
 100.0e0 * count(*) FILTER (WHERE success_declared) / count(*) AS success_percent_declared,
 bool_and(success) AS success, bool_and(success_declared) AS success_declared
 FROM ({suite_sql(name, _STANDARD[name])})"""


_ALL_STATS = "\nUNION ALL\n".join(_statistics_sql(n) for n in _STANDARD)


def _width(name: str) -> int:
    return len(columns_of(name))


def _profile_cells(name: str) -> str:
    cells = columns_of(name)
    nulls = " + ".join(f"(count({c}) < count(*))::int" for c in cells)
    rate = " + ".join(f"(count(*) - count({c}))" for c in cells)
    return (
        f"SELECT '{name}' AS dataset, count(*) AS row_count, {len(cells)} AS column_count, "
        f"{nulls} AS columns_with_nulls, ({rate}) * 1.0e0 / count(*) / {len(cells)} "
        f"AS avg_null_rate FROM {name}"
    )


def _melt(section: str, source: str, metrics: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{section}' AS section, dataset, '{m}' AS metric, "
        f"round(cast({m} AS double), 6) AS value FROM {source}" for m in metrics)


_QUALITY = ENTITIES[:-1] + f""",
st AS ({_ALL_STATS}),
pr AS ({chr(10).join([_profile_cells('patients'), 'UNION ALL', _profile_cells('treatments'), 'UNION ALL', _profile_cells('lab_results')])}),
an AS ({" UNION ALL ".join(iqr_sql(c, 1.5, "lab_results") for c in LAB_NUMBERS)})
{_melt('validation', 'st', ['evaluated', 'successful', 'unsuccessful', 'success_percent'])}
UNION ALL
{_melt('profile', 'pr', ['row_count', 'column_count', 'columns_with_nulls', 'avg_null_rate'])}
UNION ALL
SELECT 'anomaly', 'lab_results', "column", cast(anomaly_count AS double) FROM an
UNION ALL
SELECT 'overall', 'all', 'quality_score', round(avg(success_percent), 6) FROM st
UNION ALL
SELECT 'overall', 'all', 'anomaly_count', cast(sum(anomaly_count) AS double) FROM an
UNION ALL
SELECT 'overall', 'all', 'records_processed', cast(sum(row_count) AS double) FROM pr
UNION ALL
SELECT 'overall', 'all', 'passed', CASE WHEN bool_and(success) THEN 1.0e0 ELSE 0.0e0 END FROM st"""


def _bucket(seed: str, key: str) -> str:
    return f"cast('0x' || substr(md5(concat('{seed}:', {key})), 1, 8) AS bigint)"


_FAULTY = f"{_bucket('42', '{k}')} / 4294967296.0e0 < {FAULT_RATE}e0"
_SECOND = f"{_bucket('42-kind', '{k}')} % 2 = 1"
ORACLES = {
    "quality_pipeline": _QUALITY,
    "quality_score": ENTITIES + f"""
SELECT count(*) AS suites, round(avg(success_percent), 6) AS quality_score,
 bool_and(success) AS passed FROM ({_ALL_STATS})""",
    "quick_check": with_entities("treatments")
    + "SELECT suite, idx, expectation_type, unexpected_count, success FROM ("
    + suite_sql("treatments", _STANDARD["treatments"]) + ")",
    "etl_run": with_entities("treatments") + """
SELECT 'completed_treatments' AS pipeline, 'completed' AS status, 'write' AS step,
 count(*) AS extracted_rows, count(*) FILTER (WHERE status = 'completed') AS records_processed,
 cast(0 AS bigint) AS records_failed, 1.0e0 AS success_rate, '' AS errors,
 count(*) FILTER (WHERE status = 'completed') AS stored_rows FROM treatments""",
    "etl_metadata_columns": with_entities("patients") + f"""
SELECT patient_id, 'patients_load' AS _pipeline_name, '{AS_OF}' AS _processed_at FROM patients""",
    "checkpoint_run": with_entities("patients") + f"""
SELECT 'patient_checkpoint' AS checkpoint, '{RUN}' AS run_name, suite, idx, expectation_type,
 unexpected_count, success, success_declared, '{AS_OF}' AS run_time
FROM ({suite_sql("patients", _STANDARD["patients"])})""",
    "checkpoint_run_all": ENTITIES + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS checkpoint, '{RUN}' AS run_name, '{catalog.DATASET_SUITES[n]}' AS suite, "
        "evaluated, successful, unsuccessful, round(success_percent, 6) AS success_percent, "
        "round(success_percent_declared, 6) AS success_percent_declared, success, success_declared "
        f"FROM ({_statistics_sql(n)})" for c, n in _BINDINGS.items()),
    "inject_faults": with_entities("treatments") + f"""
SELECT treatment_id, CASE WHEN second THEN 'end_before_start' ELSE 'negative_dosage' END AS fault,
 round(CASE WHEN second THEN dosage ELSE -100.0e0 END, 6) AS dosage,
 cast(CASE WHEN second THEN start_date - 10 ELSE end_date END AS varchar) AS end_date
FROM (SELECT *, {_SECOND.format(k='treatment_id')} AS second FROM treatments
 WHERE {_FAULTY.format(k='treatment_id')})""",
    "inject_faults_found": with_entities("lab_results")[:-1] + f""",
broken AS (SELECT * REPLACE (
 CASE WHEN {_FAULTY.format(k='result_id')} AND NOT {_SECOND.format(k='result_id')} THEN -999.0e0
  ELSE result_value END AS result_value,
 CASE WHEN {_FAULTY.format(k='result_id')} AND {_SECOND.format(k='result_id')}
  THEN collection_datetime - interval '5' hour ELSE result_datetime END AS result_datetime)
 FROM lab_results)
SELECT idx, expectation_type, unexpected_count, success FROM (
{suite_sql("broken", _STANDARD["lab_results"], catalog.LAB_RESULT_COLUMNS)})""",
    "dataset_summary": ENTITIES + """
SELECT p AS patient_count, t AS treatment_count, l AS lab_result_count,
 round(t * 1.0e0 / p, 6) AS avg_treatments_per_patient,
 round(l * 1.0e0 / p, 6) AS avg_lab_results_per_patient, round(a, 6) AS abnormal_lab_rate
FROM (SELECT count(*) AS p FROM patients), (SELECT count(*) AS t FROM treatments),
 (SELECT count(*) AS l, avg(is_abnormal::int) AS a FROM lab_results)""",
    "category_distribution": ENTITIES + """
SELECT 'cancer_type' AS "column", cancer_type AS category, count(*) AS rows FROM patients GROUP BY 2
UNION ALL
SELECT 'treatment_type', treatment_type, count(*) FROM treatments GROUP BY 2""",
    "stream_validate": "SELECT suite, idx, expectation_type, \"column\", element_count, null_count, "
    "unexpected_count, success FROM ("
    + suite_sql("events", EVENT_SUITE, ["event_id", "event_type", "value", "props"]) + ")",
    "stream_unique_keys": "WITH again AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 0)\n"
    "SELECT suite, idx, expectation_type, \"column\", element_count, null_count, unexpected_count, success FROM ("
    + suite_sql("again", KEY_SUITE, ["event_id", "event_type", "value", "props"]) + ")",
}
