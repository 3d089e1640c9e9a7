"""Sources, sinks, statements, streams, checkpoints and pipelines."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from veristrata.operators.anomaly import detect
from veristrata.operators.faults import inject_faults
from veristrata.operators.integrity import children_per_parent, orphan_keys, orphans
from veristrata.operators.profile import profile_summary
from veristrata.operators.records import quarantined_rows, valid_rows, with_violations
from veristrata.operators.validate import statistics, validate, validate_many
from veristrata.plans import catalog
from veristrata.plans.checkpoints import Checkpoint, outcomes, run_all, run_checkpoint
from veristrata.plans.etl import Pipeline, Step, StepFailed, has_columns
from veristrata.plans.quality import quality_report, quality_score, suite_statistics
from veristrata.plans.suite import Suite
from veristrata.session import scratch_database, shared_dir
from veristrata.sources import files, tables
from veristrata.sources.entities import entities
from veristrata.streaming.microbatch import file_stream, stream_totals, validate_stream

AS_OF = "2025-01-01 00:00:00"
GOOD = {
    "patient_id": "north-17", "mrn": "MRN90817263", "first_name": "Ines", "last_name": "Varga",
    "date_of_birth": date(1948, 11, 3), "gender": "F", "race": "A", "ethnicity": "H",
    "address_line1": "7 Quay Lane", "city": "Duluth", "state": "MN", "zip_code": "55802",
    "phone": "218-555-0144", "email": "ines@varga.example", "primary_diagnosis_code": "C34.9",
    "primary_diagnosis_date": date(2021, 2, 8), "cancer_type": "lung", "cancer_stage": "IV",
    "created_at": datetime(2022, 5, 4), "updated_at": datetime(2022, 5, 5),
}
BAD = GOOD | {
    "patient_id": "north-18", "mrn": "12", "first_name": "", "date_of_birth": date(2071, 4, 9),
    "gender": "q", "state": "Minn.", "zip_code": "5580", "phone": None, "email": None,
    "primary_diagnosis_code": "34", "primary_diagnosis_date": date(2044, 7, 7),
    "cancer_type": "other?", "cancer_stage": "9",
}


def patients(spark, *rows):
    types = {"date_of_birth": "date", "primary_diagnosis_date": "date", "created_at": "timestamp",
             "updated_at": "timestamp"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in GOOD)
    return spark.createDataFrame([tuple(r[c] for c in GOOD) for r in rows], schema)


def test_good_and_bad_records(spark):
    df = patients(spark, GOOD, BAD)
    assert [r.patient_id for r in valid_rows(df, "patients", AS_OF).collect()] == ["north-17"]
    bad = quarantined_rows(df, "patients", AS_OF).first()
    assert {v.split(".")[0] for v in bad.violations} == {
        "mrn", "first_name", "date_of_birth", "gender", "state", "zip_code",
        "primary_diagnosis_code", "primary_diagnosis_date", "cancer_type", "cancer_stage"}
    assert all(r.success for r in validate(patients(spark, GOOD), catalog.patients()).collect())


def test_defaults_and_required(spark):
    row = with_violations(
        patients(spark, GOOD | {"race": None, "city": None, "last_name": "  Varga "}), "patients", AS_OF
    ).first()
    assert (row.race, row.last_name, row.violations) == ("U", "Varga", ["city.required"])


def test_orphans_with_a_hot_key(spark):
    child = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("k"))
    parent = spark.range(50).select(F.col("id").alias("k"))
    assert orphans(child, parent, "k").count() == 1000
    assert [tuple(r) for r in orphan_keys(child, parent, "k").collect()] == [(-1, 1000)]


def test_faults_break_what_they_should(spark):
    df = spark.range(2000).select(
        F.col("id").cast("string").alias("treatment_id"), F.lit(1.0).alias("dosage"),
        F.lit(date(2024, 1, 20)).alias("start_date"), F.lit(date(2024, 2, 1)).alias("end_date"))
    broken = inject_faults(df, "treatments", "treatment_id", 0.1, AS_OF).collect()
    faults = [r for r in broken if r.fault]
    assert 130 < len(faults) < 270 and {r.fault for r in faults} == {"negative_dosage", "end_before_start"}
    assert all(r.dosage == -100.0 for r in faults if r.fault == "negative_dosage")
    assert all(r.end_date == date(2024, 1, 10) for r in faults if r.fault == "end_before_start")
    assert all(r.dosage == 1.0 for r in broken if not r.fault)


def test_csv_keeps_leading_zeros_with_a_schema(spark, folder):
    df = spark.createDataFrame([("02101", 1), (None, 2)], "zip string, n int")
    paths = files.export({"t": df}, folder, "csv", summary=df.agg(F.count("*").alias("n")))
    back = files.read_csv(spark, paths["t"], df.schema)
    assert sorted(back.collect(), key=lambda r: r.n)[0].zip == "02101"
    assert spark.read.json(paths["summary"]).first().n == 2
    assert files.read_csv(spark, paths["t"]).schema["zip"].dataType.simpleString() == "int"


def test_csv_cells_of_any_text(spark, folder):
    texts = ['He said ""', 'a,b', 'two\nlines', '"', '""', " edge ", "", None, "é\\n", "\\", '\\"', "a\r\nb", "#x"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    files.write_csv(df, f"{folder}/t")
    back = {r.n: r.t for r in files.read_csv(spark, f"{folder}/t", df.schema).collect()}
    assert back == dict(enumerate(texts)) | {6: None}  # an empty cell is missing, quoted or not


def test_assets(spark, folder):
    for name in ("a", "b"):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write("x\n1\n2\n")
    with open(f"{folder}/notes.txt", "w") as f:
        f.write("no asset")
    assert sorted(r.asset for r in files.assets(spark, folder).collect()) == ["a", "b"]
    df = files.read_assets(spark, folder, "x int")
    assert {(r.asset, r.x) for r in df.collect()} == {("a", 1), ("a", 2), ("b", 1), ("b", 2)}


def test_statements_on_tables(spark):
    db = scratch_database(spark, "t")
    assert not tables.table_exists(spark, "x", db)
    assert tables.append(spark.range(10), "x", db) == 10
    assert tables.append(spark.range(10, 15), "x", db) == 5
    assert tables.table_exists(spark, "x", db)
    assert tables.update(spark, "x", F.col("id") < 3, {"id": F.lit(100)}, db) == 3
    assert tables.delete(spark, "x", F.col("id") == 100, db) == 3
    assert spark.table(f"{db}.x").count() == 12
    assert tables.delete(spark, "x", F.col("id") > 1000, db) == 0
    tables.truncate(spark, "x", db)
    assert tables.row_count(spark.table(f"{db}.x")).first().row_count == 0


def test_parameters_are_values_not_text(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    found = tables.query(spark, "SELECT * FROM {t} WHERE k = :k OR k = :k2",
                         {"k": "a", "k2": "' OR true"}, t=df)
    assert [r.k for r in found.collect()] == ["a"]


def test_stream_counts_add_up(spark, folder):
    source, results = f"{folder}/in", f"{folder}/out"
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    df.repartition(4).write.parquet(source)
    suite = Suite("s").between("v", 0, 4).not_null("id").row_count(1)
    query = validate_stream(file_stream(spark, source, df.schema), suite, results, f"{folder}/cp")
    query.awaitTermination()
    totals = {r.idx: r for r in stream_totals(spark, results).collect()}
    batch = {r.idx: r for r in validate(df, suite).collect()}
    assert totals[0].batches == 4
    assert all(totals[i].element_count == 100 for i in totals)
    assert all(totals[i].unexpected_count == batch[i].unexpected_count for i in (0, 1))
    again = validate_stream(file_stream(spark, source, df.schema), suite, results, f"{folder}/cp")
    again.awaitTermination()
    assert stream_totals(spark, results).filter("idx = 0").first().element_count == 100


def test_checkpoint_replaces_its_own_run(spark, folder):
    check = Checkpoint("c", Suite("s").unique("id").row_count(5))
    for _ in range(2):
        results = run_checkpoint(check, spark.range(3), "run1", AS_OF, folder)
    run_checkpoint(check, spark.range(9), "run2", AS_OF, folder)
    assert results.count() == 2
    stored = spark.read.parquet(folder)
    got = {r.run_name: r.success for r in outcomes(stored).collect()}
    assert got == {"run1": False, "run2": True}


def copying(source, target, required=(), count_source=False):
    steps = [
        Step("fetch", lambda _: source, has_columns(required)),
        Step("keep", lambda df: df.filter("id >= 4")),
    ]
    return Pipeline("copying", steps, lambda df: df.write.parquet(target), count_source)


def test_pipeline_writes_and_counts(spark, folder):
    seen = []
    record = copying(spark.range(10), f"{folder}/a", ["id"], count_source=True).run(lambda r: seen.append((r.step, r.status)))
    assert (record.status, record.extracted_rows, record.records_processed) == ("completed", 10, 6)
    assert record.success_rate == 1.0
    assert seen == [("fetch", "running"), ("keep", "running"), ("write", "running"), ("write", "completed")]


def test_pipeline_stops_where_it_fails(spark, folder):
    record = copying(spark.range(10), f"{folder}/b", ["id", "when", "who"]).run()
    assert (record.status, record.step, record.errors) == ("failed", "fetch", ("no column when", "no column who"))
    assert record.success_rate == 0.0
    spark.range(1).write.parquet(f"{folder}/c")
    with pytest.raises(StepFailed) as failure:
        copying(spark.range(3), f"{folder}/c").run(strict=True)
    assert failure.value.record.step == "write" and failure.value.record.status == "failed"


def test_pipeline_filters_reach_the_scan(spark, sf_dir, folder):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    steps = [Step("read", lambda _: orders), Step("open", lambda df: df.filter("o_orderstatus = 'O'"))]
    plan = Pipeline("p", steps, lambda df: None).plan()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,O)" in plan


def test_nothing_given(spark):
    assert quality_score({}).first().quality_score == 0.0
    assert quality_report({}).filter("metric = 'quality_score'").first().value == 0.0
    assert run_all({}, {}, "r", AS_OF).count() == 0
    assert validate_many({}).count() == 0
    empty = statistics(validate(spark.range(3), Suite("none")), suite="none").first()
    assert (empty.suite, empty.evaluated, empty.success) == ("none", 0, True)


def test_children_count_once_under_repeated_parents(spark):
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (1,)], "k int")
    row = children_per_parent(parent, child, "k").first()
    assert tuple(row) == (2, 2, 1.0, 1)


def test_quality_score_of_some_tables(spark):
    row = quality_score({"patients": patients(spark, GOOD)}).first()
    assert (row.suites, row.quality_score, row.passed) == (1, 100.0, True)


def test_shared_folder_is_the_configured_one(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "x"

        def __init__(self, value):
            self.value = value

        def getConf(self):
            return {"spark.checkpoint.dir": self.value} if self.value else {}

        def getCheckpointDir(self):
            return self.value

    class Session:
        def __init__(self, value):
            self.sparkContext = Context(value)

    assert shared_dir(Session("hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        shared_dir(Session(None))


def test_quality_report_equals_its_parts(spark, sf_dir):
    every = entities(spark, sf_dir)
    for given in (every, {"lab_results": every["lab_results"].limit(0)}, {"patients": every["patients"], "other": None}):
        got = {tuple(r)[:3]: r.value for r in quality_report(given).collect()}
        want = {}
        names = [n for n in ("patients", "treatments", "lab_results") if given.get(n) is not None]
        for r in suite_statistics(given).collect():
            for m in ("evaluated", "successful", "unsuccessful", "success_percent"):
                want["validation", r.dataset, m] = r[m]
        for n in names:
            r = profile_summary(given[n], n).first()
            for m in ("row_count", "column_count", "columns_with_nulls", "avg_null_rate"):
                want["profile", n, m] = r[m]
        if "lab_results" in names:
            for r in detect(given["lab_results"], "iqr", 1.5).collect():
                want["anomaly", "lab_results", r.column] = r.anomaly_count
        rows = sum(v for k, v in want.items() if k[2] == "row_count")
        failed = sum(v for k, v in want.items() if k[2] == "unsuccessful")
        assert got["overall", "all", "records_processed"] == rows
        assert got["overall", "all", "passed"] == (failed == 0)
        assert {k: v for k, v in got.items() if k[0] != "overall"} == pytest.approx(want)
