"""Chunks, split files, statements in one pass, keys over batches, and profiles that add up."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veristrata.operators import drift, sketches
from veristrata.operators.records import standardize
from veristrata.plans import catalog
from veristrata.plans.suite import Suite
from veristrata.session import scratch_database
from veristrata.sources import files, tables
from veristrata.sources.chunks import chunks, with_chunks
from veristrata.streaming.microbatch import file_stream, stream_totals, validate_stream


def test_chunks_hold_every_row_once(spark):
    df = spark.range(0, 1003, 1, 7)
    sizes = {r.chunk: r["count"] for r in with_chunks(spark.range(0, 1003, 1, 7), 100).groupBy("chunk").count().collect()}
    assert sizes == {i: 100 for i in range(10)} | {10: 3}
    parts = [sorted(r.id for r in c.collect()) for c in chunks(spark.range(0, 1003, 1, 7), 400)]
    assert [len(p) for p in parts] == [400, 400, 203] and sorted(sum(parts, [])) == list(range(1003))
    assert list(chunks(spark.range(0), 10)) == []
    with pytest.raises(ValueError, match="size"):
        with_chunks(df, 0)


TEXTS = ["plain", "two\nlines", "cr\r\nlf", "back\\slash", "\\n", "\\\\n", "a\\\nb", "quote \" and, comma", "\\", "\\\\\\r\n\\", " x ", None]


def test_one_line_files_are_split(spark, folder):
    rows = [(i, TEXTS[i % len(TEXTS)], "pad" * 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, t string, p string").coalesce(1)
    files.write_csv(df, f"{folder}/t", one_line=True)
    written = [f for f in os.listdir(f"{folder}/t") if f.endswith(".csv")]
    with open(f"{folder}/t/{written[0]}", newline="") as file:
        assert len(written) == 1 and file.read().count("\n") == 3001
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        back = files.read_csv(spark, f"{folder}/t", df.schema, one_line=True)
        assert back.rdd.getNumPartitions() > 4
        assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(rows, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_failing_statement_leaves_the_table(spark):
    db = scratch_database(spark, "atomic")
    tables.append(spark.range(100), "x", db)
    late = F.when(F.col("id") == 99, F.raise_error(F.lit("no")).cast("long")).otherwise(F.lit(-1))
    with pytest.raises(Exception, match="no"):
        tables.update(spark, "x", F.col("id") > 50, {"id": late}, db)
    assert sorted(r.id for r in spark.table(f"{db}.x").collect()) == list(range(100))
    assert tables.update(spark, "x", F.col("id") > 50, {"id": F.lit(-1)}, db) == 49
    assert tables.delete(spark, "x", F.col("id") < 10, db) == 59
    assert tables.append(spark.range(200, 203), "x", db) == 3
    assert sorted(r.id for r in spark.table(f"{db}.x").collect()) == [*range(10, 51), 200, 201, 202]
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").saveAsTable(f"{db}.parted")
    with pytest.raises(ValueError, match="partitioned"):
        tables.delete(spark, "parted", F.col("id") == 1, db)


def test_schema_report_has_the_defaults(spark):
    db = scratch_database(spark, "defaults")
    spark.sql(f"CREATE TABLE {db}.t (a INT DEFAULT 5, b STRING DEFAULT 'x', c DOUBLE) USING parquet")
    got = {r["column"]: r.default for r in tables.table_schema(spark.table(f"{db}.t")).collect()}
    assert got == {"a": "5", "b": "'x'", "c": None}


def test_keys_that_repeat_in_another_batch(spark, folder):
    source, results, keys = f"{folder}/in", f"{folder}/out", f"{folder}/keys"
    suite = Suite("s").unique("id").not_null("id").unique("v")
    schema = "id long, v string"
    part = lambda a, b: spark.range(a, b).select("id", F.concat(F.lit("v"), "id").alias("v")).coalesce(1)
    part(0, 50).write.mode("append").parquet(source)
    part(40, 60).write.mode("append").parquet(source)
    run = lambda: validate_stream(
        file_stream(spark, source, spark.createDataFrame([], schema).schema), suite, results, f"{folder}/cp", keys=keys
    ).awaitTermination()
    run()
    plain = {r.idx: r for r in stream_totals(spark, results).collect()}
    assert plain[0].success and plain[0].unexpected_count == 0
    totals = {r.idx: r for r in stream_totals(spark, results, keys).collect()}
    assert (totals[0].unexpected_count, totals[0].success, totals[1].success) == (20, False, True)
    run()  # a restart finds nothing new
    assert {r.idx: r.unexpected_count for r in stream_totals(spark, results, keys).collect()} == {0: 20, 1: 0, 2: 20}
    part(0, 1).write.mode("append").parquet(source)
    run()
    totals = {r.idx: r for r in stream_totals(spark, results, keys).collect()}
    assert totals[0].unexpected_count == 22 and totals[0].batches == 3


def test_profiles_of_parts_add_up(spark, folder):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"n": rng.normal(size=20_000) + 1e6, "k": rng.integers(0, 5000, 20_000), "same": 3})
    frame.loc[::9, "n"] = np.nan
    df = spark.createDataFrame(frame).select("*", F.when(F.col("k") % 5 > 0, F.concat(F.lit("t"), "k")).alias("t"), F.lit(None).cast("int").alias("none"))
    for i in range(3):
        sketches.sketch_profile(df.where(F.col("k") % 3 == i)).write.parquet(f"{folder}/p{i}")
    parts = [spark.read.parquet(f"{folder}/p{i}") for i in range(3)]
    empty = sketches.sketch_profile(df.where("false"))
    whole = {r["column"]: r for r in sketches.report(sketches.sketch_profile(df)).collect()}
    for combined in (sketches.combine(*parts, empty), sketches.combine(sketches.combine(*parts[:2]), parts[2])):
        got = {r["column"]: r for r in sketches.report(combined).collect()}
        assert got.keys() == whole.keys()
        for c, r in got.items():
            w = whole[c]
            assert (r["count"], r.null_count, r.min, r.max) == (w["count"], w.null_count, w.min, w.max)
            assert (r.mean, r.std) == (w.mean, w.std) or (r.mean, r.std) == (pytest.approx(w.mean), pytest.approx(w.std, rel=1e-6, abs=1e-9))
        known = frame["n"].dropna()
        for p in (25, 50, 75):
            assert abs((known <= got["n"][f"q{p}"]).mean() - p / 100) < 2 * sketches.KLL_ERROR
        assert abs(got["t"].unique_count - 4000) <= 4000 * sketches.HLL_ERROR and got["t"].q50 is None
        assert (got["same"].unique_count, got["same"].std, got["none"].unique_count, got["none"].mean) == (1, 0.0, 0, None)


def test_changed_columns_with_their_missing_values(spark):
    old = spark.createDataFrame([(1, None, 2.0), (2, "x", None)], "a int, gone string, b double")
    new = spark.createDataFrame([("1", None), (None, 5)], "a string, fresh int").withColumn("b", F.lit(1.0))
    got = {r["column"]: tuple(r)[1:] for r in drift.schema_changes(old, new).collect()}
    assert got == {
        "a": ("retyped", "int", "string", 0, 1), "gone": ("removed", "string", None, 1, None),
        "fresh": ("added", None, "int", None, 1),
    }
    assert drift.schema_changes(old, old).collect() == []
    removed = drift.schema_changes(old, old.drop("b")).first()
    assert (removed["column"], removed.reference_nulls, removed.current_nulls) == ("b", 1, None)


def test_ids_and_enumerations_as_text(spark):
    uuid = bytes(range(16))
    df = spark.createDataFrame([(uuid, 7, " F "), (b"\x01", None, None)], "patient_id binary, race int, gender string")
    rows = standardize(df, "patients", as_text=True).collect()
    assert [r.patient_id for r in rows] == ["00010203-0405-0607-0809-0a0b0c0d0e0f", "01"]
    assert [(r.race, r.gender) for r in rows] == [("7", "F"), ("U", None)]


def test_short_suite_lists_its_columns():
    assert len(catalog.PATIENT_SHORT_COLUMNS) == 15 and set(catalog.PATIENT_SHORT_COLUMNS) <= set(catalog.PATIENT_COLUMNS)
