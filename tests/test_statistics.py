"""Quantiles, profiles, anomalies, drift and scores against brute force and known answers."""


import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veristrata.functions.text import is_title, plain_number
from veristrata.operators import anomaly, drift, isolation, profile
from veristrata.operators import quantiles as Q
from veristrata.operators.frequencies import distinct_counts
from veristrata.operators.scorecard import combine, scorecard, weighted
from veristrata.operators.validate import unexpected_rows, validate
from veristrata.plans.suite import Suite

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def frame(spark, values, name="v"):
    return spark.createDataFrame(pd.DataFrame({name: values}))


@pytest.fixture
def outliers(spark):
    """Eighty even readings around -3 with four far away, at the ends of the table."""
    far = F.col("id").isin(0, 1, 82, 83)
    return spark.range(84).select(
        "id", F.when(far, 61.5).otherwise(F.col("id") % 8 * 0.25 - 4).alias("reading")
    )


def shapes():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(50, 5, 5000),
        "heavy_tail": np.exp(rng.normal(0, 6, 5000)),
        "one_value_in_a_third": np.where(rng.random(5000) < 0.34, 3.0, rng.normal(3, 1, 5000)),
        "two_values": rng.integers(0, 2, 5000).astype(float),
        "steps": rng.integers(0, 7, 5000).astype(float),
        "constant": np.full(5000, 2.5),
        "negative": -rng.exponential(3, 5000),
        "with_nan": np.where(rng.random(5000) < 0.2, np.nan, rng.normal(0, 1, 5000)),
        "all_nan": np.full(5000, np.nan),
    }


@pytest.mark.parametrize("limit, sample", [(50_000, 200_000), (60, 1500)])
def test_exact_quantiles(spark, monkeypatch, limit, sample):
    """Also when brackets must be narrowed many times from small samples."""
    monkeypatch.setattr(Q, "OPEN_LIMIT", limit)
    monkeypatch.setattr(Q, "SAMPLE_ROWS", sample)
    data = pd.DataFrame(shapes())
    got = Q.quantile_values(spark.createDataFrame(data), list(data), PROBABILITIES)
    assert "all_nan" not in got
    for name in data:
        values = data[name].dropna()
        for p in PROBABILITIES if len(values) else []:
            want = values.quantile(p)
            assert got[name][p] == pytest.approx(want, rel=1e-12, abs=1e-12), (name, p)


def test_approximate_mode_is_close(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 100).cast("double").alias("v"))
    exact = {r.column: r for r in profile.column_profile(df).collect()}
    rough = {r.column: r for r in profile.column_profile(df, mode="approx").collect()}
    for c in ("id", "v"):
        assert rough[c].q50 == pytest.approx(exact[c].q50, rel=0.02)
        assert rough[c].unique_count == pytest.approx(exact[c].unique_count, rel=0.15)
    assert anomaly.detect(df, mode="approx").count() == 2
    with pytest.raises(ValueError):
        anomaly.detect(df, "median")


def test_profile_known_answers(spark):
    one_to_ten = frame(spark, list(range(1, 11)), "value")
    row = profile.column_profile(one_to_ten).first()
    assert (row["mean"], row["min"], row["max"], row["q50"]) == (5.5, 1.0, 10.0, 5.5)
    values = pd.Series(range(1, 11))
    assert row["skewness"] == pytest.approx(values.skew(), abs=1e-12)
    assert row["kurtosis"] == pytest.approx(values.kurtosis(), abs=1e-12)
    df = spark.createDataFrame(
        [(7, None), (8, "quartz"), (9, None), (10, None)], "rock int, kind string"
    )
    kinds = {r.column: r for r in profile.column_profile(df).collect()}
    assert (kinds["kind"].null_count, kinds["kind"].null_rate) == (3, 0.75)
    assert (kinds["kind"].min_length, kinds["kind"].max_length) == (6, 6)
    assert profile.table_profile(df).first().row_count == 4


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    r = {(x.a, x.b): x.r for x in profile.correlations(df).collect()}
    assert r[("a", "b")] is None and r[("b", "b")] == pytest.approx(1.0)
    empty = profile.column_profile(df.limit(0)).first()
    assert (empty["count"], empty["null_rate"], empty["mean"]) == (0, 0.0, None)
    assert profile.correlations(df.select("a")).count() == 0


def test_distinct_counts_of_long_and_hot_texts(spark):
    long = "x" * 300
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit(long), "id"))
        .otherwise(F.lit(long)).alias("t")
    )
    row = distinct_counts(df, ["t"]).first()
    assert (row.distinct_count, row.repeated_values, row.repeated_rows) == (302, 2, 600)
    assert abs(distinct_counts(df, ["t"], approximate=True).first().distinct_count - 302) < 40


def test_samples_are_exact_and_repeatable(spark):
    df = spark.range(5000)
    first = {r.id for r in profile.sample_rows(df, 137, ["id"]).collect()}
    second = {r.id for r in profile.sample_rows(df.repartition(7), 137, ["id"]).collect()}
    assert len(first) == 137 and first == second
    assert profile.sample_rows(df, 9999, ["id"]).count() == 5000


@pytest.mark.parametrize("method, threshold", [("iqr", 1.5), ("zscore", 3.0), ("mad", 3.5)])
def test_planted_outliers_are_found(outliers, method, threshold):
    row = anomaly.detect(outliers, method, threshold, ["reading", "absent"]).first()
    assert (row.anomaly_count, row.row_count) == (4, 84)
    found = anomaly.anomalous_rows(outliers, ["id"], method, threshold, ["reading"])
    assert {r.id for r in found.collect()} == {0, 1, 82, 83}


def test_no_spread_is_an_error_not_an_anomaly(spark):
    df = spark.range(20).select(F.lit(3).alias("c"), F.floor(F.col("id") / 19).alias("m"))
    z = {r.column: r for r in anomaly.detect(df, "zscore").collect()}
    m = {r.column: r for r in anomaly.detect(df, "mad").collect()}
    assert (z["c"].error, z["c"].anomaly_count) == ("Zero standard deviation", 0)
    assert (m["m"].error, m["m"].anomaly_count) == ("Zero MAD", 0)
    assert anomaly.summarize(anomaly.detect(df)).first().columns == 2


def test_forest_finds_planted_outliers(outliers, spark):
    found = isolation.isolation_forest(outliers, ["reading"], ["id"])
    ids = {r.id for r in found.collect()}
    assert len(ids) <= 9 and (not ids or ids & {0, 1, 82, 83})
    rng = np.random.default_rng(3)
    x, y = rng.normal(0, 1, 40_000), rng.normal(0, 1, 40_000)
    x[:5], y[:5] = 30.0, -30.0
    many = spark.createDataFrame(pd.DataFrame({"id": range(40_000), "x": x, "y": y}))
    rows = isolation.isolation_forest(many, ["x", "y"], ["id"]).collect()
    assert len(rows) <= 100 and {0, 1, 2, 3, 4} <= {r.id for r in rows}


@pytest.mark.parametrize("rows", [20_000, 40_000])
def test_forest_does_not_depend_on_partitions(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") * 37 % 1009).alias("a"), (F.col("id") * 53 % 997).alias("b"))
    one, many = (
        {(r.id, r.score) for r in isolation.isolation_forest(df.repartition(n), ["a", "b"], ["id"], trees=20).collect()}
        for n in (1, 16)
    )
    assert one == many


def test_forest_as_a_method_of_detect(outliers):
    row = anomaly.detect(outliers, "isolation_forest", columns=["reading"]).first()
    assert (row.column, row.method, row.row_count, row.lower_bound) == ("reading", "isolation_forest", 84, None)
    assert row.anomaly_count <= 9 and row.asDict().keys() == anomaly.detect(outliers, columns=["reading"]).first().asDict().keys()


def test_forest_of_few_values(spark):
    """A value is drawn as often as its rows are: all trees get their rows, in the shares of the table."""
    df = spark.range(60_000).select(F.expr("CASE WHEN id % 3 < 2 THEN 1.0D WHEN id % 100 < 99 THEN 2.0D ELSE 9.0D END").alias("v"))
    row = isolation.detect(df, ["v"]).first()
    assert (row.row_count, row.anomaly_count <= 100) == (60_000, True)
    one, many = (
        isolation._fit(isolation._numbered(df.repartition(n), ["v"]).withColumn(isolation._FOREST, F.lit(0)), ["v"],
                       ["v", isolation._COPY], [60_000], 100, 42)
        .sort_values(["tree", "node"]).reset_index(drop=True) for n in (1, 16)
    )
    assert one.equals(many)
    roots = one[one["node"] == 1]
    assert len(roots) == 100 and set(roots["leaf_rows"]) == {256} and (roots["feature"] == 0).all()
    numbered = isolation._numbered(df, ["v"])
    assert numbered.count() == numbered.distinct().count() == 60_000


def test_forests_of_many_columns_are_one_job(spark):
    """Jobs don't grow with the columns; each forest finds its planted values."""
    uniform = lambda i, k: F.pmod(F.xxhash64("id", F.lit(10 * i + k)), F.lit(10**6)) / 10**4
    df = spark.range(30_000).select(*(
        F.when(F.col("id") < 3, 10_000 + F.col("id")).when(F.col("id") % 7 == i, None)
        .otherwise(uniform(i, 0) + uniform(i, 1) + uniform(i, 2) + uniform(i, 3)).alias(f"c{i}") for i in range(6)
    ), F.lit(None).cast("int").alias("empty"), F.lit(4).alias("same"))
    tracker, groups = spark.sparkContext, {}
    for n in (1, 6):
        tracker.setJobGroup(f"forests-{n}", "")
        found = isolation.anomalous_values(df, [f"c{i}" for i in range(n)]).collect()
        groups[n] = len(tracker.statusTracker().getJobIdsForGroup(f"forests-{n}"))
        for i in range(n):
            assert {10_000.0, 10_001.0, 10_002.0} <= {r.value for r in found if r["column"] == f"c{i}"}
    tracker.setJobGroup("other", "")
    assert groups[6] <= groups[1] + 1
    report = {r.columns: r for r in isolation.detect(df).collect()}
    assert len(report) == 8 and report["empty"].row_count == 0 and report["same"].anomaly_count == 0
    assert all(3 <= report[f"c{i}"].anomaly_count <= 100 for i in range(6))


def test_draw_of_trees_is_binomial(spark):
    """Rows are candidates of a binomial number of trees, and every tree has enough of them."""
    rows, trees = 50_000, 100
    limits = np.array(isolation._thresholds(rows, trees), dtype=float) / isolation._HASHES
    times = np.searchsorted(limits, np.random.default_rng(2).random(400_000), side="right")
    share = 576 / rows
    assert abs(times.mean() - trees * share) < 0.02 and abs(times.var() - trees * share * (1 - share)) < 0.03
    assert isolation._thresholds(300, 100) == [0] * 100


def test_forest_without_columns(spark):
    assert isolation.detect(spark.createDataFrame([("x",)], "t string")).count() == 0


def test_instants_around_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(2).select(F.timestamp_seconds(1730610000 + F.col("id") * 3600).alias("t"))
        assert df.select(F.col("t").cast("string")).distinct().count() == 1
        assert profile.unique_profile(df).first().unique_count == 2
        suite = Suite("s").unique("t")
        assert validate(df, suite).first().success
        assert unexpected_rows(df, suite).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_doubles_in_patterns(spark):
    values = {12345678.0: "12345678.0", 1e16: "1e+16", 1.5e-7: "1.5e-07", 0.00012: "0.00012", 0.5: "0.5", -1e7: "-10000000.0",
              1.25e300: "1.25e+300", 123456789.125: "123456789.125", 0.0: "0.0"}
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert {r[0]: r[1] for r in df.select("v", plain_number(df["v"])).collect()} == values == {v: repr(v) for v in values}


def test_top_values_beyond_the_planned_limit(spark):
    df = spark.range(6000).select((F.col("id") % 2500).cast("string").alias("v"))
    top = profile.top_value_profile(df, 2000).collect()
    assert len(top) == 2000 and {r.occurrences for r in top} == {2, 3} and top[0].rank >= 1


def test_no_common_numbers(spark):
    df = spark.createDataFrame([("x",)], "t string")
    assert drift.statistical_drift(df, df).count() == 0


def test_task_functions_do_not_import_the_package():
    code = (
        "import pickle, sys; import numpy as np; grow = pickle.loads(sys.stdin.buffer.read()); "
        "print(len(grow(0, np.arange(8.0).reshape(-1, 1), 1)))"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(isolation._grow_tree),
        capture_output=True, cwd="/tmp", env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert done.stdout.strip().isdigit(), done.stderr


def ks_brute(a, b):
    a, b = np.sort(a[~np.isnan(a)]), np.sort(b[~np.isnan(b)])
    every = np.concatenate([a, b])
    f = np.searchsorted(a, every, side="right") / len(a)
    g = np.searchsorted(b, every, side="right") / len(b)
    return np.abs(f - g).max()


def test_ks_against_brute_force(spark):
    rng = np.random.default_rng(5)
    data = shapes()
    del data["all_nan"]
    other = {n: v[rng.permutation(5000)][:3000] * rng.choice([1.0, 1.01]) for n, v in data.items()}
    other["normal"] = other["normal"] + 20
    reference, current = (spark.createDataFrame(pd.DataFrame(d)) for d in (data, other))
    got = {r.column: r for r in drift.distribution_drift(reference, current, threshold=0.05).collect()}
    for name in data:
        assert got[name].drift_score == pytest.approx(ks_brute(data[name], other[name]), abs=1e-12), name
    assert got["normal"].drift_detected
    assert got["with_nan"].reference_count == np.count_nonzero(~np.isnan(data["with_nan"]))


def test_schema_drift(spark):
    ab = spark.createDataFrame([(1, 2)], "a int, b int")
    abc = ab.withColumn("c", F.lit(1))
    assert not drift.schema_drift(ab, ab).first().drift_detected
    assert drift.schema_drift(ab, abc).first().columns_added == "c"
    gone = drift.schema_drift(abc, ab).first()
    assert (gone.columns_removed, gone.drift_score) == ("c", pytest.approx(1 / 3))


def test_scorecard_weights_give_the_published_example(spark):
    scores = {
        "completeness": 1.0, "uniqueness": 0.845, "validity": 1.0, "consistency": 1.0,
        "timeliness": 0.262, "accuracy": 1.0,
    }
    long = spark.createDataFrame(list(scores.items()), "dimension string, score double")
    row = combine(weighted(long)).first()
    assert row.overall_score == pytest.approx(0.88155) and row.grade == "B"


def test_scorecard_of_an_empty_table(spark):
    df = spark.createDataFrame([], "patient_id string, v double, seen_date date")
    row = scorecard(df, "empty", "2025-01-01 00:00:00").first()
    assert row.overall_score is None and row.grade == "F"


def test_title_case_is_that_of_python(spark):
    texts = ["O'Neil", "O'neil", "Main St", "main St", "ABC", "A1b", "A1B", "", " ", "Él Ñu", "éa",
             "Dr. Smith", "x-Ray", "X-Ray", "McDonald", "12 Main"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", is_title(F.col("t")).alias("title")).collect():
        assert r.title == (r.t == r.t.title()), r.t
