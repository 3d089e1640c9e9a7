"""Hot keys, exact selections and bounded groups: what must hold whatever the number of rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tests.test_statistics import ks_brute
from veristrata.operators import drift, hotkeys, integrity, profile, selection, validate
from veristrata.plans.suite import Suite


def test_ks_of_a_million_values_in_small_ranges(spark, monkeypatch):
    """Few cells and ranges of a thousand values: cut again and again, and the result is exact."""
    monkeypatch.setattr(drift, "RANKED", 1000)
    monkeypatch.setattr(drift, "KNOTS", [0.0, 0.5, 1.0])
    monkeypatch.setattr(drift, "CELLS_PER_KNOT", 2)
    groups, rank = [], drift._ranked
    monkeypatch.setattr(drift, "_ranked", lambda values: groups.append(values) or rank(values))
    rng = np.random.default_rng(8)
    n = 500_000
    reference = pd.DataFrame({"same": rng.normal(size=n), "ties": rng.integers(0, 3000, n) * 1.0, "late": rng.exponential(size=n) ** 9})
    current = pd.DataFrame({"same": rng.normal(size=n), "ties": rng.integers(0, 3000, n) * 1.0, "late": rng.exponential(size=n) ** 9})
    current.loc[:4000, "late"] += 1e-6
    a, b = spark.createDataFrame(reference), spark.createDataFrame(current)
    got = {r["column"]: r.drift_score for r in drift.distribution_drift(a, b).collect()}
    for name in reference:
        assert got[name] == pytest.approx(ks_brute(reference[name].to_numpy(), current[name].to_numpy()), abs=1e-12), name
    largest = [v.groupBy("c", "part").count().agg(F.max("count")).first()[0] or 0 for v in groups]
    assert len(groups) > 1 and 0 < max(largest) <= 1000


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_rows_of_a_repeated_value_stay_where_they_are(spark, adaptive):
    """A third of the rows has one value; no task is given them, adaptive execution or not."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        i = F.col("id")
        df = spark.range(0, 30_000, 1, 10).select(
            "id", F.when(i % 3 == 0, "hot").when(i % 3 == 1, i.cast("string")).otherwise(F.floor(i / 6).cast("string")).alias("k"),
            F.when(i % 7 == 0, None).otherwise(i % 20_000).alias("m"), F.lit("text").alias("_key"),
        )
        bad = validate.unexpected_rows(df, Suite("s").unique("k").not_null("m").unique("m").between("id", 0, 29_990))
        rows = df.toPandas()
        flags = [rows["k"].duplicated(keep=False), rows["m"].isna(), rows["m"].duplicated(keep=False) & rows["m"].notna(), rows["id"] > 29_990]
        want = {int(r): [j for j, f in enumerate(flags) if f[n]] for n, r in enumerate(rows["id"])}
        got = bad.select("*", F.spark_partition_id().alias("part")).toPandas()
        assert {r.id: list(r.violations) for r in got.itertuples()} == {k: v for k, v in want.items() if v}
        assert list(bad.columns) == [*df.columns, "violations"]
        hot = got[got["k"] == "hot"]
        assert len(hot) == 10_000 and hot["part"].value_counts().max() <= 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_clean_rows_are_not_shuffled_for_uniqueness(spark):
    df = spark.range(1000).withColumn("t", F.col("id").cast("string"))
    plan = plan_of(validate.unexpected_rows(df, Suite("s").unique("id").not_null("t")))
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "date"])
def test_orphans_of_hot_and_rare_keys(spark, kind):
    i = F.col("id")
    key = F.when(i % 3 == 0, -1).when(i % 3 == 1, i % 40).when(i % 11 == 0, None).otherwise(i)
    as_kind = (lambda c: F.date_add(F.lit("2020-01-01"), c.cast("int"))) if kind == "date" else (lambda c: c.cast(kind))
    child = spark.range(0, 9000, 1, 9).select("id", as_kind(key).alias("k"))
    parent = spark.range(0, 40).select(as_kind(F.col("id")).alias("p"))
    found = integrity.orphans(child, parent, "k", "p")
    assert found.columns == ["id", "k"]
    want = [n for n in range(9000) if n % 3 == 0 or (n % 3 == 2 and n % 11 != 0 and n >= 40)]
    assert sorted(r.id for r in found.collect()) == want
    assert integrity.orphans(parent.withColumnRenamed("p", "k"), parent, "k", "p").collect() == []


def test_key_filter_lets_its_keys_through(spark):
    keys = spark.createDataFrame([(0.0,), (float("nan"),), (1.5,)], "k double")
    holds = hotkeys.key_filter(keys, "k")
    probe = spark.createDataFrame([(-0.0,), (float("nan"),), (1.5,), (None,), *[(float(n),) for n in range(100, 400)]], "k double")
    got = [r.h for r in probe.select(holds(F.col("k")).alias("h")).collect()]
    assert got[:4] == [True, True, True, False] and sum(got[4:]) < 3
    many = spark.range(300_000)
    assert many.filter(~hotkeys.key_filter(many, "id")(F.col("id"))).count() == 0


def sorted_sample(df, n, key):
    """The sample by a sort, as brute force."""
    rows = df.select("*", selection.digest_of("42", *[F.col(k) for k in key]).alias("_d")).toPandas()
    return rows.sort_values(["_d", *key]).head(n).drop(columns="_d")


@pytest.mark.parametrize("few", [1000, 1])
@pytest.mark.parametrize("n", [1, 137, 4999])
def test_samples_equal_those_of_a_sort(spark, monkeypatch, few, n):
    monkeypatch.setattr(selection, "FEW", few)
    df = spark.range(5000).withColumn("name", F.concat(F.lit("n"), F.col("id") % 900))
    sample = profile.sample_rows(df, n, ["id", "name"])
    assert sorted(r.id for r in sample.collect()) == sorted(sorted_sample(df, n, ["id", "name"])["id"])
    plan = plan_of(sample)
    assert "Limit" not in plan and "Sort" not in plan and "Exchange" not in plan


def test_samples_of_repeated_rows_have_the_exact_size(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                  F.when(F.col("id") % 2 == 0, "x").alias("t"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    for n in (1, 10, 500, 1000, 1400, 2999, 3000, 5000):
        assert profile.sample_rows(df, n, ["k"]).count() == min(n, 3000)
    every = df.withColumn("m", F.to_json("m")).groupBy("k", "t", "m").count()
    taken = profile.sample_rows(df, 1400, ["k"]).withColumn("m", F.to_json("m")).groupBy("k", "t", "m").agg(F.count("*").alias("taken"))
    assert taken.join(every, taken["k"].eqNullSafe(every["k"]) & taken["t"].eqNullSafe(every["t"]) & (taken["m"] == every["m"])).filter("taken > count").count() == 0
    assert profile.sample_rows(df.filter("false"), 3, ["k"]).count() == 0


@pytest.mark.parametrize("order", [["v"], ["name", "id"], ["gap", "id"]])
def test_first_rows_of_a_large_limit(spark, monkeypatch, order):
    monkeypatch.setattr(selection, "HEAP_ROWS", 10)
    df = spark.range(0, 20_000, 1, 7).select(
        "id", F.xxhash64("id").alias("v"), F.concat(F.lit("n"), F.col("id") % 1000).alias("name"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 50).alias("gap"), F.lit(1).alias("_place"),
    )
    for n in (11, 4000, 7000, 25_000):
        got = selection.first_rows(df, n, order)
        assert got.columns == df.columns
        want = [r.id for r in df.orderBy(*order).limit(n).collect()]
        assert sorted(r.id for r in got.collect()) == sorted(want)
    assert selection.first_rows(df, 300).count() == 300 and selection.first_rows(df, 5, ["id"]).count() == 5


def scans(monkeypatch):
    from veristrata.operators import quantiles as Q

    seen, scan = [], Q._scan
    monkeypatch.setattr(Q, "_scan", lambda df, aggregates: seen.append(1) or scan(df, aggregates))
    return seen


def wide_shapes(n, rng):
    return {
        "normal": rng.normal(size=n), "skewed": rng.exponential(size=n) ** 6, "ties": rng.integers(0, 20, n) * 1.0,
        "hot": np.where(rng.random(n) < 0.7, 5.0, rng.normal(size=n)), "two": rng.integers(0, 2, n) * 1e9,
        "gaps": np.where(rng.random(n) < 0.9, np.nan, rng.normal(size=n)), "steps": np.round(rng.normal(size=n), 1),
        "far": rng.normal(size=n) + 1e12,
    }


def test_quartiles_in_three_passes(spark, monkeypatch):
    """Sketch, proof, and opening together with the other statistics; the same numbers as numpy's."""
    monkeypatch.setattr("veristrata.operators.quantiles.OPEN_LIMIT", 3000)
    data = wide_shapes(120_000, np.random.default_rng(3))
    df = spark.createDataFrame(pd.DataFrame({c: data[c] for c in ("normal", "skewed", "far")}))
    seen = scans(monkeypatch)
    got = {r["column"]: r for r in profile.numeric_profile(df).collect()}
    assert len(seen) == 2  # the third is the report itself
    for name in df.columns:
        want = np.quantile(data[name], [0.25, 0.5, 0.75])
        assert [got[name][q] for q in ("q25", "q50", "q75")] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("limit", [2500, 8000, 200_000, 40])
def test_median_deviations_in_four_passes(spark, monkeypatch, limit):
    from veristrata.operators import quantiles as Q

    monkeypatch.setattr(Q, "OPEN_LIMIT", limit)
    data = wide_shapes(120_000, np.random.default_rng(4))
    df = spark.createDataFrame(pd.DataFrame(data | {"none": np.nan, "same": 3.0}))
    seen = scans(monkeypatch)
    got = Q.median_deviations(df, df.columns)
    assert "none" not in got and got["same"] == (3.0, 0.0)
    for name, values in data.items():
        known = values[~np.isnan(values)]
        median = np.median(known)
        assert got[name] == pytest.approx((median, np.median(np.abs(known - median))), rel=1e-12), name
    if limit > 2500:
        seen.clear()
        Q.median_deviations(df, ["normal", "gaps", "far"])
        assert len(seen) <= 4


def test_correlations_of_many_columns_in_one_scan(spark, folder):
    rng = np.random.default_rng(6)
    n, width = 3000, 40
    base = rng.normal(size=(n, 3))
    x = base @ rng.normal(size=(3, width)) + rng.normal(size=(n, width)) * 0.3 + 1e6
    x[rng.random((n, width)) < 0.1] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(width)])
    frame["c3"], frame["c4"], frame["c5"] = 0.1, np.nan, frame["c5"].round(0)
    spark.createDataFrame(frame).repartition(5).write.parquet(f"{folder}/wide")
    df = spark.read.parquet(f"{folder}/wide")
    found = profile.correlations(df)
    plan = plan_of(found)
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1
    got = found.collect()
    assert len(got) == width * width
    want = frame.corr()
    for a, b, r in got:
        w = want.loc[a, b]
        assert (r is None) if np.isnan(w) else r == pytest.approx(w, abs=1e-9), (a, b)
    infinite = spark.createDataFrame(frame.head(50).assign(c0=np.inf))
    odd = {(a, b): r for a, b, r in profile.correlations(infinite).collect()}
    assert np.isnan(odd["c0", "c1"]) and not np.isnan(odd["c1", "c2"]) and odd["c3", "c1"] is None
