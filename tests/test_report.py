"""The whole profile of a table against plain counts."""

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_of
from veristrata.operators import profile, report

LONG = "long text " * 40


@pytest.fixture
def mixed(spark):
    """Long and short texts, a value in a third of the rows, missing values, clashing and odd names."""
    rows = []
    for i in range(300):
        text = LONG if i % 3 == 0 else f"{LONG}{i % 7}" if i % 3 == 1 else f"t{i % 11}"
        rows.append((i, None if i % 10 == 0 else text, float(i % 13), float("nan") if i % 17 == 0 else i * 0.5, i % 2 == 0, None))
    df = spark.createDataFrame(rows, "count long, text string, mark double, `a.b` double, flag boolean, nothing string")
    return df.withColumn("at", F.timestamp_seconds(F.col("count") % 4 * 3600)).repartition(5)


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_report_against_plain_counts(mixed):
    got = by_column(report.profile(mixed, "mixed", k=4))
    rows = [r.asDict() for r in profile.normalize_missing(mixed).withColumn("at", F.col("at").cast("string")).collect()]
    assert set(got) == set(mixed.columns)
    for c, r in got.items():
        values = [x[c] for x in rows if x[c] is not None]
        shown = [str(v).lower() if isinstance(v, bool) else str(v) for v in values]
        counts = Counter(shown)
        assert (r["name"], r["row_count"], r["null_count"], r["unique_count"]) == ("mixed", 300, 300 - len(values), len(counts)), c
        assert r["null_rate"] == pytest.approx((300 - len(values)) / 300)
        assert [x["occurrences"] for x in r["top_values"]] == sorted(counts.values(), reverse=True)[:4], c
        assert all(counts[x["value"]] == x["occurrences"] for x in r["top_values"]), c
        short = [x["value"] for x in r["top_values"] if len(x["value"]) <= 64]
        if counts and max(map(len, counts)) <= 64:
            assert short == [v for v, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4]], c
    assert [x["value"] for x in got["text"]["top_values"]][0] == LONG
    assert got["text"]["data_bytes"] == sum(len(x["text"] or "") for x in rows) and got["flag"]["data_bytes"] == 300
    assert got["mark"]["mean"] == pytest.approx(np.mean([x["mark"] for x in rows]))
    assert got["nothing"]["top_values"] == [] and got["nothing"]["unique_count"] == 0
    frame = pd.DataFrame(rows)[["count", "mark", "a.b"]].astype(float)
    for c in frame:
        found = {x["column"]: x["r"] for x in got[c]["correlations"]}
        assert sorted(found) == [x["column"] for x in got[c]["correlations"]] == sorted(frame.columns)
        for other in frame:
            assert found[other] == pytest.approx(frame[c].corr(frame[other]), abs=1e-9)
    assert got["text"]["correlations"] is None and got["flag"]["correlations"] is None


def test_report_equals_its_parts(mixed):
    got = by_column(report.profile(mixed))
    for c, r in by_column(profile.column_profile(mixed)).items():
        for name in ("dtype", "null_count", "unique_count", "mean", "std", "q25", "q50", "q75", "skewness", "min_ts", "max_length"):
            assert got[c][name] == r[name] or math.isclose(got[c][name], r[name], rel_tol=1e-9), (c, name)


def test_report_of_many_columns_takes_products_of_matrices(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(0, 1, (400, 14)), columns=[f"c{i:02}" for i in range(14)])
    frame["c01"] = frame["c00"] * 2 + frame["c01"]
    got = by_column(report.profile(spark.createDataFrame(frame), k=1))
    for c in frame:
        assert {x["column"]: x["r"] for x in got[c]["correlations"]} == pytest.approx(dict(frame.corr()[c]), abs=1e-9)


def test_report_of_a_sample(mixed):
    got = by_column(report.profile(mixed, sample=120, key=["count"], include_correlations=False))
    chosen = profile.sample_rows(mixed, 120, ["count"])
    assert {r["row_count"] for r in got.values()} == {120}
    assert got["count"]["mean"] == pytest.approx(chosen.agg(F.avg("count")).first()[0])
    assert got["count"]["correlations"] is None


def test_report_of_empty_tables(spark):
    got = by_column(report.profile(spark.createDataFrame([], "a long, b string, c double, d timestamp")))
    assert {c: (r["row_count"], r["unique_count"], r["null_rate"], r["top_values"]) for c, r in got.items()} == dict.fromkeys("abcd", (0, 0, 0.0, []))
    assert report.profile(spark.range(3).select()).collect() == []


def test_distinct_and_frequent_values_share_a_shuffle(mixed):
    figures = report.value_figures(mixed, 3)
    figures.collect()
    final = plan_of(figures).split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and "CartesianProduct" not in final
