"""Values of large tables are counted by tasks of bounded size, with the same counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from veristrata.operators import frequencies, profile, report

ROWS = 20_000
TASK_BYTES = 100_000


@pytest.fixture
def table(spark):
    """Unique numbers and texts, a value in a third of the rows, a column of one value and one of many equal rows."""
    i = F.col("id")
    return spark.range(0, ROWS, 1, 1).select(
        i,
        F.concat(F.lit("text "), F.repeat(F.lit("long "), (i % 30).cast("int")), i.cast("string")).alias("a text"),
        F.when(i % 5 == 0, F.lit(None)).when(i % 3 == 0, "hot").otherwise((i % 700).cast("string")).alias("some"),
        F.when(i % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("zero"),
    )


def counted(table):
    found = {c: Counter() for c in table.columns}
    for r in table.collect():
        for c in table.columns:
            if r[c] is not None:
                found[c]["0.0" if c == "zero" else str(r[c])] += 1
    return found


def best(counter, k):
    return sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:k]


def test_counts_of_dealt_tables(spark, table, monkeypatch):
    monkeypatch.setattr(frequencies, "TASK_BYTES", TASK_BYTES, raising=False)
    expected = counted(table)
    counts = frequencies.value_counts(table, table.columns)
    assert counts.columns == ["column", "value", "occurrences"]
    got = counts.select("*", F.spark_partition_id().alias("task")).collect()
    assert len(got) == sum(map(len, expected.values()))
    assert all(expected[r.column][r.value] == r.occurrences for r in got)
    # Values of every column are spread, and no task has more than it may count, with some room for chance.
    assert max(Counter(r.task for r in got).values()) < 1.5 * TASK_BYTES / 64


@pytest.mark.parametrize("k", [5, 2000])
def test_top_values_of_dealt_tables(spark, table, monkeypatch, k):
    monkeypatch.setattr(frequencies, "TASK_BYTES", TASK_BYTES, raising=False)
    top = profile.top_value_profile(table, k)
    expected = counted(table)
    got = {c: [] for c in table.columns}
    for r in top.orderBy("column", "rank").collect():
        got[r.column].append((r.value, r.occurrences))
    assert got == {c: best(expected[c], k) for c in table.columns}
    plan = top._jdf.queryExecution().executedPlan().toString()
    # The rows are dealt before anything is counted; counts and ranks within parts share a shuffle.
    assert plan.count("Exchange") == 3 and plan.count("REPARTITION_BY_NUM") == 2


def test_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(frequencies, "TASK_BYTES", TASK_BYTES, raising=False)
    equal = spark.range(0, ROWS, 1, 8).select(F.lit("same").alias("v"), (F.col("id") % 2 == 0).alias("flag"))
    got = frequencies.value_counts(equal, equal.columns).collect()
    assert {(r.column, r.value): r.occurrences for r in got} == {
        ("v", "same"): ROWS, ("flag", "true"): ROWS // 2, ("flag", "false"): ROWS // 2}


def test_report_of_dealt_tables_shares_the_shuffles(spark, table, monkeypatch):
    plain = sorted(map(repr, report.profile(table, include_correlations=False).collect()))
    distinct = sorted(frequencies.distinct_counts(table, table.columns).collect())
    monkeypatch.setattr(frequencies, "TASK_BYTES", TASK_BYTES, raising=False)
    assert sorted(frequencies.distinct_counts(table, table.columns).collect()) == distinct
    assert sorted(map(repr, report.profile(table, include_correlations=False).collect())) == plain
    figures = report.value_figures(table, 3)
    figures.collect()
    final = figures._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("shufflepartitionidpassthrough") == 1 and final.count("ReusedExchange") == 1


def test_nothing_to_count(spark, monkeypatch):
    monkeypatch.setattr(frequencies, "TASK_BYTES", 1, raising=False)
    empty = spark.createDataFrame([], "a string, b int")
    assert profile.top_value_profile(empty).count() == 0
    nulls = spark.createDataFrame([(None, None)] * 3, "a string, b int")
    assert frequencies.value_counts(nulls, nulls.columns).count() == 0
