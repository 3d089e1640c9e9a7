import json

import pytest
from pyspark.sql import functions as F

from veristrata.operators.checks import register_rule
from veristrata.operators.validate import (
    statistics,
    success_percent,
    summary_text,
    unexpected_rows,
    validate,
)
from veristrata.plans import catalog
from veristrata.plans.suite import IN_SET, PAIR_GREATER, REGEX, Suite


def by_idx(df):
    return {r.idx: r for r in df.collect()}


def test_suite_shape_and_round_trip():
    suite = Suite("s").not_null("id").unique("id").between("v", 0, 120)
    assert Suite("empty").to_dict()["expectations"] == []
    data = suite.to_dict()
    assert data["expectation_suite_name"] == "s" and len(data["expectations"]) == 3
    assert data["expectations"][2]["kwargs"] == {"column": "v", "min_value": 0, "max_value": 120}
    again = Suite.from_json(suite.to_json())
    assert [(r.kind, r.params) for r in again.rules] == [(r.kind, r.params) for r in suite.rules]
    assert json.loads(suite.to_json())["expectations"][0]["meta"] == {}


def test_presets_and_standard_suites():
    regex = Suite("s").icd10_oncology("c").ndc("d").loinc("l").rules
    assert [r.kind for r in regex] == [REGEX] * 3
    assert regex[0].mostly == 1.0 and regex[1].mostly == 0.8
    assert [len(f().rules) for f in catalog.STANDARD.values()] == [21, 16, 20]
    assert [len(f().rules) for f in catalog.STANDARD_SHORT.values()] == [17, 10, 12]
    assert catalog.suite_for_dataset("nonsense").name == catalog.PATIENTS


def test_success_percent():
    assert success_percent(8, 10) == 80.0
    assert success_percent(0, 0) == 0.0


def test_empty_suite_and_empty_table(spark):
    df = spark.createDataFrame([], "a string, v double")
    assert validate(df, Suite("none")).count() == 0
    suite = (Suite("s").not_null("a").unique("a").in_set("a", ["x"]).regex("a", "x").between("v", 0, 1)
             .greater("v", "v").between("a", 0, 1).row_count(1))
    got = by_idx(validate(df, suite))
    assert [got[i].success for i in range(8)] == [True] * 7 + [False]
    assert [got[i].success_declared for i in range(8)] == [True] * 7 + [False]


def test_nulls_nan_and_uniqueness(spark):
    df = spark.createDataFrame(
        [("a", 1.0), (None, float("nan")), (None, 2.0)], "k string, v double"
    )
    got = by_idx(validate(df, Suite("s").unique("k").not_null("v").unique("v").exists("z")))
    assert not got[0].success and got[0].success_declared
    assert got[1].unexpected_count == 1 and not got[1].success
    assert got[2].success and got[3].success is False


def test_regex_is_anchored_at_the_start_only(spark):
    df = spark.createDataFrame([("abc",), ("xabc",)], "k string")
    assert by_idx(validate(df, Suite("s").regex("k", "a|b")))[0].unexpected_count == 1


def test_values_of_other_types(spark):
    df = spark.createDataFrame([(1, True, "1"), (2, False, "x")], "i int, b boolean, s string")
    suite = Suite("s").in_set("s", [1, 2]).in_set("i", ["a"]).in_set("b", [True, False])
    suite.between("s", 0, 5).between("i", 1, 2).regex("b", "True|False")
    got = by_idx(validate(df, suite))
    assert [got[i].unexpected_count for i in range(3)] == [2, 2, 0]
    assert (got[3].status, got[3].error, got[3].success) == ("error", "type", False)
    assert got[4].success and got[5].success


def test_mostly_and_strictness(spark):
    df = spark.range(10).select("id", F.col("id").alias("b"))
    suite = Suite("s").between("id", 1, None, mostly=0.9).between("id", 2, None, mostly=0.9)
    suite.greater("id", "b").greater("id", "b", or_equal=True)
    got = by_idx(validate(df, suite))
    assert [got[i].success for i in range(4)] == [False, False, True, True]
    assert [got[i].success_declared for i in range(4)] == [True, False, False, True]


def test_text_dates_in_pairs(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "2024-01-01"), ("bad", "2024-01-01"), (None, None), ("2024-01-01", "2024-02-01")],
        "a string, b string",
    )
    row = by_idx(validate(df, Suite("s").greater("a", "b", parse_dates=True)))[0]
    assert (row.null_count, row.unexpected_count, row.success) == (2, 1, False)


def test_unknown_rule_passes_and_custom_rule_counts(spark):
    df = spark.range(10)
    register_rule("expect_even", lambda d, p: F.col(p["column"]) % 2 == 1)
    got = by_idx(validate(df, Suite("s").add("expect_magic", column="id").add("expect_even", column="id")))
    assert got[0].success and got[0].status == "skipped"
    assert got[1].unexpected_count == 5


def test_summary_and_statistics(spark):
    results = validate(spark.range(3), Suite("s").unique("id").not_null("id").row_count(5))
    assert "Passed 2 of 3 rules (66.7%)" in summary_text(results)
    row = statistics(results).first()
    assert (row.evaluated, row.successful, row.success) == (3, 2, False)


def test_unexpected_rows_with_a_value_in_a_third_of_the_rows(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id").cast("string")).alias("k"),
    )
    bad = unexpected_rows(df, Suite("s").unique("k"))
    assert bad.count() == 1000
    assert bad.select("k").distinct().collect()[0].k == "hot"


@pytest.mark.parametrize("kind", [IN_SET, PAIR_GREATER])
def test_missing_columns_fail(spark, kind):
    params = {"column": "z", "value_set": [1]} if kind == IN_SET else {"column_A": "z", "column_B": "id"}
    row = validate(spark.range(2), Suite("s").add(kind, **params)).first()
    assert not row.success and row.status == "missing_column"
