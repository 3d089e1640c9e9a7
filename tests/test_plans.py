"""Physical plans: no all-pairs joins, pruned scans, ranks limited before the shuffle."""

import pytest

from veristrata.operators.profile import top_value_profile
from veristrata.operators.validate import validate
from veristrata.plans.suite import Suite
from veristrata.sources.entities import base
from veristrata.workload import all_queries

QUERIES = all_queries()
PLANNED = [
    "val_suite_patients", "val_all_suites", "val_unexpected_rows", "rec_quarantine",
    "ref_integrity_orphans", "lookup_reference_ranges", "profile_columns", "anomaly_all_columns",
    "drift_ks", "scorecard", "quality_pipeline", "dataset_summary", "profile_report",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_all_pairs_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scan_reads_only_the_columns_of_the_rules(spark, sf_dir):
    plan = plan_of(validate(base(spark, sf_dir, "lineitem"), Suite("s").between("l_tax", 0, 1)))
    assert "ReadSchema: struct<l_tax:double>" in plan


def test_top_values_are_limited_inside_the_tasks(spark, sf_dir):
    plan = plan_of(top_value_profile(base(spark, sf_dir, "orders")))
    assert plan.count("WindowGroupLimit") == 4
    large = plan_of(top_value_profile(base(spark, sf_dir, "orders"), 2000))
    assert "_part" in large and large.count("Exchange") == 3


def test_row_rules_need_no_shuffle_but_the_final_merge(spark, sf_dir):
    plan = plan_of(validate(base(spark, sf_dir, "orders"), Suite("s").not_null("o_orderkey")))
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan


def test_quality_report_scans_a_table_once_besides_uniqueness(spark, sf_dir):
    plan = plan_of(QUERIES["quality_pipeline"](spark, sf_dir))
    assert plan.count("FileScan") <= 6  # three tables; unique columns are scanned by themselves
