"""References between tables, children per parent, and look-ups in small reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.functions import coding
from veristrata.functions.columns import field
from veristrata.operators.hotkeys import hot_and_rest, key_filter
from veristrata.session import stored


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is in no parent row. A missing key refers to nothing and is no orphan.

    The dangling keys are found from counts. Only child rows that may have one of them go on: the rows of very frequent
    keys by a broadcast of these, the others by a shuffle.
    """
    dangling = stored(orphan_keys(child, parent, key, parent_key), "orphan-keys")
    hot, rest, rows = hot_and_rest(dangling, "rows")
    if not rows:
        return child.filter(F.lit(False))
    maybe = child.filter(key_filter(dangling, key)(field(key)))
    few = F.broadcast(hot.select(key))  # HOT keys at most
    frequent = maybe.join(few, key, "left_semi")
    others = maybe.join(few, key, "left_anti").join(rest.select(key), key, "left_semi")
    return frequent.unionByName(others).select(*(field(c) for c in child.columns))


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """The dangling keys with their number of rows. Children are counted per key before they meet
    the parents, so a key with very many rows travels as one row per task."""
    counted = child.filter(field(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    keys = parent.select(field(parent_key or key).alias(key))
    return counted.join(keys, key, "left_anti")


def children_per_parent(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """One row: parents, children, mean children per parent, and parents without any child.

    A parent is a key: repeated rows of a key are one parent, and its children count once. Children are
    counted per key before they meet the parents.
    """
    counted = child.groupBy(key).agg(F.count(F.lit(1)).alias("children"))
    joined = parent.select(key).distinct().join(counted, key, "left")
    linked = F.coalesce(F.sum("children"), F.lit(0))
    return joined.agg(
        F.count(F.lit(1)).alias("parents"),
        linked.alias("linked_children"),
        F.try_divide(linked, F.count(F.lit(1))).alias("children_per_parent"),
        F.count(F.when(F.col("children").isNull(), 1)).alias("childless_parents"),
    )


def lab_test_reference(spark: SparkSession) -> DataFrame:
    """The reference table of laboratory tests."""
    return spark.createDataFrame(
        coding.LAB_TESTS,
        "test_code string, ref_name string, ref_category string, ref_unit string, ref_low double, "
        "ref_high double",
    )


def diagnosis_reference(spark: SparkSession) -> DataFrame:
    """The diagnosis codes that belong to each cancer type."""
    return spark.createDataFrame(
        [(t, c) for t, codes in coding.DIAGNOSIS_CODES.items() for c in codes],
        "cancer_type string, primary_diagnosis_code string",
    )


def check_lab_reference(labs: DataFrame) -> DataFrame:
    """Per test: rows, rows unknown to the reference, and rows whose unit, name or range differ."""
    reference = lab_test_reference(labs.sparkSession)
    # The reference table is a fixed list of a few tests.
    joined = labs.join(F.broadcast(reference), "test_code", "left")
    unknown = F.col("ref_name").isNull()

    def differs(own: str, ref: str):
        return F.count(F.when(~unknown & ~F.equal_null(F.col(own), F.col(ref)), 1))

    return joined.groupBy("test_code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(unknown, 1)).alias("unknown_rows"),
        differs("test_name", "ref_name").alias("name_differs"),
        differs("result_unit", "ref_unit").alias("unit_differs"),
        differs("reference_range_low", "ref_low").alias("low_differs"),
        differs("reference_range_high", "ref_high").alias("high_differs"),
    )


def diagnosis_mismatches(patients: DataFrame) -> DataFrame:
    """Patients whose diagnosis code is not one of their cancer type's codes."""
    reference = diagnosis_reference(patients.sparkSession)
    return patients.join(
        F.broadcast(reference), ["cancer_type", "primary_diagnosis_code"], "left_anti"
    )
