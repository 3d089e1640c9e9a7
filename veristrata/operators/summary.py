"""Short description of a data set of patients, treatments and lab results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veristrata.functions.columns import field


def category_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, category, rows)`` for a few categorical columns, in one pass."""
    items = [
        F.struct(F.lit(c).alias("column"), field(c).cast("string").alias("category")) for c in columns
    ]
    return (
        df.select(F.inline(F.array(*items)))
        .filter("category IS NOT NULL")
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def dataset_summary(patients: DataFrame, treatments: DataFrame, labs: DataFrame) -> DataFrame:
    """One row: counts, children per patient and the share of abnormal lab results."""
    kinds = [
        patients.agg(F.count(F.lit(1)).alias("n")).select(F.lit("p").alias("kind"), "n",
                                                          F.lit(None).cast("double").alias("rate")),
        treatments.agg(F.count(F.lit(1)).alias("n")).select(F.lit("t").alias("kind"), "n",
                                                            F.lit(None).cast("double").alias("rate")),
        labs.agg(
            F.count(F.lit(1)).alias("n"), F.avg(F.col("is_abnormal").cast("int")).alias("rate")
        ).select(F.lit("l").alias("kind"), "n", "rate"),
    ]
    # Three rows from here.
    counts = reduce(DataFrame.unionByName, kinds)

    def n(kind: str):
        return F.max(F.when(F.col("kind") == kind, F.col("n")))

    return counts.agg(
        n("p").alias("patient_count"),
        n("t").alias("treatment_count"),
        n("l").alias("lab_result_count"),
        (n("t") / F.greatest(n("p"), F.lit(1))).alias("avg_treatments_per_patient"),
        (n("l") / F.greatest(n("p"), F.lit(1))).alias("avg_lab_results_per_patient"),
        F.coalesce(F.max("rate"), F.lit(0.0)).alias("abnormal_lab_rate"),
    )
