"""Profiles that add up: each part of a table is profiled by itself, and the stored profiles are combined.

A profile holds, for each column, counts, sums and extremes, which add up exactly, and two mergeable sketches: HyperLogLog of the
distinct values and KLL of the quantiles of numbers. A new partition or run is read alone; what is known of the others
is some hundred kilobytes a column at most. The exact profiles (``profile``) read the whole table instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veristrata.functions.columns import as_double, field, is_numeric_or_bool, normalize_missing
from veristrata.operators.frequencies import identity_text

HLL_LG = 14
HLL_ERROR = 0.0244  # three standard errors of 2 ** HLL_LG registers
KLL_SIZE = 4096
KLL_ERROR = 0.0025  # of rank

def sketch_profile(df: DataFrame) -> DataFrame:
    """One row per column, to be stored: column, dtype, rows, known, mergeable sums, least, largest, and the sketches.

    The table is read once; each column is one aggregate over its values.
    """
    df = normalize_missing(df)
    aggregates, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        value = as_double(df, f.name) if is_numeric_or_bool(f.dataType) else F.lit(None).cast("double")
        known = F.count(field(f.name))
        spread = F.var_pop(value) * F.count(value)  # squares of differences from the mean
        parts = {
            "known": known, "total": F.sum(value), "squares": spread, "least": F.min(value), "largest": F.max(value),
            "distinct": F.when(known > 0, F.hll_sketch_agg(identity_text(df, f.name), F.lit(HLL_LG))),
            "quantiles": F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, F.lit(KLL_SIZE))),
        }
        aggregates += [a.alias(f"{name}{i}") for name, a in parts.items()]
        rows.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col("rows"),
            *(F.col(f"{name}{i}").alias(name) for name in parts),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def combine(*profiles: DataFrame) -> DataFrame:
    """One profile of all parts, of the same shape. A column that some parts lack has the rows of the others."""
    parts = reduce(DataFrame.unionByName, profiles)
    numbers = F.sum(F.when(F.col("total").isNotNull(), F.col("known")))
    means = parts.groupBy("column", "dtype").agg(F.try_divide(F.sum("total"), numbers).alias("mean"))
    # A part's squares about the common mean are its own and those of its mean's difference. A row for each column is
    # sent to the parts.
    keys = ["column", "dtype"]
    apart = F.try_divide("total", "known") - F.col("mean")
    parts = parts.join(F.broadcast(means), keys).withColumn("squares", F.col("squares") + F.col("known") * apart * apart)
    quantiles = F.kll_merge_agg_double("quantiles", F.lit(KLL_SIZE))
    return parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("known").alias("known"), F.sum("total").alias("total"),
        F.sum("squares").alias("squares"), F.min("least").alias("least"), F.max("largest").alias("largest"),
        F.when(F.count("distinct") > 0, F.hll_union_agg("distinct", F.lit(True))).alias("distinct"),
        F.when(F.count("quantiles") > 0, quantiles).alias("quantiles"),
    )


def report(profile: DataFrame, probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The statistics of a profile: exact counts, means, deviations and extremes; distinct values within HLL_ERROR of
    their number and quantiles within KLL_ERROR of their rank, at odds of about one in a hundred."""

    def quantile(p: float) -> Column:
        found = F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))
        return F.when(F.col("quantiles").isNotNull(), found).alias(f"q{round(p * 100)}")

    mean = F.try_divide("total", "known")
    deviation = F.sqrt(F.try_divide(F.col("squares"), F.nullif(F.col("known") - 1, F.lit(0))))
    distinct = F.when(F.col("distinct").isNotNull(), F.hll_sketch_estimate("distinct")).otherwise(0)
    return profile.select(
        "column", "dtype", F.col("rows").alias("count"), (F.col("rows") - F.col("known")).alias("null_count"),
        distinct.cast("bigint").alias("unique_count"), mean.alias("mean"), deviation.alias("std"),
        F.col("least").alias("min"), *(quantile(p) for p in probabilities), F.col("largest").alias("max"),
    )
