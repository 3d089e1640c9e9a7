"""Bias-corrected third and fourth moments, and Pearson correlation without ANSI errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_skewness(value: Column) -> Column:
    """G1 from the population skewness; NULL below three values or for a constant."""
    n = F.count(value).cast("double")
    corrected = F.skewness(value) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n >= 3, corrected)


def adjusted_kurtosis(value: Column) -> Column:
    """G2 (excess) from the population kurtosis; NULL below four values or for a constant."""
    n = F.count(value).cast("double")
    factor = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0))
    return F.when(n >= 4, factor * ((n + 1) * F.kurtosis(value) + 6))


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete correlation; NULL when either side is constant (``corr`` would raise)."""
    a_paired = F.when(b.isNotNull(), a)
    b_paired = F.when(a.isNotNull(), b)
    scale = F.stddev_samp(a_paired) * F.stddev_samp(b_paired)
    return F.try_divide(F.covar_samp(a, b), scale)
