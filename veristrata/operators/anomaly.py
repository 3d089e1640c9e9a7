"""Outliers by spread (interquartile range, z-score, median deviation) and by reference range.

Bounds are a handful of numbers per column; they enter the counting pass as constants, so that all
columns are judged in one scan without joining statistics back to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veristrata.functions.columns import (
    as_double,
    field,
    literal,
    normalize_missing,
    numeric_columns,
    result_rows,
)
from veristrata.operators import isolation
from veristrata.operators.quantiles import median_deviations, quantile_values

METHODS = ("iqr", "zscore", "mad")
# Makes the median absolute deviation comparable to a standard deviation.
MAD_SCALE = 1.4826


@dataclass
class Bounds:
    """What is normal in one column."""

    column: str
    method: str
    threshold: float
    lower: float | None = None
    upper: float | None = None
    center: float | None = None
    scale: float | None = None
    error: str | None = None

    def is_anomaly(self, value: Column) -> Column:
        """TRUE for outliers; never for missing values."""
        if self.error or self.scale is None:
            return F.lit(False)
        if self.method == "iqr":
            outside = (value < F.lit(self.lower)) | (value > F.lit(self.upper))
        else:
            factor = MAD_SCALE if self.method == "mad" else 1.0
            distance = F.abs(value - F.lit(self.center)) / F.lit(factor * self.scale)
            outside = distance > F.lit(float(self.threshold))
        return F.coalesce(outside, F.lit(False))


def fit_bounds(
    df: DataFrame,
    method: str = "iqr",
    threshold: float = 1.5,
    columns: list[str] | None = None,
    mode: str = "exact",
) -> list[Bounds]:
    """Bounds of the numeric columns; unknown columns are skipped."""
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    df = normalize_missing(df)
    names = [c for c in (columns or numeric_columns(df)) if c in df.columns]
    fit = {"iqr": _fit_iqr, "zscore": _fit_zscore, "mad": _fit_mad}[method]
    return fit(df, names, threshold, mode)


def _fit_iqr(df: DataFrame, names: list[str], t: float, mode: str) -> list[Bounds]:
    quartiles = quantile_values(df, names, (0.25, 0.5, 0.75), mode)
    fitted = []
    for name in names:
        b = Bounds(name, "iqr", t)
        if name in quartiles:
            q1, q3 = quartiles[name][0.25], quartiles[name][0.75]
            b.center, b.scale = quartiles[name][0.5], q3 - q1
            b.lower, b.upper = q1 - t * b.scale, q3 + t * b.scale
        fitted.append(b)
    return fitted


def _fit_zscore(df: DataFrame, names: list[str], t: float, mode: str) -> list[Bounds]:
    aggregates = []
    for i, name in enumerate(names):
        v = as_double(df, name)
        aggregates += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}")]
    row = df.agg(*aggregates).first() if names else None
    fitted = []
    for i, name in enumerate(names):
        b = Bounds(name, "zscore", t, center=row[f"m{i}"], scale=row[f"s{i}"])
        if b.scale == 0:
            b.error = "Zero standard deviation"
        elif b.scale is not None:
            b.lower, b.upper = b.center - t * b.scale, b.center + t * b.scale
        fitted.append(b)
    return fitted


def _fit_mad(df: DataFrame, names: list[str], t: float, mode: str) -> list[Bounds]:
    found = median_deviations(df, names, mode)
    fitted = []
    for name in names:
        b = Bounds(name, "mad", t)
        if name in found:
            b.center, b.scale = found[name]
            if b.scale == 0:
                b.error = "Zero MAD"
            else:
                reach = t * MAD_SCALE * b.scale
                b.lower, b.upper = b.center - reach, b.center + reach
        fitted.append(b)
    return fitted


def detect(
    df: DataFrame,
    method: str = "iqr",
    threshold: float = 1.5,
    columns: list[str] | None = None,
    mode: str = "exact",
) -> DataFrame:
    """One row per column: outliers, rows, rate and bounds. All columns are counted in one scan.

    Method ``isolation_forest`` has no bounds and takes no threshold: those cells are NULL.
    """
    if method == "isolation_forest":
        found = isolation.detect(df, columns)
        bounds = {n: _number(None) for n in ("threshold", "lower_bound", "upper_bound", "center", "scale")}
        return found.select(
            F.col("columns").alias("column"), "method", "anomaly_count", "row_count", "anomaly_rate",
            *(v.alias(n) for n, v in bounds.items()), F.lit(None).cast("string").alias("error"),
        )
    fitted = fit_bounds(df, method, threshold, columns, mode)
    return count_anomalies(df, fitted)


def count_anomalies(df: DataFrame, fitted: list[Bounds]) -> DataFrame:
    """Count the outliers of a table against given bounds, which may stem from another table."""
    df = normalize_missing(df)
    if not fitted:
        return df.sparkSession.createDataFrame(
            [],
            "`column` string, method string, anomaly_count bigint, row_count bigint, "
            "anomaly_rate double, threshold double, lower_bound double, upper_bound double, "
            "center double, scale double, error string",
        )
    aggregates, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, b in enumerate(fitted):
        flag = b.is_anomaly(as_double(df, b.column))
        aggregates.append(F.count(F.when(flag, F.lit(1))).alias(f"a{i}"))
        numbers = {
            "threshold": b.threshold, "lower_bound": b.lower, "upper_bound": b.upper,
            "center": b.center, "scale": b.scale,
        }
        rows.append(
            {
                "column": literal(b.column),
                "method": literal(b.method),
                "anomaly_count": f"a{i}",
                "row_count": "rows",
                "anomaly_rate": f"coalesce(try_divide(a{i}, rows), 0.0D)",
                **{n: f"cast({literal(v)} AS double)" for n, v in numbers.items()},
                "error": f"cast({literal(b.error)} AS string)",
            }
        )
    return df.agg(*aggregates).select(result_rows(rows))


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def anomalous_rows(
    df: DataFrame,
    key: list[str],
    method: str = "iqr",
    threshold: float = 1.5,
    columns: list[str] | None = None,
    mode: str = "exact",
) -> DataFrame:
    """The outliers themselves: key, column, value and bounds, one row per outlying value."""
    fitted = fit_bounds(df, method, threshold, columns, mode)
    df = normalize_missing(df)
    marks = []
    for b in fitted:
        value = as_double(df, b.column)
        found = F.struct(
            F.lit(b.column).alias("column"), value.alias("value"),
            _number(b.lower).alias("lower_bound"), _number(b.upper).alias("upper_bound"),
        )
        marks.append(F.when(b.is_anomaly(value), found))
    keys = [field(k) for k in key]
    return df.select(*keys, F.inline(F.array_compact(F.array(*marks))))


def summarize(results: DataFrame) -> DataFrame:
    """Totals over the columns of one detection."""
    return results.groupBy("method", "threshold").agg(
        F.count(F.lit(1)).alias("columns"),
        F.sum("anomaly_count").alias("total_anomalies"),
        F.max("anomaly_rate").alias("highest_rate"),
    )


def out_of_reference_range(
    df: DataFrame,
    value: str = "result_value",
    low: str = "reference_range_low",
    high: str = "reference_range_high",
) -> DataFrame:
    """Rows whose value lies outside its own range, as a count and a share of all rows."""
    df = normalize_missing(df)
    outside = _outside_range(value, low, high)
    return df.agg(
        F.count(F.when(outside, F.lit(1))).alias("anomaly_count"),
        F.count(F.lit(1)).alias("row_count"),
    ).select(
        F.lit(value).alias("column"),
        F.lit("reference_range").alias("method"),
        "anomaly_count",
        "row_count",
        F.coalesce(F.try_divide("anomaly_count", "row_count"), F.lit(0.0)).alias("anomaly_rate"),
    )


def rows_out_of_reference_range(
    df: DataFrame,
    value: str = "result_value",
    low: str = "reference_range_low",
    high: str = "reference_range_high",
) -> DataFrame:
    return normalize_missing(df).filter(_outside_range(value, low, high))


def _outside_range(value: str, low: str, high: str) -> Column:
    return (field(value) < field(low)) | (field(value) > field(high))
