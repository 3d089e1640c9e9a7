"""Profiles: one fused pass for all column statistics, one shuffle for distinct values."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.functions.columns import (
    as_double,
    field,
    is_numeric_or_bool,
    is_string,
    is_temporal,
    literal,
    normalize_missing,
    numeric_columns,
    numeric_or_bool_columns,
    result_rows,
    string_columns,
    temporal_columns,
)
from veristrata.functions.moments import adjusted_kurtosis, adjusted_skewness, pearson
from veristrata.operators.frequencies import distinct_counts, top_values, value_counts
from veristrata.operators.gram import gram_correlations
from veristrata.operators.quantiles import fused_quantiles, quantile_values
from veristrata.operators.selection import digest_of, smallest
from veristrata.session import shared_dir

QUARTILES = (0.25, 0.5, 0.75)
PAIRS_PER_PASS = 60

NULLS = ["column", "count", "null_count", "null_rate"]
UNIQUE = ["column", "count", "unique_count", "unique_rate"]
NUMERIC = ["column", "mean", "std", "min", "q25", "q50", "q75", "max"]
SHAPE = ["column", "skewness", "kurtosis"]
DATETIME = ["column", "min_ts", "max_ts", "range_days"]
STRING = ["column", "avg_length", "min_length", "max_length"]


def table_profile(df: DataFrame, name: str = "dataset") -> DataFrame:
    """Row and column count of a table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("name"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def column_profile(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    parts: Iterable[str] = ("numeric", "shape", "datetime", "string", "distinct"),
    mode: str = "exact",
) -> DataFrame:
    """One row per column; statistics that do not fit its type are NULL.

    ``mode='approx'`` takes quantiles and distinct counts from sketches.
    """
    df = normalize_missing(df)
    names, parts = list(columns or df.columns), set(parts)
    quartiles, aggregates = {}, [F.count(F.lit(1)).alias("count")]
    if "numeric" in parts:
        numbers = [c for c in names if is_numeric_or_bool(df.schema[c].dataType)]
        if mode == "exact":
            quartiles = fused_quantiles(df, numbers, QUARTILES, aggregates)
        else:
            quartiles = quantile_values(df, numbers, QUARTILES, mode)
    rows = [column_statistics(df, c, i, parts, quartiles.get(c), aggregates) for i, c in enumerate(names)]
    stats = df.agg(*aggregates).select(result_rows(rows))
    if "distinct" in parts:
        counts = distinct_counts(df, names, approximate=mode == "approx")
        # One row per column of the table on either side.
        stats = stats.join(
            F.broadcast(counts.select("column", "distinct_count")), "column", "left"
        )
        unique = F.coalesce(F.col("distinct_count"), F.lit(0))
    else:
        unique = F.lit(None).cast("bigint")
    return stats.withColumn("unique_count", unique).select(
        "column", "dtype", "count", "null_count",
        F.when(F.col("count") == 0, 0.0)
        .otherwise(F.try_divide("null_count", "count"))
        .alias("null_rate"),
        "unique_count",
        F.when(F.col("count") == 0, 0.0)
        .otherwise(F.try_divide("unique_count", "count"))
        .alias("unique_rate"),
        *NUMERIC[1:], *SHAPE[1:], *DATETIME[1:], *STRING[1:],
    )


def column_statistics(
    df: DataFrame, name: str, i: int, parts: set[str], quartiles: dict | None,
    aggregates: list[Column],
) -> dict[str, str]:
    """Adds the aggregates of one column and returns its result row over them."""
    data_type = df.schema[name].dataType
    values: dict[str, Column] = {"known": F.count(field(name))}
    if is_numeric_or_bool(data_type):
        v = as_double(df, name)
        if "numeric" in parts:
            values |= {
                "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v),
            }
        if "shape" in parts:
            values |= {"skewness": adjusted_skewness(v), "kurtosis": adjusted_kurtosis(v)}
    elif is_temporal(data_type) and "datetime" in parts:
        v = field(name).cast("timestamp_ntz")
        values |= {"min_ts": F.min(v), "max_ts": F.max(v)}
    elif is_string(data_type) and "string" in parts:
        length = F.char_length(field(name))
        values |= {
            "avg_length": F.avg(length), "min_length": F.min(length), "max_length": F.max(length),
        }
    for key, expression in values.items():
        aggregates.append(expression.alias(f"{key}_{i}"))

    def out(key: str, data_type: str) -> str:
        return f"cast({f'{key}_{i}' if key in values else 'NULL'} AS {data_type})"

    def quartile(p: float) -> str:
        found = (quartiles or {}).get(p)
        return f"cast({found if isinstance(found, str) else literal(found)} AS double)"

    days = f"timestampdiff(DAY, min_ts_{i}, max_ts_{i})" if "min_ts" in values else "NULL"
    return {
        "column": literal(name),
        "dtype": literal(data_type.simpleString()),
        "count": "count",
        "null_count": f"count - known_{i}",
        "mean": out("mean", "double"),
        "std": out("std", "double"),
        "min": out("min", "double"),
        "q25": quartile(0.25),
        "q50": quartile(0.5),
        "q75": quartile(0.75),
        "max": out("max", "double"),
        "skewness": out("skewness", "double"),
        "kurtosis": out("kurtosis", "double"),
        "min_ts": out("min_ts", "timestamp_ntz"),
        "max_ts": out("max_ts", "timestamp_ntz"),
        "range_days": f"cast({days} AS bigint)",
        "avg_length": out("avg_length", "double"),
        "min_length": out("min_length", "int"),
        "max_length": out("max_length", "int"),
    }


def null_profile(df: DataFrame) -> DataFrame:
    """Values, missing values and their share per column."""
    return column_profile(df, parts=()).select(*NULLS)


def unique_profile(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Distinct values (NULL is none) per column, as a count and as a share of all rows."""
    return column_profile(df, parts=("distinct",), mode=mode).select(*UNIQUE)


def top_value_profile(df: DataFrame, k: int = 5, columns: list[str] | None = None) -> DataFrame:
    """The most frequent values per column, as text."""
    df = normalize_missing(df)
    return top_values(value_counts(df, columns or df.columns, parts=True), k)


def numeric_profile(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Mean, sample deviation, extremes and quartiles of numeric and boolean columns."""
    columns = numeric_or_bool_columns(df)
    return column_profile(df, columns, ("numeric",), mode).select(*NUMERIC)


def shape_profile(df: DataFrame) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis."""
    return column_profile(df, numeric_or_bool_columns(df), ("shape",)).select(*SHAPE)


def datetime_profile(df: DataFrame) -> DataFrame:
    """First and last moment and the whole days between them."""
    return column_profile(df, temporal_columns(df), ("datetime",)).select(*DATETIME)


def string_profile(df: DataFrame) -> DataFrame:
    """Lengths in characters."""
    return column_profile(df, string_columns(df), ("string",)).select(*STRING)


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson matrix in long form ``(a, b, r)``; empty with fewer than two numeric columns.

    One scan for any number of columns: a few pairs are one aggregate, more are sums of matrix products of Arrow batches.
    """
    df = normalize_missing(df)
    names = columns or numeric_columns(df)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    pairs = [*combinations(names, 2), *((n, n) for n in names)]
    return _correlate(df, pairs) if len(pairs) <= PAIRS_PER_PASS else gram_correlations(df, names)


def _correlate(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    aggregates = [
        pearson(as_double(df, a), as_double(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)
    ]
    rows = [
        {"a": literal(left), "b": literal(right), "r": f"r{i}"}
        for i, (a, b) in enumerate(pairs) for left, right in sorted({(a, b), (b, a)})
    ]
    return df.agg(*aggregates).select(result_rows(rows))


# Bytes of one value per type.
_WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def byte_profile(df: DataFrame) -> DataFrame:
    """Data bytes per column: fixed width by type, and the encoded length of texts."""
    aggregates, rows = [F.count(F.lit(1)).alias("count")], []
    for i, c in enumerate(df.columns):
        rows.append({"column": literal(c), "data_bytes": column_bytes(df, c, f"b{i}", aggregates)})
    return df.agg(*aggregates).select(result_rows(rows))


def column_bytes(df: DataFrame, name: str, alias: str, aggregates: list[Column]) -> str:
    """Bytes of a column over the aggregates, the first of which counts the rows; adds the one that it needs."""
    data_type = df.schema[name].dataType
    if is_string(data_type) or isinstance(data_type, T.BinaryType):
        aggregates.append(F.sum(F.octet_length(field(name)).cast("bigint")).alias(alias))
        return f"coalesce({alias}, 0)"
    return f"`count` * {_WIDTHS.get(type(data_type), 8)}"


def profile_summary(df: DataFrame, name: str = "dataset") -> DataFrame:
    """Rows, columns, data size, columns with missing values and the mean null rate, in one scan."""
    df = normalize_missing(df)
    return df.agg(*(figure.alias(k) for k, figure in summary_figures(df).items())).select(
        F.lit(name).alias("name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
        "data_bytes", "columns_with_nulls", "avg_null_rate",
    )


def summary_figures(df: DataFrame) -> dict[str, Column]:
    """The aggregates of the summary, by name."""
    rows = F.count(F.lit(1))
    nulls = [rows - F.count(field(c)) for c in df.columns]
    with_nulls = sum((F.when(n > 0, 1).otherwise(0) for n in nulls), F.lit(0))
    rates = sum((F.coalesce(F.try_divide(n, rows), F.lit(0.0)) for n in nulls), F.lit(0.0))
    size = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if is_string(f.dataType) or isinstance(f.dataType, T.BinaryType):
            octets = F.sum(F.octet_length(field(f.name)).cast("bigint"))
            size = size + F.coalesce(octets, F.lit(0))
        else:
            size = size + rows * F.lit(_WIDTHS.get(type(f.dataType), 8))
    return {
        "row_count": rows,
        "columns_with_nulls": with_nulls,
        "avg_null_rate": rates / F.lit(max(len(df.columns), 1)),
        "data_bytes": size,
    }


def overview(df: DataFrame) -> DataFrame:
    """Compact list of columns: type, values, null percent, distinct values."""
    return column_profile(df, parts=("distinct",)).select(
        "column", "dtype", (F.col("count") - F.col("null_count")).alias("non_null"),
        (F.col("null_rate") * 100).alias("null_percent"), "unique_count",
    )


def sample_rows(
    df: DataFrame, n: int, key: list[str], seed: int = 42, stored: bool = False
) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), the same ones on every run. ``stored`` keeps
    the sample in the checkpoint folder, for when several passes over it follow.

    These are the rows with the smallest hashes of their key, found without a sort (see ``selection``).
    """
    sampled = smallest(df, n, digest_of(str(seed), *(field(k) for k in key)))
    if stored:
        shared_dir(df.sparkSession)
        sampled = sampled.checkpoint()
    return sampled


def preview(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*(field(c) for c in order_by)).limit(n)
