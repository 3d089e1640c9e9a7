"""The whole profile of a table: statistics, sizes, distinct and most frequent values, correlations, by column.

All of it shares a few scans. The quartiles take two (sketches, then proofs); a third counts everything else: nulls, moments,
lengths, bytes, the opened brackets of the quartiles, and the correlations of a few columns. A fourth reads the values: one
shuffle of (column, value) counts gives both the distinct and the most frequent ones. Correlations of many columns are a scan
of their own (see ``gram``).

Values of more than 64 bytes are counted by a digest. Only of those that are among the most frequent is the text
looked up again, in one more scan of tables that have text columns, so no long text is shuffled but those in the report.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.functions.columns import (
    as_double,
    is_numeric_or_bool,
    is_string,
    literal,
    normalize_missing,
    numeric_columns,
    result_rows,
)
from veristrata.functions.moments import pearson
from veristrata.operators.frequencies import IDENTITY_BYTES, as_text, identity, top_values, value_counts
from veristrata.operators.gram import gram_correlations
from veristrata.operators.profile import PAIRS_PER_PASS, QUARTILES, column_bytes, column_statistics, sample_rows
from veristrata.operators.quantiles import fused_quantiles
from veristrata.session import stored

MARK_BYTES = 65  # of a digest; no value that travels as itself is as long


def profile(
    df: DataFrame,
    name: str = "dataset",
    include_correlations: bool = True,
    sample: int | None = None,
    key: list[str] | None = None,
    k: int = 5,
) -> DataFrame:
    """One row per column: ``name``, ``row_count``, the columns of ``column_profile``, ``data_bytes``, ``top_values`` (of
    value and occurrences, the most frequent first, at most ``k``) and ``correlations`` (of column and r, by column).

    With ``sample`` the profile is one of exactly so many rows, chosen by the hash of ``key`` (all columns, if
    there is none). A column without values has no top values; ``correlations`` is NULL for columns that are not numeric, or
    if there are fewer than two of these, or if it isn't wanted. Ties go to the smaller value, of long ones to the smaller
    digest. An empty table has its rows with counts of zero; one without columns has none.
    """
    if sample is not None:
        df = sample_rows(df, sample, key or df.columns, stored=True)
    df = normalize_missing(df)
    names = df.columns
    if not names:
        return df.sparkSession.createDataFrame([], "name string, row_count long, column string")
    aggregates = [F.count(F.lit(1)).alias("count")]
    numbers = [c for c in names if is_numeric_or_bool(df.schema[c].dataType)]
    quartiles = fused_quantiles(df, numbers, QUARTILES, aggregates)
    rows = [
        column_statistics(df, c, i, {"numeric", "shape", "datetime", "string"}, quartiles.get(c), aggregates)
        | {"data_bytes": column_bytes(df, c, f"bytes_{i}", aggregates)}
        for i, c in enumerate(names)
    ]
    related = numeric_columns(df) if include_correlations else []
    few = len(related) * (len(related) + 1) // 2 <= PAIRS_PER_PASS
    found = _pairs(df, related, aggregates) if len(related) > 1 and few else {}
    for row, c in zip(rows, names, strict=True):
        row["correlations"] = found.get(c, "cast(NULL AS array<struct<column: string, r: double>>)")
    stats = df.agg(*aggregates).select(result_rows(rows))
    if len(related) > 1 and not few:
        listed = gram_correlations(df, related).groupBy(F.col("a").alias("column")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("b").alias("column"), "r"))).alias("correlations")
        )
        stats = stats.drop("correlations").join(listed, "column", "left")
    values = _values(df, k)
    # A row for each column of the table on either side.
    stats = stats.join(F.broadcast(values), "column", "left")
    unique = F.coalesce("unique_count", F.lit(0))
    share = lambda part: F.when(F.col("count") == 0, 0.0).otherwise(F.try_divide(part, F.col("count")))
    return stats.select(
        F.lit(name).alias("name"), F.col("count").alias("row_count"), "column", "dtype",
        "null_count", share(F.col("null_count")).alias("null_rate"),
        unique.alias("unique_count"), share(unique).alias("unique_rate"),
        "mean", "std", "min", "q25", "q50", "q75", "max", "skewness", "kurtosis", "min_ts", "max_ts", "range_days",
        "avg_length", "min_length", "max_length", "data_bytes",
        F.coalesce("top_values", F.expr("array()").cast("array<struct<value: string, occurrences: bigint>>")).alias("top_values"),
        "correlations",
    )


def _pairs(df: DataFrame, names: list[str], aggregates: list) -> dict[str, str]:
    """Adds the correlations of all pairs to the aggregates; returns each column's list of them."""
    place = {}
    for i, (a, b) in enumerate(combinations_with_replacement(names, 2)):
        aggregates.append(pearson(as_double(df, a), as_double(df, b)).alias(f"r_{i}"))
        place[a, b] = place[b, a] = f"r_{i}"
    return {
        a: "array(" + ", ".join(f"named_struct('column', {literal(b)}, 'r', {place[a, b]})" for b in sorted(names)) + ")"
        for a in names
    }


def _values(df: DataFrame, k: int) -> DataFrame:
    """(column, unique_count, top_values) of the columns with any value."""
    best = _written_out(df, stored(value_figures(df, k), "values"))
    listed = best.groupBy("column", "unique_count").agg(
        F.sort_array(F.collect_list(F.struct("rank", "value", "occurrences"))).alias("top")
    )
    plain = F.transform("top", lambda x: F.struct(x["value"].alias("value"), x["occurrences"].alias("occurrences")))
    return listed.select("column", "unique_count", plain.alias("top_values"))


def value_figures(df: DataFrame, k: int) -> DataFrame:
    """(column, unique_count, value, occurrences, rank): the most frequent values of each column, long ones as digests."""
    counts = value_counts(df, df.columns, identities=True, parts=True)
    # Both sides read the occurrences, so that their plans share one shuffle.
    distinct = counts.groupBy("column").agg(F.count_if(F.col("occurrences") > 0).alias("unique_count"))
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    clock = F.when(F.col("column").isin(instants), F.timestamp_micros(F.col("value").try_cast("bigint")).cast("string"))
    shown = counts.withColumn("value", F.coalesce(clock, "value")) if instants else counts
    return top_values(shown, k).join(F.broadcast(distinct), "column")


def _written_out(df: DataFrame, best: DataFrame) -> DataFrame:
    """The chosen values with the texts that the digests stand for."""
    long = [f.name for f in df.schema.fields if is_string(f.dataType) or isinstance(f.dataType, T.BinaryType)]
    if not long:
        return best
    marks = best.where(F.octet_length("value") == MARK_BYTES).select("column", F.col("value").alias("mark"))
    cells = F.array(*(
        F.when(F.octet_length(as_text(df, c)) > IDENTITY_BYTES, F.struct(F.lit(c).alias("column"), as_text(df, c).alias("text")))
        for c in long
    ))
    texts = df.select(F.inline(F.filter(cells, lambda x: x.isNotNull()))).withColumn("mark", identity(F.col("text")))
    # k marks for each column at most.
    found = texts.join(F.broadcast(marks), ["column", "mark"]).groupBy("column", "mark").agg(F.any_value("text").alias("text"))
    best = best.withColumnRenamed("value", "mark").join(F.broadcast(found), ["column", "mark"], "left")
    return best.select("column", "unique_count", "rank", F.coalesce("text", "mark").alias("value"), "occurrences")
