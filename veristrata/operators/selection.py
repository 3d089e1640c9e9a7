"""Exactly n rows of a table, without a sort of the table and without passing them through one task.

The n-th smallest of a hash is found by histograms: counts by the first digits, then by the next digits among the rows with
the digits found, until few rows are left. A filter then keeps the rows up to that hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.functions.columns import field, is_temporal
from veristrata.session import stored

DIGITS = 4  # hexadecimal digits of a histogram: 65,536 counts
FEW = 1000  # hashes that are looked at one by one
HEAP_ROWS = 10_000  # first rows that a task may hold
ACCURACY = 10_000


def digest_of(*columns: Column | str) -> Column:
    """MD5 of the columns' texts joined with colons; texts are given as they are."""
    parts = [F.lit(c) if isinstance(c, str) else c.cast("string") for c in columns]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def nth_digest(df: DataFrame, digest: Column, n: int) -> tuple[str, int, int] | None:
    """The n-th smallest digest, how many rows with it belong to the first n, and how many there are; nothing if
    there are no more than n rows."""
    digests = df.select(digest.alias("d"))
    prefix, below = "", 0
    while True:
        part = F.substring("d", len(prefix) + 1, DIGITS).alias("part")
        counts = digests.filter(F.col("d").startswith(prefix)).groupBy(part).count().collect()
        if not prefix and sum(r["count"] for r in counts) <= n:
            return None
        found, below, inside = _holder(counts, below, n)
        prefix += found
        if inside <= FEW or len(prefix) == 32:
            break
    if len(prefix) < 32:
        counts = digests.filter(F.col("d").startswith(prefix)).groupBy(F.col("d").alias("part")).count().collect()
        prefix, below, inside = _holder(counts, below, n)
    return prefix, n - below, inside


def _holder(counts: list, below: int, n: int) -> tuple[str, int, int]:
    """Of parts with counts the one that holds the n-th row, the rows before it, and its own."""
    for part, count in sorted((r["part"], r["count"]) for r in counts):
        if below + count >= n:
            return part, below, count
        below += count
    raise ValueError("the table has changed between two passes")


def smallest(df: DataFrame, n: int, digest: Column) -> DataFrame:
    """The ``n`` rows with the smallest digests (all, if there are fewer). Of rows with the digest at the border
    those with the smallest digest of the whole row are taken; rows that are equal throughout are made anew."""
    found = nth_digest(df, digest, n)
    if found is None:
        return df
    last, wanted, there = found
    if wanted == there:
        return df.filter(digest <= F.lit(last))
    ties = df.filter(digest == F.lit(last))
    row = F.md5(F.to_json(F.struct(*(field(c) for c in df.columns)), {"ignoreNullFields": "false"}).cast("binary"))
    last_row, wanted, there = nth_digest(ties, row, wanted)
    if wanted == there:
        chosen = ties.filter(row <= F.lit(last_row))
    else:
        like = ties.filter(row == F.lit(last_row)).agg(F.first(F.struct(*(field(c) for c in df.columns))).alias("r"))
        copies = like.select(F.explode(F.array_repeat("r", wanted)).alias("r")).select("r.*")
        chosen = ties.filter(row < F.lit(last_row)).unionByName(copies)
    return df.filter(digest < F.lit(last)).unionByName(chosen)


def first_rows(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in an order, stored; without an order any ``n`` rows.

    Up to HEAP_ROWS rows each task keeps its first ones, and these meet in one. More are cut by a bound on the first column of
    the order, where it has one, dealt by ranges, sorted within these, numbered and stored; the counts of the ranges tell
    where to cut.
    """
    if n <= HEAP_ROWS:
        return stored((df.orderBy(*(field(c) for c in order_by)) if order_by else df).limit(n), "first-rows")
    if not order_by:
        return stored(smallest(df, n, F.md5(F.to_json(F.struct(*(field(c) for c in df.columns))).cast("binary"))), "first-rows")
    order = [field(c) for c in order_by]
    name = "_place"
    while name in df.columns:
        name += "_"
    ranged = _bounded(df, n, order_by[0]).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(ranged.withColumn(name, F.monotonically_increasing_id()), "first-rows")
    # A number holds its range in the upper bits and the place in it in the lower 33.
    counts = numbered.groupBy(F.shiftright(name, 33).alias("part")).count().orderBy("part").collect()
    left, end = n, None
    for part, count in counts:
        if count >= left:
            end = (part << 33) + left
            break
        left -= count
    return (numbered if end is None else numbered.filter(F.col(name) < F.lit(end))).drop(name)


def _bounded(df: DataFrame, n: int, first: str) -> DataFrame:
    """The rows up to a bound of the column that leaves ``n`` rows at least, for numbers and times."""
    kind = df.schema[first].dataType
    if not (isinstance(kind, T.NumericType) or is_temporal(kind)):
        return df
    value = field(first)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count(value).alias("known")).first()
    nothing = row["rows"] - row["known"]  # comes first
    share = (n - nothing) / max(row["known"], 1) + 2 / ACCURACY
    if share >= 1:
        return df
    if share <= 0:
        return df.filter(value.isNull())
    bound = df.agg(F.percentile_approx(value, share, ACCURACY).alias("b")).select(F.col("b")).first()["b"]
    cut = df.filter(value.isNull() | (value <= F.lit(bound)))
    return cut if cut.count() >= n else df
