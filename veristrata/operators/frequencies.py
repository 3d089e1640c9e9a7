"""How often each value occurs, for many columns in one pass over the table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.functions.columns import field, literal, result_rows

# Longer values are represented by a digest wherever only their identity counts.
IDENTITY_BYTES = 64
TOP_PARTS = 256
# What one task counts: bytes of values, each with its share of the hash tables and of the sort.
TASK_BYTES = 64 << 20
VALUE_BYTES = 64
# Parts of values to each task, so that tasks get about the same number of values.
PARTS_PER_TASK = 16


def as_text(df: DataFrame, name: str) -> Column:
    """The value as text; -0.0 and 0.0 are one value."""
    column = field(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        column = F.when(column == 0, F.lit(0.0)).otherwise(column)
    return column.cast("string")


def identity_text(df: DataFrame, name: str) -> Column:
    """Text that is the same for equal values only: an instant by its microseconds, as its clock text in a
    zone with summer time stands for two instants; long texts by a digest."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(field(name)).cast("string")
    text = as_text(df, name)
    return identity(text) if isinstance(data_type, (T.StringType, T.BinaryType)) else text


def identity(text: Column) -> Column:
    """The text itself, or a SHA-256 mark for long ones, so that shuffles stay narrow."""
    digest = F.concat(F.lit("#"), F.sha2(text.cast("binary"), 256))
    return F.when(F.octet_length(text) > IDENTITY_BYTES, digest).otherwise(text)


def value_counts(df: DataFrame, columns: Sequence[str], identities: bool = False, parts: bool = False) -> DataFrame:
    """``(column, value, occurrences)``, NULL left out.

    Equal values are combined before the shuffle, so a value that fills a third of the rows costs
    one row per task. Columns travel under their position, which keeps shuffled rows short.

    Tables of more than ``TASK_BYTES`` are counted by tasks of about that size, however large a split of the source is: the
    rows are dealt to them, counted there, and these counts are added up by parts of each column's values. The size is one
    more pass, which reads the texts only if they travel whole. With ``parts`` the counts of such tables have a column
    ``_part``, by which they are partitioned.
    """
    names = list(columns)
    text = identity_text if identities else as_text
    texts = df.select(*(text(df, c).alias(f"{i}") for i, c in enumerate(names)))
    tasks = _tasks(df, texts, names, identities)
    own = []
    if tasks > 1:
        # By what a row holds and where it lies, not by its place there, so that a repeated task deals alike, and equal rows
        # of different splits meet in no one task.
        row = F.xxhash64(*(f"`{i}`" for i in range(len(names))), F.spark_partition_id())
        texts = texts.withColumn("_task", F.pmod(row, F.lit(tasks)).cast("int")).repartitionById(tasks, "_task")
        own = ["_task"]
    # Not ``unpivot``, after which Spark no longer knows that a task's rows are together.
    values = F.posexplode(F.array(*(f"`{i}`" for i in range(len(names)))))
    counts = (
        texts.select(*own, values.alias("position", "value"))
        .filter("value IS NOT NULL")
        .groupBy(*own, "position", "value")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    kept = []
    if tasks > 1:
        spread = max(TOP_PARTS, math.ceil(PARTS_PER_TASK * tasks / len(names)))
        part = F.col("position").cast("bigint") * spread + F.pmod(F.xxhash64("value"), F.lit(spread))
        counts = (
            counts.select("position", "value", "occurrences", part.alias("_part"))
            .repartition(tasks, "_part")
            .groupBy("_part", "position", "value")
            .agg(F.sum("occurrences").alias("occurrences"))
        )
        kept = ["_part"] if parts else []
    return counts.select(_name_at("position", names), "value", "occurrences", *kept)


def _tasks(df: DataFrame, texts: DataFrame, names: list[str], identities: bool) -> int:
    """How many tasks are to count the texts of a table."""
    if not names:
        return 1
    size = F.lit(VALUE_BYTES * len(names)).cast("bigint")
    for i, c in enumerate(names):
        data_type = df.schema[c].dataType
        whole = isinstance(data_type, (T.StringType, T.BinaryType)) and not identities
        if whole or not isinstance(data_type, T.AtomicType):
            size = size + F.coalesce(F.octet_length(f"`{i}`"), F.lit(0))
    return max(1, math.ceil((texts.agg(F.sum(size)).first()[0] or 0) / TASK_BYTES))


def _name_at(position: str, names: list[str]) -> Column:
    listed = ", ".join(literal(n) for n in names)
    return F.expr(f"element_at(array({listed}), cast({position} AS int) + 1)").alias("column")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """``(column, distinct_count, repeated_values, repeated_rows)`` per column with any value.

    ``approximate`` uses one HyperLogLog sketch per column instead of shuffling the values; the
    repeated_* columns are then NULL.
    """
    if approximate:
        sketches = [F.approx_count_distinct(field(c)).alias(f"d{i}") for i, c in enumerate(columns)]
        nothing = "cast(NULL AS bigint)"
        rows = [
            {"column": literal(c), "distinct_count": f"d{i}", "repeated_values": nothing,
             "repeated_rows": nothing}
            for i, c in enumerate(columns)
        ]
        return df.agg(*sketches).select(result_rows(rows)).filter("distinct_count > 0")
    repeated = F.col("occurrences") > 1
    return (
        value_counts(df, columns, identities=True)
        .groupBy("column")
        .agg(
            F.count("*").alias("distinct_count"),
            F.count_if(repeated).alias("repeated_values"),
            F.sum(F.when(repeated, F.col("occurrences")).otherwise(0)).alias("repeated_rows"),
        )
    )


def top_values(counts: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values per column, ties by value.

    The values of a column are ranked in parts first, so that no more than ``k`` of each part meet, whatever ``k``. Counts
    that have their parts (see ``value_counts``) are ranked where they are.
    """
    best = [F.desc("occurrences"), F.asc("value")]
    part = F.pmod(F.xxhash64("value"), F.lit(TOP_PARTS))
    parts = counts if "_part" in counts.columns else counts.withColumn("_part", part)
    local = Window.partitionBy("column", "_part").orderBy(*best)
    counts = parts.withColumn("_n", F.row_number().over(local)).filter(F.col("_n") <= k).drop("_n", "_part")
    order = Window.partitionBy("column").orderBy(*best)
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
