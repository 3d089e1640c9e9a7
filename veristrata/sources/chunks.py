"""Results of any size in chunks of a bounded number of rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veristrata.session import stored

_PLACES = 33  # bits of a row's place in its partition


def with_chunks(df: DataFrame, size: int, name: str = "chunk") -> DataFrame:
    """The rows with the number of their chunk, from 0; each chunk but the last has ``size`` rows.

    The rows are stored once with their partition and place; from the counts of the partitions, a row each, follows
    every row's number. Nothing is sorted or gathered.
    """
    if size < 1 or name in df.columns:
        raise ValueError("chunks need a size of one row at least, and a column name of their own")
    numbered = stored(df.withColumn(name, F.monotonically_increasing_id()), "chunks")
    part = F.shiftright(name, _PLACES)
    counts = numbered.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, offsets = 0, []
    for r in counts:
        offsets.append((r["part"], before))
        before += r["count"]
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")  # a row for each partition
    joined = numbered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    number = F.col("_before") + F.col(name).bitwiseAND(F.lit((1 << _PLACES) - 1))
    return joined.withColumn(name, F.floor(number / F.lit(size))).drop("_part", "_before")


def chunks(df: DataFrame, size: int) -> Iterator[DataFrame]:
    """The rows as DataFrames of ``size`` rows each (the last one fewer), none of them collected."""
    name = "chunk"
    while name in df.columns:
        name += "_"
    rows = with_chunks(df, size, name)
    last = rows.agg(F.max(name)).first()[0]
    for i in range(0 if last is None else last + 1):
        yield rows.filter(F.col(name) == i).drop(name)
