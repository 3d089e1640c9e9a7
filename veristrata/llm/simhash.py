"""Near-duplicates by SimHash fingerprints: links at few differing bits, found through bit counts.

A fingerprint is cut into segments and mapped to the number of set bits of each. The Manhattan distance of
two such points is never more than the number of differing bits, so linked fingerprints lie in the same
cell of the integer grid or in cells not farther apart than the radius. Every distinct fingerprint is kept in its
own cell and looks into the cells around it, of each pair of cells only in one direction; the pairs that meet are
verified by their bits. Documents with equal fingerprints are one node. Components of the links
give the groups.

A fingerprint has a bounded number of possible partners (2,080 at two bits), so the links of any group, however
large, grow in proportion to its distinct fingerprints.

Defined cases: NULL and wordless texts have the fingerprint zero, linked like any other; texts of fewer words
than a shingle are one shingle; repeated rows are in the group of their like, NULL ids last; very long texts are read
whole; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.llm.common import bloom, free_names, row_marks, sifted, stored, whole_text, words_of
from veristrata.llm.components import components

SHINGLE = 3
RADIUS = 2
SEGMENTS = 16
SEED = 42
STEP = 1 << 15  # hashes whose bits are counted at a time


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' XXH64 hashes."""
    import xxhash

    words = words_of(text)
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(" ".join(words).encode(), SEED)
    joined = " ".join(words).encode()
    lengths = np.fromiter(map(len, [w.encode() for w in words]) if not joined.isascii() else map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    n = len(words) - size + 1
    ends = (starts + lengths)[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends, strict=True)), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        bits = np.unpackbits(hashes[at : at + STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint as a signed 64-bit number."""
    return _with_fingerprint(df.select(F.col(key), whole_text(text).alias("_text")), size)


def _with_fingerprint(df: DataFrame, size: int) -> DataFrame:
    """The columns but the last, a text, and ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            found = np.fromiter((fingerprint(t, size) for t in texts.to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found.view(np.int64))], names=[*names, "fp"])

    names = df.columns[:-1]
    return df.mapInArrow(run, T.StructType([*df.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def _bit_counts(fp: Column, segments: int) -> list[Column]:
    """Set bits of each segment; segment lengths differ by one at most."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [
        F.bit_count(F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)))
        for a, b in zip(edges, edges[1:], strict=False)
    ]


def neighbour_steps(segments: int, radius: int, base: int) -> list[int]:
    """Differences of cell numbers within the Manhattan radius, one of each opposite pair, zero included."""
    places = [base**i for i in range(segments)]
    steps: set[int] = {0}
    reach = {(0,) * segments}
    for _ in range(radius):
        grown = set()
        for point in reach:
            for i in range(segments):
                for d in (-1, 1):
                    grown.add(point[:i] + (point[i] + d,) + point[i + 1 :])
        reach |= grown
    for point in reach:
        number = sum(x * p for x, p in zip(point, places, strict=True))
        steps.add(abs(number))
    return sorted(steps)


def links(nodes: DataFrame, fp: str = "fp", segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """(a, b) of the distinct fingerprints ``nodes`` that differ in one to ``radius`` bits.

    The number of a cell is the counts read as digits; the base leaves room for counts below and above, so
    that cell numbers differ by a step's number only if the counts differ by that step.
    """
    longest = -(-64 // segments)
    base = longest + 2 * radius + 1
    if base**segments >= 1 << 63:
        raise ValueError("too many segments for the numbers of the cells")
    number = F.lit(0).cast("long")
    for i, count in enumerate(_bit_counts(F.col(fp), segments)):
        number = number + count * F.lit(base**i).cast("long")
    cells = nodes.select(F.col(fp).alias("fp"), number.alias("cell"))
    steps = F.array(*[F.lit(s).cast("long") for s in neighbour_steps(segments, radius, base)])
    looking = cells.select(F.col("fp").alias("b"), F.explode(F.transform(steps, lambda s: F.col("cell") + s)).alias("cell"))
    pairs = looking.join(cells.withColumnRenamed("fp", "a"), "cell").where(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
           segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint as 16 hexadecimal digits, component_id: the smallest key of the group)."""
    marked = stored(fingerprints(df, key, text, size), "fingerprints")
    classes = _classes(marked, key, segments, radius)
    return marked.join(classes, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(marked: DataFrame, key: str, segments: int, radius: int) -> DataFrame:
    """(fp, component: a fingerprint that names the group, component_id: its smallest key)."""
    nodes = stored(marked.groupBy("fp").agg(F.min(key).alias("first")), "nodes")
    found = components(links(nodes, "fp", segments, radius))
    grouped = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    return grouped.join(least, "component").select("fp", "component", "component_id")


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """One row of each group, whole: the one with the smallest key, NULL last, and of several with that key the one
    with the smallest hash of its columns.

    Groups are told by fingerprints, not by keys, so repeated and NULL keys put no other group's text at risk. Rows
    are known by 128 bits of all their columns; rows that are surely alone in their group are not shuffled.
    """
    h1, h2, content = free_names(df, "h1", "h2", "content")
    rows = df.withColumns(dict(zip((h1, h2), row_marks(df), strict=True)))
    named = rows.select(F.col(f"`{key}`").alias("key"), F.col(h1).alias("h1"), F.col(h2).alias("h2"), whole_text(text).alias(content))
    marked = stored(_with_fingerprint(named, size), "fingerprints")
    grouped = marked.join(_classes(marked, "key", segments, radius).select("fp", "component"), "fp")
    order = F.struct(F.col("key").isNull().alias("nil"), "key", "h1", "h2")
    groups = grouped.groupBy("component").agg(F.count("*").alias("rows"), F.min(order).alias("first"))
    groups = stored(groups.where("rows > 1").select("component", "first.h1", "first.h2"), "groups")
    crowd = stored(grouped.join(groups.select("component"), "component", "left_semi").select("h1", "h2").distinct(), "crowd")
    bits = bloom(crowd, "h1", "h2")
    alone = sifted(rows, bits, h1, h2, inside=False).select(df.columns)
    maybe = sifted(rows, bits, h1, h2)
    on = lambda other: (maybe[h1] == other["h1"]) & (maybe[h2] == other["h2"])
    spared = maybe.join(crowd, on(crowd), "left_anti")
    kept = maybe.join(groups, on(groups), "left_semi").dropDuplicates([h1, h2])
    return alone.union(spared.select(df.columns)).union(kept.select(df.columns))
