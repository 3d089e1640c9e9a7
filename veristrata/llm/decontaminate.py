"""Benchmark decontamination: finds items of a benchmark inside documents, however long these are.

Words are runs of letters, digits and underscores in small letters; shingles are five words in a row. A
document holds an item if it has at least ``share`` of the item's distinct shingles.

A sketch of an item is its smallest shingle hashes. Of n shingles at most n - ceil(share * n) can be
missing from a document that holds the item, so one more than that are enough: at least one of them is in
every such document, whatever the document's length. Items are partitioned by size (powers of two); each
partition has its own sketch length rule and table. A document's shingles are looked up in the tables
inside its task; each candidate is then counted exactly, by the texts of the shingles.

Benchmarks of any size are served in blocks of bounded size, one pass over the documents for each block:
only one block's items are on the driver and in the tasks at a time. Documents are not shuffled.

Defined cases: NULL texts are empty; items or documents of less than five words have no shingle and match
nothing; an item that repeats is one item per row; a repeated document repeats its result; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veristrata.llm.common import stored
from veristrata.llm.rolling import PrefixHash, mix, powers

WORDS = 5
SHARE = 0.8
BLOCK_SHINGLES = 1_000_000  # of the items that are in memory at a time
WORD = re.compile(r"\w+")
FILTER_BITS = 20


def needed(n: int, share: float = SHARE) -> int:
    return max(1, math.ceil(share * n - 1e-9))


_TABLE: list[np.ndarray] = []


def _word_characters() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(c).isalnum() or c == 95 for c in range(0x110000)), bool, 0x110000))
    return _TABLE[0]


def shingle_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the shingles of each text, in order, repeats included."""
    lowered = [t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _word_characters()[codes]
    steps = np.diff(inside)
    first, last = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    words = mix(PrefixHash(codes).part(first, last) + (last - first).astype(np.uint64))
    n = len(words) - WORDS + 1
    ends = np.cumsum([len(t) for t in lowered])
    cuts = np.searchsorted(first, ends).tolist()
    if n <= 0:
        return [np.zeros(0, np.uint64) for _ in texts]
    factors = powers(0xD6E8FEB86659FD93, WORDS)
    joined = np.zeros(n, np.uint64)
    for i in range(WORDS):
        joined += words[i : i + n] * factors[i]
    joined = mix(joined)
    out, start = [], 0
    for stop in cuts:
        out.append(joined[start : max(start, min(stop - WORDS + 1, n))])
        start = stop
    return out


def shingle_texts(text: str) -> list[str]:
    words = WORD.findall(text.lower())
    return [" ".join(words[i : i + WORDS]) for i in range(len(words) - WORDS + 1)]


class Sketches:
    """A block of items: for each partition by size, the sketch hashes sorted, and the item of each."""

    def __init__(self, items: list[tuple[object, str]], share: float = SHARE):
        self.ids, self.texts, self.hashes, self.need = [], [], [], []
        by_size: dict[int, list[tuple[int, int]]] = {}
        for (name, text), found in zip(items, shingle_hashes([t for _, t in items]) if items else [], strict=True):
            own = np.unique(found)
            if not len(own):
                continue
            at = len(self.ids)
            self.ids.append(name)
            self.texts.append(text)
            self.hashes.append(own)
            self.need.append(needed(len(own), share))
            for h in own[: len(own) - self.need[-1] + 1].tolist():
                by_size.setdefault(len(own).bit_length(), []).append((h, at))
        self.tables = []
        for pairs in by_size.values():
            pairs.sort()
            keys = np.array([h for h, _ in pairs], np.uint64)
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[keys >> np.uint64(64 - FILTER_BITS)] = True
            self.tables.append((keys, np.array([i for _, i in pairs]), bits))
        self.shingles: dict[int, set[str]] = {}

    def candidates(self, hashes: np.ndarray) -> set[int]:
        """Items of which a sketch hash is among the hashes."""
        found: set[int] = set()
        prefix = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        for keys, items, bits in self.tables:
            some = hashes[bits[prefix]]
            if len(some):
                left, right = np.searchsorted(keys, some), np.searchsorted(keys, some, side="right")
                for a, b in zip(left[left < right].tolist(), right[left < right].tolist(), strict=True):
                    found.update(items[a:b].tolist())
        return found

    def matches(self, text: str, hashes: np.ndarray) -> list[tuple[object, int, int]]:
        """(item, its shingles, those in the text) of the items that the text holds, counted by texts."""
        out, own, exact = [], None, None
        for i in sorted(self.candidates(hashes)):
            if own is None:
                own = np.unique(hashes)
            if len(np.intersect1d(own, self.hashes[i], assume_unique=True)) < self.need[i]:
                continue
            if exact is None:
                exact = set(shingle_texts(text))
            if i not in self.shingles:
                self.shingles[i] = set(shingle_texts(self.texts[i]))
            item = self.shingles[i]
            both = len(item & exact)
            if both >= self.need[i]:
                out.append((self.ids[i], len(item), both))
        return out


def _word_counts(rows: DataFrame) -> DataFrame:
    """(words) of the column ``text``, by the same words as the shingles have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [sum(1 for _ in WORD.finditer(t.lower())) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["words"])

    return rows.select("text").mapInArrow(run, "words long")


def item_blocks(items: DataFrame, key: str, text: str, block: int = BLOCK_SHINGLES) -> Iterator[tuple[list[tuple], bool]]:
    """Items in blocks of about ``block`` words at most, each collected on its own, and whether it is the only one;
    dealt by a hash."""
    rows = items.select(
        F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    size = _word_counts(rows).agg(F.sum("words")).first()[0] or 0
    parts = max(1, math.ceil(size / block))
    for part in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        yield [tuple(r) for r in mine.collect()], parts == 1


def find(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
         item_key: str = "item_id", item_text: str = "text", share: float = SHARE,
         block: int = BLOCK_SHINGLES) -> DataFrame:
    """(key, item_key, item_shingles, shared_shingles, containment) for each document and item it holds."""
    doc_kind, item_kind = documents.schema[key].dataType, items.schema[item_key].dataType
    schema = (
        f"`{key}` {doc_kind.simpleString()}, `{item_key}` {item_kind.simpleString()}, "
        "item_shingles long, shared_shingles long, containment double"
    )
    source = documents.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    context = documents.sparkSession.sparkContext
    passes = []
    for chosen, only in item_blocks(items, item_key, item_text, block):
        shared = context.broadcast(Sketches(chosen, share))  # one block: bounded by BLOCK_SHINGLES
        found = source.mapInArrow(_searcher(shared, key, item_key, item_kind), schema)
        if not only:
            found = stored(found, "matches")
            shared.destroy()  # before the next block is sent
        passes.append(found)
    result = passes[0]
    for more in passes[1:]:
        result = result.union(more)
    return result


def _searcher(shared, key: str, item_key: str, item_kind):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(item_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = shared.value
        for batch in batches:
            rows, found = [], []
            start, size, texts = 0, 0, batch.column(1).to_pylist()
            for i, text in enumerate(texts):
                size += len(text)
                if size > 1_000_000 or i == len(texts) - 1:
                    block = texts[start : i + 1]
                    for j, hashes in enumerate(shingle_hashes(block)):
                        for match in sketches.matches(block[j], hashes):
                            rows.append(start + j)
                            found.append(match)
                    start, size = i + 1, 0
            shingles = np.array([f[1] for f in found], np.int64)
            both = np.array([f[2] for f in found], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array([f[0] for f in found], kind),
                    pa.array(shingles), pa.array(both), pa.array(both / np.maximum(shingles, 1)),
                ],
                names=[key, item_key, "item_shingles", "shared_shingles", "containment"],
            )

    return run


def without(documents: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
            item_text: str = "text", share: float = SHARE, block: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that hold no item, all columns as they were. Of several blocks of items each sifts what the ones
    before it have left; what is left is written down, so that the tasks hold one block at a time."""
    context = documents.sparkSession.sparkContext
    at = documents.columns.index(text)
    rest = documents
    for chosen, only in item_blocks(items, item_key, item_text, block):
        shared = context.broadcast(Sketches(chosen, share))  # one block: bounded by BLOCK_SHINGLES
        rest = rest.mapInArrow(_sieve(shared, at), documents.schema)
        if not only:
            rest = stored(rest, "clean")
            shared.destroy()  # before the next block is sent
    return rest


def _sieve(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [t or "" for t in part.column(at).to_pylist()]
                clean = [not sketches.matches(t, h) for t, h in zip(texts, shingle_hashes(texts), strict=True)]
                yield part.filter(pa.array(clean, pa.bool_()))

    return run
