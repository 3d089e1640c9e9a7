"""Ranked lexical search: for each item of a stated set the documents with the highest scores, by NRA.

Terms are runs of letters and digits, and of all characters beyond ASCII. A score is a sum of integers over the item's
terms, each the term's weight times a share that grows with the term's count in the document and shrinks with the
document's length (see ``impacts``).

1. The items' different texts are dealt into blocks of bounded bytes; the following is done for each block.
2. One pass over the documents keeps, for each, the number of its terms and the counts of the block's terms. The table is
   written; sums over it give the documents, all terms, and the documents of each term.
3. A second pass over the table searches portions of documents, bounded in terms. The portion's lists, one a term, are sorted
   by impact and read in order from the top, some further places each round. From what is read every document has
   a lower bound, and an upper bound by what is next in the lists where it was not seen; documents not seen at all are
   bounded by the sum of these. Those that can't reach the k-th lower bound are given up; reading goes on until every
   document left has equal bounds, so that membership, ties and scores are final. What a task has found so far is the bound
   that its next portions start from.
4. Each task gives its best k of each text; they are ranked by score and key in two steps, so that no group is larger than
   the root of the number of tasks, about.

Bounds: an item block of ITEM_BYTES on the driver and in the tasks, with the weights of its terms; portions of POSTINGS.

Defined cases: NULL texts have no terms; documents without any do not count; items without a term, or whose terms are in
no document, have no row; repeated items are ranked each; repeated documents each count and each can be ranked; documents
with equal scores come by key, NULL last; texts of any length are read whole; an empty table on either side gives
no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.llm.common import free_names, stored, whole_text

K = 10
ITEM_BYTES = 4 << 20  # of item texts that are searched in one pass
POSTINGS = 1 << 20  # of the documents that are searched together
FIRST, FURTHER = 64, 4  # places of each list that are read in the first round, and times as many in each later one
GROUPS = 256  # of tasks, in the first ranking

# What separates terms: all of ASCII but letters and digits. A-Z are read as a-z.
_BYTES = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms_of(text: str | bytes) -> list[bytes]:
    data = text if isinstance(text, bytes) else text.encode()
    return data.translate(_BYTES).split()


def weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """What a term adds to a document's score, by its weight and count and the document's terms."""
    if 75 * int(n.max(initial=0)) * documents < 1 << 63:
        long = 25 + 75 * n * documents // all_terms
    else:
        long = np.array([25 + 75 * x * documents // all_terms for x in n.tolist()], np.int64)
    return weights * (1_000_000_000 * tf // (1000 * tf + 8 * long))


class Items:
    """A block of item texts: their terms, numbered, and each text's numbers with their counts."""

    def __init__(self, texts: list[str]):
        counts = [Counter(terms_of(t)) for t in texts]
        self.numbers: dict[bytes, int] = {}
        for c in counts:
            for term in c:
                self.numbers.setdefault(term, len(self.numbers))
        self.terms = [np.array([self.numbers[t] for t in c], np.int64) for c in counts]
        self.times = [np.array(list(c.values()), np.int64) for c in counts]
        self.weights = np.zeros(len(self.numbers), np.int64)


class Lists:
    """The postings of a portion of documents, by term, each list by impact from the top."""

    def __init__(self, term: np.ndarray, document: np.ndarray, impact: np.ndarray, documents: int, terms: int):
        order = np.lexsort((document, -impact, term))
        self.document, self.impact = document[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(terms + 1))
        self.documents = documents

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k highest scores that are above 0 and not below ``least``, ties by number."""
        begin, size = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        full = size > 0
        begin, size, times = begin[full], size[full], times[full]
        lower, seen = np.zeros(self.documents, np.int64), np.zeros(self.documents, np.int64)
        left, read, depth = None, np.zeros(len(begin), np.int64), FIRST
        done = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]  # what is read: documents and list numbers
        while True:
            upto = np.minimum(size, depth)
            which = np.repeat(np.arange(len(begin)), upto - read)
            at = np.arange(len(which)) + np.repeat(begin + read - (np.cumsum(upto - read) - (upto - read)), upto - read)
            found = self.document[at]
            if left is not None:  # those given up are read past
                kept = left[found]
                found, which, at = found[kept], which[kept], at[kept]
            np.add.at(lower, found, times[which] * self.impact[at])
            done[0].append(found)
            done[1].append(which)
            read = upto
            ahead = np.where(read < size, times * self.impact[np.minimum(begin + read, len(self.impact) - 1)], 0)
            bound = max(least, 1)
            if np.count_nonzero(lower) >= k:
                bound = max(bound, int(np.partition(lower, len(lower) - k)[-k]))
            unseen = int(ahead.sum())
            if unseen < bound:
                # Upper bound: what was read, and what may still come from the lists where the document was not seen.
                seen[:] = 0
                for documents, lists in zip(*done, strict=True):
                    np.add.at(seen, documents, ahead[lists])
                left = lower + unseen - seen >= bound
                left &= lower > 0
                open_ = left & (unseen - seen > 0)
                if not open_.any():
                    break
            depth *= FURTHER
        chosen = np.flatnonzero(left)
        chosen = chosen[np.lexsort((chosen, -lower[chosen]))][:k]
        return chosen, lower[chosen]


def _entries(documents: DataFrame, key: str, text: str, shared) -> DataFrame:
    """(key, n, terms, counts) of documents with terms: the number of terms, and the block's terms with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, size = shared.value.numbers.get, len(shared.value.numbers)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [terms_of(t) for t in rows.column(1).cast(pa.binary()).to_pylist()]
                n = np.array([len(x) for x in found])
                numbers = np.fromiter((i for x in found for i in map(find, x, repeat(-1))), np.int64, n.sum())
                known = numbers >= 0
                pairs = np.repeat(np.arange(len(n)), n)[known] * size + numbers[known]
                pairs, counts = np.unique(pairs, return_counts=True)
                of = pairs // max(size, 1)
                ends = np.searchsorted(of, np.arange(len(n)), side="right")
                kept = pa.array(np.flatnonzero(n > 0))
                columns = [_lists((pairs % max(size, 1)).astype(np.int32), ends), _lists(counts.astype(np.int32), ends)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(kept), pa.array(n).take(kept), *[c.take(kept) for c in columns]],
                    names=[key, "n", "terms", "counts"],
                )

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([
        documents.schema[key], T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("counts", ints)
    ])
    return documents.select(F.col(key), whole_text(text).alias("_text")).mapInArrow(run, schema)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))


def _holders(entries: DataFrame, terms: int) -> np.ndarray:
    """Documents of each term; counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(terms, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["term", "held"])

    rows = entries.select("terms").mapInArrow(run, "term long, held long").groupBy("term").agg(F.sum("held").alias("held"))
    out = np.zeros(terms, np.int64)
    for r in rows.collect():  # the terms of one block of items
        out[r["term"]] = r["held"]
    return out


def _search(entries: DataFrame, key: str, shared, documents: int, all_terms: int, k: int, most: int) -> DataFrame:
    """(item, task, key, score): the best k of each text of the block in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best: list[list[tuple]] = [[] for _ in items.terms]  # (-score, NULL key, key), sorted
        kind = None
        held, size = [], 0

        def searched(portion: pa.Table) -> None:
            keys = portion.column(0).combine_chunks()
            order = pc.sort_indices(keys, null_placement="at_end").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            names = keys.take(pa.array(order))
            lists = portion.column(2).combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = portion.column(3).combine_chunks().flatten().to_numpy().astype(np.int64)
            n = np.repeat(portion.column(1).to_numpy(), sizes)
            impact = impacts(items.weights[term], tf, n, documents, all_terms)
            some = impact > 0
            index = Lists(term[some], np.repeat(place, sizes)[some], impact[some], len(order), len(items.weights))
            for i, (terms, times) in enumerate(zip(items.terms, items.times, strict=True)):
                least = -best[i][-1][0] if len(best[i]) == k else 1
                at, scores = index.best(terms, times, k, least)
                if len(at):
                    found = zip(names.take(pa.array(at)).to_pylist(), scores.tolist(), strict=True)
                    rows = [(-s, x is None, x) for x, s in found]
                    best[i] = sorted(best[i] + rows, key=lambda r: r[:2] if r[1] else r)[:k]

        def portions() -> Iterator[pa.Table]:
            nonlocal kind, held, size
            for batch in batches:
                kind = batch.column(0).type
                ends = np.cumsum(batch.column(2).value_lengths().to_numpy())
                at = 0
                while at < batch.num_rows:
                    before = ends[at - 1] if at else 0
                    stop = max(at + 1, int(np.searchsorted(ends, before + most - size, side="right")))
                    held.append(batch.slice(at, stop - at))
                    size += int(ends[stop - 1] - before)
                    at = stop
                    if size >= most or at < batch.num_rows:
                        yield pa.Table.from_batches(held)
                        held, size = [], 0
            if held:
                yield pa.Table.from_batches(held)

        for portion in portions():
            searched(portion)
        rows = [(i, x, -s) for i, own in enumerate(best) for s, _, x in own]
        if rows:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array(np.full(len(rows), part, np.int32)),
                 pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())],
                names=["item", "task", key, "score"],
            )

    schema = T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("task", T.IntegerType()), entries.schema[key],
        T.StructField("score", T.LongType()),
    ])
    return entries.select(key, "n", "terms", "counts").mapInArrow(run, schema)


def _ranked(found: DataFrame, key: str, k: int) -> DataFrame:
    """(item, rank, key, score): ranked among some tasks, then among those."""
    order = [F.desc("score"), F.asc_nulls_last(key)]
    near = Window.partitionBy("item", F.pmod("task", F.lit(GROUPS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item", "rank", key, "score")


def search(documents: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", block: int = ITEM_BYTES, portion: int = POSTINGS) -> DataFrame:
    """item_key, rank (int, from 1), key, score: for each item the documents with the k highest scores above 0."""
    if key == item_key:
        raise ValueError("documents and items need keys of different names")
    context = documents.sparkSession.sparkContext
    key_, item_ = free_names(items, "key", "item")  # whatever the keys are called
    mark = F.xxhash64(whole_text(item_text)), F.xxhash64(F.lit("second"), whole_text(item_text))
    named = items.select(F.col(item_key).alias(item_), mark[0].alias("x1"), mark[1].alias("x2"), whole_text(item_text).alias("own"))
    texts = stored(named.select("x1", "x2", "own").distinct(), "item-texts")
    bytes_ = texts.agg(F.sum(F.octet_length("own"))).first()[0] or 0
    blocks = max(1, math.ceil(bytes_ / block))
    results = None
    for b in range(blocks):
        rows = texts.where(F.pmod("x1", F.lit(blocks)) == b).collect()  # about ``block`` bytes
        own = Items([r["own"] for r in rows])
        shared = context.broadcast(own)
        entries = stored(_entries(documents.select(F.col(key).alias(key_), F.col(text).alias("text")), key_, "text", shared), "entries")
        total = entries.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        held = _holders(entries, len(own.numbers))
        own.weights = np.array([weight(total["documents"], int(x)) for x in held], np.int64)
        shared.unpersist()
        shared = context.broadcast(own)
        found = stored(_search(entries, key_, shared, total["documents"], total["terms"], k, portion), "found")
        shared.unpersist()
        marks = documents.sparkSession.createDataFrame(
            [(i, r["x1"], r["x2"]) for i, r in enumerate(rows)], "item int, x1 long, x2 long"
        )
        ranked = _ranked(found, key_, k).join(marks, "item").select("x1", "x2", "rank", key_, "score")
        results = ranked if results is None else results.union(ranked)
    return named.join(results, ["x1", "x2"]).select(
        F.col(item_).alias(item_key), F.col("rank").cast("int").alias("rank"), F.col(key_).alias(key), "score"
    )
