"""Exact top-k search by distributed selection on score histograms.

Queries and candidates meet in blocks of bounded size (every query block with every candidate block). A
pass multiplies the blocks' matrices and counts, per query, the best scores in equal bins of the range in
which the k-th score is still sought; the counts of all blocks add up to the global histogram, which tells the bin
of the k-th score. The next pass refines that bin, until it is one score wide. The last pass emits the
scores above it, and of those equal to it the smallest ids, of which the final ranking keeps k.

A block counts only its own k best scores of a query: what lies below them can't hold the k-th.

Vectors are turned into integers, floor(scale * x), and scores are exact integers: by products of matrices of doubles where
both vectors are shorter than 2**26, else by Python's integers, for the rows of a block that need them only.

Defined cases: vectors that are NULL, empty, or hold NULL or non-finite components, and rows without id,
take no part; vectors are scored against those of their own length only; a row is no candidate for queries of its
own id, repeated rows included; ties go to the smaller id; fewer than k candidates are all returned; an
empty table gives no row; components beyond what a long holds count as the nearest long, scores beyond 2**61 in size as
2**61 with their sign.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veristrata.llm.common import stored

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 4096
BINS = 4096
STEP = 256  # candidates that are multiplied at a time
SHORT = 2.0**26  # products of vectors up to this length are exact in doubles
MOST = 1 << 61  # greatest score
NONE = np.iinfo(np.int64).min  # in place of a score: no candidate


def integers(df: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v, length): the rows that take part, components as integers."""
    x = F.col(vector)
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = df.where(F.col(key).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, odd))
    return rows.select(
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"),
        F.size(x).alias("length"),
    )


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _doubles(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the rows as doubles, long ones as zeros; places of the long rows)."""
    values = matrix.astype(np.float64)
    far = np.flatnonzero(np.linalg.norm(values, axis=1) >= SHORT)
    values[far] = 0
    return values, far


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.clip(left.astype(object) @ right.astype(object).T, -MOST, MOST).astype(np.int64)


def _scores(queries: pa.Table, candidates: pa.Table):
    """(candidate ids, scores of candidates x queries; NONE for a query's own row) step by step."""
    left, right = _matrix(queries), _matrix(candidates)
    near, far_queries = _doubles(left)
    names = queries.column("id").to_numpy()
    ids = candidates.column("id").to_numpy()
    for at in range(0, len(ids), STEP):
        part, rows = ids[at : at + STEP], right[at : at + STEP]
        values, far = _doubles(rows)
        scores = (values @ near.T).astype(np.int64)
        if len(far_queries):
            scores[:, far_queries] = _exact(rows, left[far_queries])
        if len(far):
            scores[far] = _exact(rows[far], left)
        scores[part[:, None] == names[None, :]] = NONE
        yield part, scores


def _histogram(k: int):
    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"id": [], "bin": [], "n": []}
        if queries.num_rows and candidates.num_rows:
            low = queries.column("low").to_numpy()
            width = queries.column("width").to_numpy()
            high = low + queries.column("span").to_numpy()
            best = np.zeros((0, len(low)), np.int64)
            for _, scores in _scores(queries, candidates):
                scores[(scores < low) | (scores >= high)] = NONE
                best = np.concatenate([best, scores])
                if len(best) > k:
                    best = np.partition(best, len(best) - k, axis=0)[-k:]
            row, column = np.nonzero(best != NONE)
            bins = (best[row, column] - low[column]) // width[column]
            pairs, counts = np.unique(column * BINS + bins, return_counts=True)
            out = {"id": queries.column("id").to_numpy()[pairs // BINS], "bin": pairs % BINS, "n": counts}
        return pa.table({c: pa.array(np.asarray(v, np.int64)) for c, v in out.items()})

    return run


def _emit(k: int):
    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3
        if queries.num_rows and candidates.num_rows:
            names = queries.column("id").to_numpy()
            least = queries.column("low").to_numpy()
            parts, ties = [], []
            for ids, scores in _scores(queries, candidates):
                row, column = np.nonzero(scores > least)
                parts.append((names[column], ids[row], scores[row, column]))
                row, column = np.nonzero(scores == least)
                ties.append((column, ids[row]))
            column = np.concatenate([t[0] for t in ties])
            ids = np.concatenate([t[1] for t in ties])
            order = np.lexsort((ids, column))
            column, ids = column[order], ids[order]
            place = np.arange(len(column)) - np.searchsorted(column, column)
            column, ids = column[place < k], ids[place < k]
            parts.append((names[column], ids, least[column]))
            found = [np.concatenate([p[i] for p in parts]) for i in range(3)]
        return pa.table({c: pa.array(v) for c, v in zip(("query_id", "vec_id", "score"), found, strict=True)})

    return run


def search(df: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
           scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row for which ``is_query`` holds.

    Each query id stands for one query; of repeated rows of an id the greatest vector is taken.
    """
    rows = stored(integers(df, key, vector, scale), "vectors")
    sizes = rows.agg(
        F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)),
    ).first()
    total, largest = sizes[0], math.sqrt(sizes[1] or 0.0)
    asked = (
        rows.where(is_query).groupBy("id").agg(F.max(F.struct("v", "length")).alias("q"))
        .select("id", "q.v", "q.length")
    )
    bound = min(math.ceil(largest * largest) + 1, MOST)
    width = F.expr(f"(span + {BINS - 1}) div {BINS}")
    start = asked.select(
        "*", F.lit(-bound).cast("long").alias("low"), F.lit(2 * bound + 1).cast("long").alias("span"),
        F.lit(0).cast("long").alias("above"),
    )
    state = stored(start, "queries").withColumn("width", width)
    query_blocks = max(1, math.ceil(state.count() / QUERY_BLOCK))
    candidate_blocks = max(1, math.ceil(total / CANDIDATE_BLOCK))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    candidates = rows.select(
        "id", "v", "length", F.pmod(F.monotonically_increasing_id(), F.lit(candidate_blocks)).alias("c")
    ).select("*", blocks.alias("q"))

    def met(queries: DataFrame, function, schema: str) -> DataFrame:
        dealt = queries.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).withColumn(
            "c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(candidate_blocks - 1).cast("long")))
        )
        by = ("length", "q", "c")
        return dealt.groupBy(*by).cogroup(candidates.groupBy(*by)).applyInArrow(function, schema)

    down = Window.partitionBy("id").orderBy(F.desc("bin"))
    while True:
        counts = met(state, _histogram(k), "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        placed = counts.withColumn("upto", F.sum("n").over(down))
        # Counted from ``above``, the number of scores over the range, the k-th is the (k - above)-th.
        kth = placed.join(state.select("id", "above"), "id").groupBy("id").agg(
            F.max(F.when(F.col("upto") + F.col("above") >= k, F.struct(
                "bin", (F.col("upto") - F.col("n") + F.col("above")).alias("above")))).alias("at")
        )
        found = F.col("at").isNotNull()
        state = stored(
            state.join(kth, "id", "left").select(
                "id", "v", "length",
                # Fewer than k candidates: no bin holds the k-th, and all of them are taken.
                F.when(found, F.col("low") + F.col("at.bin") * F.col("width")).otherwise(-bound).alias("low"),
                F.when(found, F.col("width")).otherwise(1).alias("span"),
                F.coalesce("at.above", F.lit(0)).cast("long").alias("above"),
            ),
            "queries",
        )
        if (state.agg(F.max("span")).first()[0] or 1) <= 1:
            break
        state = state.withColumn("width", width)
    best = met(state, _emit(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
