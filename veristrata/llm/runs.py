"""Periodic runs of words in texts, found by seeds and extension along diagonals.

A run is a stretch of consecutive words with smallest period q, of ``least`` words and 2 q words at least, that
cannot be extended with that period. On the diagonal of lag q (each word against the one q further on) it is a stretch
of at least max(least - q, q) equal words, so never fewer than half of ``least``: k-grams of that size are the seeds.

1. For k, 2 k, 4 k and so on, equal k-grams of a document are brought together by their hashes. A run with a lag from k to
   2 k - 1 has two equal k-grams at that lag (the smallest k also serves the lags below k).
2. Equal k-grams that follow within half of k overlap in a stretch of a small period. Of such a cluster only the first and the
   last are paired with all occurrences elsewhere: a run with a longer period has an end of such a stretch in it, or
   begins or ends with one, and so has one of these pairs. Each occurrence thus has a few partners, however
   often its k-gram occurs.
3. Pairs are taken by lag and place. A table holds for each lag how far its diagonal is covered; a pair in the covered part is
   skipped, any other is extended to both sides, word by word in slices. Extension compares the words themselves, so
   hashes decide nothing.
4. Of stretches over the same words the smallest lag is the period.

Several documents are searched at a time, parted by marks that equal nothing; the work is near to linear in the words.

Defined cases: NULL and wordless texts have no run and an empty collapsed text; texts of any length are searched whole;
repeated rows give a row each; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.llm.common import portions, whole_text
from veristrata.llm.rolling import PrefixHash, mix

LEAST = 12
TOGETHER = 2_000_000  # bytes of text that are searched at a time; a longer text is searched alone
SLICE = 64  # words compared at a time, then four times as many each

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _equal_ahead(words: np.ndarray, i: int, j: int) -> int:
    """Equal words from i and j on, i < j."""
    n, step, most = 0, SLICE, len(words) - j
    while n < most:
        end = min(n + step, most)
        unlike = words[i + n : i + end] != words[j + n : j + end]
        at = int(unlike.argmax())
        if unlike[at]:
            return n + at
        n, step = end, 4 * step
    return n


def _equal_back(words: np.ndarray, i: int, j: int) -> int:
    """Equal words before i and j, i < j."""
    n, step = 0, SLICE
    while n < i:
        end = min(n + step, i)
        unlike = (words[i - end : i - n] != words[j - end : j - n])[::-1]
        at = int(unlike.argmax())
        if unlike[at]:
            return n + at
        n, step = end, 4 * step
    return n


def _near_pairs(group: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of all occurrences of a gram that are fewer than k words apart."""
    first, lags = [], []
    for t in range(1, k):
        lag = place[t:] - place[:-t]
        near = (group[t:] == group[:-t]) & (lag < k)
        if not near.any():
            break
        first.append(place[:-t][near])
        lags.append(lag[near])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *lags])


def _far_pairs(group: np.ndarray, place: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of occurrences with a lag from k to 2 k - 1, of which one ends its cluster on the near side."""
    key = group * (n + 2 * k + 1) + place
    apart = np.ones(len(key), bool)
    apart[1:] = (group[1:] != group[:-1]) | (place[1:] - place[:-1] > k // 2)
    firsts, lasts = np.flatnonzero(apart), np.flatnonzero(np.append(apart[1:], True))
    # Each occurrence with the first ones of later clusters,
    low, high = np.searchsorted(key[firsts], key + k), np.searchsorted(key[firsts], key + 2 * k)
    a = np.repeat(np.arange(len(key)), high - low)
    b = firsts[_ranges(low, high)]
    # and with the last ones of earlier clusters.
    low, high = np.searchsorted(key[lasts], key - 2 * k, "right"), np.searchsorted(key[lasts], key - k, "right")
    c = lasts[_ranges(low, high)]
    d = np.repeat(np.arange(len(key)), high - low)
    first, second = place[np.concatenate([a, c])], place[np.concatenate([b, d])]
    same = group[np.concatenate([a, c])] == group[np.concatenate([b, d])]
    return first[same], (second - first)[same]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after another."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (document, start, length, period), sorted, of documents whose words are numbers >= 0 and stand one after
    another in ``words``, each followed by a negative number of its own; ``ends`` are the places of these."""
    n = len(words)
    begins = np.concatenate([[0], ends[:-1] + 1])
    document = np.repeat(np.arange(len(ends)), ends - begins + 1)
    k = max(1, least // 2)
    room = ends[document] - np.arange(n)  # words from here to the end of the document
    at = np.flatnonzero(room >= k)
    prefix = PrefixHash(mix(words.astype(np.uint64)))
    salt = mix(document.astype(np.uint64))
    smallest, found = True, []
    while len(at):
        grams = mix(prefix.part(at, at + k) + salt[at])
        order = np.argsort(grams, kind="stable")
        grams, at = grams[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = grams[1:] != grams[:-1]
        group = np.cumsum(new) - 1
        often = np.bincount(group, minlength=1)[group] > 1
        group, at = group[often], at[often]
        if not len(at):
            break
        pairs = [_far_pairs(group, at, k, n)]
        if smallest:
            pairs.append(_near_pairs(group, at, k))
        place, lag = (np.concatenate(x) for x in zip(*pairs, strict=True))
        same = document[place] == document[place + lag]
        found += _extended(words, place[same], lag[same], k, least)
        again = np.zeros(n + 1, bool)
        again[at] = True
        at = at[room[at] >= 2 * k]
        at = np.sort(at[again[at + k]])
        k, smallest = 2 * k, False
    rows = np.array(found, np.int64).reshape(-1, 3)
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)  # the smallest period of equal stretches
    start, length, period = rows[first].T
    of = document[start]
    rows = np.stack([of, start - begins[of], length, period], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _extended(words: np.ndarray, place: np.ndarray, lag: np.ndarray, k: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, lag) of the stretches on the diagonals that the pairs of equal k-grams lie in."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    # Pairs on one diagonal whose grams overlap or touch are in one stretch.
    new = np.ones(len(place), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + k)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    covered: dict[int, int] = {}
    out = []
    for a, b, q in zip(place[first].tolist(), (place[last[: len(first)]] + k).tolist(), lag[first].tolist(), strict=True):
        if a < covered.get(q, -1):
            continue
        start = a - _equal_back(words, a, a + q)
        stop = b + _equal_ahead(words, b, b + q)
        covered[q] = stop
        if stop - start >= max(q, least - q):
            out.append((start, stop - start + q, q))
    return out


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, each text followed by a negative number of its own, and where these are."""
    numbers: dict[bytes, int] = {}
    for words in texts:
        numbers.update(dict.fromkeys(words, 0))
    for i, word in enumerate(numbers):
        numbers[word] = i
    ends = np.cumsum([len(words) + 1 for words in texts]) - 1
    out = np.empty(int(ends[-1]) + 1, np.int64)
    at = 0
    for i, words in enumerate(texts):
        out[at : at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        at += len(words) + 1
        out[at - 1] = -1 - i
    return out, ends


def search(texts: list[list[bytes]], least: int = LEAST) -> tuple[np.ndarray, list[bytes]]:
    """The runs (document, start, length, period) of the texts, and the texts without the words that repeat."""
    words, ends = _numbered(texts)
    rows = find_runs(words, ends, least)
    collapsed = [b" ".join(w) for w in texts]
    if len(rows):
        begins = np.concatenate([[0], ends[:-1] + 1])[rows[:, 0]]
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, begins + rows[:, 1] + rows[:, 3], 1)
        np.add.at(depth, begins + rows[:, 1] + rows[:, 2], -1)
        kept = np.cumsum(depth) == 0
        for i in np.unique(rows[:, 0]).tolist():
            at = int(ends[i]) - len(texts[i])
            collapsed[i] = b" ".join([w for w, k in zip(texts[i], kept[at : at + len(texts[i])].tolist(), strict=True) if k])
    return rows, collapsed


def find(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """key, ``runs`` (start, length, period, by start and period), ``collapsed``: the words that no run repeats, joined
    by blanks. A word is dropped if a run holds it after that run's first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in portions(list(map(len, texts)), TOGETHER):
                rows, collapsed = search([t.split() for t in texts[a:b]], least)  # parts at blank, tab to carriage return
                counts = np.bincount(rows[:, 0], minlength=b - a)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in (1, 2, 3)], names=RUN.names)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), runs),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=[key, "runs", "collapsed"],
                )

    schema = T.StructType([df.schema[key], T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return df.select(F.col(key), whole_text(text).alias("_text")).mapInArrow(run, schema)
