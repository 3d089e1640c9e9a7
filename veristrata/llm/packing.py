"""Packing of documents into sequences of a fixed number of tokens: concatenate and cut.

1. Documents are tokenised where they lie. Each partition writes its ids with the number of ids before them in the
   partition, and the partition's number; the written table is what counts from there on, so a task that runs twice
   changes nothing.
2. The totals of the partitions are added up, one number a partition, and their prefix sums give every id its place in the
   concatenation of all documents.
3. Windows of a fixed length are cut from that concatenation: a document yields a record for each window that it has ids
   in, with flags where a window's edge cuts through it. Each partition does so alone; no ids are shuffled.
4. ``sequences`` puts the records of a window together: those that a partition holds whole, in place; what a partition has of
   its first and last window, boundary records, is shuffled by window, two records a partition.

Every sequence but the last is full, so less than one sequence of padding is needed, whatever the input.

Bound of the driver: the partitions' totals, eight bytes each (one million partitions: 8 MB).

Defined cases: NULL and empty texts are the end id alone; without an end id they have no piece; texts of any length are cut
as often as needed; repeated rows are packed each; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.llm.common import portions, stored, whole_text

LENGTH = 2048
END = 1
LONG_RUN = 1000  # characters with or without white space in a row
TOGETHER = 4 << 20  # characters or ids that are worked on at a time; a longer text alone

# Fixed value: how a byte-level tokenizer of this kind cuts a text before merging.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _letters_of_bytes() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: visible ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of texts by a tokenizer file of the library ``tokenizers``, without special tokens around them.

    For byte-level merges in the order of their ids, a faster library gives the same ids (compared over all code
    points in the tests); texts with a special token's name or very long runs go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        model, cut = kind["model"], kind.get("pre_tokenizer") or {}
        names = [t["content"] for t in kind.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.fast = None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        made = [model["vocab"].get("".join(m), -1) for m in merges]
        plain = not any(
            [kind.get("normalizer"), model.get("unk_token"), model.get("dropout"), model.get("ignore_merges"),
             model.get("end_of_word_suffix"), model.get("continuing_subword_prefix"), cut.get("add_prefix_space")]
        )
        if plain and model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and made == sorted(made):
            letters = _letters_of_bytes()
            ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in names}
            self.fast = tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})

    def _odd(self, text: str) -> bool:
        if self.special and self.special.search(text):
            return True
        words = text.split()
        return bool(words) and max(map(len, words)) >= LONG_RUN or len(text) - sum(map(len, words)) - len(words) >= LONG_RUN

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or self._odd(text):
            return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Parts of ``data``, one after another up to ``ends``, as little-endian bytes, without a copy for each."""
    offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data.astype("<u4", copy=False))])


def tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int | None = END) -> DataFrame:
    """(part, before, key, n, ids): each document's ids, 32 bits each, with the ids before it in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = encoder_of(path), TaskContext.get().partitionId(), 0
        tail = [] if end is None else [np.array([end], np.uint32)]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in portions(list(map(len, texts)), TOGETHER):
                found = [encoder.ids(t) for t in texts[a:b]]
                n = np.array([len(x) for x in found]) + len(tail)
                ends = np.cumsum(n)
                data = np.concatenate([y for x in found for y in (x, *tail)] or [np.zeros(0, np.uint32)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(before + ends - n),
                     batch.column(0).slice(a, b - a), pa.array(n), _binary(data, ends)],
                    names=["part", "before", key, "n", "ids"],
                )
                before += int(ends[-1])

    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), df.schema[key],
        T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    return df.select(F.col(key), whole_text(text).alias("_text")).mapInArrow(run, schema)


def cut(first: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first place, ids) of the pieces of documents that begin at the places ``first`` and have ``n`` ids."""
    windows = np.where(n > 0, (first + n - 1) // length - first // length + 1, 0)
    document = np.repeat(np.arange(len(n)), windows)
    turn = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.where(turn == 0, first[document], (first[document] // length + turn) * length)
    stop = np.minimum((start // length + 1) * length, (first + n)[document])
    return document, start, stop - start


def pieces(tokenised: DataFrame, key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """key, start, length, ids, doc_tokens, sequence_id, offset, and whether the document began before the piece
    (``continued``) and goes on after it (``continues``); of a stored table of ``tokens``."""
    totals = tokenised.groupBy("part").agg(F.sum("n").alias("n")).collect()  # a row for each partition
    places = np.zeros(max((r["part"] for r in totals), default=0) + 2, np.int64)
    for r in totals:
        places[r["part"] + 1] = r["n"]
    shared = tokenised.sparkSession.sparkContext.broadcast(np.cumsum(places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in portions(batch.column(3).to_pylist(), TOGETHER):
                part, before, keys, n, ids = batch.slice(a, b - a).columns
                n = n.to_numpy()
                first = shared.value[part.to_numpy()] + before.to_numpy()
                document, place, own = cut(first, n, length)
                data = np.frombuffer(b"".join(ids.to_pylist()), "<u4")  # pieces follow one another as documents do
                start = place - first[document]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(document)), pa.array(start), pa.array(own), _binary(data, np.cumsum(own)),
                     pa.array(n[document]), pa.array(place // length), pa.array(place % length),
                     pa.array(start > 0), pa.array(start + own < n[document])],
                    names=[key, *names],
                )

    names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset", "continued", "continues"]
    kinds = [T.LongType(), T.LongType(), T.BinaryType(), *[T.LongType()] * 3, *[T.BooleanType()] * 2]
    fields = [T.StructField(name, kind) for name, kind in zip(names, kinds, strict=True)]
    return tokenised.mapInArrow(run, T.StructType([tokenised.schema[key], *fields]))


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         end: int | None = END) -> DataFrame:
    """The pieces of all documents, see ``pieces``."""
    return pieces(stored(tokens(df, path, key, text, end), "tokens"), key, length)


def sequences(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(sequence_id, n, ids): the ids of each sequence as 32-bit numbers, without padding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []  # the window that is open, and its pieces: (offset, ids)

        def closed() -> tuple[int, int, bytes]:
            return at, held[0][0], b"".join(x for _, x in held)

        for batch in batches:
            out = []
            for number, offset, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (number != at or offset != held[-1][0] + len(held[-1][1]) // 4):
                    out.append(closed())
                    held = []
                at = number
                held.append((offset, ids))
            yield _fragments(out)
        if held:
            yield _fragments([closed()])

    kept = packed.select("sequence_id", "offset", "ids")
    found = stored(kept.mapInArrow(run, "sequence_id long, offset long, ids binary"), "windows")
    whole = F.octet_length("ids") == 4 * length
    edges = found.where(~whole).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda x, y: F.concat(x, y["ids"]))
    out = found.where(whole).select("sequence_id", "ids").union(edges.select("sequence_id", joined))
    return out.select("sequence_id", F.expr("octet_length(ids) div 4").cast("long").alias("n"), "ids")


def _fragments(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    names = ["sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)
