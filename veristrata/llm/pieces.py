"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding joins, again and again, the adjacent pair of symbols whose union is the best-scored piece (ties to
the left), kept in an agenda ordered by score. What has no piece is spelled in byte pieces. No piece of
such a vocabulary goes on after a word's end (checked when it is loaded), so the words of a text are encoded
one by one and remembered. All words that are new in an Arrow batch are encoded by the library, too, in one
call; a difference is an error.

Defined cases: NULL text is empty; an empty text has the end id alone and decodes to the empty text; very
long words use a heap; repeated rows give repeated results; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
REMEMBERED = 200_000  # words in each of the two generations of a Python worker's memory
SIZES = (8, 12, 16, 24, 48)  # widths of shared agendas; longer words have a heap each
NONE = np.iinfo(np.int32).max


class PieceModel:
    """Pieces, scores and ids of a model file, and the agenda."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = lib.eos_id()
        self.text = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        self.shown = [str(i) for i in range(len(self.text))]
        self.bytes_ids: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.silent = set()
        for i, piece in enumerate(self.text):
            if lib.is_byte(i):
                value = int(piece[3:-1], 16)
                self.bytes_ids[value], self.byte_of[i] = i, value
            elif lib.is_control(i):
                self.silent.add(i)
            elif not lib.is_unknown(i):
                self.ids[piece], self.scores[piece] = i, lib.get_score(i)
        longer = [p for p in self.ids if len(p) > 1]
        unfit = any(BLANK in p.lstrip(BLANK) for p in longer) or any("\n" in p for p in longer)
        if unfit or len(self.bytes_ids) != 256 or any(lib.is_unused(i) for i in range(len(self.text))):
            raise ValueError("not a merge-type vocabulary of words with byte pieces")
        self._pairs(longer)

    def _pairs(self, longer: list[str]) -> None:
        """All pairs of pieces whose union is a piece, sorted, with the rank of its score and its id."""
        order = {x: r for r, x in enumerate(sorted({self.scores[p] for p in longer}, reverse=True))}
        found = [
            (self.ids[p[:k]] << 32 | self.ids[p[k:]], order[self.scores[p]], self.ids[p])
            for p in longer for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids
        ]
        found.sort()
        self.pair_keys = np.array([f[0] for f in found], np.int64)
        self.pair_ranks = np.array([f[1] for f in found], np.int32)
        self.pair_ids = np.array([f[2] for f in found], np.int64)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where they don't join) and id of the union of symbols; symbols without a piece are -1."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        joins = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(joins, self.pair_ranks[at], NONE).astype(np.int32), self.pair_ids[at]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of many words: those of similar length share their agenda, a row of pair ranks for each
        word, of which every step takes the best pair of every word that still has one."""
        out: list[list[int]] = [[]] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_size.setdefault(next((s for s in SIZES if len(word) <= s), 0), []).append(i)
        for size, rows in by_size.items():
            if size:
                for i, ids in zip(rows, self._together([words[i] for i in rows], size), strict=True):
                    out[i] = ids
            else:
                for i in rows:
                    out[i] = self._spelled(self._by_heap(list(words[i])))
        return out

    def _together(self, words: list[str], size: int) -> list[list[int]]:
        n, width = len(words), size + 1
        codes = np.zeros((n, size), np.uint32)
        lengths = np.array([len(w) for w in words])
        inside = np.arange(size) < lengths[:, None]
        codes[inside] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        alphabet, where = np.unique(codes, return_inverse=True)
        known = np.array([self.ids.get(chr(c), -1) if c else -1 for c in alphabet.tolist()], np.int64)
        if codes.size and not alphabet[0]:  # the character zero is spelled in bytes, the filling is no symbol
            known[0] = -1
        symbols = np.full((n, width), -1, np.int64)
        symbols[:, :size] = known[where.reshape(n, size)]
        alive = np.zeros((n, width), bool)
        alive[:, :size] = inside
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        ranks = np.full((n, width), NONE, np.int32)
        ranks[:, :size - 1], _ = self._look_up(symbols[:, :size - 1], symbols[:, 1:size])
        rows = np.arange(n)
        while len(rows):
            at = ranks[rows].argmin(1)
            going = ranks[rows, at] != NONE
            rows, at = rows[going], at[going]
            right = after[rows, at]
            _, merged = self._look_up(symbols[rows, at], symbols[rows, right])
            symbols[rows, at] = merged
            alive[rows, right] = False
            ranks[rows, right] = NONE
            beyond = after[rows, right]
            after[rows, at] = beyond
            beyond = np.minimum(beyond, size)  # the last column is never alive: no symbol
            before[rows, beyond] = at
            ranks[rows, at], _ = self._look_up(merged, symbols[rows, beyond])
            left = before[rows, at]
            has_left = left >= 0
            lr, ll = rows[has_left], left[has_left]
            ranks[lr, ll], _ = self._look_up(symbols[lr, ll], merged[has_left])
        row, column = np.nonzero(alive)
        ids = symbols[row, column]
        ends = np.searchsorted(row, np.arange(n), side="right").tolist()
        plain = ids.tolist()
        out, start = [], 0
        odd = set(row[ids < 0].tolist())
        columns = column.tolist()
        for i, end in enumerate(ends):
            if i in odd:
                stops = [*columns[start + 1 : end], len(words[i])]
                out.append(self._spelled([words[i][a:b] for a, b in zip(columns[start:end], stops, strict=True)]))
            else:
                out.append(plain[start:end])
            start = end
        return out

    def _by_heap(self, symbols: list[str]) -> list[str]:
        n, score = len(symbols), self.scores.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < n:
                joined = symbols[left] + symbols[right]
                if (value := score(joined)) is not None:
                    heapq.heappush(agenda, (-value, left, right, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            stale = not symbols[left] or not symbols[right] or after[left] != right
            if stale or symbols[left] + symbols[right] != joined:
                continue
            symbols[left], symbols[right] = joined, ""
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s]

    def _spelled(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for symbol in symbols:
            found = self.ids.get(symbol)
            if found is not None:
                out.append(found)
            else:
                out.extend(self.bytes_ids[b] for b in symbol.encode())
        return out

    def decode_word(self, ids: list[int]) -> str:
        """Text of the ids of a word, blanks as blanks."""
        if self.silent.isdisjoint(ids) and self.byte_of.keys().isdisjoint(ids):
            return "".join([self.text[i] for i in ids]).replace(BLANK, " ")
        raw = b"".join(
            bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else self.text[i].encode()
            for i in ids
        )
        return raw.decode(errors="replace").replace(BLANK, " ")

    def check(self, words: list[str], found: list[list[int]]) -> None:
        """Against the library. It puts a blank before each text, so a word that starts without one is
        shown to it after a line break, which joins with nothing; one more follows each word, as a blank alone
        would be an empty text."""
        shown = [(w[1:] if w[0] == BLANK else "\n" + w) + "\n" for w in words]
        theirs = self.library.encode(shown, num_threads=1)
        for word, mine, other in zip(words, found, theirs, strict=True):
            if mine != (other if word[0] == BLANK else other[2:])[:-1]:
                raise ValueError(f"{word!r}: {mine}, the library has {other}")


WORD = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")


class Codec:
    """Encodes and decodes texts; remembers words in two generations, so that memory stays bounded."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.unlike: dict[str, str] = {}  # what words decode to that don't decode to themselves

    def _learn(self, words: list[str]) -> dict[str, str]:
        """Ids as text of new words, checked."""
        model, learnt = self.model, {}
        shown = model.shown
        found = model.encode_words(words)
        model.check(words, found)
        for word, ids in zip(words, found, strict=True):
            learnt[word] = " ".join([shown[i] for i in ids])
            back = model.decode_word(ids)
            if back != word.replace(BLANK, " "):
                self.unlike[word] = back
        self.young.update((w, x) for w, x in learnt.items() if len(w) <= SIZES[-1])
        return learnt

    def batch(self, texts: list[str]) -> Iterator[tuple[str, int, str]]:
        """(ids as text, their number, decoded text) of each text, the end id included."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        shown = [(BLANK + t).replace(" ", BLANK) if t else "" for t in texts]
        split = [WORD.findall(t) for t in shown]
        young, old, new, rare = self.young, self.old, [], {}
        for word in set().union(*split) - young.keys():
            if word in old:
                young[word] = old[word]
            else:
                new.append(word)
        if new:
            rare = {w: x for w, x in self._learn(new).items() if w not in young}
        find, end = young.__getitem__, f" {self.model.end}"
        for text, words in zip(shown, split, strict=True):
            if rare and not rare.keys().isdisjoint(words):
                parts = [rare[w] if w in rare else young[w] for w in words]
            else:
                parts = map(find, words)
            ids = (" ".join(parts) + end).lstrip()
            if self.unlike and not self.unlike.keys().isdisjoint(words):
                back = "".join([self.unlike.get(w) or w.replace(BLANK, " ") for w in words])
            else:  # every word decodes to itself
                back = text.replace(BLANK, " ")
            yield ids, ids.count(" ") + 1, back[1:]


_CODECS: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    """One codec for all tasks of a Python worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_decode(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text",
                  keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256, and on request ``ids`` and ``decoded``."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * keep_ids + ", decoded string" * keep_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, shas, texts, ids, decoded = [], [], [], [], []
                for id_text, count, back in codec.batch(part.column(1).to_pylist()):
                    n.append(count)
                    shas.append(hashlib.sha256(id_text.encode()).hexdigest())
                    texts.append(hashlib.sha256(back.encode()).hexdigest())
                    if keep_ids:
                        ids.append([int(i) for i in id_text.split()])
                    if keep_text:
                        decoded.append(back)
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                if keep_text:
                    columns.append(pa.array(decoded, pa.string()))
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                names += ["ids"] * keep_ids + ["decoded"] * keep_text
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = df.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return source.mapInArrow(run, schema)
