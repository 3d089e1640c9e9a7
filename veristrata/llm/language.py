"""Language identification of mixed texts.

Training counts, per language, the three-letter windows and the scripts of the letters, over all training
rows; each task adds its counts up, so only languages x windows numbers are shuffled. Prediction takes the
words (runs of letters) of a text: the script of a word narrows the languages that come into question, the
windows score it under each of them, and the best path through the words, at a fixed price for each change
of language, labels spans. The language of the text is the one with the most letters; its share of the
letters is the score. Ties go to the language that sorts first.

Defined cases: NULL and texts without a letter are ``und`` with score 0; rows without language don't
train; without any training row every text is ``und``; words in a script that no language uses say
nothing, and a text of such words alone takes the language with the most training letters, with score 0;
very long texts are cut between words into blocks for counting only, while their path is found whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 15  # of the windows' hashes
SWITCH = 12.0  # price of a change of language, in nats
CLIP = 6.0  # a word speaks against a language by no more than this
RARE_SCRIPT = 0.001  # a language uses the scripts of at least this share of its letters
MAX_LANGUAGES = 200  # the model is a table of languages x windows; more is an error, not cut

SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())
]))

# Blocks of the Unicode standard by script, as first and last code point.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x139F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
SCRIPT_NAMES = ["other", *SCRIPTS]


@functools.cache
def script_table() -> np.ndarray:
    """For each code point: 0 if it is no letter, else 1 + the position of its script."""
    scripts = np.zeros(0x110000, np.uint8)
    for at, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            scripts[first : last + 1] = at
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letters, scripts + 1, 0).astype(np.uint8)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the small-lettered texts, one blank around each, and the start of each text."""
    lowered = [" " + t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in lowered], out=starts[1:])
    return codes, starts


def windows(codes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the letters, and the bucket of the window (before, letter, after) of each."""
    at = np.flatnonzero(kinds)
    plain = np.where(kinds > 0, codes, 32).astype(np.uint64)
    mixed = plain[at - 1] * np.uint64(0x9E3779B97F4A7C15) + plain[at]
    mixed = mixed * np.uint64(0xC2B2AE3D27D4EB4F) + plain[at + 1]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x165667B19E3779F9)
    return at, (mixed >> np.uint64(64 - 15)).astype(np.int64)


def _blocks(texts: list[str], limit: int = 1_000_000) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size > limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def count_windows(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, bucket, n) over all rows with a language; scripts are the buckets from BUCKETS on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = script_table(), {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for value, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(name, []).append(value or "")
            for name, texts in by_lang.items():
                own = counts.setdefault(name, np.zeros(BUCKETS + 32, np.int64))
                for block in _blocks(texts):
                    codes, _ = code_points(block)
                    kinds = table[codes]
                    at, buckets = windows(codes, kinds)
                    own[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                    own[BUCKETS:] += np.bincount(kinds[at], minlength=32)
        for name, own in counts.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(own[used], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = rows.select(F.col(text).cast("string"), F.col(lang).cast("string")).mapInArrow(
        run, "lang string, bucket long, n long"
    )
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets x languages, log-probabilities
    uses: np.ndarray  # scripts x languages, whether the language comes into question
    usual: int  # the language with the most letters


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """A model from all rows of ``df``; None if none of them has a letter and a language."""
    counts = count_windows(df, text, lang)
    names = [r[0] for r in counts.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not names:
        return None
    found = counts.toPandas()  # languages x buckets at most
    seen = np.zeros((BUCKETS + 32, len(names)))
    seen[found["bucket"], [names.index(x) for x in found["lang"]]] = found["n"]
    grams, scripts = seen[:BUCKETS], seen[BUCKETS:]
    logs = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS))
    uses = scripts >= RARE_SCRIPT * np.maximum(scripts.sum(0), 1)
    uses &= scripts > 0
    return Model(names, logs.astype(np.float32), uses, int(scripts.sum(0).argmax()))


def word_scores(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: first position, length, scores under the languages (best 0, worst -CLIP), and whether any
    language uses its script."""
    kinds = script_table()[codes]
    at, buckets = windows(codes, kinds)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(model.languages))), np.zeros(0, bool)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    sums = np.add.reduceat(model.scores[buckets], first, axis=0).astype(np.float64)
    uses = model.uses[kinds[at[first]]]
    unknown = ~uses.any(1)
    sums[~uses] = -np.inf
    sums[unknown] = 0.0
    sums -= sums.max(1, keepdims=True)
    return at[first], np.diff(first, append=len(at)), np.maximum(sums, -CLIP), ~unknown


def best_path(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Language of each word on the path of the highest sum of scores less ``switch`` per change.

    If one language leads in sum and no stretch of words gains more than the price of leaving it, no path that
    has this language anywhere is better than staying with it (each stretch in another pays one change). A
    path of r stretches without it has r - 1 changes, so it must gain more than the price in its first and last
    stretch together. If neither is possible, the path stays; else Viterbi's recursion runs word by word.
    """
    sums = np.cumsum(scores, axis=0)
    best = int(sums[-1].argmax())
    lead = sums - sums[:, best : best + 1]
    low = np.minimum(np.minimum.accumulate(lead, axis=0), 0.0)
    first, last = lead.max(), (lead[-1] - lead).max()
    if (lead - low).max() <= switch and first + last <= switch:
        return np.full(len(scores), best, np.int64)
    n, k = scores.shape
    came = np.zeros((n, k), np.int64)
    stay = np.arange(k)
    value = scores[0].copy()
    for t in range(1, n):
        top = int(value.argmax())
        change = value[top] - switch
        came[t] = np.where(value >= change, stay, top)
        value = np.maximum(value, change) + scores[t]
    path = np.empty(n, np.int64)
    path[-1] = int(value.argmax())
    for t in range(n - 1, 0, -1):
        path[t - 1] = came[t, path[t]]
    return path


def label(model: Model, texts: list[str]) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans) of each text; spans are (first and last+1 position among the letters'
    code points of the small-lettered text, language)."""
    for block in _blocks(texts):
        codes, starts = code_points(block)
        begin, length, scores, known = word_scores(model, codes)
        cut = np.searchsorted(begin, starts)
        for i in range(len(block)):
            a, b = cut[i], cut[i + 1]
            if a == b:
                yield "und", 0.0, []
                continue
            own = scores[a:b]
            if not known[a:b].any():
                yield model.languages[model.usual], 0.0, []
                continue
            path = best_path(own)
            letters = np.bincount(path, weights=length[a:b], minlength=len(model.languages))
            top = int(letters.argmax())
            turn = np.flatnonzero(np.diff(path, prepend=-1))
            last = np.append(turn[1:], len(path)) - 1
            offset = starts[i] + 1
            spans = [
                (int(begin[a + f] - offset), int(begin[a + g] + length[a + g] - offset), model.languages[path[f]])
                for f, g in zip(turn, last, strict=True)
            ]
            yield model.languages[top], float(letters[top] / letters.sum()), spans


def identify(df: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
             spans: bool = False, lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """The columns ``keep``, ``lang_pred``, ``score``, and on request ``spans`` (start, end, lang); where kept columns
    have these names, give others by ``lang_name`` and ``score_name``."""
    fields = [df.schema[c] for c in keep]
    fields += [T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    fields += [T.StructField("spans", SPANS)] * spans
    schema = T.StructType(fields)
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x windows, at most 26 MB at 200 languages
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                found = list(label(own, texts)) if own else [("und", 0.0, [])] * len(texts)
                columns = [part.column(i) for i in range(len(keep))]
                columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                if spans:
                    rows = [[{"start": a, "end": b, "lang": x} for a, b, x in f[2]] for f in found]
                    columns.append(pa.array(rows, kind))
                names = [*keep, lang_name, score_name] + ["spans"] * spans
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_text_of_row"))
    return source.mapInArrow(run, schema)


def training_rows(df: DataFrame, held: Column) -> DataFrame:
    return df.where(~held).select("text", "lang")
