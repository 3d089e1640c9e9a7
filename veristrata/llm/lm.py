"""A log-bilinear language model, trained with noise-contrastive estimation, and its scores.

The model predicts the class of a token from the two tokens before it: each context class has a vector for each
of the two places, each predicted class a vector and a bias, and the score of a class is the inner product of its
vector with the sum of the context's, plus the bias. The most frequent words and the end are classes of
their own, eight times the cube root of the number of different words, up to 3,968 (a table of all pairs of
contexts then takes 64 MB in a task); all other words share classes by their ending, within which a word has its
share of the counts (each count plus one, one more for all words never seen). So the probabilities of all words
add up to one in any context. Normalisers of all pairs of context classes are products of matrices.

Counts are taken over all training texts. Then each text is cut into words once more and stored as two bytes for
each token, its class; training and scores read these. Training goes through every training text once, in rounds:
each task trains a copy of the parameters on its texts, the copies are averaged by their numbers of tokens, and
the next round starts from the average. Only parameters (49 for each class) reach the driver.

Words in the head of the vocabulary (a bounded number of at most 64 bytes each, broadcast) are looked up inside the
tasks; the others are joined with the table of counts. Longer words stand in the tables with their SHA-256.

Defined cases: NULL texts are empty; an empty text has one token, the end; without any training text all
probabilities are uniform over the classes; repeated rows are scored and counted each; a NULL key counts as
the empty text for the split; an empty table gives no row; very long texts are whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veristrata.llm.common import stored, whole_text

END = b"\n"  # no word has white space
HEAD = 400_000  # words at most in the broadcast head of the vocabulary
LONGEST = 64  # bytes of a word that stands for itself
OWN = 3_968  # words at most with a class of their own
SHARED = 127  # classes by ending
DIM = 16
NOISE = 32
BATCH = 2048
ROUNDS = 3
RATE = 0.15
FLUSH = 300_000


def tokens(text: str) -> list[bytes]:
    """Words and the end. Bytes are lower-cased and split by ASCII alone, as the tokens are defined."""
    return [*text.encode().lower().split(), END]


def named(word: bytes) -> bytes:
    """The word, or the mark of a long one, by which the tables know it."""
    if len(word) <= LONGEST:
        return word
    return END + hashlib.sha256(word).hexdigest().encode() + word.decode()[-2:].encode()


def ending(name: bytes) -> int:
    """The shared class of a word, by its name."""
    return zlib.crc32(name[-2:] if name.isascii() else name[-4:] + b"+") % SHARED


def ending_column(name: Column) -> Column:
    raw = name.cast("binary")
    wide = F.concat(F.substring(raw, -4, 4), F.lit("+").cast("binary"))
    return (F.crc32(F.when(F.char_length(name) < F.octet_length(name), wide).otherwise(F.substring(raw, -2, 2))) % SHARED).cast("int")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of all tokens, words by name; each task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([named(w) for w in counts], pa.binary()).cast(pa.string())
            found = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return found

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(tokens(text))
                if len(counts) > FLUSH:
                    yield out()
        yield out()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """Totals, the head of the vocabulary, and the classes: own words, shared classes, the end."""

    total: int
    distinct: int
    words: list[bytes]
    counts: np.ndarray
    own: int  # words with a class of their own
    classes: np.ndarray  # of the head's words
    class_counts: np.ndarray
    within: np.ndarray  # per shared class: the sum of its words' counts plus one, plus one
    index: dict[bytes, int] = field(default_factory=dict)

    @property
    def ends(self) -> int:
        """The class of the end."""
        return self.own + SHARED

    @property
    def start(self) -> int:
        """The context before the first token."""
        return self.own + SHARED + 1

    def __getstate__(self):
        return {**self.__dict__, "index": {}}

    def prepare(self) -> None:
        if not self.index:
            self.index = {w: i for i, w in enumerate(self.words)}

    def class_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Position in the head (-1: not there) and class of each word."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        kinds = self.classes[at] if len(self.words) else np.zeros(len(words), np.int16)
        outside = np.flatnonzero(at < 0)
        kinds[outside] = [self.ends if words[i] == END else self.own + ending(named(words[i])) for i in outside.tolist()]
        return at, kinds


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    totals = counts.agg(F.sum("c"), F.count("*")).first()
    level = F.floor(F.log2("c") * 16).cast("int")
    short = counts.where(F.octet_length("word") <= LONGEST)  # the marks of long words are longer
    levels = short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # about 16 a doubling
    least, seen = None, 0
    for row in levels:
        seen += row["count"]
        if seen > head:
            break
        least = row["level"]
    rows = [] if least is None else short.where(level >= least).collect()  # at most ``head``
    rows = sorted(((r["word"].encode(), r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))
    words = [r[0] for r in rows]
    numbers = np.array([r[1] for r in rows], np.int64)
    most = min(OWN, int(8 * np.cbrt(totals[1])))
    own = [w for w in words[: most + 1] if w != END][:most]
    ends = len(own) + SHARED
    place = {w: i for i, w in enumerate(own)} | {END: ends}
    classes = np.fromiter((place[w] if w in place else len(own) + ending(w) for w in words), np.int16, len(words))
    shared = counts.where(F.col("word") != END.decode()).groupBy(ending_column(F.col("word")).alias("k")).agg(
        F.sum("c").alias("c"), F.count("*").alias("n")
    ).collect()  # one row per shared class
    sums, kinds = np.zeros(SHARED, np.int64), np.zeros(SHARED, np.int64)
    for row in shared:
        sums[row["k"]], kinds[row["k"]] = row["c"], row["n"]
    numbers_of = dict(zip(words, numbers.tolist(), strict=True))
    for word in own:
        sums[ending(word)] -= numbers_of[word]
        kinds[ending(word)] -= 1
    class_counts = np.zeros(ends + 1, np.int64)
    class_counts[: len(own)] = [numbers_of[w] for w in own]
    class_counts[len(own) : ends] = sums
    class_counts[ends] = numbers_of.get(END, 0)
    return Vocabulary(totals[0] or 0, totals[1], words, numbers, len(own), classes, class_counts, sums + kinds + 1)


@dataclass
class Parameters:
    first: np.ndarray  # contexts x DIM, for the token right before
    second: np.ndarray  # the token before that
    predicted: np.ndarray
    bias: np.ndarray

    @staticmethod
    def initial(class_counts: np.ndarray) -> Parameters:
        draw, classes = np.random.default_rng(7), len(class_counts)
        small = lambda n: draw.normal(0, 0.1, (n, DIM))
        share = (class_counts + 1) / (class_counts + 1).sum()
        return Parameters(small(classes + 1), small(classes + 1), small(classes), np.log(share))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.first.ravel(), self.second.ravel(), self.predicted.ravel(), self.bias])

    @staticmethod
    def of(flat: np.ndarray) -> Parameters:
        classes = (len(flat) - 2 * DIM) // (3 * DIM + 1)
        n, m = (classes + 1) * DIM, classes * DIM
        a, b, c, d = np.split(flat, [n, 2 * n, 2 * n + m])
        return Parameters(a.reshape(-1, DIM), b.reshape(-1, DIM), c.reshape(-1, DIM), d)

    def scores(self, one: np.ndarray, two: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Scores of classes after the contexts, not normalised."""
        return np.einsum("ij,ij->i", self.first[one] + self.second[two], self.predicted[kinds]) + self.bias[kinds]

    def normalisers(self, rows: int = 256) -> np.ndarray:
        """The logarithm of the normaliser of every pair of contexts, by products of matrices."""
        b = (self.second @ self.predicted.T).astype(np.float32)
        top_b = b.max(1)
        b = np.exp(b - top_b[:, None]).T
        out = np.empty((len(self.first), len(self.second)), np.float32)
        for at in range(0, len(out), rows):
            a = (self.first[at : at + rows] @ self.predicted.T + self.bias).astype(np.float32)
            top_a = a.max(1)
            out[at : at + rows] = np.log(np.exp(a - top_a[:, None]) @ b) + top_a[:, None] + top_b[None, :]
        return out


def contexts(classes: np.ndarray, starts: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two tokens before each token; texts stand one after another, ``starts`` are their first
    tokens, and ``before`` is the context there."""
    one = np.roll(classes, 1)
    one[starts] = before
    two = np.roll(one, 1)
    two[starts] = before
    return one, two


def _gather(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values by row."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    out = np.zeros((n, values.shape[1]), values.dtype)
    out[ordered[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation in steps of many tokens, which share their noise; AdaGrad's rates."""

    def __init__(self, start: Parameters, class_counts: np.ndarray, seed: int):
        self.p = Parameters.of(start.flat().astype(np.float32))
        share = (class_counts + 1) / (class_counts + 1).sum()
        self.chance = np.log(NOISE * share).astype(np.float32)
        self.upto = np.cumsum(share)
        self.draw = np.random.default_rng(seed)
        self.squares = [np.full(x.shape, 1e-2, np.float32) for x in (self.p.first, self.p.second, self.p.predicted, self.p.bias)]
        self.n = 0

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        p, n = self.p, len(target)
        context = p.first[one] + p.second[two]
        noise = np.minimum(np.searchsorted(self.upto, self.draw.random(NOISE)), len(self.upto) - 1)
        words, others = p.predicted[target], p.predicted[noise]
        real = (context * words).sum(1) + p.bias[target] - self.chance[target]
        false = context @ others.T + (p.bias - self.chance)[noise]
        up = 1 / (1 + np.exp(np.clip(real, -30, 30)))  # of the real tokens
        down = -1 / (1 + np.exp(-np.clip(false, -30, 30)))  # of the noise
        moved = up[:, None] * words + down @ others
        classes = len(p.predicted)
        slopes = [
            _gather(one, moved, classes + 1), _gather(two, moved, classes + 1),
            _gather(target, up[:, None] * context, classes),
            np.bincount(target, weights=up, minlength=classes).astype(np.float32),
        ]
        np.add.at(slopes[2], noise, down.T @ context)
        np.add.at(slopes[3], noise, down.sum(0))
        for x, g, square in zip((p.first, p.second, p.predicted, p.bias), slopes, self.squares, strict=True):
            g /= 64.0
            square += g * g
            x += RATE * g / np.sqrt(square)
        self.n += n


def _blocks(sizes: list[int], size: int) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held > size or i == len(sizes) - 1:
            yield start, i + 1
            start, held = i + 1, 0


def _classes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Stored classes of the texts in blocks: first and last text, all classes, first token of each text."""
    packed = column.to_pylist()
    for a, b in _blocks([len(x) for x in packed], 2_000_000):
        starts = np.concatenate([[0], np.cumsum([len(x) // 2 for x in packed[a : b - 1]])]).astype(np.int64)
        yield a, b, np.frombuffer(b"".join(packed[a:b]), "<i2"), starts


def train_round(classes: DataFrame, shared_vocabulary, start: Parameters, seed: int) -> Parameters:
    """One pass over the texts' classes; the average of the tasks' parameters, weighted by tokens."""
    flat = start.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared_vocabulary.value
        trainer = Trainer(Parameters.of(flat), own.class_counts, seed * 1_000_003 + TaskContext.get().partitionId())
        for batch in batches:
            for _, _, kinds, starts in _classes(batch.column(0)):
                one, two = contexts(kinds, starts, own.start)
                order = trainer.draw.permutation(len(kinds))
                one, two, kinds = one[order], two[order], kinds[order]
                for at in range(0, len(kinds), BATCH):
                    cut = slice(at, at + BATCH)
                    trainer.step(one[cut], two[cut], kinds[cut])
        if trainer.n:
            found = trainer.p.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(found))), pa.array(found * trainer.n), pa.array(np.full(len(found), trainer.n))],
                names=["at", "value", "n"],
            )

    sums = classes.mapInArrow(run, "at long, value double, n long").groupBy("at").agg(
        (F.sum("value") / F.sum("n")).alias("value")
    )
    rows = sums.toPandas()  # as many rows as the model has parameters
    if len(rows):
        flat = flat.copy()
        flat[rows["at"]] = rows["value"]
    return Parameters.of(flat)


def encoded(rows: DataFrame, shared_vocabulary) -> DataFrame:
    """Per row of (key, held_out, turn, text): the number of tokens, of known ones in the head, the sums of their
    logarithms of counts, over all and over words of shared classes, the tokens' classes, and the words outside
    the head. Each row gets a number of its own."""
    kind = rows.schema["key"].dataType.simpleString()
    tail_kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared_vocabulary.value
        own.prepare()
        logs = np.log10(own.counts + 1.0)
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for start, stop in _blocks([len(t) for t in texts], 2_000_000):
                found = [tokens(t) for t in texts[start:stop]]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                first = np.cumsum(sizes) - sizes
                words = [w for of_text in found for w in of_text]
                at, kinds = own.class_ids(words)
                inside = at >= 0
                plus = np.zeros(len(words))
                plus[inside] = logs[at[inside]]
                shared = np.where((kinds >= own.own) & (kinds < own.ends), plus, 0.0)
                sums = [np.add.reduceat(x, first) for x in (inside.astype(np.int64), plus, shared)]
                outside = np.flatnonzero(~inside)
                cut = np.searchsorted(outside, np.append(first, len(words))).tolist()
                places = outside.tolist()
                tails = [
                    [{"word": named(w).decode(), "n": n} for w, n in Counter([words[p] for p in places[x:y]]).items()]
                    for x, y in zip(cut, cut[1:], strict=False)
                ]
                raw = kinds.astype("<i2").tobytes()
                packed = [raw[2 * a : 2 * (a + n)] for a, n in zip(first.tolist(), sizes.tolist(), strict=True)]
                n = stop - start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row_id, row_id + n)), *(batch.column(i).slice(start, n) for i in range(3)),
                        pa.array(sizes), *(pa.array(x) for x in sums), pa.array(packed, pa.binary()),
                        pa.array(tails, tail_kind),
                    ],
                    names=["row", "key", "held_out", "turn", "n_tokens", "n_known", "plus", "shared", "classes", "tail"],
                )
                row_id += n

    return rows.mapInArrow(
        run,
        f"row long, key {kind}, held_out boolean, turn int, n_tokens long, n_known long, plus double, shared double, "
        "classes binary, tail array<struct<word:string,n:long>>",
    )


def modelled(texts: DataFrame, shared_vocabulary, parameters: Parameters) -> DataFrame:
    """Rows with ``classes`` replaced by ``model``, the model's log10 probability of the classes, and of words of
    shared classes within these but for the words' counts."""
    flat = parameters.flat()
    at_classes = texts.columns.index("classes")
    others = [i for i in range(len(texts.columns)) if i != at_classes]
    names = [texts.columns[i] for i in others] + ["model"]
    schema = ", ".join(f"`{texts.columns[i]}` {texts.dtypes[i][1]}" for i in others) + ", model double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, p = shared_vocabulary.value, Parameters.of(flat.astype(np.float32))
        normal = None
        within = np.zeros(own.start)
        within[own.own : own.ends] = np.log(own.within)
        for batch in batches:
            if normal is None:
                normal = p.normalisers()
            for start, stop, kinds, starts in _classes(batch.column(at_classes)):
                one, two = contexts(kinds, starts, own.start)
                logs = p.scores(one, two, kinds).astype(np.float64) - normal[one, two] - within[kinds]
                kept = [batch.column(i).slice(start, stop - start) for i in others]
                model = pa.array(np.add.reduceat(logs, starts) / math.log(10))
                yield pa.RecordBatch.from_arrays([*kept, model], names=names)

    return texts.mapInArrow(run, schema)


def score(df: DataFrame, held: Column, key: str = "doc_id", text: str = "text", head: int = HEAD,
          rounds: int = ROUNDS) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; learns from the rows for
    which ``held`` is false."""
    spark = df.sparkSession
    turn = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), whole_text(text)), F.lit(rounds))
    rows = df.select(
        F.col(key).alias("key"), held.alias("held_out"), turn.cast("int").alias("turn"), whole_text(text).alias("text")
    )
    counts = stored(word_counts(rows.where(~F.col("held_out")).select("text")), "words")
    known = vocabulary(counts, head)
    shared = spark.sparkContext.broadcast(known)  # ``head`` words at most
    texts = stored(encoded(rows, shared), "classes")
    parameters = Parameters.initial(known.class_counts)
    for turn in range(rounds if known.total else 0):
        part = texts.where(~F.col("held_out") & (F.col("turn") == turn)).select("classes")
        parameters = train_round(part, shared, parameters, turn)
    base = math.log10(known.total + known.distinct + 1)
    model = modelled(texts.drop("turn", "tail"), shared, parameters)
    tail = texts.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    looked = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more"),
    )
    more = F.coalesce("more", F.lit(0.0))
    # Words outside the head all belong to shared classes: their counts enter both scores alike.
    return model.join(looked, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("plus") + more - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("model") + F.col("shared") + more).alias("score"),
    )
