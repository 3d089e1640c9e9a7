"""Removal of repeated byte strings by suffix sorting.

Every byte is removed that a string of ``size`` bytes covers which also starts somewhere else, in the same or another
text. Windows of that size are dealt by their anchors (see ``anchors``): equal windows have equal anchors at equal
places, so only stretches with the same anchor need to be compared.

1. Anchors that occur once are dropped (counts are added up in the tasks first).
2. Stretches that occur more than once as a whole repeat in all their windows.
3. The other stretches of an anchor are one group. A group of more than ``GROUP`` different stretches is cut in two by its
   windows: those that begin at most m bytes before the anchor, and the others. All windows of a half have a longer core
   in common, so the half falls into groups by that core's hash; stretches that are the same in a half are one from
   there on. At last a half is a single window, which has one stretch a core, so every group gets small, in eight
   rounds at most, and whatever has one partner less is never carried on.
4. Each group is sorted by what follows from the anchor: a mergesort whose comparisons find the common extension by
   binary search on prefix hashes, so each takes logarithmic time. The common prefixes of neighbours give those of all
   pairs; what the pairs have in common to the left is found by the same search. The order and every string found are
   verified by their bytes; where hashes have misled, the group is sorted anew by its bytes.

What is taken for one by a polynomial hash is verified, too: whole stretches by an independent hash of their bytes,
halves by the bytes themselves. A collision stops the query.

Texts are known by 128-bit hashes of their content, so repeated rows are found as repeats of their windows;
copies of a whole text are told by counts. Only texts that hold a repeat are shuffled.

Defined cases: NULL texts are empty; texts shorter than ``size`` are kept; copies of a text of that size or
more are removed whole; texts of any length are read in overlapping chunks; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.llm.anchors import LONGEST, Stretches
from veristrata.llm.common import bloom, free_names, sifted, stored, whole_text
from veristrata.llm.rolling import PrefixHash, mix

SIZE = 200
PART = 64
GROUP = 256  # stretches that are sorted together
BLOCK = 1 << 19
ROWS = 1024  # texts that are unpacked at a time

ID = ["i1", "i2"]


def with_id(df: DataFrame) -> DataFrame:
    """Adds the 128-bit identity of the text ``text``."""
    return df.withColumns({"i1": F.xxhash64("text"), "i2": F.xxhash64(F.lit("second"), "text")})


def chunks(texts: list[bytes], size: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(text, offset, bytes) in lists of about BLOCK bytes; longer texts in chunks that overlap by size - 1."""
    most = LONGEST - size
    which, offsets, parts, held = [], [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            part = text[at : at + most] if len(text) > most else text
            which.append(i)
            offsets.append(at)
            parts.append(part)
            held += len(part)
            if held >= BLOCK:
                yield which, offsets, parts
                which, offsets, parts, held = [], [], [], 0
            at += most - size + 1
            if at + size > len(text) or len(text) <= most:
                break
    if parts:
        yield which, offsets, parts


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def stretches(rows: DataFrame, size: int, part: int) -> DataFrame:
    """(h, g, check, i1, i2, start, n, lead): hashes of anchor and stretch, an independent hash of the stretch's bytes,
    text, first window, windows, and the anchor's distance from the first window."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            i1, i2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for which, offsets, parts in chunks(batch.column(2).cast(pa.binary()).to_pylist(), size):
                lengths = np.array([len(p) for p in parts])
                ends = np.cumsum(lengths)
                if ends[-1] > LONGEST:  # a block ends with its first part over the limit
                    pieces = [(w, o, p) for w, o, p in zip(which, offsets, parts, strict=True)]
                    groups = [[x] for x in pieces]
                else:
                    groups = [list(zip(which, offsets, parts, strict=True))]
                for group in groups:
                    ends = np.cumsum([len(p) for _, _, p in group])
                    data = b"".join(p for _, _, p in group)
                    found = Stretches(np.frombuffer(data, np.uint8), ends, size, part)
                    last = (found.first + found.count + size - 1).tolist()
                    check = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(found.first.tolist(), last, strict=True)]
                    text = np.array([w for w, _, _ in group])[found.text]
                    base = (np.concatenate([[0], ends[:-1]]) - [o for _, o, _ in group])[found.text]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found.kind.view(np.int64)), pa.array(found.whole.view(np.int64)),
                            pa.array(np.array(check, np.uint64).view(np.int64)),
                            pa.array(i1[text]), pa.array(i2[text]), pa.array(found.first - base, pa.int64()),
                            pa.array(found.count, pa.int32()), pa.array(found.anchor - found.first, pa.int32()),
                        ],
                        names=["h", "g", "check", *ID, "start", "n", "lead"],
                    )

    return rows.select(*ID, "text").mapInArrow(run, "h long, g long, check long, i1 long, i2 long, start long, n int, lead int")


class Sorter:
    """Stretches of several groups: ``data`` holds their bytes one after another, ``first`` where each
    begins, ``size`` its bytes, ``lead`` the place of its anchor, ``group`` its group; groups stand together."""

    def __init__(self, parts: list[bytes], lead: np.ndarray, group: np.ndarray):
        self.bytes = b"".join(parts)
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.size = np.array([len(p) for p in parts])
        self.first = np.cumsum(self.size) - self.size
        self.lead, self.group = lead, group
        self.anchor = self.first + lead
        self.right = self.size - lead
        self.ahead = PrefixHash(self.data)
        self.back = PrefixHash(self.data[::-1])

    def extension(self, i: np.ndarray, j: np.ndarray, left: bool = False) -> np.ndarray:
        """Length of the common extension of two stretches from their anchors, by binary search."""
        if left:
            a, b = len(self.data) - self.anchor[i], len(self.data) - self.anchor[j]
            most, hashes = np.minimum(self.lead[i], self.lead[j]), self.back
        else:
            a, b, hashes = self.anchor[i], self.anchor[j], self.ahead
            most = np.minimum(self.right[i], self.right[j])
        low, high = np.zeros(len(i), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = hashes.part(a, a + middle) == hashes.part(b, b + middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether stretch i comes before j, from the anchors on; equals by number."""
        common = self.extension(i, j)
        ends_i, ends_j = common >= self.right[i], common >= self.right[j]
        top = len(self.data) - 1
        x = self.data[np.minimum(self.anchor[i] + common, top)]
        y = self.data[np.minimum(self.anchor[j] + common, top)]
        return np.where(ends_i & ends_j, i < j, np.where(ends_i, True, np.where(ends_j, False, x < y)))

    def order(self) -> np.ndarray:
        """Mergesort within the groups: in each round every stretch finds its place in the neighbouring run."""
        n = len(self.size)
        order = np.arange(n)
        begin = np.flatnonzero(np.diff(self.group, prepend=-1))
        of = np.cumsum(np.diff(self.group, prepend=-1) != 0) - 1
        start, stop = begin[of], np.append(begin[1:], n)[of]
        run = 1
        while run < (stop - start).max(initial=0):
            place = np.arange(n) - start
            own = place // run
            other = np.where(own % 2 == 0, own + 1, own - 1)
            low = np.minimum(start + other * run, stop)
            high = np.minimum(low + run, stop)
            first, item = low.copy(), order
            while True:
                going = np.flatnonzero(low < high)
                if not len(going):
                    break
                middle = (low[going] + high[going]) >> 1
                earlier = self.before(order[middle], item[going])
                low[going] = np.where(earlier, middle + 1, low[going])
                high[going] = np.where(earlier, high[going], middle)
            pair = start + (own // 2) * 2 * run
            new = pair + (place % run) + (low - first)
            merged = np.empty(n, np.int64)
            merged[new] = order
            order = merged
            run *= 2
        return order

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """The order, and the common prefix of each stretch with the next (-1 at the end of a group), verified."""
        order = self.order()
        n, data = len(order), self.bytes
        common = np.full(n, -1, np.int64)
        same = np.flatnonzero(self.group[order[:-1]] == self.group[order[1:]])
        common[same] = self.extension(order[same], order[same + 1])
        bad = set()
        for k in same.tolist():
            i, j, c = order[k], order[k + 1], int(common[k])
            a, b = int(self.anchor[i]), int(self.anchor[j])
            x, y = data[a : a + int(self.right[i])], data[b : b + int(self.right[j])]
            if x[:c] != y[:c] or x[c:] > y[c:] or (x[c : c + 1] == y[c : c + 1] and x[c:]):
                bad.add(int(self.group[i]))
        for group in bad:
            where = np.flatnonzero(self.group[order] == group)
            tails = {i: data[int(self.anchor[i]) : int(self.anchor[i] + self.right[i])] for i in order[where].tolist()}
            order[where] = sorted(tails, key=lambda i: (tails[i], i))
            for k in where[:-1].tolist():
                x, y = tails[int(order[k])], tails[int(order[k + 1])]
                common[k] = next((c for c, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        return order, common

    def repeats(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stretch, first window, windows) that another stretch of the group has, too."""
        order, common = self.neighbours()
        found = []
        shared = common.copy()
        distance = 1
        at = np.flatnonzero(shared >= 0)
        while len(at):
            i, j = order[at], order[at + distance]
            reach = shared[at]
            # A window with x bytes before the anchor needs size - x after it.
            near = np.minimum(self.lead[i], self.lead[j]) >= size - reach
            left = self.extension(i[near], j[near], left=True)
            low = np.maximum(size - reach[near], 0)
            fit = left >= low
            for side in (i[near][fit], j[near][fit]):
                found.append((side, low[fit], left[fit]))
            for a, b, x, y in zip(i[near][fit].tolist(), j[near][fit].tolist(), low[fit].tolist(), left[fit].tolist(), strict=True):
                p, q, long = int(self.anchor[a]) - y, int(self.anchor[b]) - y, y - x + size
                if self.bytes[p : p + long] != self.bytes[q : q + long]:
                    raise ArithmeticError("hashes of different strings are equal")
            distance += 1
            on = at[at + distance < len(order)]
            on = on[(self.group[order[on]] == self.group[order[np.minimum(on + distance, len(order) - 1)]])]
            shared[on] = np.minimum(shared[on], common[on + distance - 1])
            at = on[shared[on] >= PART]
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, none
        which, low, high = (np.concatenate([f[k] for f in found]) for k in range(3))
        return which, self.lead[which] - high, high - low + 1


# A piece: its group (h, k), what it is (g), the stretches it stands for (c), its place, its anchor's distance from the
# first window, the range of distances that its group is about, and the bytes of its windows.
PIECE = "h long, k long, g long, c long, i1 long, i2 long, start long, lead int, low int, high int, bytes binary"
PIECE_NAMES = ["h", "k", "g", "c", *ID, "start", "lead", "low", "high", "bytes"]
PIECE_TYPES = [pa.int64()] * 7 + [pa.int32()] * 3 + [pa.binary()]


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(PIECE_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, PIECE_TYPES, strict=True)], names=PIECE_NAMES)


def _resolve(size: int):
    """Over pieces sorted by (h, k), the group: (i1, i2, start, n) of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solved(rows: list[tuple]) -> pa.RecordBatch:
            names = {}
            group = np.array([names.setdefault((r[0], r[1]), len(names)) for r in rows])
            sorter = Sorter([r[-1] for r in rows], np.array([r[7] for r in rows]), group)
            which, first, n = sorter.repeats(size)
            open_ = np.array([r[3] for r in rows])[which] == 1  # the others repeat as a whole
            which, first, n = which[open_], first[open_], n[open_]
            columns = [np.array([r[k] for r in rows], np.int64)[which] for k in (4, 5, 6)]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2] + first), pa.array(n.astype(np.int32))],
                names=[*ID, "start", "n"],
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if len(held) >= 4096 and row[:2] != held[-1][:2]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    return run


def _halves(size: int):
    """Each piece as its pieces in the halves of its range: ``k`` is the hash of the core that all windows of a half have
    in common, ``g`` that of the piece; both with the range and the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for h, _, _, c, i1, i2, start, lead, low, high, data in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                prefix = PrefixHash(np.frombuffer(data, np.uint8))
                least = lead - (len(data) - size)
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    near, far = max(a, least), min(b, lead)
                    if near > far:
                        continue
                    first, last = np.array([lead - a, lead - far]), np.array([lead + size - b, lead + size - near])
                    places = np.array([a << 48 | b << 32, near << 48 | far << 32], np.uint64)
                    k, g = mix(prefix.part(first, last) ^ mix(places)).view(np.int64).tolist()
                    out.append((h, k, g, c, i1, i2, start + lead - far, far, a, b, data[lead - far : lead - near + size]))
            yield _pieces(out)

    return run


def _cut_bytes(size: int, most: int):
    """From (i1, i2, text, wanted) the wanted stretches as pieces, each anchor one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            i1, i2, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
            out: list[tuple] = []
            for a, b, text, wanted in zip(i1, i2, texts.to_pylist(), batch.column(3).to_pylist(), strict=True):
                for w in wanted:
                    data = text[w["start"] : w["start"] + w["n"] + size - 1]
                    out.append((w["h"], 0, w["g"], w["c"], a, b, w["start"], w["lead"], 0, most, data))
            yield _pieces(out)

    return run


def _same(low, high, value, what: str):
    """``value`` if both hashes, or bytes, are the same; else the query stops."""
    return F.when(low == high, value).otherwise(F.raise_error(F.lit(f"hashes of different {what} are equal")).cast("long"))


def _within_groups(pieces: DataFrame, size: int, group: int) -> DataFrame:
    """(i1, i2, start, n) of the windows of pieces that another piece of their group has, too."""
    found = None
    while True:
        counts = pieces.groupBy("h", "k").agg(
            F.count("*").alias("kinds"), F.sum(F.when(F.col("c") == 1, 1).otherwise(0)).alias("open")
        )
        counts = stored(counts.where("kinds > 1 AND open > 0"), "groups")
        small = pieces.join(counts.where(F.col("kinds") <= group).select("h", "k"), ["h", "k"]).select(PIECE_NAMES)
        solved = small.repartition("h", "k").sortWithinPartitions("h", "k").mapInArrow(
            _resolve(size), "i1 long, i2 long, start long, n int"
        )
        found = solved if found is None else found.union(solved)
        large = stored(counts.where(F.col("kinds") > group).select("h", "k"), "large-groups")
        if large.isEmpty():
            return found
        key = ["h", "k", "g"]
        cut = stored(pieces.join(large, ["h", "k"]).select(PIECE_NAMES).mapInArrow(_halves(size), PIECE), "halves")
        kinds = cut.groupBy(*key).agg(
            _same(F.min("bytes"), F.max("bytes"), F.sum("c"), "strings").alias("c"), F.count("*").alias("pieces"),
            F.min(F.struct(*PIECE_NAMES[4:])).alias("r"),
        )
        kinds = stored(kinds, "kinds")
        again = kinds.where("c > 1 AND pieces > 1").select(key)
        whole = cut.where("c = 1").join(again, key).select(
            *ID, "start", (F.octet_length("bytes") - F.lit(size - 1)).cast("int").alias("n")
        )
        found = found.union(whole)
        pieces = kinds.select(*key, "c", "r.*").select(PIECE_NAMES)


def repeated_windows(rows: DataFrame, size: int = SIZE, part: int = PART, group: int = GROUP) -> DataFrame:
    """(i1, i2, start, n): windows of texts (rows i1, i2, text) that also start elsewhere."""
    found = stretches(rows, size, part)
    often = stored(found.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "anchors")
    repeated = stored(found.join(often, "h"), "stretches")
    kinds = repeated.groupBy("h", "g").agg(
        _same(F.min("check"), F.max("check"), F.count("*"), "stretches").alias("c"),
        F.min(F.struct(*ID, "start", "n", "lead")).alias("r"),
    )
    kinds = stored(kinds, "kinds")
    whole = repeated.join(kinds.where("c > 1").select("h", "g"), ["h", "g"]).select(*ID, "start", "n")
    mixed = kinds.groupBy("h").agg(
        F.count("*").alias("kinds"), F.sum(F.when(F.col("c") == 1, 1).otherwise(0)).alias("open")
    ).where("kinds > 1 AND open > 0").select("h")
    wanted = kinds.join(stored(mixed, "mixed"), "h").groupBy("r.i1", "r.i2").agg(
        F.collect_list(F.struct("h", "g", "c", "r.start", "r.n", "r.lead")).alias("wanted")
    )
    wanted = stored(wanted, "wanted")
    texts = sifted(rows.select(*ID, "text"), bloom(wanted, *ID), *ID)
    texts = texts.groupBy(*ID).agg(F.first("text").alias("text"))
    pieces = texts.join(wanted, ID).select(*ID, "text", "wanted").mapInArrow(_cut_bytes(size, size - part), PIECE)
    return whole.union(_within_groups(stored(pieces, "pieces"), size, group))


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("n", T.IntegerType())]))


def removed_runs(length: int, starts: np.ndarray, counts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows cover: windows ``starts`` to ``starts + counts - 1``."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate((starts + counts + size - 1)[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    return [(int(x), min(int(y), length)) for x, y in zip(a[first], b[last], strict=True)]


def kept_text(data: bytes, runs: list[tuple[int, int]]) -> str:
    """The remaining text; characters of which a part was removed are left out whole."""
    kept, at = [], 0
    for a, b in [*runs, (len(data), len(data))]:
        kept.append(data[at:a])
        at = b
    return "".join(k.decode(errors="ignore") for k in kept)


def _removed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for data, spans in zip(texts, batch.column(3).to_pylist(), strict=True):
                runs = removed_runs(
                    len(data), np.array([s["start"] for s in spans]), np.array([s["n"] for s in spans]), size
                )
                sha, at = hashlib.sha256(), 0
                for a, b in [*runs, (len(data), len(data))]:
                    sha.update(data[at:a])
                    at = b
                out.append((sum(b - a for a, b in runs), len(runs), sha.hexdigest(), kept_text(data, runs)))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)] + [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                names=[*ID, "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def removals(rows: DataFrame, size: int = SIZE, part: int = PART, group: int = GROUP) -> DataFrame:
    """(i1, i2, n_removed, n_spans, kept_sha256, kept) of the different texts that lose something.

    ``rows`` has i1, i2 and text for every row of the table."""
    spans = repeated_windows(rows, size, part, group)
    copied = rows.groupBy(*ID).agg(F.count("*").alias("times"), F.max(F.octet_length("text")).alias("size")).where(
        F.col("times") > 1
    )
    copied = stored(copied, "copied")
    listed = spans.groupBy(*ID).agg(F.collect_set(F.struct("start", "n")).alias("spans")).join(copied, ID, "left_anti")
    listed = stored(listed, "spans")
    texts = sifted(rows.select(*ID, "text"), bloom(listed, *ID), *ID)
    single = texts.join(listed, ID).select(*ID, "text", "spans").mapInArrow(
        _removed(size), "i1 long, i2 long, n_removed long, n_spans long, kept_sha256 string, kept string"
    )
    whole = copied.where(F.col("size") >= size).select(
        *ID, F.col("size").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"), F.lit("").alias("kept"),
    )
    return single.union(whole)


def report(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = with_id(df.select(F.col(key), whole_text(text).alias("text")))
    found = removals(rows.select(*ID, "text"), size).drop("kept")
    own = rows.select(
        key, *ID, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    )
    return own.join(found, ID, "left").select(
        key, "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def remove(df: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """The rows with what is left of their texts; texts that lose nothing are as they were (NULL stays NULL) and
    are not shuffled."""
    names = df.columns
    i1, i2 = free_names(df, *ID)
    rows = df.withColumns({i1: F.xxhash64(whole_text(text)), i2: F.xxhash64(F.lit("second"), whole_text(text))})
    narrow = rows.select(F.col(i1).alias("i1"), F.col(i2).alias("i2"), whole_text(text).alias("text"))
    found = stored(removals(narrow, size).select(*ID, "kept"), "kept")
    bits = bloom(found, *ID)
    rest = sifted(rows, bits, i1, i2)
    on = (rest[i1] == found["i1"]) & (rest[i2] == found["i2"])
    left = [F.coalesce(found["kept"], rest[c]).alias(c) if c == text else rest[c] for c in names]
    return sifted(rows, bits, i1, i2, inside=False).select(names).union(rest.join(found, on, "left").select(left))
