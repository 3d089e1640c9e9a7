"""Ranked search, periodic runs and packing against brute force, and their edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.test_operators import SPECIAL, WORDS, documents, prose
from veristrata.llm import packing, ranked, runs
from veristrata.llm.common import portions
from veristrata.llm.queries import byte_model_path, op12_periodic_runs, op13_packing, periodic

# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(small)


def plain_ranking(docs, items, k):
    """All scores of (key, text) for (key, text): sorted (item key, rank, key, score)."""
    own = [(i, plain_terms(t)) for i, t in docs]
    own = [(i, t, collections.Counter(t)) for i, t in own if t]
    n, length = len(own), sum(len(t) for _, t, _ in own)
    held = collections.Counter(x for _, _, c in own for x in c)
    out = []
    for item, text in items:
        found = []
        for i, terms, counts in own:
            m = 100 - 75 + 75 * len(terms) * n // length
            score = 0
            for t in plain_terms(text):
                tf = counts[t]
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1)))
                score += w * (1000000000 * tf // (1000 * tf + 8 * m)) if tf else 0
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if nil else i, -s) for r, (s, nil, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "portion"), [(1 << 20, 1 << 20), (300, 40), (1 << 20, 1)])
def test_ranked_search_by_brute_force(spark, block, portion):
    draw = random.Random(3)
    texts = [*SPECIAL, "a" * 3, "---", "a-b_c D'e", prose(WORDS, 1, 5000)]
    texts += [prose(WORDS[:60], i, draw.choice([3, 20, 80])) for i in range(120)]
    texts += [texts[20]] * 15 + ["été Été ÉTÉ x"] * 3
    docs = documents(spark, texts).repartition(5)
    keyless = documents(spark, ["w", texts[20], texts[20]]).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "key", "n")
    wanted = [None, "", "??", "a", "A b c", texts[20], texts[20], "nowhere", prose(WORDS[:60], 500, 30), prose(WORDS, 77, 300), "été x x x"]
    items = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(wanted)] + [(5, "a a", 2, "y")], "item_id long, text string, key long, item string")
    got = ranked.search(docs.union(keyless), items, block=block, portion=portion)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    pairs = [*enumerate(texts), (None, "w"), (None, texts[20]), (None, texts[20])]
    want = plain_ranking(pairs, [*enumerate(wanted), (5, "a a")], 10)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_ranked_search_of_nothing(spark):
    docs = documents(spark, ["a", "b"])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(docs.where("false"), items).collect() == []
    assert ranked.search(docs, items.where("false")).collect() == []
    assert ranked.search(documents(spark, [None, "."]), items).collect() == []
    with pytest.raises(ValueError, match="different names"):
        ranked.search(docs, docs, item_key="doc_id")


def test_reading_stops_only_when_all_is_known():
    """Portions of lists with ties at the k-th place, bounds from before, and lists of very different lengths."""
    draw = np.random.default_rng(5)
    for _ in range(60):
        n, terms = int(draw.integers(1, 3000)), int(draw.integers(1, 12))
        pairs = np.unique(draw.integers(0, n * terms, int(draw.integers(1, n * terms + 1))))
        impact = draw.integers(1, draw.choice([3, 50, 10**9]), len(pairs))
        lists = ranked.Lists(pairs % terms, pairs // terms, impact, n, terms)
        times = draw.integers(1, 4, terms)
        scores = np.zeros(n, np.int64)
        np.add.at(scores, pairs // terms, impact * times[pairs % terms])
        least = int(draw.choice([1, np.sort(scores)[-1], max(1, np.sort(scores)[len(scores) // 2])]))
        order = np.lexsort((np.arange(n), -scores))
        want = [(i, scores[i]) for i in order if scores[i] >= least][:10]
        at, found = lists.best(np.arange(terms), times, 10, least)
        assert list(zip(at, found, strict=True)) == want


def test_shares_of_very_large_corpora():
    n = np.array([10**7, 3])
    got = ranked.impacts(np.array([5, 5]), np.array([2, 1]), n, 10**12, 10**14)
    long = [100 - 75 + 75 * x * 10**12 // 10**14 for x in n.tolist()]
    assert got.tolist() == [5 * (10**9 * t // (1000 * t + 8 * m)) for t, m in zip([2, 1], long, strict=True)]


# Periodic runs


def plain_runs(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i >= max(q, least - q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def hostile(draw, kind, n):
    if kind < 2:
        return [draw.choice("ab" if kind else "abc") for _ in range(n)]
    if kind == 2:
        part = [draw.choice("ab") for _ in range(draw.randrange(1, 20))]
        w = (part * n)[:n]
        for _ in range(draw.randrange(3)):
            w[draw.randrange(n)] = "x"
        return w
    if kind == 3:
        w = []
        while len(w) < n:
            w += [draw.choice("aab") for _ in range(draw.randrange(1, 9))] * draw.randrange(1, 8)
        return w
    if kind == 4:  # Fibonacci words
        a, b = ["a"], ["a", "b"]
        while len(b) <= n:
            a, b = b, b + a
        return b[:n]
    m = draw.randrange(4, 30)
    return (["a", "b"] * 50)[:m] + (["a", "b"] * 50)[draw.randrange(2) :][:m] + ["c"] * draw.randrange(14)


@pytest.mark.parametrize("least", [12, 4, 13])
def test_runs_by_brute_force(least):
    draw, total = random.Random(least), 0
    for _ in range(700):
        texts = [[x.encode() for x in hostile(draw, draw.randrange(6), draw.randrange(1, 90))] for _ in range(draw.choice([1, 4]))]
        rows, rest = runs.search([*texts, []], least)
        for i, words in enumerate(texts):
            want = plain_runs(words, least)
            assert [tuple(r[1:]) for r in rows.tolist() if r[0] == i] == want, words
            assert rest[i] == b" ".join(collapsed(words, want))
            total += len(want)
    assert total > 1000


def test_work_on_runs_is_near_linear():
    """Words that occur everywhere don't make pairs of all their places."""
    for words in ([b"a"] * 100_000, [b"a", b"b"] * 50_000, [b"a"] * 50_000 + [b"b"] + [b"a"] * 50_000):
        rows, rest = runs.search([words])
        assert len(rows) in (1, 2) and len(rest[0]) < 10
        grams = np.zeros(len(words), np.int64)
        place, _ = runs._far_pairs(grams, np.arange(len(words)), 6, len(words))
        assert len(place) <= 8 * len(words)


def test_runs_query_by_brute_force(spark, sf_dir):
    found = {r["doc_id"]: r for r in op12_periodic_runs(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    some = 0
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want = plain_runs(words) if n < 1500 else [tuple(r[1:]) for r in runs.search([[w.encode() for w in words]])[0].tolist()]
        some += bool(want)
        top = min(want, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in want)
        assert tuple(found[doc_id])[1:] == (
            len(want), *(top or (None,) * 3), top and 1000 * top[1] // top[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(collapsed(words, want)).encode()).hexdigest(),
        )
    assert some >= 10


def test_runs_edges(spark):
    texts = [*SPECIAL, "la " * 40, "a b c " * 5 + "x", " b " * 20, prose(WORDS, 1, 30000)]
    df = documents(spark, texts + texts[-4:]).selectExpr("*", "1 runs", "2 collapsed", "3 _text")
    got = {r["doc_id"]: r for r in runs.find(df).collect()}
    n = len(SPECIAL)
    assert all(got[i]["runs"] == [] for i in range(n)) and got[0]["collapsed"] == "" and got[5]["collapsed"] == "A a a"
    assert [tuple(r) for r in got[n]["runs"]] == [(0, 40, 1)] and got[n]["collapsed"] == "la"
    assert got[n + 1]["collapsed"] == "a b c x" and tuple(got[n + 2]["runs"][0]) == (0, 20, 1)
    assert got[n + 3]["runs"] == [] and got[n + 3]["collapsed"] == texts[n + 3]
    assert [got[i][1:] for i in range(n, n + 4)] == [got[i][1:] for i in range(n + 4, n + 8)]
    assert runs.find(df.where("false")).collect() == []
    nameless = periodic(spark.createDataFrame([(None, "a b"), (8, None)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in nameless) == [(0, "a b"), (8, "")]


# Packing


def numbers(data):
    return np.frombuffer(bytes(data), "<u4").tolist()


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_model_path())


def test_encoder_equals_the_library():
    """Over one in seven of all code points, alone, doubled and beside letters, digits and blanks; and odd texts."""
    encoder, own = packing.Encoder(byte_model_path()), library()
    assert encoder.fast is not None
    points = [chr(c) for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" x{c}1 {c}{c}a  {c}" for c in points] + [t or "" for t in SPECIAL]
    texts += ["a <|endoftext|> b", " " * 5000 + "x", "y" * 3000, "\n" * 1200, "日本語" * 500, "I'll 'tis\t\n  we've  ", "\x00\x1c\x85"]
    texts += [prose(WORDS, i, 300) for i in range(20)]
    for text, want in zip(texts, own.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.ids(text).tolist() == want.ids, repr(text)


@pytest.mark.parametrize("length", [2048, 16, 1])
def test_packing_by_brute_force(spark, length):
    texts = [*SPECIAL, prose(WORDS, 1, 4000), *[prose(WORDS, i, i % 40) for i in range(60)]]
    df = documents(spark, texts).selectExpr("*", "1 start", "2 ids", "'x' part").repartition(7).persist()
    packed = packing.pack(df, byte_model_path(), length=length).persist()
    rows = packed.orderBy("sequence_id", "offset").collect()
    own, place = library(), 0
    ids = {i: own.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    parts = collections.defaultdict(list)
    for r in rows:
        assert (r["sequence_id"], r["offset"]) == divmod(place, length)
        assert 0 < r["length"] <= length - r["offset"] and len(r["ids"]) == 4 * r["length"]
        place += r["length"]
        parts[r["doc_id"]].append(r)
    assert place == sum(map(len, ids.values()))
    for i, want in ids.items():
        pieces = sorted(parts[i], key=lambda r: r["start"])
        assert [x for r in pieces for x in numbers(r["ids"])] == want
        at = 0
        for r in pieces:
            assert (r["start"], r["doc_tokens"], r["continued"]) == (at, len(want), at > 0)
            at += r["length"]
            assert r["continues"] == (at < len(want))
    whole = {r["sequence_id"]: r for r in packing.sequences(packed, length).collect()}
    assert sorted(whole) == list(range(-(-place // length)))
    joined = [x for r in rows for x in numbers(r["ids"])]
    for s, r in whole.items():
        assert numbers(r["ids"]) == joined[s * length : (s + 1) * length] and r["n"] == len(r["ids"]) // 4


def test_packing_edges(spark):
    df = documents(spark, [None, "a", "a"])
    none = packing.pack(df.where("false"), byte_model_path())
    assert none.collect() == [] and packing.sequences(none).collect() == []
    rows = packing.pack(df, byte_model_path(), end=None).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2]
    keyless = df.selectExpr("cast(null as long) doc_id", "text")
    assert [r["doc_id"] for r in packing.pack(keyless, byte_model_path()).collect()] == [None] * 3
    assert list(portions([5, 1, 1, 9, 2], 4)) == [(0, 1), (1, 3), (3, 4), (4, 5)] and list(portions([], 4)) == []


def test_packing_query(spark, sf_dir):
    rows = op13_packing(spark, sf_dir).orderBy("sequence_id", "offset").collect()
    own = library()
    place, ids = 0, {}
    for doc_id, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids[doc_id] = np.array(own.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
    for r in rows:
        assert (r["sequence_id"], r["offset"]) == divmod(place, 2048)
        place += r["length"]
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (r["ids_crc32"], r["doc_tokens"]) == (zlib.crc32(part.tobytes()), len(ids[r["doc_id"]]))
    assert place == sum(map(len, ids.values()))
    seen = collections.Counter()
    for r in rows:
        seen[r["doc_id"]] += r["length"]
    assert seen == {i: len(x) for i, x in ids.items()}
