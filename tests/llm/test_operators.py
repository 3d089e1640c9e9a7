"""The operators on small tables: edge cases, and brute-force versions of what SQL can't express."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from veristrata.llm import chat, decontaminate, html, language, lm, pieces, simhash, suffix, topk, warc
from veristrata.llm.common import held_out, words_of
from veristrata.llm.components import components
from veristrata.llm.queries import piece_model_path

SPECIAL = [None, "", " ", "\n", "a", "A a\ta", "été  été", "x" * 300, "no\x00zero", "日本 語", "▁ blank", "<s> </s>"]


def documents(spark, texts, extra="clash"):
    rows = [(i, t, "en", "src", extra, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key string, n long")


def prose(words, seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) for _ in range(n))


WORDS = ["".join(random.Random(i).choice("abcdefghij") for _ in range(2 + i % 7)) for i in range(400)]


# Language models


def plain_tokens(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", small) + ["\n"]


def test_lm_counts_by_hand(spark):
    texts = SPECIAL + [prose(WORDS, i, 200) for i in range(30)] + [prose(WORDS, 1, 200)]
    df = documents(spark, texts)
    got = {r["doc_id"]: r for r in lm.score(df, held_out("doc_id", 7, 2), head=50).collect()}
    counts = collections.Counter()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(plain_tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    for i, t in enumerate(texts):
        own, row = plain_tokens(t), got[i]
        assert row["n_tokens"] == len(own)
        assert row["n_known"] == sum(counts[w] > 0 for w in own)
        assert row["train_tokens"] == total
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        assert row["base_score"] == pytest.approx(base)
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert row["score"] < 0


def test_lm_probabilities_add_up(spark):
    df = documents(spark, [prose(WORDS, i, 100) for i in range(20)])
    counts = lm.word_counts(df.select("text"))
    known = lm.vocabulary(counts)
    known.prepare()
    draw = np.random.default_rng(1)
    parameters = lm.Parameters.of(draw.normal(0, 0.5, lm.Parameters.initial(known.class_counts).flat().shape))
    every = np.arange(len(known.class_counts))
    before = np.full(len(every), 7), np.full(len(every), known.start)
    chances = np.exp(parameters.scores(*before, every) - parameters.normalisers(3)[7, known.start])
    assert chances.sum() == pytest.approx(1, abs=1e-4)
    # Words of a shared class, with one more for unseen words, have all of its chance.
    shares = collections.Counter()
    for r in counts.collect():
        _, kind = known.class_ids([r["word"].encode()])
        if known.own <= kind[0] < known.ends:
            shares[int(kind[0])] += r["c"] + 1
    for kind, n in shares.items():
        assert n + 1 == known.within[kind - known.own]


def test_lm_long_words_and_growing_classes(spark):
    long = ["w" * 65, "w" * 64, "日本語" * 30, "é" + "x" * 80, "x" * 80 + "é", "a" * 5_000]
    texts = [f"{w} {w}a b" for w in long] * 3 + [None] + [prose(WORDS, i, 60) for i in range(20)]
    never = F.lit(False)
    got = {r["doc_id"]: r for r in lm.score(documents(spark, texts), never).collect()}
    counts = collections.Counter(w for t in texts for w in plain_tokens(t))
    size = sum(counts.values()) + len(counts) + 1
    for i, t in enumerate(texts):
        own = plain_tokens(t)
        assert got[i]["n_known"] == len(own)
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / size) for w in own))
    # The head is bounded by bytes; names, classes and their sums agree between Python and Spark.
    table = lm.word_counts(documents(spark, texts).select(F.coalesce("text", F.lit(""))))
    known = lm.vocabulary(table)
    assert max(map(len, known.words)) <= lm.LONGEST
    for r in table.select("word", lm.ending_column(F.col("word")).alias("k")).collect():
        assert lm.ending(r["word"].encode()) == r["k"]
    words = spark.range(5_000).select(F.concat(F.lit("v"), F.col("id")).alias("word"), F.lit(2).alias("c"))
    assert lm.vocabulary(words.limit(1_000)).own < lm.vocabulary(words).own <= lm.OWN


def test_lm_learns_and_survives_nothing(spark):
    texts = [" ".join(["ab cd"] * 100) if i % 2 else " ".join(["ef gh"] * 100) for i in range(60)]
    rows = lm.score(documents(spark, texts), held_out("doc_id", 7, 2)).collect()
    assert all(r["score"] > r["base_score"] for r in rows)
    assert lm.score(documents(spark, []), held_out("doc_id", 7, 2)).collect() == []
    alone = lm.score(documents(spark, [None]), held_out("doc_id", 7, zlib.crc32(b"0") % 7)).collect()[0]
    assert (alone["n_tokens"], alone["n_known"], alone["train_tokens"], alone["base_score"]) == (1, 0, 0, 0.0)


# Fingerprints


def plain_fingerprint(text):
    words = plain_tokens(text)[:-1]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_by_brute_force(spark):
    texts = SPECIAL + SPECIAL + [prose(WORDS, i, 80) for i in range(20)]
    texts += [texts[-1].replace(" ", "  "), texts[-2].upper()]
    got = {r["doc_id"]: r for r in simhash.groups(documents(spark, texts)).collect()}
    marks = [plain_fingerprint(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(marks):
            for j, b in enumerate(marks):
                if (a ^ b).bit_count() <= 2:
                    label[i] = min(label[i], label[j])
    for i in range(len(texts)):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{marks[i]:016x}", label[i])


def test_links_are_complete(spark):
    draw = np.random.default_rng(5)
    base = draw.integers(-(2**63), 2**63 - 1, 40)
    marks = set(base.tolist())
    for x in base.tolist():
        for _ in range(5):
            y = x
            for bit in draw.integers(0, 64, draw.integers(1, 4)).tolist():
                y ^= 1 << bit if bit < 63 else -(1 << 63)
            marks.add(y)
    df = spark.createDataFrame([(m,) for m in marks], "fp long")
    for segments in (8, 12, 16):
        got = {tuple(r) for r in simhash.links(df, segments=segments).distinct().collect()}
        want = {(a, b) for a in marks for b in marks if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
        assert got == want


def test_components_of_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 300)], "a long, b long")
    got = dict(tuple(r) for r in components(links).collect())
    assert got == {i: 0 for i in range(101)} | {200: 200, 300: 200}


def test_representatives(spark):
    """One row a group: the smallest key, NULL last; no text of another group goes with a repeated or missing key."""
    base = prose(WORDS, 5, 400)
    other = prose(WORDS, 6, 400)
    texts = [base, base, other, other.upper(), prose(WORDS, 9, 50)]
    df = documents(spark, texts)
    assert sorted(r["doc_id"] for r in simhash.representatives(df).collect()) == [0, 2, 4]
    none = df.where("false")
    assert simhash.representatives(none).collect() == [] and simhash.groups(none).collect() == []
    own = [prose(WORDS, 40 + i, 60) for i in range(7)]
    ids = [None, None, None, 3, 5, 5, 7, 7]
    rows = [(i, own[min(n, 6)], n, "a", 1) for n, i in enumerate(ids)] + [(3, own[5], 9, "b", 2), (None, own[0], 0, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h1 int, H2 string, content int")
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    got = [tuple(r) for r in kept.collect()]
    assert sorted(t for _, t, *_ in got) == sorted(set(own))
    assert {(i, t) for i, t, *_ in got} == {
        (None, own[0]), (None, own[1]), (None, own[2]), (3, own[3]), (5, own[4]), (3, own[5]), (7, own[6])
    }


def test_representatives_by_brute_force(spark):
    """Against all pairs: groups of texts that differ in few bits, with hot copies, NULL texts and long ones."""
    draw, texts = random.Random(77), [None, "", "a", "a", "A", prose(WORDS, 3, 30000)]
    for g in range(30):
        base = prose(WORDS, 600 + g, 300).split()
        for _ in range(draw.choice([1, 2, 5, 20])):
            copy = list(base)
            if draw.random() < 0.7:
                copy[draw.randrange(300)] = "other"
            texts.append(" ".join(copy))
    found = [simhash.fingerprint(t or "") for t in texts]
    first = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (found[i] ^ found[j]).bit_count() <= 2 and first[i] != first[j]:
                low, high = sorted((first[i], first[j]))
                first = [low if f == high else f for f in first]
    df = documents(spark, texts)
    assert 30 < len(set(first)) < len(texts)
    assert sorted(r["doc_id"] for r in simhash.representatives(df).collect()) == sorted(set(first))
    assert {r["doc_id"]: r["component_id"] for r in simhash.groups(df).collect()} == dict(enumerate(first))


# Languages


def test_language_spans_and_edges(spark):
    german = "der die das und nicht schön straße über"
    english = "the of and with that this there when"
    russian = "что это как его для все было"
    rows = [(i, " ".join(random.Random(i).choices(t.split(), k=40)), name)
            for i in range(40) for name, t in (("de", german), ("en", english), ("ru", russian))]
    rows += [(99, None, "de"), (100, "xyz", None)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(train)
    assert model.languages == ["de", "en", "ru"]
    mixed = f"{english} {english} {english} {german} {german}"
    texts = [None, "", "12 34", mixed, russian, "日本", english]
    got = language.identify(documents(spark, texts), model, spans=True).collect()
    assert [(r["lang_pred"], r["score"]) for r in got[:3]] == [("und", 0.0)] * 3
    assert got[3]["lang_pred"] == "en"
    assert [s["lang"] for s in got[3]["spans"]] == ["en", "de"]
    assert mixed[got[3]["spans"][1]["start"] : got[3]["spans"][1]["end"]] == f"{german} {german}"
    assert (got[4]["lang_pred"], got[4]["score"]) == ("ru", 1.0)
    assert got[5]["lang_pred"] in model.languages and got[5]["score"] == 0.0
    assert language.train(train.where("false")) is None
    assert {r["lang_pred"] for r in language.identify(documents(spark, texts), None).collect()} == {"und"}


def test_corpus_in_one_language(spark):
    """Through stage 1: texts in the one language stay, texts in scripts that it does not use go."""
    texts = ["the cat and the dog", "日本 語", "", *[f"this is text {i}" for i in range(20)]]
    docs = documents(spark, texts)
    docs = docs.selectExpr("doc_id", "text", "if(doc_id = 1, null, lang) lang", "source", "key", "n")
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, *range(3, 23)]
    model = language.train(documents(spark, texts[3:]))
    found = list(language.label(model, texts[:3]))
    assert found == [("en", 1.0, found[0][2]), ("en", 0.0, []), ("und", 0.0, [])] and found[0][2]


def test_best_path_is_the_best():
    draw = np.random.default_rng(3)
    for n in (1, 2, 5, 7):
        for _ in range(40):
            scores = -draw.integers(0, 20, (n, 3)).astype(float)
            path = language.best_path(scores, 7.0)
            value = lambda p: scores[range(n), p].sum() - 7.0 * (np.diff(p) != 0).sum()  # noqa: B023, E731
            grid = np.stack(np.meshgrid(*[range(3)] * n), -1).reshape(-1, n)
            assert value(path) == max(value(p) for p in grid)


# Pages


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain & simple", "plain & simple"), ("<p>a<p>b", "a\nb"),
    ("<article><h1>T</h1><p>One, &eacute;&nbsp;two<br>three<script>x</script></p></article><div class=ad>buy, buy, buy, now</div>",
     "T\nOne, é two three"),
    ("<div id=sidebar><p>a, b, c, d</p></div><div class=content><p>Long enough to be read, is it not?</p></div>"
     "<section class='comments'><p>first, second, third</p></section>", "Long enough to be read, is it not?"),
    ("<nav><a href=x>m</a></nav>", ""), ("<body><article><ul><li>i<li>j</ul>tail</article>", "i\nj\ntail"),
    ("<article><header><h1>H</h1></header><p>x</p><footer>f</footer></article><header>top</header>", "H\nx"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("<p>unclosed <b>bold <i>it</p><p>next</p>", "unclosed bold it\nnext"),
])
def test_main_text(page, text):
    assert html.main_text(page or "") == text


ARTICLE = "This is an article, with commas, and a good deal of text. " * 11


@pytest.mark.parametrize("marks", [
    "post hentry tag-python", "container sidebar-left", "wrapper nav-open", "content widget-area", "entry share-enabled",
    "sidebar-left", "post comments-open",
])
def test_layout_classes_keep_the_article(marks):
    alone = f'<body><div class="{marks}"><p>{ARTICLE}</p></div></body>'
    assert html.main_text(alone) == ARTICLE.strip()
    page = (
        f'<body><nav><a href=x>menu</a></nav><div class="{marks}"><p>{ARTICLE}</p>'
        f'<div class="comments-area"><p>{ARTICLE}</p></div></div></body>'
    )
    assert html.main_text(page) == ARTICLE.strip()


@pytest.mark.parametrize("marks", ["sidebar", "widget-area", "social-share", "post-comments content", "cookie-banner", "tags"])
def test_noise_classes_go(marks):
    page = f'<body><div class="post"><p>{ARTICLE}</p></div><div class="{marks}"><p>{ARTICLE}</p></div></body>'
    assert html.main_text(page) == ARTICLE.strip()


@pytest.mark.parametrize("page", [
    lambda n: "<b>" * n + "<p>x" * n, lambda n: "<div>x" * n, lambda n: "<span>" * n + "</q>" * n + "x",
    lambda n: "<span>" * n + "<li>x" * n, lambda n: "<article>" + "<header>x" * n + "<h1>h", lambda n: "<td>x<b>" * n,
    lambda n: "".join(f"<x{i}>" for i in range(n)) + "</div>" * n + "x", lambda n: "<ul><li>x" * n, lambda n: "<p>x</p>" * n,
])
def test_time_is_linear_in_the_page(page):
    def seconds(n):
        """The least of three runs, as the collector of garbage may come in between."""
        took = []
        for _ in range(3):
            begin = time.process_time()
            assert html.main_text(page(n))
            took.append(time.process_time() - begin)
        return min(took)

    # Eight times the page: 8 times the time if it is linear, 64 times if it is square.
    assert seconds(40_000) < 24 * max(seconds(5000), 0.01)


def plain_points(root):
    """The scores by their definition: each element asks all blocks below it."""
    found = html.blocks(root)

    def distance(node, owner):
        holder = owner.parent if owner.tag in html.PARAGRAPHS and owner.parent else owner
        steps = 1
        while holder is not None and holder is not node:
            holder, steps = holder.parent, steps + 1
        return steps if holder is node else None

    def points(node):
        own = [(distance(node, o), t, linked) for o, t, linked in found]
        own = [(d, t, linked) for d, t, linked in own if d is not None]
        total = sum(html._points(t) * (1 - linked / len(t)) / d for d, t, linked in own)
        if node.tag in ("article", "main"):
            total = total * 2 + 25
        elif html.ARTICLE.search(node.marks):
            total = total * 1.25 + 5
        length = sum(len(t) for _, t, _ in own)
        return (total * (1 - sum(x for *_, x in own) / max(length, 1)), length) if own else None

    out, stack = {}, [root]
    while stack:
        node = stack.pop()
        value = points(node)
        if value:
            out[id(node)] = value
        stack += [c for c in node.children if isinstance(c, html.Node)]
    return out


def test_scores_by_brute_force():
    draw = random.Random(6)
    tags = "div p span b a ul li table tr td h2 article header section main body blockquote".split()
    for _ in range(400):
        parts = []
        for _ in range(draw.randrange(1, 50)):
            kind, tag = draw.random(), draw.choice(tags)
            if kind < 0.4:
                parts.append(f"<{tag}{draw.choice(['', ' class=post', ' class=sidebar', ' id=x'])}>")
            elif kind < 0.65:
                parts.append(f"</{tag}>")
            else:
                parts.append(draw.choice(["some words here, and more of them ", "x", "a, b, c, d", "Long enough to be read? " * 5]))
        nodes = []
        root = html.parse("".join(parts), nodes)
        scored = {id(n): (n.points, n.length) for n in html.score(html.blocks(root), nodes)}
        want = plain_points(root)
        assert scored.keys() == want.keys()
        assert all(scored[k] == pytest.approx(want[k]) for k in want)


def test_extract_keeps_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>", "x"), (2, None, None, "y")], "page_id long, url string, html string, text string")
    assert [tuple(r) for r in html.extract(pages).orderBy("page_id").collect()] == [(1, "u", "é", 1), (2, None, "", 0)]


# Repeated byte strings


def plain_removed(texts, size):
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(d[s : s + size] for d in data for s in range(len(d) - size + 1))
    out = []
    for d in data:
        cover = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - size + 1):
            if counts[d[s : s + size]] > 1:
                cover[s : s + size] = True
        runs = int((np.diff(cover.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, c in zip(d, cover, strict=False) if not c)
        out.append((len(d), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [64, 5, 1])
def test_suffix_by_brute_force(spark, group):
    draw = random.Random(8)
    passages = [prose(WORDS, 100 + i, 70) for i in range(6)]
    texts = [*SPECIAL, "z" * 700, "ab" * 400, "ab" * 400, "é" * 150]
    for i in range(50):
        text = prose(WORDS, i, 60)
        for p in draw.sample(passages, 2):
            a, b = sorted(draw.choices(range(len(p)), k=2))
            text += p[a:b] + prose(WORDS, 999 + i, draw.choice([0, 0, 3]))
        texts.append(text)
    texts += [texts[-1], texts[-2] + " more", "x" + texts[-3]]
    # A passage in very different surroundings, of which some share a part, too.
    for i in range(30):
        texts.append(prose(WORDS, 5000 + i % 7, 30) + f" {i} " + passages[0] + f"{i % 5} " + prose(WORDS, 6000 + i % 3, 30))
    rows = suffix.with_id(documents(spark, texts).selectExpr("doc_id", "coalesce(text, '') as text"))
    found = {(r["i1"], r["i2"]): r for r in suffix.removals(rows.select("i1", "i2", "text"), group=group).collect()}
    want = plain_removed(texts, 200)
    for r in rows.collect():
        n, removed, runs, sha = want[r["doc_id"]]
        own = found.get((r["i1"], r["i2"]))
        got = (own["n_removed"], own["n_spans"], own["kept_sha256"]) if own else (0, 0, hashlib.sha256(r["text"].encode()).hexdigest())
        assert got == (removed, runs, sha), r["doc_id"]


def test_suffix_report_and_remove(spark):
    passage = prose(WORDS, 3, 80)
    texts = [None, "", "short", passage + " tail one", "head é" + passage, "q" * 250, "q" * 250]
    df = documents(spark, texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.report(df).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removed(texts, 200)
    left = {r["doc_id"]: r["text"] for r in suffix.remove(df).collect()}
    assert left[0] is None and left[2] == "short" and left[5] == "" and passage[5:50] not in left[3]
    assert suffix.remove(df).columns == df.columns
    assert suffix.report(documents(spark, [])).collect() == []


def test_suffix_with_clashing_columns(spark):
    passage = prose(WORDS, 3, 80)
    rows = [(0, "a " + passage, 7, 8, "k"), (1, passage + " b", 9, None, "l"), (2, None, 1, 2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, i1 long, I2 long, kept string")
    left = suffix.remove(df)
    assert left.columns == df.columns
    got = sorted(tuple(r) for r in left.collect())
    assert [r[2:] for r in got] == [r[2:] for r in rows]
    assert passage[10:-10] not in got[0][1] + got[1][1] and got[2][1] is None


def test_collisions_of_stretches_stop_the_query(spark):
    rows = spark.createDataFrame([(1, 2, 5), (1, 2, 6)], "h long, g long, check long")
    kinds = rows.groupBy("h", "g").agg(suffix._same(F.min("check"), F.max("check"), F.count("*"), "stretches").alias("c"))
    with pytest.raises(Exception, match="hashes of different stretches"):
        kinds.collect()


def test_sorting_survives_bad_hashes(monkeypatch):
    parts = [prose(WORDS, i, 60).encode()[:220] for i in range(12)]
    parts = [p[:100] + parts[0][100:164] + p[164:] for p in parts]
    sorter = suffix.Sorter(parts, np.full(12, 100), np.zeros(12, np.int64))
    good = sorter.neighbours()
    monkeypatch.setattr(sorter.ahead, "sums", sorter.ahead.sums & np.uint64(0))
    order, common = sorter.neighbours()
    assert order.tolist() == good[0].tolist() and common.tolist() == good[1].tolist()


# Vectors


def test_topk_edges(spark):
    draw = np.random.default_rng(2)
    vectors = [(i, draw.normal(0, 1, 4).tolist()) for i in range(200)]
    vectors += [(i, vectors[3][1]) for i in range(200, 260)]  # ties
    vectors += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (304, []),
                (50, vectors[50][1]), (None, [1.0] * 4), (350, [1.0, 2.0]), (351, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<double>, score int, id string")
    got = {}
    from pyspark.sql import functions as F
    for r in topk.search(df, F.col("id") % 50 == 0, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    fit = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in {i: v for i, v in fit if i % 50 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in fit if i != q and len(w) == len(v))[:5]
        assert sorted(got.get(q, [])) == [(k, i, -s) for k, (s, i) in enumerate(scores, 1)], q
    assert topk.search(df.where("false"), F.col("id") % 50 == 0, 5).collect() == []


def test_topk_of_long_vectors_and_large_scores(spark):
    from pyspark.sql import functions as F

    draw = np.random.default_rng(5)
    size = [1.0, 1.0, 1e3, 2.0**20, 2.0**20 + 1, 3e5]
    vectors = [(i, (draw.normal(0, 1, 3) * size[i % 6]).tolist()) for i in range(90)]
    # Scores that differ by one where doubles no longer tell them apart.
    vectors += [(100, [2.0**22, 1 / 256, 0.0]), (101, [2.0**22, 0.0, 0.0]), (102, [2.0**22, 2 / 256, 0.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    ints = {i: [math.floor(256 * x) for x in v] for i, v in vectors}
    got = {}
    for r in topk.search(df, F.col("id") % 10 == 0, 4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {q for q in ints if q % 10 == 0}
    for q, found in got.items():
        scores = sorted((-sum(a * b for a, b in zip(ints[q], w, strict=True)), i) for i, w in ints.items() if i != q)[:4]
        assert sorted(found) == [(k, i, -x) for k, (x, i) in enumerate(scores, 1)], q
    huge = spark.createDataFrame([(0, [1e300]), (1, [1.0]), (2, [-1e300]), (3, [5e299])], "vec_id long, embedding array<double>")
    top = 1 << 61
    found = topk.search(huge, F.col("id") == 0, 5).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, top), (3, top), (2, -top)]


# Pieces


def test_pieces_equal_the_library(spark):
    model = pieces.PieceModel(piece_model_path())
    draw = random.Random(4)
    texts = [*SPECIAL, " lead", "trail ", "a  b   c", "\n\n x", "\n", "word\nword", "y" * 5000, "é" * 60, "　x", "👍🏽 ok",
             "".join(chr(draw.choice([32, 97, 98, 0x2581, 10, 233, 0x4E00, 0x1F600])) for _ in range(3000))]
    texts += [prose(WORDS, i, 50) for i in range(20)]
    got = pieces.encode_decode(documents(spark, texts), piece_model_path(), keep_ids=True, keep_text=True).collect()
    for r in got:
        text = texts[r["doc_id"]] or ""
        ids = model.library.encode(text, add_eos=True)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded"] == model.library.decode(ids)
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


# Web archives


def test_canonical_urls(spark):
    pairs = {
        "http://WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1#top": "example.com/a/b?a=1&b=2",
        "https://example.com": "example.com", "https://example.com/": "example.com", "example.com/X": "example.com/X",
    }
    df = spark.createDataFrame([(u,) for u in pairs], "url string")
    assert {r[0]: r[1] for r in df.select("url", warc.canonical_url(df["url"])).collect()} == pairs


def test_revisits(spark):
    def record(kind, name, url, date, status, fields, body=""):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\n\r\n"
        return (head + f"HTTP/1.1 {status}\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n" + body,)

    u, full = "http://a.com/x", [("ETag", '"1"'), ("Content-Length", "3"), ("Age", "1")]
    rows = [
        record("response", "r1", u, "2024-01-01T00:00:00Z", "200 OK", full, "abc"),
        record("response", "r2", u, "2024-01-03T00:00:00Z", "404 Not Found", full, "no"),
        record("revisit", "v0", u, "2024-01-01T00:00:00Z", "304 Not Modified", []),
        record("revisit", "v1", "https://www.a.com/x/", "2024-01-05T00:00:00Z", "304 Not Modified", [("ETag", 'W/"1"'), ("Age", "9"), ("Content-Length", "0")]),
        record("revisit", "v2", u, "2024-01-06T00:00:00Z", "304 Not Modified", [("ETag", '"2"')]),
        record("revisit", "v3", u, "bad date", "304 Not Modified", []),
        record("response", "r3", u, "2024-01-07T00:00:00Z", "200 OK", full, "xyz"),
        ("no record at all",), (None,),
    ]
    df = spark.createDataFrame(rows, "record string")
    for ranges in (1, 2, 256):
        got = {r["record_id"]: r for r in warc.resolve(warc.parse(df), ranges).collect()}
        assert {k: r["outcome"] for k, r in got.items()} == {
            "v0": "no response", "v1": "resolved", "v2": "validators differ", "v3": "no response"
        }
        assert got["v1"]["refers_to"] == "r1" and got["v1"]["payload_bytes"] == 3
        assert [tuple(h) for h in got["v1"]["fields"]] == [("age", "9"), ("content-length", "3"), ("etag", 'W/"1"')]
    assert warc.resolve(warc.parse(df.where("false"))).collect() == []


def test_revisits_of_dates_with_fractions(spark):
    def record(kind, name, date, status):
        return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\nWARC-Target-URI: http://a.com/\r\n"
                f"WARC-Date: {date}\r\n\r\nHTTP/1.1 {status}\r\nETag: \"1\"\r\n\r\nx",)

    df = spark.createDataFrame([
        record("response", "r1", "2024-01-01T00:00:00.25Z", "200 OK"), record("response", "r2", "2024-01-01T00:00:00.123456789Z", "200 OK"),
        record("revisit", "v1", "2024-01-01T00:00:00.2Z", "304 Not Modified"), record("revisit", "v2", "2024-01-01T00:00:01Z", "304 Not Modified"),
    ], "record string")
    got = {r["record_id"]: r["refers_to"] for r in warc.resolve(warc.parse(df)).collect()}
    assert got == {"v1": "r2", "v2": "r1"}


def test_records_end_at_their_length(spark):
    def record(length, block, tail=""):
        given = "" if length is None else f"Content-Length: {length}\r\n"
        return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: r\r\n{given}\r\n{block}{tail}",)

    answer = "HTTP/1.1 200 OK\r\nETag: 1\r\n\r\n"
    body = "é\r\n\r\nx"  # seven bytes
    size = len((answer + body).encode())
    rows = [record(size, answer + body, "\r\n\r\n"), record(None, answer + body), record("odd", answer + body), record(-1, answer + body),
            record(10**12, answer + body), record(size - 1, answer + body), record(0, answer + body), record(3, answer + body)]
    got = [r["payload_bytes"] for r in warc.parse(spark.createDataFrame(rows, "record string")).collect()]
    assert got == [7, 7, 7, 7, 7, 6, 0, 0]
    plain = spark.createDataFrame([("WARC/1.1\r\nWARC-Type: response",), ("",)], "record string")
    assert [(r["type"], r["payload_bytes"], r["status"]) for r in warc.parse(plain).collect()] == [("response", 0, None), (None, 0, None)]


def test_time_ranges(spark):
    from pyspark.sql import functions as F

    for edges in ([], [5], [1, 2, 3], list(range(0, 300, 3))):
        df = spark.range(-2, 310).select("id", F.timestamp_micros("id").alias("date"))
        for r in df.select("id", warc.time_range(edges).alias("part")).collect():
            assert r["part"] == sum(e <= r["id"] for e in edges), (edges, r)


def test_revisits_without_a_point(spark):
    from pyspark.sql import functions as F

    full = ("r", "response", "http://a.com/", "2024-01-01T00:00:00Z", 200)
    lost = [(f"v{i}", "revisit", *point, 304) for i, point in enumerate(
        [(None, "2024-01-02T00:00:00Z"), ("http://a.com/", None), (None, None), ("http://a.com", "2024-01-02T00:00:00Z")] * 50)]
    df = spark.createDataFrame([full, *lost], "record_id string, type string, url string, date string, status int").selectExpr(
        "*", "'x' AS canonical", "array(struct('etag' AS name, '1' AS value)) AS fields", "1L AS payload_bytes", "'s' AS payload_sha256",
        "1 AS found", "1 AS part").withColumn("date", F.to_timestamp("date"))
    got = warc.resolve(df).collect()
    assert len(got) == 200
    assert sum(r["outcome"] == "resolved" and r["refers_to"] == "r" for r in got) == 50
    assert sum(r["outcome"] == "no response" for r in got) == 150


# Conversations


def test_placeholders_are_numbered_in_order_of_many_parts(spark):
    kinds = ["text", "image", "audio", "other", None]
    parts = [(kinds[i * 7 % 5], f"t{i}", f"r{i}", None, None, None, None) for i in range(20_000)]
    df = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts array<{chat.PART.simpleString()}>")
    got = chat.visit(df).select("content", "attachments").first()
    want, number = [], 0
    for kind, text, *_ in parts:
        if kind in ("text", None):
            want.append(text)
        else:
            number += 1
            want.append(f"<{'file' if kind == 'other' else kind} {number}>")
    assert got["content"] == "".join(want)
    assert [a["number"] for a in got["attachments"]] == list(range(1, number + 1))


def test_chat_parts_and_round_trip(spark):
    rows = [
        (1, 0, "user", [("text", "see \\l <turn> ", None, None, None, None, None), ("image", None, "i.png", 56, 57, None, None),
                        ("document", None, "d.pdf", None, None, None, 2), ("text", "?", None, None, None, None, None)]),
        (1, 1, "assistant", [("audio", None, "a.wav", None, None, 1.5, None), ("text", "ok</turn>\n", None, None, None, None, None)]),
        (1, 2, None, None), (2, None, "a\nb", []), (2, 1, "assistant", [("odd", None, "z", None, None, None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART.simpleString()}>")
    got = {r["conv_id"]: r for r in chat.format_turns(df.withColumn("text", df["role"])).collect()}
    first = got[1]["formatted"]
    assert first.startswith("<turn>user\nsee \\bl \\lturn> <image 1><document 2>?</turn>\n<turn>assistant\n<audio 1>ok\\l/turn>\n</turn>\n")
    spans = [first[s["start"] - 1 : s["start"] - 1 + s["length"]] for s in got[1]["loss_spans"]]
    assert spans == ["<audio 1>ok\\l/turn>\n"]
    assert got[1]["placeholder_tokens"] == 2 * 3 + 2 * 1024 + 38
    assert [(t["position"], [tuple(a) for a in t["attachments"]]) for t in got[1]["attachments"]] == [
        (1, [(1, "image", "i.png", 6), (2, "document", "d.pdf", 2048)]), (2, [(1, "audio", "a.wav", 38)])
    ]
    assert got[2]["formatted"] == "<turn>a\\nb\n</turn>\n<turn>assistant\n<file 1></turn>\n"
    assert chat.digest(chat.format_turns(df.where("false"))).collect() == []


# Benchmarks


def test_decontamination_by_brute_force(spark):
    items = [prose(WORDS, 500 + i, n) for i, n in enumerate([5, 6, 9, 14, 40, 59, 59])] + [None, "", "too few words", prose(WORDS, 505, 59)]
    texts = [*SPECIAL]
    draw = random.Random(6)
    for i in range(60):
        words = prose(WORDS, i, 300).split()
        item = (items[i % 7]).split()
        for _ in range(i % 4):
            item[draw.randrange(len(item))] = "changed"
        texts.append(" ".join(words[:150] + item + words[150:]).upper().replace(" ", ", ", i))
    texts.append(texts[-1])
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)], "item_id long, text string, doc_id long")
    want = set()
    sets = [set(decontaminate.shingle_texts(t or "")) for t in texts]
    for j, item in enumerate(items):
        own = set(decontaminate.shingle_texts(item or ""))
        for i, s in enumerate(sets):
            if own and len(own & s) >= 0.8 * len(own):
                want.add((i, j, len(own), len(own & s)))
    for block in (10_000, 60):
        got = decontaminate.find(documents(spark, texts), bench, block=block).collect()
        assert {tuple(r)[:4] for r in got} == want and len(got) == len(want)
    clean = {r["doc_id"] for r in decontaminate.without(documents(spark, texts), bench, block=60).collect()}
    assert clean == set(range(len(texts))) - {w[0] for w in want}
    assert decontaminate.find(documents(spark, []), bench).collect() == []
    assert decontaminate.find(documents(spark, texts), bench.where("false")).collect() == []


def test_blocks_of_items_in_any_script(spark):
    texts = [" ".join(f"слово{chr(0x430 + i)}" for i in range(20)) for _ in range(60)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    blocks = list(decontaminate.item_blocks(items, "item_id", "text", 100))
    assert len(blocks) == 12 and sorted(i for b, _ in blocks for i, _ in b) == list(range(60))
    assert not any(only for _, only in blocks)


def test_words_of_has_only_the_contract_spaces():
    assert words_of("A b C\x0bd") == ["a b", "c", "d"]
