"""The registered queries against their SQL, and the pipeline as a whole."""

import pytest

import corpus_pipeline
from tests.llm.test_operators import plain_removed
from tools.compare import compare, connect
from veristrata.llm import decontaminate, simhash
from veristrata.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    ok, text = compare(spark, connect(sf_dir), sf_dir, name, QUERIES[name], ORACLES[name])
    assert ok, text


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark, sf_dir, folder):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
    assert kept == sorted(kept, reverse=True) and 0 < kept[-1] < documents.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[-1]


def test_pipeline_by_its_definition(spark, sf_dir, folder):
    """On a small table with missing and repeated ids and columns named as the stages' own: what each stage keeps, by
    plain code."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang is not null").orderBy("doc_id").limit(60).collect()
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in texts]
    rows += [(None, rows[3][1], "en"), (rows[5][0], rows[5][1] + " one more", "en"), (7, "", None), (None, None, None)]
    rows += [(900, f"before {item} after", texts[0]["lang"]), (900, " 12 34 ", "en")]
    names = "doc_id long, text string, lang string, source string, n_chars long, score int, lang_pred string, i1 int, kept string, fp int, h1 string"
    docs = spark.createDataFrame(
        [(i, t, x, "s", len(t or ""), n, "own", n, "k", n, f"h{n}") for n, (i, t, x) in enumerate(rows)], names
    )
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        result = stage(spark, before, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        kept = spark.read.schema(result.schema).parquet(f"{folder}/{name}")
        assert result.columns == docs.columns
        given, left = ({r["score"]: r for r in d.collect()} for d in (before, kept))  # ``score`` numbers the rows here
        assert left.keys() <= given.keys()
        if name == "language_id":
            assert all(any(c.isalpha() for c in r["text"]) for r in left.values())
        if name == "near_duplicates":
            found = {n: simhash.fingerprint(r["text"] or "") for n, r in given.items()}
            group = {n: n for n in found}
            for a in found:
                for b in found:
                    if (found[a] ^ found[b]).bit_count() <= 2 and group[a] != group[b]:
                        group = {n: group[a] if g == group[b] else g for n, g in group.items()}
            for g in set(group.values()):
                members = [n for n in group if group[n] == g]
                stays = [n for n in members if n in left]
                least = min((given[n]["doc_id"] is None, given[n]["doc_id"] or 0) for n in members)
                assert len(stays) == 1 and (left[stays[0]]["doc_id"] is None, left[stays[0]]["doc_id"] or 0) == least
            assert all(left[n] == given[n] for n in left)
        if name == "repeated_passages":
            want = plain_removed([r["text"] for r in given.values()], 200)
            for (n, r), (size, removed, _, _) in zip(given.items(), want, strict=True):
                assert (n in left) == ((r["text"] or "").strip(" \t\n\x0b\x0c\r") != "" and removed < size)
                assert n not in left or removed or left[n]["text"] == r["text"]
        if name == "benchmark_free":
            own = set(decontaminate.shingle_texts(item))
            assert not any(len(own & set(decontaminate.shingle_texts(r["text"]))) >= 0.8 * len(own) for r in left.values())
            assert all(left[n] == given[n] for n in left)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert last.count() == kept.count()


def test_pipeline_of_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf_dir)
        assert result.count() == 0
        docs = result
