"""From raw documents to token counts, in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.llm import decontaminate, language, pieces, simhash, suffix
from veristrata.llm.common import free_names, held_out, table
from veristrata.llm.queries import piece_model_path
from veristrata.session import shared_dir

LEAST_SHARE = 0.5  # of the letters that the main language of a kept document has


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of which one language has at least half of the letters; those without letters go."""
    model = language.train(language.training_rows(docs, held_out("doc_id", 3, 1)))
    lang, score = free_names(docs, "lang_pred", "score")
    labelled = language.identify(docs, model, keep=tuple(docs.columns), lang_name=lang, score_name=score)
    kept = labelled.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SHARE))
    return kept.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group whose fingerprints of three-word shingles link at
    two or fewer differing bits."""
    return simhash.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 200 bytes or more that repeat; documents of which nothing is left go."""
    rest = suffix.remove(docs)
    return rest.where(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != "").withColumn(
        "n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)
    ).select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return pieces.encode_decode(docs, piece_model_path())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_free", benchmark_free),
    ("tokenised", tokenised),
]

# No SQL: letter models, fingerprints by XXH64, byte strings and merges are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{name}")
    return docs
