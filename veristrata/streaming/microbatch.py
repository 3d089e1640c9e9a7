"""A suite run on each micro-batch of a stream, results stored per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veristrata.functions.columns import normalize_missing
from veristrata.operators.frequencies import value_counts
from veristrata.operators.validate import validate
from veristrata.plans.suite import UNIQUE, Suite


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, file_format: str = "parquet",
    files_per_batch: int = 1, name_pattern: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream; the number of files bounds a batch."""
    reader = spark.readStream.schema(schema).format(file_format)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(folder)


def validate_stream(
    stream: DataFrame, suite: Suite, results: str, checkpoint: str, available_now: bool = True, keys: str | None = None
) -> StreamingQuery:
    """Run the suite on every micro-batch and store its results.

    A batch overwrites its own folder, so a batch that is repeated after a failure is not counted
    twice. All row-wise counts add up over the batches. Uniqueness is judged within a batch; with a folder for ``keys``
    each batch also stores how often each value of the unique columns occurs, and ``stream_totals`` judges it over all
    batches.
    """
    unique = _unique_columns(suite)

    def run(batch: DataFrame, batch_id: int) -> None:
        if keys and unique:
            there = [c for c in unique if c in batch.columns]
            counts = value_counts(normalize_missing(batch), there, identities=True)
            counts.write.mode("overwrite").parquet(f"{keys}/batch_id={batch_id}")
        validate(batch, suite).write.mode("overwrite").parquet(f"{results}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _unique_columns(suite: Suite) -> list[str]:
    return list(dict.fromkeys(r.column for r in suite.rules if r.kind == UNIQUE))


def stream_totals(spark: SparkSession, results: str, keys: str | None = None) -> DataFrame:
    """Counts of all batches added up per rule; with ``keys`` a value that is repeated in another batch counts as
    repeated, too."""
    totals = (
        spark.read.parquet(results)
        .groupBy("suite", "idx", "expectation_type", "column")
        .agg(
            F.count(F.lit(1)).alias("batches"),
            F.sum("element_count").alias("element_count"),
            F.sum("null_count").alias("null_count"),
            F.sum("unexpected_count").alias("unexpected_count"),
            F.bool_and("success").alias("success"),
        )
    )
    if keys is None:
        return totals
    counts = spark.read.parquet(keys).groupBy("column", "value").agg(F.sum("occurrences").alias("n"))
    repeated = counts.groupBy("column").agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated"))
    # A row for each column with a uniqueness rule.
    joined = totals.join(F.broadcast(repeated), "column", "left")
    unique = F.col("expectation_type") == UNIQUE
    found = F.when(unique, F.coalesce("repeated", F.lit(0))).otherwise(F.col("unexpected_count"))
    passed = F.when(unique, (found == 0) & (F.col("null_count") <= 1)).otherwise(F.col("success"))
    return joined.withColumns({"unexpected_count": found, "success": passed}).select(totals.columns)
