"""Suites bound to tables, run and stored under a run name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.operators.validate import statistics, validate
from veristrata.plans import catalog
from veristrata.plans.suite import Suite
from veristrata.plans.together import together


@dataclass(frozen=True)
class Checkpoint:
    """A suite under the name of a recurring check."""

    name: str
    suite: Suite


def standard_checkpoints() -> dict[str, Checkpoint]:
    """The three standard bindings."""
    bindings = {
        "patient_checkpoint": catalog.patients(),
        "treatment_checkpoint": catalog.treatments(),
        "lab_results_checkpoint": catalog.lab_results(),
    }
    return {name: Checkpoint(name, suite) for name, suite in bindings.items()}


def run_checkpoint(
    checkpoint: Checkpoint, df: DataFrame, run_name: str, run_time: str, store: str | None = None
) -> DataFrame:
    """Results of one run; with ``store`` they are written there and read back.

    A run owns its folder in the store, so that a repeated run replaces itself.
    """
    results = validate(df, checkpoint.suite).withColumn(
        "run_time", F.lit(run_time).cast("timestamp_ntz")
    )
    if store is None:
        return results.select(
            F.lit(checkpoint.name).alias("checkpoint"), F.lit(run_name).alias("run_name"), "*"
        )
    folder = f"{store}/checkpoint={checkpoint.name}/run_name={run_name}"
    results.write.mode("overwrite").parquet(folder)
    stored = df.sparkSession.read.option("basePath", store).parquet(folder)
    return stored.select("checkpoint", "run_name", *results.columns)


def run_all(
    checkpoints: Mapping[str, Checkpoint],
    tables: Mapping[str, DataFrame],
    run_name: str,
    run_time: str,
    store: str | None = None,
) -> DataFrame:
    """Every checkpoint that has a table; without any there are no rows."""
    runs = together([
        partial(run_checkpoint, c, tables[name], run_name, run_time, store)
        for name, c in checkpoints.items() if name in tables
    ])
    if not runs:
        none = Checkpoint("", Suite(""))
        return run_checkpoint(none, SparkSession.active().range(0), run_name, run_time)
    return reduce(DataFrame.unionByName, runs)


def outcomes(results: DataFrame) -> DataFrame:
    """One row per checkpoint run: statistics and success."""
    return statistics(results, by=("checkpoint", "run_name", "suite"))
