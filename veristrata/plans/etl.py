"""Table pipelines as a list of named steps, run one after another, with a record of each run."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Step:
    """A name, what it does with the table of the step before, and what must hold of its result.

    ``gate`` gives the reasons against the result; none means that the run goes on.
    """

    name: str
    work: Callable[[DataFrame | None], DataFrame]
    gate: Callable[[DataFrame], Sequence[str]] = lambda df: ()


class StepFailed(RuntimeError):
    """A step raised or its gate was closed; knows the record of its run."""

    def __init__(self, record: RunRecord):
        super().__init__(f"{record.pipeline} stopped at {record.step}: {'; '.join(record.errors)}")
        self.record = record


@dataclass(frozen=True)
class RunRecord:
    """What one run came to. ``extracted_rows`` is known only if it was asked for."""

    pipeline: str
    status: str = "running"
    step: str = "start"
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    duration_seconds: float | None = None
    extracted_rows: int | None = None
    records_processed: int = 0
    records_failed: int = 0
    errors: tuple[str, ...] = ()

    @property
    def success_rate(self) -> float:
        total = self.records_processed + self.records_failed
        return self.records_processed / total if total else 0.0

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The record as one row, without the clock readings."""
        return spark.createDataFrame(
            [(self.pipeline, self.status, self.step, self.extracted_rows, self.records_processed,
              self.records_failed, self.success_rate, "; ".join(self.errors))],
            "pipeline string, status string, step string, extracted_rows bigint, "
            "records_processed bigint, records_failed bigint, success_rate double, errors string",
        )


def has_columns(required: Iterable[str]) -> Callable[[DataFrame], list[str]]:
    """A gate: one reason for each column that is not there."""
    names = sorted(set(required))
    return lambda df: [f"no column {n}" for n in names if n not in df.columns]


class Pipeline:
    """Steps from a source to a sink. Steps describe work; the one action is the write at the end.

    The source is read as the steps leave it: nothing stands between it and their filters, so that these
    reach the scan. Rows written are counted by the write itself. With ``count_source`` the source's rows are
    counted by a query of their own, which reads no columns.
    """

    def __init__(self, name: str, steps: Sequence[Step], write: Callable[[DataFrame], None],
                 count_source: bool = False) -> None:
        self.name, self.steps, self.write, self.count_source = name, list(steps), write, count_source

    def plan(self) -> DataFrame:
        """The table that the write would get; no gate is asked."""
        df = None
        for step in self.steps:
            df = step.work(df)
        return df

    def run(self, listener: Callable[[RunRecord], None] | None = None, strict: bool = False) -> RunRecord:
        """Runs all steps and the write. ``listener`` gets the record before each step and at the end; with
        ``strict`` a failed run raises ``StepFailed`` instead of returning its record."""
        clock, record, df = time.monotonic(), RunRecord(self.name), None
        tell = listener or (lambda record: None)
        written = Observation("written")

        def put(df: DataFrame) -> DataFrame:
            self.write(df.observe(written, F.count(F.lit(1)).alias("rows")))
            return df

        for number, step in enumerate([*self.steps, Step("write", put)]):
            record = replace(record, step=step.name)
            tell(record)
            try:
                df = step.work(df)
                reasons = tuple(step.gate(df))
                if number == 0 and self.count_source and not reasons:
                    record = replace(record, extracted_rows=df.count())
            except Exception as error:  # noqa: BLE001  kept in the record, raised on request
                reasons = (f"{type(error).__name__}: {error}",)
            if reasons:
                record = replace(record, status="failed", errors=reasons)
                break
        else:
            # The write has ended, so the count is there; get waits for its delivery however long it takes.
            record = replace(record, status="completed", records_processed=written.get["rows"])
        record = replace(record, duration_seconds=time.monotonic() - clock)
        tell(record)
        if strict and record.errors:
            raise StepFailed(record)
        return record


def add_metadata_columns(df: DataFrame, pipeline: str, as_of: str) -> DataFrame:
    """Name of the pipeline and moment of processing on every row."""
    return df.withColumns(
        {
            "_pipeline_name": F.lit(pipeline),
            "_processed_at": F.lit(as_of).cast("timestamp_ntz"),
        }
    )
