"""Independent pieces of a plan that run queries of their own, side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def together(pieces: Sequence[Callable[[], Result]], at_once: int = 8) -> list[Result]:
    """Results in the order of the pieces. Each piece waits for small queries of its own, during which the
    executors can work for the others. The first error is raised after all have ended."""
    if len(pieces) < 2:
        return [piece() for piece in pieces]
    target = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(min(at_once, len(pieces))) as threads:
        return [f.result() for f in [threads.submit(target(piece)) for piece in pieces]]
