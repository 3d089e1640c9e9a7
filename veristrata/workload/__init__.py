"""The registered queries by area, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for area in _areas():
        found |= area.QUERIES
    return found


def all_oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for area in _areas():
        found |= area.ORACLES
    return found


def _areas():
    from veristrata.workload import (
        anomalies,
        drifts,
        pipelines,
        profiles,
        records,
        scores,
        storage,
        validation,
    )

    return (validation, records, profiles, anomalies, drifts, scores, pipelines, storage)
