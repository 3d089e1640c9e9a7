"""Shared by the query areas: inputs, rounding for comparison, and SQL text of the inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.sources.entities import SQL, base, entities, entity

__all__ = ["AS_OF", "base", "entities", "entity", "rounded", "with_entities"]

# The present moment of all queries, so that their results can be repeated.
AS_OF = "2025-01-01 00:00:00"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because sums of doubles depend on their order."""
    return df.select(
        *(
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def with_entities(*names: str) -> str:
    """``WITH`` clause that defines the entity views."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"
