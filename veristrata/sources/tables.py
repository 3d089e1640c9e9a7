"""Queries and statements on catalog tables and, over JDBC, on external databases."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veristrata.functions.columns import field


def query(spark: SparkSession, text: str, params: Mapping[str, Any] | None = None,
          **tables: DataFrame) -> DataFrame:
    """A query with named markers (``:name``) bound as typed values; ``{name}`` stands for a
    DataFrame given by keyword."""
    return spark.sql(text, args=dict(params) if params else None, **tables)


def query_external(
    spark: SparkSession,
    url: str,
    text: str | None = None,
    table: str | None = None,
    partition: tuple[str, Any, Any, int] | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A query or table of an external database. ``partition`` = (column, low, high, parts) reads
    in parallel slices; without it one connection reads everything."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    if partition:
        column, low, high, parts = partition
        source = table or f"({text}) AS source"
        reader = (
            reader.option("dbtable", source).option("partitionColumn", column)
            .option("lowerBound", str(low)).option("upperBound", str(high))
            .option("numPartitions", str(parts))
        )
    else:
        reader = reader.option("query", text) if text else reader.option("dbtable", table)
    return reader.options(**options).load()


def write_external(df: DataFrame, url: str, table: str, batch_size: int = 1_000,
                   mode: str = "append", **options: str) -> None:
    """Append to an external table in batches, one connection per partition."""
    (
        df.write.format("jdbc").option("url", url).option("dbtable", table)
        .option("batchsize", batch_size).options(**options).mode(mode).save()
    )


def qualified(table: str, schema: str | None = None) -> str:
    return f"{schema}.{table}" if schema else table


def table_exists(spark: SparkSession, table: str, schema: str | None = None) -> bool:
    return spark.catalog.tableExists(qualified(table, schema))


def table_schema(df: DataFrame) -> DataFrame:
    """``(position, column, type, nullable, default)`` of a table, the default as SQL text; metadata only."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable, (f.metadata or {}).get("CURRENT_DEFAULT"))
         for i, f in enumerate(df.schema.fields)],
        "position int, `column` string, type string, nullable boolean, default string",
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def append(df: DataFrame, table: str, schema: str | None = None, file_format: str = "parquet") -> int:
    """Append to a table (created if needed); returns the number of rows, counted while writing."""
    seen = Observation("append")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").format(file_format).saveAsTable(qualified(table, schema))
    return seen.get["rows"]


def truncate(spark: SparkSession, table: str, schema: str | None = None) -> None:
    spark.sql(f"TRUNCATE TABLE {qualified(table, schema)}")


def updated(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """What ``UPDATE .. SET .. WHERE`` leaves: matching rows with new values, others as they are."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *(
            F.when(hit, values[f.name].cast(f.dataType)).otherwise(field(f.name)).alias(f.name)
            if f.name in values else field(f.name)
            for f in df.schema.fields
        )
    )


def deleted(df: DataFrame, condition: Column) -> DataFrame:
    """What ``DELETE .. WHERE`` leaves; rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def affected(df: DataFrame, condition: Column) -> DataFrame:
    """Number of rows a statement touches."""
    return df.agg(F.count(F.when(condition, F.lit(1))).alias("affected_rows"))


def rewrite(spark: SparkSession, table: str, change, condition: Column, schema: str | None = None) -> int:
    """Replace the content of a file table by what ``change`` makes of it; returns the rows that met ``condition``.

    The table is read once: the new content is written to a folder of its own while the rows are counted, and one change of
    the table's location puts it in place. Until then, and if the write fails, the table is what it was; readers that
    have begun go on with the old files, which stay where they are.
    """
    name = qualified(table, schema)
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        raise ValueError(f"{name} is partitioned: its partitions have locations of their own")
    seen = Observation("rewrite")
    rows = spark.table(name).observe(seen, F.count(F.when(condition, F.lit(1))).alias("touched"))
    version = re.sub("--[0-9a-f]{12}$", "", about["Location"].rstrip("/")) + f"--{uuid.uuid4().hex[:12]}"
    change(rows).write.format(about["Provider"]).save(version)
    touched = seen.get["touched"]
    if touched:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    return touched


def update(spark: SparkSession, table: str, condition: Column, values: Mapping[str, Column],
           schema: str | None = None) -> int:
    """UPDATE on a file-backed table; returns the number of affected rows."""
    return rewrite(spark, table, lambda df: updated(df, condition, values), condition, schema)


def delete(spark: SparkSession, table: str, condition: Column, schema: str | None = None) -> int:
    """DELETE on a file-backed table; returns the number of affected rows."""
    return rewrite(spark, table, lambda df: deleted(df, condition), condition, schema)
