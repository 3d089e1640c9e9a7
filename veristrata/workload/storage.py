"""Queries on sources, sinks, statements and table metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.operators.profile import null_profile, preview
from veristrata.operators.validate import validate_table
from veristrata.plans.suite import Suite
from veristrata.session import scratch_database, scratch_path
from veristrata.sources import files, tables
from veristrata.sources.chunks import with_chunks
from veristrata.workload.common import base, entities, rounded, with_entities
from veristrata.workload.validation import COLUMNS, suite_sql


def _through_csv(table: str):
    """The whole table written as CSV and read back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = base(spark, folder, table)
        path = scratch_path(spark, f"{table}-csv")
        files.write_csv(df, path)
        return files.read_csv(spark, path, df.schema)

    return run


def scan_csv_one_line(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, line breaks and all, in CSV files that can be split."""
    df = base(spark, folder, "documents")
    path = scratch_path(spark, "documents-csv")
    files.write_csv(df, path, one_line=True)
    return files.read_csv(spark, path, df.schema, one_line=True)


def chunked_query(spark: SparkSession, folder: str) -> DataFrame:
    """A query's result in chunks: their number, and the rows of the largest and of all."""
    text = "SELECT l_orderkey, l_linenumber, l_tax FROM {lineitem} WHERE l_quantity > :least"
    found = tables.query(spark, text, {"least": 10.0}, lineitem=base(spark, folder, "lineitem"))
    sizes = with_chunks(found, CHUNK_ROWS).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
    return sizes.agg(
        F.count(F.lit(1)).alias("chunks"), F.max("rows").alias("largest"), F.sum("rows").alias("rows"),
        F.max("chunk").alias("last_chunk"),
    )


CHUNK_ROWS = 10_000
ENTITY_NAMES = ("patients", "treatments", "lab_results")


def sink_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """Every entity exported; what can be read back, counted."""
    given = entities(spark, folder)
    paths = files.export({n: given[n] for n in ENTITY_NAMES}, scratch_path(spark, "export"), "parquet")
    parts = [
        spark.read.parquet(paths[n]).agg(
            F.lit(n).alias("entity"), F.count(F.lit(1)).alias("rows"),
            F.countDistinct(key).alias("keys"),
        )
        for n, key in zip(ENTITY_NAMES, ("patient_id", "treatment_id", "result_id"), strict=True)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def summary_json(spark: SparkSession, folder: str) -> DataFrame:
    """An export with its summary, and the summary read back from JSON."""
    orders = base(spark, folder, "orders")
    summary = rounded(orders.agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("o_custkey").alias("customers"),
        F.avg("o_totalprice").alias("avg_price"),
    ), 4)
    paths = files.export({"orders": orders}, scratch_path(spark, "export"), "parquet", summary)
    return spark.read.schema(summary.schema).json(paths["summary"])


def file_assets(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the folder as assets, with the rows in them."""
    found = files.assets(spark, folder, r"(.*)\.parquet")
    names = [r[0] for r in found.select("asset").distinct().orderBy("asset").collect()]  # one per table
    rows = [
        base(spark, folder, n).agg(F.lit(n).alias("asset"), F.count(F.lit(1)).alias("rows")) for n in names
    ]
    counted = reduce(DataFrame.unionByName, rows)
    return found.groupBy("asset").agg(F.count(F.lit(1)).alias("files")).join(counted, "asset")


def sql_query(spark: SparkSession, folder: str) -> DataFrame:
    text = """SELECT o_orderstatus, count(*) AS orders, round(avg(o_totalprice), 4) AS avg_price
              FROM {orders} GROUP BY o_orderstatus"""
    return tables.query(spark, text, orders=base(spark, folder, "orders"))


def sql_param_query(spark: SparkSession, folder: str) -> DataFrame:
    text = """SELECT o_orderkey, o_orderstatus, o_totalprice FROM {orders}
              WHERE o_orderstatus = :status AND o_totalprice > :least"""
    params = {"status": "P", "least": 450000.0}
    return tables.query(spark, text, params, orders=base(spark, folder, "orders"))


def _stored_orders(spark: SparkSession, folder: str) -> tuple[str, str]:
    database = scratch_database(spark, "vs")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    base(spark, folder, "orders").select(*columns).write.saveAsTable(f"{database}.orders")
    return database, f"{database}.orders"


def _dear() -> Column:
    return F.col("o_totalprice") > 300000.0


def dml_update_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    database, name = _stored_orders(spark, folder)
    count = tables.update(spark, "orders", _dear(), {"o_orderstatus": F.lit("X")}, database)
    return _content(spark.table(name), count)


def dml_delete_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    database, name = _stored_orders(spark, folder)
    return _content(spark.table(name), tables.delete(spark, "orders", _dear(), database), name)


def _content(df: DataFrame, affected: int, name: str | None = None) -> DataFrame:
    df = df.sparkSession.table(name) if name else df
    return rounded(
        df.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("rows"), F.avg("o_totalprice").alias("avg_price")
        ).withColumn("affected_rows", F.lit(affected).cast("bigint")),
        4,
    )


def batch_append(spark: SparkSession, folder: str) -> DataFrame:
    database = scratch_database(spark, "vs")
    events = base(spark, folder, "events")
    written = 0
    for half in (events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")):
        written += tables.append(half, "events", database)
    stored = spark.table(f"{database}.events")
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "rows_written", F.lit(written).cast("bigint")
    )


def truncate_then_append(spark: SparkSession, folder: str) -> DataFrame:
    database, name = _stored_orders(spark, folder)
    tables.truncate(spark, "orders", database)
    emptied = spark.table(name).count()
    orders = base(spark, folder, "orders")
    tables.append(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), "orders", database)
    return tables.row_count(spark.table(name)).withColumn(
        "rows_after_truncate", F.lit(emptied).cast("bigint")
    )


def table_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Columns with their types, and how often each is missing."""
    orders = base(spark, folder, "orders")
    missing = null_profile(orders).select("column", "null_count")
    return tables.table_schema(orders).join(F.broadcast(missing), "column")


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return tables.row_count(base(spark, folder, "lineitem"))


TABLE_SUITE = (
    Suite("orders").not_null("o_orderkey").unique("o_orderkey").between("o_totalprice", 0, 400000)
    .in_set("o_orderstatus", ["F", "O"]).row_count(1)
)


def validate_sql_table(spark: SparkSession, folder: str) -> DataFrame:
    database, _ = _stored_orders(spark, folder)
    whole = validate_table(spark, "orders", TABLE_SUITE, schema=database)
    first = validate_table(spark, "orders", TABLE_SUITE, database, 1000, ["o_orderkey"])
    scopes = [whole.withColumn("scope", F.lit("all")), first.withColumn("scope", F.lit("first"))]
    return scopes[0].unionByName(scopes[1]).select("scope", *COLUMNS)


def preview_head(spark: SparkSession, folder: str) -> DataFrame:
    return preview(base(spark, folder, "customer"), ["c_custkey"], 10)


QUERIES = {
    "scan_csv": _through_csv("customer"),
    "scan_csv_documents": _through_csv("documents"),
    "scan_csv_conversations": _through_csv("conversations"),
    "scan_csv_one_line": scan_csv_one_line,
    "chunked_query": chunked_query,
    "summary_json": summary_json,
    "sink_parquet": sink_parquet,
    "file_assets": file_assets,
    "sql_query": sql_query,
    "sql_param_query": sql_param_query,
    "dml_update_rewrite": dml_update_rewrite,
    "dml_delete_rewrite": dml_delete_rewrite,
    "batch_append": batch_append,
    "truncate_then_append": truncate_then_append,
    "table_schema": table_schema,
    "row_count": row_count,
    "validate_sql_table": validate_sql_table,
    "preview_head": preview_head,
}


# ---- the same in SQL -----------------------------------------------------------------------

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
_ORDER_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
_DEAR_COUNT = "(SELECT count(*) FROM orders WHERE o_totalprice > 300000)"
ORACLES = {
    "scan_csv": "SELECT * FROM customer",
    "scan_csv_documents": "SELECT * FROM documents",
    "scan_csv_conversations": "SELECT * FROM conversations",
    "scan_csv_one_line": "SELECT * FROM documents",
    "chunked_query": f"""
SELECT cast(ceil(count(*) / {CHUNK_ROWS}e0) AS bigint) AS chunks, least(count(*), {CHUNK_ROWS}) AS largest, count(*) AS rows,
 cast(ceil(count(*) / {CHUNK_ROWS}e0) AS bigint) - 1 AS last_chunk FROM lineitem WHERE l_quantity > 10""",
    "summary_json": """SELECT count(*) AS orders, count(DISTINCT o_custkey) AS customers,
 round(avg(o_totalprice), 4) AS avg_price FROM orders""",
    "sink_parquet": with_entities(*ENTITY_NAMES) + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS entity, count(*) AS rows, count(DISTINCT {k}) AS keys FROM {n}"
        for n, k in zip(ENTITY_NAMES, ("patient_id", "treatment_id", "result_id"), strict=True)),
    "file_assets": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS asset, cast(1 AS bigint) AS files, count(*) AS rows FROM {t}" for t in _TABLES),
    "sql_query": """SELECT o_orderstatus, count(*) AS orders, round(avg(o_totalprice), 4)
 AS avg_price FROM orders GROUP BY o_orderstatus""",
    "sql_param_query": """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
 WHERE o_orderstatus = 'P' AND o_totalprice > 450000""",
    "dml_update_rewrite": f"""
SELECT CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
 count(*) AS rows, round(avg(o_totalprice), 4) AS avg_price, {_DEAR_COUNT} AS affected_rows
FROM orders GROUP BY 1""",
    "dml_delete_rewrite": f"""
SELECT o_orderstatus, count(*) AS rows, round(avg(o_totalprice), 4) AS avg_price,
 {_DEAR_COUNT} AS affected_rows FROM orders WHERE NOT o_totalprice > 300000 GROUP BY 1""",
    "batch_append": """SELECT event_type, count(*) AS rows, (SELECT count(*) FROM events)
 AS rows_written FROM events GROUP BY event_type""",
    "truncate_then_append": """SELECT count(*) AS row_count, cast(0 AS bigint)
 AS rows_after_truncate FROM orders""",
    "table_schema": "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, true AS nullable, "
        f"cast(NULL AS varchar) AS \"default\", count(*) - count({c}) AS null_count FROM orders" for i, (c, t) in enumerate(_ORDER_TYPES.items())),
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "validate_sql_table": "WITH head AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000)\n"
    + f"SELECT 'all' AS scope, * FROM ({suite_sql('orders', TABLE_SUITE, list(_ORDER_TYPES))})\n"
    + "UNION ALL\n"
    + f"SELECT 'first' AS scope, * FROM ({suite_sql('head', TABLE_SUITE, list(_ORDER_TYPES))})",
    "preview_head": "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
}
