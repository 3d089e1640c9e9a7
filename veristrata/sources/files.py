"""File sources and sinks, and discovery of assets in a folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veristrata.functions.columns import field, is_string

# Quotes inside cells are doubled, cells may hold line breaks, and white space is kept; an empty cell is
# missing, quoted or not.
CSV_OPTIONS = {
    "header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "quote": '"', "escape": '"',
    "multiLine": "true", "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "", "maxCharsPerColumn": "-1",
}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, one_line: bool = False) -> DataFrame:
    """CSV with a header. With a schema codes such as ``02101`` keep their zeros; without one the
    types are inferred by an extra pass over the files.

    As a cell may hold line breaks, a file is read by one task. Files that ``write_csv`` has written with ``one_line`` have
    a row on every line, so large ones are split and read by many."""
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(not one_line).lower())
    df = reader.option("inferSchema", "true").csv(path) if schema is None else reader.schema(schema).csv(path)
    return _each_text(df, _broken) if one_line else df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", one_line: bool = False) -> None:
    """CSV with a header. With ``one_line`` line breaks in texts are written as \\n and \\r, and backslashes doubled."""
    (_each_text(df, _unbroken) if one_line else df).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def _each_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(*(
        change(field(f.name)).alias(f.name) if is_string(f.dataType) else field(f.name) for f in df.schema.fields
    ))


def _unbroken(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _broken(text: Column) -> Column:
    """Undoes ``_unbroken``: between doubled backslashes a single one begins a line break."""
    parts = F.split(text, r"\\\\")
    lines = lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.when(text.contains("\\"), F.array_join(F.transform(parts, lines), "\\")).otherwise(text)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def export(
    tables: Mapping[str, DataFrame],
    folder: str,
    file_format: str = "csv",
    summary: DataFrame | None = None,
) -> dict[str, str]:
    """Each table to ``folder/<name>``, and a one-row summary as JSON; returns the paths."""
    writers = {"csv": write_csv, "parquet": write_parquet}
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        writers[file_format](df, paths[name])
    if summary is not None:
        paths["summary"] = f"{folder.rstrip('/')}/summary"
        summary.write.json(paths["summary"])
    return paths


def assets(spark: SparkSession, folder: str, pattern: str = r"(.*)\.csv") -> DataFrame:
    """``(asset, path, bytes)`` of the files in a folder whose name matches the pattern."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    return (
        listing.select("path", "length")
        .withColumn("asset", F.regexp_extract(name, f"^{pattern}$", 1))
        .filter("asset <> ''")
        .select("asset", "path", F.col("length").alias("bytes"))
    )


def read_assets(spark: SparkSession, folder: str, schema: StructType | str, extension: str = "csv") -> DataFrame:
    """All files of a folder in one scan, each row with the name of its asset."""
    reader = spark.read.options(**CSV_OPTIONS).option("pathGlobFilter", f"*.{extension}")
    df = reader.schema(schema).format(extension).load(folder)
    asset = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*)\.{extension}$", 1)
    return df.withColumn("asset", asset)

