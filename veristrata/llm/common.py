"""Shared by the operators of this subpackage: tables, text columns, splits, batches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)
# The white space of the contracts: blank and the control characters from tab to carriage return.
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text column with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Rows whose crc32 of the key as text leaves ``remainder``; a NULL key counts as the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder


def words_of(text: str) -> list[str]:
    """Words of an ASCII-lower-cased text."""
    return [w for w in SPACES.split(text.translate(ASCII_LOWER)) if w]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns to add that no column of ``df`` has, told apart as Spark does, without regard to case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_marks(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns of a row; NULL differs from any value, maps count as their JSON."""
    columns = []
    for field in df.schema.fields:
        own = F.col(f"`{field.name}`")
        nil = own.isNull()
        if "map<" in field.dataType.simpleString():
            own = F.to_json(F.struct(own))
        columns += [own, nil]
    return [F.xxhash64(F.lit(start), *columns) for start in ("first", "second")]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later steps start from the files, so a
    lost executor costs no more than the step it was in."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def portions(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that have ``most`` together, or are a single one."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


BLOOM_BITS = 1 << 24


def _bloom_places(first: Column, second: Column) -> list[Column]:
    mask = F.lit(BLOOM_BITS - 1)
    return [x.bitwiseAND(mask) for x in (first, second, F.shiftright(first, 24), F.shiftright(second, 24))]


def bloom(ids: DataFrame, first: str, second: str) -> np.ndarray:
    """A bit field of fixed size (2 MB) that holds the ids, pairs of hashes. It only saves work: with very many
    ids it lets all through."""
    place = F.explode(F.array(*_bloom_places(F.col(first), F.col(second)))).alias("p")
    words = ids.select(place).groupBy(F.shiftright("p", 5).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(p & 31))")).alias("bits")
    )
    out = np.zeros(BLOOM_BITS // 32, np.uint32)
    rows = words.toPandas()  # 524,288 rows at most
    out[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def bloom_holds(bits: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    held = np.ones(len(first), bool)
    for x in (first, second, first >> 24, second >> 24):
        p = x & (BLOOM_BITS - 1)
        held &= (bits[p >> 5] >> (p & 31).astype(np.uint32) & 1).astype(bool)
    return held


def sifted(df: DataFrame, bits: np.ndarray, first: str, second: str, inside: bool = True) -> DataFrame:
    """Rows whose ids may be in the field (or, with ``inside`` false, those whose ids are surely not)."""
    shared = df.sparkSession.sparkContext.broadcast(bits)
    a, b = df.columns.index(first), df.columns.index(second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = bloom_holds(shared.value, batch.column(a).to_numpy(), batch.column(b).to_numpy())
            yield batch.filter(pa.array(held if inside else ~held))

    return df.mapInArrow(run, df.schema)
