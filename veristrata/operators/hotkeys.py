"""Meeting the rows of a table with few of its keys, where one key may have very many rows.

Keys are counted first, which combines equal ones in the tasks. The rows of keys that hold more than a thousandth of all
rows wanted, a thousand keys at most, are told by a broadcast of these keys. Of the others only rows that a bit field
lets through are shuffled by their key, so no task gets more than a thousandth of the rows for one key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT = 1000  # a key with more than 1 / HOT of the rows is hot, so there are HOT at most
BITS = 1 << 17
_WORDS = BITS // 64


def _place(key: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        key = F.when(key == 0, F.lit(0.0).cast(data_type)).otherwise(key)  # -0.0 joins with 0.0
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def key_filter(keys: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test of keys: true for those of the table, and for a few others. Its size is fixed (16 KB); with very many
    keys it lets all through."""
    data_type = keys.schema[name].dataType
    place = keys.select(_place(F.col(name), data_type).alias("p"))
    words = place.groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(p % 64))")).alias("bits")
    ).collect()  # _WORDS rows at most
    field = [0] * _WORDS
    for r in words:
        field[r["w"]] = r["bits"]
    # The least number can't be written as a literal of its type.
    listed = F.expr(f"array({', '.join('bigint(-9223372036854775808)' if w == -(1 << 63) else f'{w}L' for w in field)})")

    def holds(key: Column) -> Column:
        p = _place(key, data_type)
        word = F.get(listed, F.floor(p / 64).cast("int"))
        return F.coalesce(F.getbit(word, (p % 64).cast("int")) == 1, F.lit(False)) & key.isNotNull()

    return holds


def hot_and_rest(counted: DataFrame, count: str) -> tuple[DataFrame, DataFrame, int]:
    """The keys that hold more than 1 / HOT of the rows that all keys of ``counted`` hold, the others, and the rows."""
    rows = counted.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    hot = F.col(count) * HOT > F.lit(rows)
    return counted.filter(hot), counted.filter(~hot), rows
