"""Correlations of very many columns in one scan, by matrix products.

Each task multiplies its Arrow batches with themselves: the products of values, of squares and of marks for known values
hold all sums that pairwise-complete correlations need. Its sums are one row a pair, which Spark adds up over the tasks.
Values are taken as differences from a value of their column, so that the sums of squares keep their digits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veristrata.functions.columns import as_double

# Workers get the functions of this module with the task, so that they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHIFT_ROWS = 1000
ROWS = 4096  # multiplied at a time
CONSTANT = 1e-13  # a share of the squares below which a spread is an error of rounding
_SUMS = ["n", "si", "sj", "qi", "qj", "p", "odd"]


class Sums:
    """Sums over rows for all pairs of columns in which both are known."""

    def __init__(self, shift: np.ndarray):
        width = len(shift)
        self.shift = shift
        self.known, self.value, self.square, self.product, self.odd = (np.zeros((width, width)) for _ in range(5))

    def add(self, x: np.ndarray) -> None:
        known = ~np.isnan(x)
        finite = np.isfinite(x)
        y = np.where(finite, x - self.shift, 0.0)
        if not np.array_equal(known, finite):
            both = (known & ~finite).T.astype(float) @ known
            self.odd += both + both.T
        marks = known.astype(float)
        self.known += marks.T @ marks
        self.value += y.T @ marks
        self.square += (y * y).T @ marks
        self.product += y.T @ y

    def rows(self) -> Iterator[pa.RecordBatch]:
        """For each column the pairs with itself and later ones: the sums of _SUMS."""
        for i in range(len(self.shift)):
            j = np.arange(i, len(self.shift))
            columns = [
                self.known[i, i:], self.value[i, i:], self.value[i:, i], self.square[i, i:], self.square[i:, i],
                self.product[i, i:], self.odd[i, i:],
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(j), i, np.int32)), pa.array(j.astype(np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                names=["i", "j", *_SUMS],
            )


def gram_correlations(df: DataFrame, names: list[str]) -> DataFrame:
    """Pearson matrix in long form ``(a, b, r)`` of pairwise-complete rows; NULL where a side does not vary, NaN where
    one is infinite."""
    values = df.select(*(as_double(df, c).alias(f"v{i}") for i, c in enumerate(names)))
    # A value from the middle of some rows: exact for columns that never vary.
    some = values.limit(SHIFT_ROWS).agg(*(F.percentile_approx(f"v{i}", 0.5).alias(f"v{i}") for i in range(len(names)))).first()
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(shift)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sums.add(np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns]))
        yield from sums.rows()

    sums = values.mapInArrow(run, "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS))
    pairs = sums.groupBy("i", "j").agg(*(F.sum(s).alias(s) for s in _SUMS))
    n = F.col("n")
    squares = {s: n * F.col(f"q{s}") for s in "ij"}
    spread = {s: squares[s] - F.col(f"s{s}") * F.col(f"s{s}") for s in "ij"}
    varies = (n >= 2) & (spread["i"] > squares["i"] * CONSTANT) & (spread["j"] > squares["j"] * CONSTANT)
    r = F.try_divide(n * F.col("p") - F.col("si") * F.col("sj"), F.sqrt(spread["i"]) * F.sqrt(spread["j"]))
    r = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(varies, F.when(F.col("i") == F.col("j"), 1.0).otherwise(r))
    listed = F.array(*(F.lit(c) for c in names))
    name = {s: F.element_at(listed, F.col(s) + 1) for s in "ij"}
    there, back = (
        F.struct(name[x].alias("a"), name[y].alias("b"), F.col("r").alias("r")) for x, y in (("i", "j"), ("j", "i"))
    )
    both = F.when(F.col("i") == F.col("j"), F.array(there)).otherwise(F.array(there, back))
    return pairs.withColumn("r", r).select(F.inline(both))
