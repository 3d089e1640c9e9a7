"""Drift between two versions of a table: schema, distribution (two-sample KS) and statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veristrata.functions.columns import (
    as_double,
    field,
    is_numeric_or_bool,
    literal,
    normalize_missing,
    result_rows,
)
from veristrata.operators.quantiles import SAMPLE_ROWS, SAMPLE_SHARE, SKETCH_ACCURACY, quantiles_of
from veristrata.session import stored

# Places where the value range is cut for the KS pass: even steps, and finer ones in the tails.
KNOTS = [0.0, 0.0005, 0.002, 0.008, *(i / 48 for i in range(1, 48)), 0.992, 0.998, 0.9995, 1.0]
CELLS_PER_KNOT = 32
COLUMNS_PER_PASS = 16
RANKED = 50_000  # different values that one task ranks
PARTS = 32  # into which a range of more values is cut


def schema_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Columns added, removed or of another type; the score is changes per reference column."""
    old = dict(reference.dtypes)
    new = dict(current.dtypes)
    added, removed = sorted(set(new) - set(old)), sorted(set(old) - set(new))
    retyped = sorted(f"{c}:{old[c]}->{new[c]}" for c in set(old) & set(new) if old[c] != new[c])
    score = (len(added) + len(removed) + len(retyped)) / max(len(old), 1)
    return reference.sparkSession.createDataFrame(
        [("schema", score, score > 0, ",".join(added), ",".join(removed), ",".join(retyped),
          len(old), len(new))],
        "drift_type string, drift_score double, drift_detected boolean, columns_added string, "
        "columns_removed string, type_changes string, reference_column_count int, "
        "current_column_count int",
    )


def schema_changes(reference: DataFrame, current: DataFrame) -> DataFrame:
    """A row for each column that was added, removed or changed its type: both types, and how often it is missing in
    either version. Each table is read once, only the changed columns of it; without changes there are no rows."""
    old, new = dict(reference.dtypes), dict(current.dtypes)
    changed = [c for c in [*old, *(c for c in new if c not in old)] if old.get(c) != new.get(c)]
    kinds = {c: "added" if c not in old else "removed" if c not in new else "retyped" for c in changed}
    parts = []
    for version, table, types in (("reference", reference, old), ("current", current, new)):
        names = [c for c in changed if c in types]
        if names:
            counted = normalize_missing(table).agg(
                F.count(F.lit(1)).alias("rows"), *(F.count(field(c)).alias(f"n{i}") for i, c in enumerate(names))
            )
            parts.append(counted.select(result_rows([
                {"column": literal(c), f"{version}_nulls": f"rows - n{i}"} for i, c in enumerate(names)
            ])))
    columns = "`column` string, reference_nulls bigint, current_nulls bigint"
    if not parts:
        empty = reference.sparkSession.createDataFrame([], columns)
        nulls = empty
    else:
        nulls = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy("column").agg(
            *((F.max(n) if any(n in p.columns for p in parts) else F.lit(None).cast("bigint")).alias(n)
              for n in ("reference_nulls", "current_nulls"))
        )
    known = reference.sparkSession.createDataFrame(
        [(c, kinds[c], old.get(c), new.get(c)) for c in changed],
        "`column` string, change string, reference_type string, current_type string",
    )
    return known.join(F.broadcast(nulls), "column", "left")  # a row for each changed column


def common_numeric_columns(reference: DataFrame, current: DataFrame, both: bool = True) -> list[str]:
    """Shared columns that are numeric (or boolean) in the reference, and in the current table."""
    names = []
    for f in reference.schema.fields:
        if f.name in current.columns and is_numeric_or_bool(f.dataType):
            if not both or is_numeric_or_bool(current.schema[f.name].dataType):
                names.append(f.name)
    return names


def _sides(reference: DataFrame, current: DataFrame, names: list[str]) -> DataFrame:
    """Both tables under one another as doubles ``v0 ..``, with the side as a flag."""
    parts = []
    for table, flag in ((normalize_missing(reference), True), (normalize_missing(current), False)):
        values = [as_double(table, c).alias(f"v{i}") for i, c in enumerate(names)]
        parts.append(table.select(F.lit(flag).alias("is_reference"), *values))
    return parts[0].unionAll(parts[1])


def statistical_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    threshold: float = 0.1,
    mode: str = "exact",
) -> DataFrame:
    """Relative change of mean and deviation per column; both tables in one aggregate."""
    names = columns or common_numeric_columns(reference, current, both=False)
    if not names:
        numbers = ["drift_score", "mean_diff_pct", "std_diff_pct"]
        numbers += [f"{s}_{k}" for s in ("reference", "current") for k in ("mean", "std", "min", "max", "median")]
        fields = {n: "double" for n in numbers} | {"drift_detected": "boolean"}
        order = ["drift_score", "drift_detected", *numbers[1:]]
        listed = ", ".join(f"{n} {fields[n]}" for n in order)
        return reference.sparkSession.createDataFrame([], f"`column` string, drift_type string, {listed}")
    both = _sides(reference, current, names)
    side = {"reference": F.col("is_reference"), "current": ~F.col("is_reference")}
    medians = quantiles_of(
        both,
        {f"{s}{i}": F.when(flag, F.col(f"v{i}")) for s, flag in side.items()
         for i in range(len(names))},
        (0.5,),
        mode,
    )
    aggregates, rows = [], []
    for i, name in enumerate(names):
        stats = {}
        for s, flag in side.items():
            v = F.when(flag, F.col(f"v{i}"))
            for key, a in (("mean", F.avg(v)), ("std", F.stddev_samp(v)), ("min", F.min(v)),
                           ("max", F.max(v))):
                aggregates.append(a.alias(f"{s}_{key}_{i}"))
                stats[f"{s}_{key}"] = f"{s}_{key}_{i}"
            median = medians.get(f"{s}{i}", {}).get(0.5)
            stats[f"{s}_median"] = f"cast({literal(median)} AS double)"
        mean_change = _relative(stats["reference_mean"], stats["current_mean"])
        std_change = _relative(stats["reference_std"], stats["current_std"])
        score = f"({mean_change} + {std_change}) / 2"
        rows.append(
            {
                "column": literal(name),
                "drift_type": "'statistical'",
                "drift_score": score,
                "drift_detected": f"coalesce({score} > {literal(float(threshold))}, false)",
                "mean_diff_pct": mean_change,
                "std_diff_pct": std_change,
                **stats,
            }
        )
    return both.agg(*aggregates).select(result_rows(rows))


def _relative(old: str, new: str) -> str:
    return f"abs({old} - {new}) / (abs({old}) + 1e-10D)"


def distribution_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    threshold: float = 0.1,
) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov statistic per column, with its limiting p-value.

    The value range is cut into cells. Counts per cell give both distribution functions at the cell
    edges, and a ceiling for their distance inside each cell. Only cells whose ceiling beats the best
    edge are opened, and only their values are grouped. A cell of more than RANKED different values is cut
    by its quantiles, counted and judged again, until each range left is ranked by its own task.
    The table as a whole is never sorted or shuffled.
    """
    names = columns or common_numeric_columns(reference, current)
    parts = [
        _ks(reference, current, names[i : i + COLUMNS_PER_PASS])
        for i in range(0, len(names), COLUMNS_PER_PASS)
    ]
    if not parts:
        return reference.sparkSession.createDataFrame(
            [], "`column` string, drift_score double, reference_count bigint, "
            "current_count bigint, p_value double, drift_type string, drift_detected boolean",
        )
    distances = reduce(DataFrame.unionByName, parts)
    p_value = smirnov_p_value("drift_score", "reference_count", "current_count")
    return distances.withColumn("p_value", p_value).select(
        "column", F.lit("distribution").alias("drift_type"), "drift_score", "p_value",
        (F.col("p_value") < F.lit(threshold)).alias("drift_detected"),
        "reference_count", "current_count",
    )


def smirnov_p_value(d: str, n_reference: str, n_current: str) -> Column:
    """Limiting distribution of the KS statistic: first hundred terms of Smirnov's series."""
    return F.expr(
        f"""
        CASE WHEN {d} IS NULL THEN NULL
             WHEN {d} * sqrt(cast({n_reference} AS double) * {n_current}
                             / ({n_reference} + {n_current})) < 0.2 THEN 1.0D
             ELSE least(1.0D, greatest(0.0D, 2.0D * aggregate(
                 sequence(1, 100), 0.0D,
                 (acc, k) -> acc + CASE WHEN k % 2 = 1 THEN 1.0D ELSE -1.0D END * exp(
                     -2.0D * k * k * {d} * {d} * (cast({n_reference} AS double) * {n_current}
                     / ({n_reference} + {n_current}))))))
        END"""
    )


def _ks(reference: DataFrame, current: DataFrame, names: list[str]) -> DataFrame:
    both = _sides(reference, current, names)
    knots = _knots(both, len(names))
    known = F.col("v").isNotNull()
    interval = [_interval(f"v{i}", k).alias(f"k{i}") for i, k in enumerate(knots)]
    located = both.select("*", *interval).select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("c"),
                        _cell(F.col(f"v{i}"), F.col(f"k{i}"), k).alias("cell"),
                        F.col(f"v{i}").alias("v"),
                        F.col("is_reference").alias("is_reference"),
                    )
                    for i, k in enumerate(knots)
                )
            )
        )
    ).filter(known)
    sides = [
        F.count(F.when(F.col("is_reference"), F.lit(1))).alias("r"),
        F.count(F.when(~F.col("is_reference"), F.lit(1))).alias("u"),
    ]
    # At most columns x knots x CELLS_PER_KNOT rows.
    per_cell = stored(located.groupBy("c", "cell").agg(*sides), "drift-cells")
    whole = Window.partitionBy("c")
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (
        per_cell.select(
            "c", "cell", "r", "u",
            F.sum("r").over(upto).alias("r_upto"), F.sum("u").over(upto).alias("u_upto"),
            F.sum("r").over(whole).alias("n_r"), F.sum("u").over(whole).alias("n_u"),
        )
        .filter((F.col("n_r") > 0) & (F.col("n_u") > 0))
        .withColumn("at_edge", _distance(F.col("r_upto"), F.col("u_upto")))
        .withColumn("best_edge", F.max("at_edge").over(whole))
    )
    r_before, u_before = F.col("r_upto") - F.col("r"), F.col("u_upto") - F.col("u")
    to_open = edges.filter(_may_beat(F.col("best_edge"))).select(
        "c", "cell", r_before.alias("r_before"), u_before.alias("u_before"), "n_r", "n_u",
        (F.col("r") + F.col("u")).alias("rows"), "best_edge",
    )
    opened = [r.asDict() for r in to_open.groupBy("c").agg(
        F.max("rows").alias("rows"), F.max("best_edge").alias("best")
    ).collect()]  # a row for each column
    values = (
        located.join(F.broadcast(to_open.drop("rows", "best_edge")), ["c", "cell"])
        .groupBy("c", "cell", "v", "r_before", "u_before", "n_r", "n_u")
        .agg(*sides)
        .withColumn("part", F.col("cell").cast("string")).drop("cell")
    )
    if max((r["rows"] for r in opened), default=0) <= RANKED:
        inside = [_ranked(values)]
    else:
        inside = _refined(stored(values, "drift-values"), {r["c"]: r["best"] for r in opened})
    at_edges = edges.select("c", F.col("at_edge").alias("distance"), "n_r", "n_u")
    found = reduce(DataFrame.unionByName, inside, at_edges).groupBy("c").agg(
        F.max("distance").alias("drift_score"),
        F.max("n_r").alias("reference_count"),
        F.max("n_u").alias("current_count"),
    )
    name_of = F.element_at(F.array(*(F.lit(n) for n in names)), F.col("c") + 1)
    return found.select(
        name_of.alias("column"), "drift_score", "reference_count", "current_count"
    )


def _may_beat(best: Column) -> Column:
    """Whether the distance inside a range may be larger than ``best``, from the counts up to its end (``r_upto``,
    ``u_upto``) and in it. A range with rows of one side only cannot beat its own edges."""
    r_before, u_before = F.col("r_upto") - F.col("r"), F.col("u_upto") - F.col("u")
    ceiling = F.greatest(
        F.col("r_upto") / F.col("n_r") - u_before / F.col("n_u"),
        F.col("u_upto") / F.col("n_u") - r_before / F.col("n_r"),
    )
    return (ceiling > best) & (F.col("r") > 0) & (F.col("u") > 0)


def _ranked(values: DataFrame) -> DataFrame:
    """(c, distance, n_r, n_u) at each value of ranges (c, part), each ranked by its own task."""
    inside = Window.partitionBy("c", "part").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    r, u = F.col("r_before") + F.sum("r").over(inside), F.col("u_before") + F.sum("u").over(inside)
    return values.select("c", _distance(r, u).alias("distance"), "n_r", "n_u")


def _refined(values: DataFrame, best: dict[int, float]) -> list[DataFrame]:
    """(c, distance, n_r, n_u) that decide the ranges of ``values`` (c, part, v, r, u and the counts before the range).

    Ranges of at most RANKED values are ranked. The others are cut at quantiles of their values, which leaves a part of
    them little more than 1 / PARTS each; the counts of the parts give distances at their ends, and ceilings inside
    them, and only parts that may beat the best distance so far are kept. So a few rounds are enough for any
    number of values, and no task ranks more than RANKED of them.
    """
    found = []
    steps = F.array(*(F.lit(i / PARTS) for i in range(1, PARTS)))
    key = ["c", "part"]
    while True:
        counts = values.groupBy(*key).agg(F.count(F.lit(1)).alias("values"))
        large = stored(counts.filter(F.col("values") > RANKED).select(*key), "drift-large")
        found.append(_ranked(values.join(large, key, "left_anti")))
        if large.isEmpty():
            return found
        rest = values.join(large, key, "left_semi")
        cuts = rest.groupBy(*key).agg(F.percentile_approx("v", steps, SKETCH_ACCURACY).alias("cuts"))
        number = F.size(F.filter("cuts", lambda x: x < F.col("v")))
        cut = stored(rest.join(cuts, key).withColumn("number", number).drop("cuts"), "drift-parts")
        before = Window.partitionBy(*key).orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        same = [F.first(c).alias(c) for c in ("r_before", "u_before", "n_r", "n_u")]
        parts = cut.groupBy(*key, "number").agg(F.sum("r").alias("r"), F.sum("u").alias("u"), *same)
        parts = parts.withColumn("r_upto", F.col("r_before") + F.sum("r").over(before)).withColumn(
            "u_upto", F.col("u_before") + F.sum("u").over(before)
        )
        parts = stored(parts.withColumn("distance", _distance(F.col("r_upto"), F.col("u_upto"))), "drift-edges")
        found.append(parts.select("c", "distance", "n_r", "n_u"))
        for r in parts.groupBy("c").agg(F.max("distance").alias("d")).collect():  # a row for each column
            best[r["c"]] = max(best[r["c"]], r["d"])
        so_far = F.expr("CASE c " + " ".join(f"WHEN {c} THEN {literal(d)}" for c, d in best.items()) + " END")
        kept = parts.filter(_may_beat(so_far)).select(
            *key, "number", (F.col("r_upto") - F.col("r")).alias("r_from"), (F.col("u_upto") - F.col("u")).alias("u_from")
        )
        values = stored(cut.join(kept, [*key, "number"]).select(
            "c", F.concat_ws(".", "part", "number").alias("part"), "v", "r", "u",
            F.col("r_from").alias("r_before"), F.col("u_from").alias("u_before"), "n_r", "n_u",
        ), "drift-values")


def _distance(r: Column, u: Column) -> Column:
    return F.abs(r / F.col("n_r") - u / F.col("n_u"))


def _knots(both: DataFrame, count: int) -> list[list[float]]:
    """A fixed number of cutting points per column, from a sample.

    They make cells hold about as many rows each; correctness needs only that cells keep the order
    of the values.
    """
    rows = both.count()
    share = max(SAMPLE_ROWS / max(rows, 1), SAMPLE_SHARE)
    sample = both if share >= 0.5 else both.sample(fraction=share, seed=42)
    row = sample.agg(
        *(
            F.expr(f"percentile_approx(v{i}, array({','.join(map(literal, KNOTS))}), "
                   f"{SKETCH_ACCURACY})").alias(f"k{i}")
            for i in range(count)
        )
    ).first()
    return [sorted(set(row[f"k{i}"] or [])) for i in range(count)]


def _doubles(values: list[float]) -> Column:
    return F.expr(f"array({', '.join(map(literal, values))})")


def _interval(name: str, knots: list[float]) -> Column:
    """Number of knots at or below the value, found by halving."""

    def between(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return (
            f"CASE WHEN {name} < {literal(knots[middle])} THEN {between(low, middle)} "
            f"ELSE {between(middle + 1, high)} END"
        )

    return F.expr(between(0, len(knots)))


def _cell(v: Column, interval: Column, knots: list[float]) -> Column:
    """The interval cut into equal steps; a number that never falls as the value rises."""
    if len(knots) < 2:
        return interval * CELLS_PER_KNOT
    lows = _doubles([knots[0], *knots])
    widths = _doubles([0.0, *(b - a for a, b in zip(knots, knots[1:])), 0.0])
    position = F.try_divide(v - F.get(lows, interval), F.get(widths, interval))
    step = F.floor(position * F.lit(float(CELLS_PER_KNOT))).cast("int")
    last = F.lit(CELLS_PER_KNOT - 1)
    return interval * CELLS_PER_KNOT + F.coalesce(F.least(step, last), F.lit(0))


def compare(reference: DataFrame, current: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Schema drift and distribution drift of every shared column, and whether there is any."""
    schema = schema_drift(reference, current).select(
        "drift_type", F.lit(None).cast("string").alias("column"), "drift_score",
        F.lit(None).cast("double").alias("p_value"), "drift_detected",
    )
    columns = distribution_drift(reference, current, threshold=threshold).select(
        "drift_type", "column", "drift_score", "p_value", "drift_detected"
    )
    both = schema.unionByName(columns)
    # A handful of report rows.
    anything = F.bool_or("drift_detected").over(Window.partitionBy(F.lit(1)))
    return both.withColumn("any_drift", anything)
