"""Exact quantiles of many columns without sorting the table or holding a column in one task.

``percentile`` keeps every distinct value of a column in one task. Here the first pass takes, with counts and extremes, a
mergeable sketch of all rows, which proposes a narrow bracket of values for each wanted quantile; the second, a fused
count over all rows, proves that the bracket holds the wanted ranks, and how many rows it holds; the third opens
brackets that are proven to be small. Brackets that are still large are narrowed again from a sample of their own rows (each
round shrinks them a hundredfold or more); a bracket of equal values is an answer. The result is exact: sketches and
samples only say where to look, ranks are counted over all rows. No step shuffles table rows.

The same sketch tells where the median of the distances from the median lies, so that both take four passes together.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from veristrata.functions.columns import as_double, literal, normalize_missing

SKETCH_ACCURACY = 10_000
# Size of the first pass' sketches (about 100 KB each), and a bound for their error of rank, at odds of one in a hundred; a
# bracket that does not hold its ranks is found out and searched anew.
SKETCH_SIZE = 4096
SKETCH_ERROR = 0.0015
MERGED = 512  # sketches that meet in the last task of the first pass
GRID = 2048  # steps of a sketch that is read as a distribution
# Values that one opened bracket may hold, and columns handled together: these bound what a single
# task gathers (BATCH x probabilities x OPEN_LIMIT doubles).
OPEN_LIMIT = 50_000
BATCH = 32
SAMPLE_ROWS = 200_000
SAMPLE_SHARE = 0.001

Quantiles = dict[str, dict[float, float]]


def quantile_values(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], mode: str = "exact"
) -> Quantiles:
    """Quantiles as numbers, as ``approxQuantile`` does: columns x probabilities reach the driver.

    Columns without any value are left out.
    """
    df = normalize_missing(df)
    return quantiles_of(df, {c: as_double(df, c) for c in columns}, probabilities, mode)


def quantiles_of(
    df: DataFrame,
    expressions: Mapping[str, Column],
    probabilities: Sequence[float],
    mode: str = "exact",
) -> Quantiles:
    """Quantiles of double expressions over ``df``, linear between neighbouring ranks."""
    if mode not in ("exact", "approx"):
        raise ValueError(f"unknown quantile mode: {mode}")
    wanted = sorted({float(p) for p in probabilities})
    found: Quantiles = {}
    names = list(expressions)
    for start in range(0, len(names), BATCH):
        batch = names[start : start + BATCH]
        projected = df.select(*(expressions[n].alias(f"v{i}") for i, n in enumerate(batch)))
        step = _approximate if mode == "approx" else _exact
        for i, values in step(projected, len(batch), wanted).items():
            found[batch[i]] = values
    return found


def _approximate(projected: DataFrame, count: int, wanted: list[float]) -> dict[int, dict]:
    row = projected.agg(
        *(F.percentile_approx(f"v{i}", wanted, SKETCH_ACCURACY).alias(f"q{i}") for i in range(count))
    ).first()
    return {i: dict(zip(wanted, row[f"q{i}"])) for i in range(count) if row[f"q{i}"] is not None}


@dataclass
class _Target:
    """One quantile of one column: the ranks wanted and the bracket known to hold them."""

    column: int
    probability: float
    position: float
    low: float
    high: float
    below: int
    inside: int
    widen: float = 1.0

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    def within(self) -> Column:
        v = F.col(f"v{self.column}")
        return (v >= F.lit(self.low)) & (v <= F.lit(self.high))

    def holds(self, below: int, inside: int) -> bool:
        return below <= self.ranks[0] and self.ranks[1] < below + inside


def _scan(df: DataFrame, aggregates: Sequence[Column]) -> Row:
    """One pass over all rows."""
    return df.agg(*aggregates).first()


def _exact(projected: DataFrame, count: int, wanted: list[float]) -> dict[int, dict]:
    answers, to_open = _search(projected, count, wanted)
    _open_all(projected, to_open, answers)
    return answers


def fused_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], aggregates: list[Column]
) -> dict[str, dict[float, float | str]]:
    """Quantiles for a report that is one aggregate of ``df``: as numbers, or as SQL text over aggregates that open their
    brackets and are added to ``aggregates``. Of more than BATCH columns all are numbers, so that no task gathers
    more than the brackets of BATCH columns."""
    if len(columns) > BATCH:
        return quantile_values(df, columns, probabilities)
    names, wanted = list(columns), sorted({float(p) for p in probabilities})
    values = {c: as_double(df, c) for c in names}
    projected = df.select(*(v.alias(f"v{i}") for i, v in enumerate(values.values())))
    answers, to_open = _search(projected, len(names), wanted) if names else ({}, [])
    found: dict[str, dict[float, float | str]] = {names[i]: dict(a) for i, a in answers.items()}
    for j, t in enumerate(to_open):
        name = names[t.column]
        aggregates += _open(j, t, values[name])
        between = f"l{j} + {literal(t.position - t.ranks[0])} * (h{j} - l{j})"
        found.setdefault(name, {})[t.probability] = f"CASE WHEN l{j} = h{j} THEN l{j} ELSE {between} END"
    return found


def _search(projected: DataFrame, count: int, wanted: list[float]) -> tuple[dict[int, dict], list[_Target]]:
    """Answers that are known, and the targets whose brackets are proven to be small enough to be opened."""
    edges = _sketch_edges(wanted)
    row = _overview(projected, count, edges)
    answers: dict[int, dict[float, float]] = {}
    pending: list[_Target] = []
    proposed: dict[int, tuple[float, float]] = {}
    for i in range(count):
        n, low, high = row[f"n{i}"], row[f"a{i}"], row[f"z{i}"]
        for k, p in enumerate(wanted if n else []):
            target = _Target(i, p, p * (n - 1), low, high, 0, n)
            if low == high or target.ranks[1] == 0:
                answers.setdefault(i, {})[p] = low
            elif target.ranks[0] == n - 1:
                answers.setdefault(i, {})[p] = high
            else:
                # The ends of a sketch are not the ends of the column.
                a, z = row[f"s{i}"][2 * k : 2 * k + 2]
                proposed[len(pending)] = a if edges[2 * k] > 0.0 else low, z if edges[2 * k + 1] < 1.0 else high
                pending.append(target)
    large = {j: proposed[j] for j, t in enumerate(pending) if t.inside > OPEN_LIMIT}
    if large:
        _prove(projected, [pending[j] for j in large], list(large.values()))
        pending = _answered(pending, answers)
    return answers, _settle(projected, pending, answers)


def _settle(projected: DataFrame, pending: list[_Target], answers: dict[int, dict[float, float]]) -> list[_Target]:
    """Narrows brackets until each can be opened or is an answer."""
    to_open: list[_Target] = []
    rounds = 0
    while pending:
        to_open += [t for t in pending if t.inside <= OPEN_LIMIT]
        pending = [t for t in pending if t.inside > OPEN_LIMIT]
        if pending:
            _narrow(projected, pending, rounds)
            rounds += 1
            pending = _answered(pending, answers)
    return to_open


def _answered(pending: list[_Target], answers: dict[int, dict[float, float]]) -> list[_Target]:
    """Those that are still open; a bracket of equal values is an answer."""
    for t in pending:
        if t.low == t.high:
            answers.setdefault(t.column, {})[t.probability] = t.low
    return [t for t in pending if t.low < t.high]


def _sketch_edges(wanted: list[float]) -> list[float]:
    margin = 2 * SKETCH_ERROR
    return [e for p in wanted for e in (max(p - margin, 0.0), min(p + margin, 1.0))]


def _overview(projected: DataFrame, count: int, places: Sequence[float]) -> Row:
    """One pass: the number of values (n), the least (a), the largest (z), and the values at places of a sketch of all
    rows (s; NULL without any) of each column. The tasks' sketches are merged in groups first."""
    parts, whole = [], []
    listed = F.expr(f"array({', '.join(literal(float(p)) for p in places)})")
    for i in range(count):
        v = F.col(f"v{i}")
        parts += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}"),
                  F.when(F.count(v) > 0, F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE))).alias(f"s{i}")]
        values = F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(f"s{i}", F.lit(SKETCH_SIZE)), listed)
        whole += [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}"), F.min(f"a{i}").alias(f"a{i}"),
                  F.max(f"z{i}").alias(f"z{i}"), F.when(F.sum(f"n{i}") > 0, values).alias(f"s{i}")]
    group = F.pmod(F.spark_partition_id(), F.lit(MERGED))
    return _scan(projected.groupBy(group.alias("part")).agg(*parts), whole)


def median_deviations(df: DataFrame, columns: Sequence[str], mode: str = "exact") -> dict[str, tuple[float, float]]:
    """Median, and median distance from it, of each column with any value.

    The first pass' sketch gives brackets of both. The second proves the medians' brackets, and for the distances' that
    few rows can lie in them, wherever in its bracket a median is; the third opens the medians; the fourth counts
    and opens the distances. Where too many rows may lie in a distances' bracket, it is proven by itself once the
    median is known, and narrowed like any other.
    """
    df = normalize_missing(df)
    found: dict[str, tuple[float, float]] = {}
    names = list(columns)
    for start in range(0, len(names), BATCH):
        batch = names[start : start + BATCH]
        values = {c: as_double(df, c) for c in batch}
        if mode == "exact":
            projected = df.select(*(v.alias(f"v{i}") for i, v in enumerate(values.values())))
            found |= {batch[i]: pair for i, pair in _median_deviations(projected, len(batch)).items()}
        rest = {c: v for c, v in values.items() if c not in found}
        medians = quantiles_of(df, rest, (0.5,), mode)
        distances = quantiles_of(df, {c: F.abs(rest[c] - F.lit(m[0.5])) for c, m in medians.items()}, (0.5,), mode)
        found |= {c: (m[0.5], distances[c][0.5]) for c, m in medians.items()}
    return found


def _median_deviations(projected: DataFrame, count: int) -> dict[int, tuple[float, float]]:
    row = _overview(projected, count, [i / GRID for i in range(GRID + 1)])
    grids: dict[int, list[float]] = {}
    pending, counts = [], []
    for i in range(count):
        n, low, high = row[f"n{i}"], row[f"a{i}"], row[f"z{i}"]
        if not n or not math.isfinite(low) or not math.isfinite(high):
            continue
        grids[i] = grid = [low, *row[f"s{i}"][1:-1], high]
        pending.append(_Target(i, 0.5, 0.5 * (n - 1), low, high, 0, n))
        # Rows whose distance may be in its bracket, for any median in its own.
        v, (first, last), (near, far) = F.col(f"v{i}"), _middle(grid), _distance_bracket(grid, slack=True)
        left, right = (v >= F.lit(first - far)) & (v <= F.lit(last - near)), (v >= F.lit(first + near)) & (v <= F.lit(last + far))
        if n > OPEN_LIMIT:
            counts.append(F.count(F.when(left | right, 1)).alias(f"may{i}"))
    sizes = {t.column: t.inside for t in pending}
    few = {i for i, n in sizes.items() if n <= OPEN_LIMIT}
    large = [t for t in pending if t.column not in few]
    answers: dict[int, dict[float, float]] = {i: {0.5: g[0]} for i, g in grids.items() if g[0] == g[-1]}
    if large:
        row = _prove(projected, large, [_middle(grids[t.column]) for t in large], counts)
        few |= {t.column for t in large if row[f"may{t.column}"] <= OPEN_LIMIT}
    to_open = _settle(projected, _answered(pending, answers), answers)
    _open_all(projected, to_open, answers)
    medians = {i: a[0.5] for i, a in answers.items()}
    distances = projected.select(*(
        (F.abs(F.col(f"v{i}") - F.lit(medians[i])) if i in medians else F.lit(None).cast("double")).alias(f"v{i}") for i in range(count)
    ))
    return {i: (medians[i], d) for i, d in _distances(distances, medians, grids, sizes, few).items()}


def _distances(distances: DataFrame, medians: dict[int, float], grids: dict[int, list[float]], sizes: dict[int, int],
               few: set[int]) -> dict[int, float]:
    """The medians of the columns of ``distances``; of ``few``, whose brackets surely hold few rows, in one pass."""
    targets, proposed = {}, {}
    for i, m in medians.items():
        targets[i] = _Target(i, 0.5, 0.5 * (sizes[i] - 1), 0.0, max(m - grids[i][0], grids[i][-1] - m), 0, sizes[i])
        proposed[i] = (0.0, targets[i].high) if sizes[i] <= OPEN_LIMIT else _distance_bracket(grids[i], m)
    answers: dict[int, dict[float, float]] = {}
    at_once = [i for i in targets if i in few]
    if at_once:
        aggregates = []
        for i in at_once:
            v, (near, far) = F.col(f"v{i}"), proposed[i]
            inside = F.sort_array(F.collect_list(F.when((v >= F.lit(near)) & (v <= F.lit(far)), v)))
            below = F.count(F.when(v < F.lit(near), 1))
            for side, r in zip(("l", "h"), targets[i].ranks):
                place = (F.lit(r) - below).cast("int")
                aggregates.append(F.when(place >= 0, F.get(inside, place)).alias(f"{side}{i}"))
        row = _scan(distances, aggregates)
        for i in at_once:
            if row[f"l{i}"] is not None and row[f"h{i}"] is not None:
                answers[i] = {0.5: _interpolate(targets[i], row, i)}
    rest = [i for i in targets if i not in answers]
    if rest:
        _prove(distances, [targets[i] for i in rest], [proposed[i] for i in rest])
        _open_all(distances, _settle(distances, _answered([targets[i] for i in rest], answers), answers), answers)
    return {i: a[0.5] for i, a in answers.items()}


def _open_all(projected: DataFrame, targets: list[_Target], answers: dict[int, dict[float, float]]) -> None:
    if targets:
        opened = _scan(projected, [a for j, t in enumerate(targets) for a in _open(j, t, F.col(f"v{t.column}"))])
        for j, t in enumerate(targets):
            answers.setdefault(t.column, {})[t.probability] = _interpolate(t, opened, j)


def _middle(grid: list[float]) -> tuple[float, float]:
    """Between which values the median lies."""
    margin = 2 * SKETCH_ERROR
    return grid[int(GRID * (0.5 - margin))], grid[math.ceil(GRID * (0.5 + margin))]


def _distance_bracket(grid: list[float], middle: float | None = None, slack: bool = False) -> tuple[float, float]:
    """Between which numbers the median distance from ``middle`` lies, by values at equal steps of rank; with ``slack``
    the distance from whatever value the median may be."""
    margin = 3 * SKETCH_ERROR + 2 / GRID
    middle = grid[GRID // 2] if middle is None else middle

    def share(distance: float) -> float:
        return (bisect.bisect_right(grid, middle + distance) - bisect.bisect_left(grid, middle - distance)) / len(grid)

    steps = sorted(abs(x - middle) for x in grid)
    near = steps[max(bisect.bisect_left(steps, 0.5 - margin, key=share) - 1, 0)]
    far = steps[min(bisect.bisect_right(steps, 0.5 + margin, key=share), len(steps) - 1)]
    more = max(abs(x - middle) for x in _middle(grid)) if slack else 0.0
    return max(near - more, 0.0), far + more


def _narrow(projected: DataFrame, targets: list[_Target], seed: int) -> None:
    """One round: propose smaller brackets from a sample, accept those that the counts prove."""
    largest = max(t.inside for t in targets)
    share = max(SAMPLE_ROWS / largest, SAMPLE_SHARE)
    sample = projected if share >= 0.5 else projected.sample(fraction=share, seed=seed)
    # Targets that still share a bracket share one sketch.
    shared: dict[tuple[int, float, float], list[tuple[int, list[float]]]] = {}
    for j, t in enumerate(targets):
        shared.setdefault((t.column, t.low, t.high), []).append((j, _edges(t, share)))
    sketches = []
    for k, group in enumerate(shared.values()):
        first = targets[group[0][0]]
        value = F.when(first.within(), F.col(f"v{first.column}"))
        positions = [q for _, edges in group for q in edges]
        sketches.append(F.percentile_approx(value, positions, SKETCH_ACCURACY).alias(f"e{k}"))
    row = _scan(sample, sketches)
    proposed: dict[int, tuple[float, float]] = {}
    for k, group in enumerate(shared.values()):
        values = row[f"e{k}"]
        for m, (j, edges) in enumerate(group):
            t = targets[j]
            # The ends of a sample are not the ends of the bracket.
            low = values[2 * m] if values and edges[0] > 0.0 else t.low
            high = values[2 * m + 1] if values and edges[1] < 1.0 else t.high
            proposed[j] = (low, high)
    _prove(projected, targets, [proposed[j] for j in range(len(targets))])


def _prove(projected: DataFrame, targets: list[_Target], proposed: list[tuple[float, float]],
           more: Sequence[Column] = ()) -> Row:
    """Takes the proposed brackets that hold their ranks, by one count over all rows; ``more`` is counted with it."""
    counts = list(more)
    for j, (t, (low, high)) in enumerate(zip(targets, proposed)):
        v = F.col(f"v{t.column}")
        counts.append(F.count(F.when(v < F.lit(low), 1)).alias(f"below{j}"))
        counts.append(F.count(F.when((v >= F.lit(low)) & (v <= F.lit(high)), 1)).alias(f"in{j}"))
    counted = _scan(projected, counts)
    tied = []
    for j, (t, (low, high)) in enumerate(zip(targets, proposed)):
        below, inside = counted[f"below{j}"], counted[f"in{j}"]
        if not t.holds(below, inside):
            t.widen *= 4
            continue
        if low < high and inside > max(OPEN_LIMIT, t.inside // 2):
            tied.append(t)
        t.low, t.high, t.below, t.inside, t.widen = low, high, below, inside, 1.0
    if tied:
        _split_ties(projected, tied)
    return counted


def _split_ties(projected: DataFrame, targets: list[_Target]) -> None:
    """Brackets that hardly shrink hold a very frequent value at an end: count the ends apart."""
    counts = []
    for j, t in enumerate(targets):
        v = F.col(f"v{t.column}")
        between = (v > F.lit(t.low)) & (v < F.lit(t.high))
        counts += [
            F.count(F.when(v == F.lit(t.low), 1)).alias(f"at_low{j}"),
            F.count(F.when(between, 1)).alias(f"between{j}"),
            F.min(F.when(between, v)).alias(f"first{j}"),
            F.max(F.when(between, v)).alias(f"last{j}"),
        ]
    counted = _scan(projected, counts)
    for j, t in enumerate(targets):
        at_low, between = counted[f"at_low{j}"], counted[f"between{j}"]
        parts = [
            (t.low, t.low, t.below, at_low),
            (counted[f"first{j}"], counted[f"last{j}"], t.below + at_low, between),
            (t.high, t.high, t.below + at_low + between, t.inside - at_low - between),
        ]
        parts = [part for part in parts if part[3]]
        whole = [part for part in parts if t.holds(part[2], part[3])]
        if whole:
            t.low, t.high, t.below, t.inside = whole[0]
            continue
        # The two ranks lie on either side of a step between two parts.
        left = next(p[1] for p in parts if p[2] <= t.ranks[0] < p[2] + p[3])
        right = next(p[0] for p in parts if p[2] <= t.ranks[1] < p[2] + p[3])
        t.low = t.high = left + (t.position - t.ranks[0]) * (right - left)


def _edges(t: _Target, share: float) -> list[float]:
    """Where in its bracket a target lies, give or take the errors of sketch and sample."""
    drawn = max(t.inside * min(share, 1.0), 1.0)
    middle = (t.position - t.below) / max(t.inside - 1, 1)
    margin = 2 / SKETCH_ACCURACY + 2 / t.inside
    if share < 0.5:
        margin += 4 * math.sqrt(max(middle * (1 - middle), 1 / drawn) / drawn)
    margin *= t.widen
    return [max(middle - margin, 0.0), min(middle + margin, 1.0)]


def _open(j: int, t: _Target, value: Column) -> list[Column]:
    values = F.sort_array(F.collect_list(F.when((value >= F.lit(t.low)) & (value <= F.lit(t.high)), value)))
    return [
        F.get(values, F.lit(rank - t.below)).alias(f"{side}{j}")
        for side, rank in zip(("l", "h"), t.ranks)
    ]


def _interpolate(t: _Target, opened: Row, j: int) -> float:
    low, high = opened[f"l{j}"], opened[f"h{j}"]
    return low if low == high else low + (t.position - t.ranks[0]) * (high - low)
