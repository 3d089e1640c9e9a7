"""Six quality dimensions, their weighted mean and a grade."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veristrata.functions.columns import (
    as_double,
    as_timestamp,
    field,
    is_numeric_or_bool,
    is_string,
    literal,
    normalize_missing,
    numeric_columns,
    result_rows,
    string_columns,
)
from veristrata.functions.text import is_blank, is_lower, is_title, is_upper
from veristrata.operators.frequencies import distinct_counts
from veristrata.operators.quantiles import quantile_values

DIMENSIONS = (
    "completeness", "uniqueness", "validity", "consistency", "timeliness", "accuracy",
)
# Weights of the dimensions, lowest score of each grade, telling parts of column names.
WEIGHTS = {
    "completeness": 0.25, "accuracy": 0.20, "consistency": 0.20, "timeliness": 0.15,
    "validity": 0.15, "uniqueness": 0.05,
}
GRADES = (("A", 0.95), ("B", 0.85), ("C", 0.75), ("D", 0.65))
KEY_NAME_PARTS = ("id", "mrn", "code")
DATE_NAME_PARTS = ("date", "time", "created", "updated")
OLDEST = "2000-01-01 00:00:00"
REACH = 3.0


@dataclass
class _Plan:
    """Aggregates of the dimensions, and score and column count of each as SQL text over them."""

    aggregates: list[Column] = dataclass_field(default_factory=list)
    scores: dict[str, tuple[str, str]] = dataclass_field(default_factory=dict)

    def add(self, expression: Column) -> str:
        name = f"a{len(self.aggregates)}"
        self.aggregates.append(expression.alias(name))
        return name

    def count(self, condition: Column) -> str:
        return self.add(F.count(F.when(condition, F.lit(1))))


def dimension_scores(
    df: DataFrame,
    as_of: str,
    dimensions: Iterable[str] = DIMENSIONS,
    required_columns: list[str] | None = None,
    unique_columns: list[str] | None = None,
    date_columns: list[str] | None = None,
    mode: str = "exact",
) -> DataFrame:
    """``(dimension, score, columns_checked, row_count)``, one row per dimension.

    All dimensions but uniqueness come from one fused scan; uniqueness adds one shuffle of the key
    columns. ``as_of`` stands for the present moment, so that results can be repeated.
    """
    df = normalize_missing(df)
    chosen = [d for d in DIMENSIONS if d in set(dimensions)]
    plan = _Plan()
    rows = plan.add(F.count(F.lit(1)))
    if "completeness" in chosen:
        _completeness(df, plan, rows, required_columns)
    if "validity" in chosen:
        _validity(df, plan, rows)
    if "consistency" in chosen:
        _consistency(df, plan)
    if "timeliness" in chosen:
        _timeliness(df, plan, as_of, date_columns)
    if "accuracy" in chosen:
        _accuracy(df, plan, mode)
    if "uniqueness" in chosen:
        plan.scores["uniqueness"] = ("NULL", "0")
    result = [
        {
            "dimension": literal(d),
            "score": f"cast({plan.scores[d][0]} AS double)",
            "columns_checked": f"cast({plan.scores[d][1]} AS int)",
            "row_count": rows,
        }
        for d in chosen
    ]
    scores = df.agg(*plan.aggregates).select(result_rows(result))
    return _with_uniqueness(df, scores, unique_columns, mode) if "uniqueness" in chosen else scores


def _completeness(df: DataFrame, plan: _Plan, rows: str, required: list[str] | None) -> None:
    names = [c for c in required if c in df.columns] if required else df.columns
    shares = [f"try_divide({plan.add(F.count(field(c)))}, {rows})" for c in names]
    plan.scores["completeness"] = _mean(shares)


def _mean(shares: list[str]) -> tuple[str, str]:
    """Mean over all columns; 1 without columns, NULL for an empty table."""
    if not shares:
        return "1.0D", "0"
    return f"({' + '.join(shares)}) / {float(len(shares))}D", str(len(shares))


def _mean_where_known(shares: list[str]) -> tuple[str, str]:
    """Mean over the columns that have values; 1 when there is none."""
    if not shares:
        return "1.0D", "0"
    known = f"filter(array({', '.join(shares)}), s -> s IS NOT NULL)"
    total = f"aggregate({known}, 0.0D, (total, s) -> total + s)"
    return f"coalesce(try_divide({total}, size({known})), 1.0D)", f"size({known})"


def _validity(df: DataFrame, plan: _Plan, rows: str) -> None:
    """Texts: not blank (a missing text counts as valid); numbers: present and finite."""
    shares = []
    for f in df.schema.fields:
        if is_string(f.dataType):
            good = F.coalesce(~is_blank(field(f.name)), F.lit(True))
        elif is_numeric_or_bool(f.dataType):
            good = F.abs(as_double(df, f.name)) < F.lit(float("inf"))
        else:
            shares.append(f"CASE WHEN {rows} > 0 THEN 1.0D END")
            continue
        shares.append(f"try_divide({plan.count(good)}, {rows})")
    plan.scores["validity"] = _mean(shares)


def _consistency(df: DataFrame, plan: _Plan) -> None:
    """Per text column the largest share of one writing style: upper, lower or title case."""
    shares = []
    for name in string_columns(df):
        text = field(name)
        known = plan.add(F.count(text))
        styles = [
            f"try_divide({plan.count(test(text))}, {known})" for test in (is_upper, is_lower, is_title)
        ]
        shares.append(f"greatest({', '.join(styles)})")
    plan.scores["consistency"] = _mean_where_known(shares)


def _timeliness(df: DataFrame, plan: _Plan, as_of: str, date_columns: list[str] | None) -> None:
    """Dates neither in the future nor before the year 2000. Numbers are dates only if named."""
    if date_columns:
        names = [c for c in date_columns if c in df.columns]
    else:
        names = [
            c for c in df.columns
            if any(p in c.lower() for p in DATE_NAME_PARTS)
            and not is_numeric_or_bool(df.schema[c].dataType)
        ]
    now, oldest = (F.lit(t).cast("timestamp_ntz") for t in (as_of, OLDEST))
    shares = []
    for name in names:
        moment = as_timestamp(df, name)
        known = plan.add(F.count(moment))
        future, old = plan.count(moment > now), plan.count(moment < oldest)
        shares.append(f"1.0D - try_divide({future}, {known}) - try_divide({old}, {known})")
    score, checked = _mean_where_known(shares)
    plan.scores["timeliness"] = (f"greatest(0.0D, least(1.0D, {score}))", checked)


def _accuracy(df: DataFrame, plan: _Plan, mode: str) -> None:
    """Share of numbers within three interquartile ranges of the quartiles."""
    names = numeric_columns(df)
    quartiles = quantile_values(df, names, (0.25, 0.75), mode)
    shares = []
    for name in (n for n in names if n in quartiles):
        q1, q3 = quartiles[name][0.25], quartiles[name][0.75]
        low, high = q1 - REACH * (q3 - q1), q3 + REACH * (q3 - q1)
        value = as_double(df, name)
        near = plan.count((value >= F.lit(low)) & (value <= F.lit(high)))
        shares.append(f"try_divide({near}, {plan.add(F.count(value))})")
    plan.scores["accuracy"] = _mean_where_known(shares)


def _with_uniqueness(
    df: DataFrame, scores: DataFrame, unique_columns: list[str] | None, mode: str
) -> DataFrame:
    names = unique_columns or [
        c for c in df.columns if any(p in c.lower() for p in KEY_NAME_PARTS)
    ]
    names = [c for c in names if c in df.columns]
    is_unique = F.col("dimension") == "uniqueness"
    if not names:
        return scores.withColumn("score", F.when(is_unique, 1.0).otherwise(F.col("score")))
    # The distinct values of all key columns together, put under the scores: report rows only.
    distinct = distinct_counts(df, names, approximate=mode == "approx").agg(
        F.coalesce(F.sum("distinct_count"), F.lit(0)).alias("distinct")
    ).select(
        F.lit("uniqueness").alias("dimension"), F.lit(None).cast("double").alias("score"),
        F.lit(len(names)).alias("columns_checked"), F.lit(None).cast("bigint").alias("row_count"),
        "distinct",
    )
    share = F.coalesce(
        F.try_divide(F.col("distinct"), F.col("row_count") * F.lit(len(names))), F.lit(1.0)
    )
    return (
        scores.withColumn("distinct", F.lit(None).cast("bigint"))
        .unionByName(distinct)
        .groupBy("dimension")
        .agg(*(F.max(c).alias(c) for c in ("score", "columns_checked", "row_count", "distinct")))
        .select(
            "dimension", F.when(is_unique, share).otherwise(F.col("score")).alias("score"),
            "columns_checked", "row_count",
        )
    )


def weighted(scores: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Scores with the weight of their dimension; dimensions without a given weight count 1."""
    known = WEIGHTS if weights is None else weights
    cases = " ".join(
        f"WHEN {literal(d)} THEN {literal(float(known.get(d, 1.0)))}" for d in DIMENSIONS
    )
    return scores.withColumn("weight", F.expr(f"CASE dimension {cases} END"))


def scorecard_long(
    df: DataFrame, as_of: str, weights: Mapping[str, float] | None = None, **options
) -> DataFrame:
    """One row per dimension: score, percentage, weight, columns checked."""
    return weighted(dimension_scores(df, as_of, **options), weights).select(
        "dimension", "score", (F.col("score") * 100).alias("percentage"), "weight",
        "columns_checked",
    )


def scorecard(
    df: DataFrame, name: str, as_of: str, weights: Mapping[str, float] | None = None, **options
) -> DataFrame:
    """One row: the six scores, the overall score and its grade."""
    long = weighted(dimension_scores(df, as_of, **options), weights)
    return combine(long).select(
        F.lit(name).alias("dataset"), "row_count", *DIMENSIONS, "overall_score", "grade"
    )


def combine(long: DataFrame) -> DataFrame:
    """Weighted scores in long form to one row with the overall score and grade."""
    total = F.sum(F.col("score") * F.col("weight"))
    missing = F.count(F.when(F.col("score").isNull(), 1)) > 0
    overall = F.when(~missing, F.try_divide(total, F.sum("weight")))
    columns = [F.max(F.when(F.col("dimension") == d, F.col("score"))).alias(d) for d in DIMENSIONS]
    extra = [F.max("row_count").alias("row_count")] if "row_count" in long.columns else []
    return long.agg(*extra, *columns, overall.alias("overall_score")).withColumn(
        "grade", grade(F.col("overall_score"))
    )


def grade(score: Column) -> Column:
    """Letter of a score; F also when there is no score."""
    letter = F.when(score >= GRADES[0][1], F.lit(GRADES[0][0]))
    for name, lowest in GRADES[1:]:
        letter = letter.when(score >= lowest, F.lit(name))
    return letter.otherwise(F.lit("F"))
