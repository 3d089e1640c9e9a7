"""Queries on the scorecard."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from veristrata.operators.scorecard import (
    DIMENSIONS,
    GRADES,
    WEIGHTS,
    dimension_scores,
    scorecard_long,
)
from veristrata.operators.scorecard import scorecard as one_scorecard
from veristrata.plans.together import together
from veristrata.workload.common import AS_OF, entities, entity, rounded, with_entities
from veristrata.workload.profiles import FLAGS, MOMENTS, NUMBERS, TEXTS, columns_of


def _dimension(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(dimension_scores(entity(spark, folder, "patients"), AS_OF, [name]))

    return run


def scorecard(spark: SparkSession, folder: str) -> DataFrame:
    cards = together([
        partial(one_scorecard, df, name, AS_OF) for name, df in entities(spark, folder).items()
    ])
    return rounded(reduce(DataFrame.unionByName, cards))


def scorecard_of_treatments(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scorecard_long(entity(spark, folder, "treatments"), AS_OF))


def scorecard_with_options(spark: SparkSession, folder: str) -> DataFrame:
    card = one_scorecard(
        entity(spark, folder, "patients"), "patients", AS_OF,
        weights={"completeness": 0.5, "uniqueness": 0.5},
        required_columns=["last_name", "phone", "absent"],
        unique_columns=["mrn", "absent"],
        date_columns=["primary_diagnosis_date"],
    )
    return rounded(card)


QUERIES = {f"score_{d}": _dimension(d) for d in DIMENSIONS} | {
    "scorecard": scorecard,
    "scorecard_long": scorecard_of_treatments,
    "scorecard_with_options": scorecard_with_options,
}


# ---- the same in SQL -----------------------------------------------------------------------

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def keys_of(name: str) -> list[str]:
    return [c for c in columns_of(name) if any(p in c for p in ("id", "mrn", "code"))]


def dates_of(name: str) -> list[str]:
    parts = ("date", "time", "created", "updated")
    return [c for c in columns_of(name) if any(p in c for p in parts) and c in MOMENTS[name]]


def _mean_over(name: str, values: list[str]) -> str:
    listed = " UNION ALL ".join(f"SELECT {v} AS s FROM {name}" for v in values)
    return f"(SELECT coalesce(avg(s), 1.0e0) AS score, count(s) AS n FROM ({listed}))"


def completeness_sql(name: str, columns: list[str] | None = None) -> str:
    names = columns or columns_of(name)
    return _mean_over(name, [f"count({c}) * 1.0e0 / count(*)" for c in names])


def uniqueness_sql(name: str, columns: list[str] | None = None) -> str:
    names = columns or keys_of(name)
    return _mean_over(name, [f"count(DISTINCT {c}) * 1.0e0 / count(*)" for c in names])


def validity_sql(name: str) -> str:
    values = [
        f"avg(CASE WHEN {c} IS NULL OR trim({c}) <> '' THEN 1.0e0 ELSE 0.0e0 END)"
        for c in TEXTS[name]
    ]
    values += [
        f"avg(CASE WHEN {c} IS NOT NULL AND isfinite(cast({c} AS double)) THEN 1.0e0 ELSE 0.0e0 END)"
        for c in NUMBERS[name]
    ]
    values += [f"count({c}) * 1.0e0 / count(*)" for c in FLAGS[name]]
    values += [f"any_value(1.0e0)" for _ in MOMENTS[name]]
    return _mean_over(name, values)


def consistency_sql(name: str) -> str:
    def share(test: str) -> str:
        return f"avg(CASE WHEN {test} THEN 1.0e0 ELSE 0.0e0 END)"

    values = []
    for c in TEXTS[name]:
        title = (
            f"NOT regexp_matches({c}, '(^|[^{_CASED}])\\p{{Ll}}') "
            f"AND NOT regexp_matches({c}, '[{_CASED}]\\p{{Lu}}')"
        )
        tests = (f"{c} = upper({c})", f"{c} = lower({c})", title)
        best = ", ".join(
            f"sum(CASE WHEN {c} IS NULL THEN NULL WHEN {t} THEN 1.0e0 ELSE 0.0e0 END) "
            f"/ nullif(count({c}), 0)" for t in tests)
        values.append(f"greatest({best})")
    return _mean_over(name, values)


def timeliness_sql(name: str, columns: list[str] | None = None) -> str:
    values = []
    for c in columns or dates_of(name):
        future = f"count(*) FILTER (WHERE {c} > timestamp '{AS_OF}')"
        old = f"count(*) FILTER (WHERE {c} < timestamp '2000-01-01 00:00:00')"
        known = f"nullif(count({c}), 0)"
        values.append(f"1.0e0 - {future} * 1.0e0 / {known} - {old} * 1.0e0 / {known}")
    return (
        "(SELECT greatest(0.0e0, least(1.0e0, score)) AS score, n FROM "
        f"{_mean_over(name, values)})"
    )


def accuracy_sql(name: str) -> str:
    values = []
    for c in NUMBERS[name]:
        q1, q3 = (f"(SELECT quantile_cont(cast({c} AS double), {p}) FROM {name})"
                  for p in (0.25, 0.75))
        inside = (
            f"{c} >= {q1} - 3.0e0 * ({q3} - {q1}) AND {c} <= {q3} + 3.0e0 * ({q3} - {q1})"
        )
        values.append(f"count(*) FILTER (WHERE {inside}) * 1.0e0 / nullif(count({c}), 0)")
    return _mean_over(name, values)


DIMENSION_SQL = {
    "completeness": completeness_sql, "uniqueness": uniqueness_sql, "validity": validity_sql,
    "consistency": consistency_sql, "timeliness": timeliness_sql, "accuracy": accuracy_sql,
}


def _dimension_sql(name: str, dimension: str) -> str:
    return (
        f"SELECT '{dimension}' AS dimension, round(score, 6) AS score, "
        f"cast(n AS int) AS columns_checked, (SELECT count(*) FROM {name}) AS row_count "
        f"FROM {DIMENSION_SQL[dimension](name)}"
    )


def _card_sql(name: str, sources: dict[str, str], weights: dict[str, float]) -> str:
    scores = ", ".join(f"round({d}, 6) AS {d}" for d in DIMENSIONS)
    parts = ", ".join(f"(SELECT score FROM {sources[d]}) AS {d}" for d in DIMENSIONS)
    total = " + ".join(f"{d} * {weights[d]}e0" for d in DIMENSIONS)
    overall = f"({total}) / {sum(weights.values())}e0"
    letters = " ".join(f"WHEN {overall} >= {low} THEN '{g}'" for g, low in GRADES)
    return (
        f"SELECT '{name}' AS dataset, (SELECT count(*) FROM {name}) AS row_count, {scores}, "
        f"round({overall}, 6) AS overall_score, CASE {letters} ELSE 'F' END AS grade "
        f"FROM (SELECT {parts})"
    )


def _standard(name: str) -> dict[str, str]:
    return {d: make(name) for d, make in DIMENSION_SQL.items()}


ALL = with_entities("patients", "treatments", "lab_results")
ORACLES = {
    f"score_{d}": with_entities("patients") + _dimension_sql("patients", d) for d in DIMENSIONS
} | {
    "scorecard": ALL + "\nUNION ALL\n".join(
        _card_sql(n, _standard(n), WEIGHTS) for n in ("patients", "treatments", "lab_results")),
    "scorecard_long": with_entities("treatments") + "\nUNION ALL\n".join(
        f"SELECT '{d}' AS dimension, round(score, 6) AS score, round(score * 100, 6) AS percentage, "
        f"{WEIGHTS[d]}e0 AS weight, cast(n AS int) AS columns_checked "
        f"FROM {DIMENSION_SQL[d]('treatments')}" for d in DIMENSIONS),
    "scorecard_with_options": with_entities("patients") + _card_sql(
        "patients",
        _standard("patients") | {
            "completeness": completeness_sql("patients", ["last_name", "phone"]),
            "uniqueness": uniqueness_sql("patients", ["mrn"]),
            "timeliness": timeliness_sql("patients", ["primary_diagnosis_date"]),
        },
        {d: {"completeness": 0.5, "uniqueness": 0.5}.get(d, 1.0) for d in DIMENSIONS},
    ),
}
