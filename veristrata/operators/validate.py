"""Suites over tables: all row rules in one aggregate, all uniqueness rules in one shuffle."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.functions.columns import field, literal, normalize_missing, result_rows
from veristrata.operators.checks import (
    SKIPPED,
    Check,
    DistinctCheck,
    RowCheck,
    RowCountCheck,
    StaticCheck,
    compile_rule,
)
from veristrata.operators.frequencies import distinct_counts, identity_text, value_counts
from veristrata.operators.hotkeys import hot_and_rest, key_filter
from veristrata.operators.selection import first_rows
from veristrata.plans.suite import UNIQUE, Rule, Suite
from veristrata.session import stored


def validate(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per rule with its counts.

    ``success`` is what the evaluator observes: no tolerance, pair rules always ``>=``, and four
    declared rule types passed over (``status = 'skipped'``). ``success_declared`` is what the suite
    asks for. Both come from the same counts, hence from the same scan.
    """
    return _judge(_counted(df, suite)) if suite.rules else _no_results(df.sparkSession)


def validate_with(
    df: DataFrame, suite: Suite, aggregates: Sequence[Column], figures: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Verdicts of a suite and other figures of the same scan, ``(section, metric, value, success)``.

    A rule is a row of section ``validation`` with its success; a figure ``(section, metric, value)`` is a row with its
    value, SQL text over the names of the ``aggregates``, which are taken over the same rows as the counts of the rules.
    """
    rows = [
        {"section": literal(section), "metric": literal(metric), "value": f"cast({value} AS double)"}
        for section, metric, value in figures
    ]
    judged = _judge(_counted(df, suite, aggregates, rows), ("section", "metric", "value"))
    return judged.select(
        F.coalesce("section", F.lit("validation")).alias("section"), "metric", "value",
        F.when(F.col("section").isNull(), F.col("success")).alias("success"),
    )


def _counted(
    df: DataFrame, suite: Suite, aggregates: Sequence[Column] = (), figures: Sequence[dict[str, str]] = ()
) -> DataFrame:
    """The counts of each rule, still to be judged, and rows of other figures of the same scan."""
    df = normalize_missing(df)
    checks = [compile_rule(df, rule) for rule in suite.rules]
    counts = _Counts()
    rows = [_rule_row(suite, i, r, c, counts) for i, (r, c) in enumerate(zip(suite.rules, checks))]
    if figures:
        missing = _rule_row(suite, -1, Rule("figure"), StaticCheck(None, None), counts)
        blank = {"section": "cast(NULL AS string)", "metric": "cast(NULL AS string)", "value": "cast(NULL AS double)"}
        rows = [{**row, **blank} for row in rows] + [{**missing, **{k: f[k] for k in blank}} for f in figures]
    long = df.agg(*counts.aggregates, *aggregates).select(result_rows(rows))
    distinct = list(dict.fromkeys(c.column for c in checks if isinstance(c, DistinctCheck)))
    if distinct:
        uniques = distinct_counts(df, distinct).withColumnRenamed("column", "distinct_column")
        # One row per uniqueness rule on either side.
        long = long.join(F.broadcast(uniques), "distinct_column", "left")
    else:
        for name in ("distinct_count", "repeated_values", "repeated_rows"):
            long = long.withColumn(name, _null("bigint"))
    return long


def validate_many(tables: Mapping[str, tuple[DataFrame, Suite]]) -> DataFrame:
    """Several tables against their suites, with the table name in front."""
    parts = [
        validate(df, suite).select(F.lit(name).alias("dataset"), "*")
        for name, (df, suite) in tables.items()
    ]
    if not parts:
        return _no_results(SparkSession.active()).select(F.lit("").alias("dataset"), "*")
    return reduce(DataFrame.unionByName, parts)


def validate_table(
    spark: SparkSession,
    table: str,
    suite: Suite,
    schema: str | None = None,
    limit: int | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """A catalog table against a suite, optionally its first ``limit`` rows in a given order.

    Limited rows are stored first: without an order, two passes over a limit may see different rows.
    """
    df = spark.table(f"{schema}.{table}" if schema else table)
    return validate(first_rows(df, limit, order_by) if limit else df, suite)


def statistics(results: DataFrame, by: tuple[str, ...] = ("suite",), suite: str | None = None) -> DataFrame:
    """Evaluated, successful and failed rules, the success percent, and overall success.

    With the name of the ``suite`` there is always its one row: a suite without rules passes, at 0 percent.
    """
    passed, declared = F.count_if("success"), F.count_if("success_declared")
    total = F.count("*")
    if suite is not None:
        nothing = F.coalesce(F.try_divide(passed, total) * 100, F.lit(0.0))
        nothing_declared = F.coalesce(F.try_divide(declared, total) * 100, F.lit(0.0))
        return results.agg(
            total.alias("evaluated"), passed.alias("successful"), (total - passed).alias("unsuccessful"),
            nothing.alias("success_percent"), nothing_declared.alias("success_percent_declared"),
            F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
            F.coalesce(F.bool_and("success_declared"), F.lit(True)).alias("success_declared"),
        ).select(F.lit(suite).alias("suite"), "*")
    return results.groupBy(*by).agg(
        total.alias("evaluated"),
        passed.alias("successful"),
        (total - passed).alias("unsuccessful"),
        (F.try_divide(passed, total) * 100).alias("success_percent"),
        (F.try_divide(declared, total) * 100).alias("success_percent_declared"),
        F.bool_and("success").alias("success"),
        F.bool_and("success_declared").alias("success_declared"),
    )


def failed_rules(results: DataFrame, declared: bool = False) -> DataFrame:
    """The rules that did not pass."""
    return results.filter(~F.col("success_declared" if declared else "success"))


def success_percent(passed: int, evaluated: int) -> float:
    """Share of passed rules in percent; 0 when nothing was evaluated."""
    return passed / evaluated * 100 if evaluated else 0.0


def summary_text(results: DataFrame, first: int = 5) -> str:
    """Readable summary of one validation with its first failures (a handful of report rows)."""
    rows = results.orderBy("idx").collect()
    passed = sum(r.success for r in rows)
    lines = [
        f"Validation of {rows[0].suite if rows else '-'}",
        f"Overall: {'PASSED' if passed == len(rows) else 'FAILED'}",
        f"Passed {passed} of {len(rows)} rules ({success_percent(passed, len(rows)):.1f}%)",
    ]
    failures = [r for r in rows if not r.success]
    lines += [f"  - {r.expectation_type} {r.column or ''}".rstrip() for r in failures[:first]]
    return "\n".join(lines)


def unexpected_rows(df: DataFrame, suite: Suite, declared: bool = True) -> DataFrame:
    """The rows that break at least one rule, with the positions of those rules in the suite.

    Values that occur more than once are found by one shuffle of value counts. Only rows that may have such a value are
    shuffled to be marked, those of very frequent values not even then (see ``hotkeys``).
    """
    original, df = df.columns, normalize_missing(df)
    marks: list[Column] = []
    unique: dict[str, str] = {}  # column -> flag
    for idx, rule in enumerate(suite.rules):
        check = compile_rule(df, rule)
        if isinstance(check, RowCheck) and (declared or rule.kind not in SKIPPED):
            bad = check.bad
            if declared and check.bad_declared is not None:
                bad = check.bad_declared
            marks.append(F.when(bad, F.lit(idx)))
        elif isinstance(check, DistinctCheck) and rule.kind == UNIQUE:
            flag = unique.setdefault(check.column, f"_repeated_{len(unique)}")
            marks.append(F.when(field(flag), F.lit(idx)))
    if unique:
        df = _mark_repeated(df, unique)
    broken = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<int>")
    return df.select(*(field(c) for c in original), broken.alias("violations")).filter(
        F.size("violations") > 0
    )


def _mark_repeated(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Adds a flag for each column: whether the row's value of it occurs more than once (else NULL)."""
    repeated = stored(
        value_counts(df, list(flags), identities=True).filter("occurrences > 1"), "repeated-values"
    )
    keys = {c: f"_key{i}" for i, c in enumerate(flags)}
    rows = df.select("*", *(identity_text(df, c).alias(k) for c, k in keys.items()))
    rest, possible = {}, {}
    for column, flag in flags.items():
        key = keys[column]
        own = repeated.filter(F.col("column") == column).select(F.col("value").alias(key), "occurrences")
        hot, others, count = hot_and_rest(own, "occurrences")
        if not count:
            rows = rows.withColumn(flag, F.lit(None).cast("boolean"))
            continue
        few = F.broadcast(hot.select(key, F.lit(True).alias(flag)))  # at most a thousand values
        rows = rows.join(few, key, "left")
        rest[column] = others.select(F.col(key).alias(f"{key}_again"), F.lit(True).alias(f"{flag}_again"))
        possible[column] = field(flag).isNull() & key_filter(own, key)(field(key))
    if not rest:
        return rows
    some = reduce(Column.__or__, possible.values())
    marked = rows.filter(some)
    row_hash = F.concat(F.lit("\x00absent:"), F.xxhash64(*(field(c) for c in df.columns)).cast("string"))
    for column, others in rest.items():
        # Rows that surely match nothing are dealt by their own hash.
        key, flag = keys[column], flags[column]
        on = F.when(possible[column], field(key)).otherwise(row_hash)
        joined = marked.withColumn("_on", on).join(others, F.col("_on") == field(f"{key}_again"), "left")
        marked = joined.withColumn(f"{flag}_found", F.coalesce(field(flag), field(f"{flag}_again"))).drop(
            "_on", f"{key}_again", f"{flag}_again"
        )
    for flag in (flags[c] for c in rest):
        marked = marked.withColumn(flag, field(f"{flag}_found")).drop(f"{flag}_found")
    return rows.filter(~some).unionByName(marked.select(*(field(c) for c in rows.columns)))


_RESULT = [
    ("suite", "string"), ("idx", "int"), ("expectation_type", "string"), ("column", "string"),
    ("kwargs", "string"), ("element_count", "bigint"), ("null_count", "bigint"),
    ("unexpected_count", "bigint"), ("success", "boolean"), ("success_declared", "boolean"),
    ("status", "string"), ("error", "string"),
]


def _no_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in _RESULT))


class _Counts:
    """Collects the aggregates of a suite; Spark evaluates equal ones once."""

    def __init__(self) -> None:
        self.aggregates: list[Column] = [F.count(F.lit(1)).alias("n")]

    def of(self, condition: Column) -> str:
        """Number of rows where the condition holds; the name of the aggregate."""
        return self._add(F.count(F.when(condition, F.lit(1))))

    def known(self, column: str) -> str:
        return self._add(F.count(field(column)))

    def _add(self, aggregate: Column) -> str:
        name = f"c{len(self.aggregates)}"
        self.aggregates.append(aggregate.alias(name))
        return name


def _null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def _rule_row(suite: Suite, idx: int, rule: Rule, check: Check, counts: _Counts) -> dict[str, str]:
    """The row of one rule as SQL text over the counts, still to be judged."""
    no_count, no_flag = "cast(NULL AS bigint)", "cast(NULL AS boolean)"
    considered = bad = bad_declared = nulls = no_count
    fixed = fixed_declared = no_flag
    kind, status, distinct_column, type_error = "static", "evaluated", None, False
    if isinstance(check, RowCheck):
        kind, type_error = "row", check.type_error
        bad = counts.of(check.bad)
        bad_declared = bad if check.bad_declared is None else counts.of(check.bad_declared)
        considered = "n" if check.considered is None else counts.of(check.considered)
        column = rule.params.get("column")
        nulls = f"n - {counts.known(column)}" if column else f"n - {considered}"
    elif isinstance(check, DistinctCheck):
        kind, distinct_column = "proportion" if check.proportion else "unique", check.column
        considered = counts.known(check.column)
        nulls = f"n - {considered}"
    elif isinstance(check, RowCountCheck):
        kind = "row_count"
    elif isinstance(check, StaticCheck):
        status = check.status
        fixed, fixed_declared = literal(check.success), literal(check.success_declared)
        bad = bad_declared = f"cast({literal(check.unexpected)} AS bigint)"
    if rule.kind in SKIPPED:
        status = "skipped"
    low, high = (
        literal(float(b) if _is_number(b) else None)
        for b in (rule.params.get("min_value"), rule.params.get("max_value"))
    )
    return {
        "suite": literal(suite.name),
        "idx": literal(idx),
        "expectation_type": literal(rule.kind),
        "column": f"cast({literal(rule.column)} AS string)",
        "kwargs": literal(json.dumps(rule.params, default=str)),
        "element_count": "n",
        "null_count": nulls,
        "considered": considered,
        "bad": bad,
        "bad_declared": bad_declared,
        "fixed": fixed,
        "fixed_declared": fixed_declared,
        "kind": literal(kind),
        "status": literal(status),
        "type_error": literal(type_error),
        "mostly": literal(rule.mostly),
        "low": f"cast({low} AS double)",
        "high": f"cast({high} AS double)",
        "distinct_column": f"cast({literal(distinct_column)} AS string)",
    }


def _is_number(value: object) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _judge(long: DataFrame, others: Sequence[str] = ()) -> DataFrame:
    """Both verdicts from the counts; ``others`` are kept."""
    repeated, failed_type = "coalesce(repeated_rows, 0)", "(type_error AND considered > 0)"

    def within(value: str) -> str:
        return f"(coalesce({value} >= low, true) AND coalesce({value} <= high, true))"

    share = "try_divide(considered - bad_declared, considered)"
    proportion = "try_divide(coalesce(distinct_count, 0), considered)"
    return long.selectExpr(
        *others, "suite", "idx", "expectation_type", "`column`", "kwargs", "element_count", "null_count",
        f"CASE WHEN kind = 'unique' THEN {repeated} ELSE bad END AS unexpected_count",
        f"""CASE WHEN status = 'skipped' THEN true
            WHEN kind = 'static' THEN fixed
            WHEN kind = 'row_count' THEN {within('element_count')}
            WHEN kind = 'unique' THEN {repeated} = 0 AND null_count <= 1
            ELSE bad = 0 AND NOT {failed_type} END AS success""",
        f"""CASE WHEN kind = 'static' THEN fixed_declared
            WHEN kind = 'row_count' THEN {within('element_count')}
            WHEN kind = 'unique' THEN {repeated} = 0
            WHEN kind = 'proportion' THEN coalesce({within(proportion)}, true)
            ELSE coalesce({share} >= mostly, true) AND NOT {failed_type} END AS success_declared""",
        f"CASE WHEN {failed_type} THEN 'error' ELSE status END AS status",
        f"CASE WHEN {failed_type} THEN 'type' END AS error",
    )
