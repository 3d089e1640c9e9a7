"""Queries on rules and suites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.functions import coding
from veristrata.functions.columns import field
from veristrata.operators.checks import register_rule
from veristrata.operators.validate import (
    failed_rules,
    statistics,
    unexpected_rows,
    validate,
    validate_many,
)
from veristrata.plans import catalog
from veristrata.plans import suite as S
from veristrata.plans.suite import Rule, Suite
from veristrata.workload.common import base, entities, entity, with_entities

COLUMNS = [
    "suite", "idx", "expectation_type", "column", "element_count", "null_count",
    "unexpected_count", "success", "success_declared", "status", "error",
]

# Treatments with the start date as text, every fiftieth unreadable.
TEXT_DATES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN 'n/a' WHEN o_orderkey % 70 = 3 THEN NULL
 ELSE cast(cast(o_orderdate AS date) AS string) END AS start_text FROM orders
"""


def _suite() -> Suite:
    return Suite("check")


# Small suites: key -> (table, suite).
CHECKS: dict[str, tuple[str, Suite]] = {
    "val_not_null": ("patients", _suite().not_null("last_name", "mrn", "phone")),
    "val_unique": ("patients", _suite().unique("patient_id", "mrn", "phone", "no_such_column")),
    "val_in_set": (
        "treatments",
        _suite().in_set("route", [*coding.ROUTES, None]).in_set("status", coding.TREATMENT_STATUSES),
    ),
    "val_regex": (
        "patients",
        _suite().regex("mrn", coding.MRN).regex("zip_code", coding.ZIP)
        .regex("state", coding.STATE).regex("cancer_stage", coding.STAGE).regex("city", "[A-F]"),
    ),
    "val_regex_icd10": ("patients", _suite().icd10_oncology("primary_diagnosis_code")),
    "val_regex_ndc": ("treatments", _suite().ndc("drug_code")),
    "val_regex_loinc": ("lab_results", _suite().loinc("test_code")),
    "val_between": (
        "treatments",
        _suite().between("dosage", 0).between("cycles_planned", 1, 50)
        .between("cycles_completed", None, 40).between("drug_code", 0, 1),
    ),
    "val_pair_ge": ("treatments", _suite().greater("end_date", "start_date", or_equal=True)),
    "val_pair_gt_declared": (
        "treatments",
        _suite().greater("updated_at", "created_at").greater("end_date", "start_date"),
    ),
    "val_row_count": ("patients", _suite().row_count(1).row_count(1, 100).row_count(None, 10**9)),
    "val_columns_match_set": (
        "patients",
        _suite().columns_match(catalog.PATIENT_COLUMNS)
        .columns_match(catalog.PATIENT_COLUMNS, exact=True).columns_match(["mrn", "absent"])
        .exists("mrn").exists("absent"),
    ),
    "val_unique_proportion": (
        "lab_results",
        _suite().unique_proportion("test_code", 0.001, 1.0)
        .unique_proportion("test_name", 0.0, 0.5).unique_proportion("patient_id", 0.0, 0.001),
    ),
    "val_mostly": (
        "treatments",
        _suite().ndc("drug_code", 0.8).between("dosage", 0, mostly=0.95)
        .in_set("route", coding.ROUTES, mostly=0.95).between("cycles_planned", 1, 50, mostly=0.9),
    ),
    "val_suite_patients": ("patients", catalog.patients()),
    "val_suite_treatments": ("treatments", catalog.treatments()),
    "val_suite_lab_results": ("lab_results", catalog.lab_results()),
}


def _check(table: str, suite: Suite) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return validate(entity(spark, folder, table), suite).select(*COLUMNS)

    return run


# The same dates in several written forms; the SQL has them in one.
MIXED_DATES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN 'n/a' WHEN o_orderkey % 70 = 3 THEN NULL
 ELSE date_format(o_orderdate, element_at(array('yyyy-MM-dd', 'MM/dd/yyyy', 'M/d/yyyy', 'yyyyMMdd',
  'MMM d, yyyy', 'd MMMM yyyy', 'yyyy/MM/dd'), cast(o_orderkey % 7 AS int) + 1)) END AS start_text,
 date_format(date_add(o_orderdate, cast(o_orderkey % 5 AS int) - 1), 'M/d/yyyy') AS end_text FROM {orders}
"""
MIXED_DATES_SQL = """
SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'n/a' WHEN o_orderkey % 70 = 3 THEN NULL
 ELSE cast(cast(o_orderdate AS date) AS string) END AS start_text,
 CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 70 = 3 THEN NULL ELSE cast(o_orderdate AS date) END AS d,
 cast(o_orderdate AS date) + cast(o_orderkey % 5 - 1 AS int) AS e FROM orders
"""


def val_date_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Dates in several forms, and a pair of them in order; the SQL knows the dates behind the texts."""
    dated = spark.sql(MIXED_DATES, orders=base(spark, folder, "orders"))
    suite = Suite("check").date_parseable("start_text").greater("end_text", "start_text", or_equal=True)
    return validate(dated, suite).select("expectation_type", "element_count", "null_count", "unexpected_count")


def val_date_parseable(spark: SparkSession, folder: str) -> DataFrame:
    text = TEXT_DATES.replace("FROM orders", "FROM {orders}")
    df = spark.sql(text, orders=base(spark, folder, "orders"))
    return validate(df, Suite("check").date_parseable("start_text")).select(*COLUMNS)


def _three(spark: SparkSession, folder: str, suites) -> dict[str, tuple[DataFrame, Suite]]:
    tables = entities(spark, folder)
    return {n: (tables[n], suites[catalog.DATASET_SUITES[n]]()) for n in tables}


def val_builtin_suites(spark: SparkSession, folder: str) -> DataFrame:
    results = validate_many(_three(spark, folder, catalog.STANDARD_SHORT))
    return results.select("dataset", *COLUMNS)


def val_all_suites(spark: SparkSession, folder: str) -> DataFrame:
    return validate_many(_three(spark, folder, catalog.STANDARD)).select("dataset", *COLUMNS)


def val_success_percent(spark: SparkSession, folder: str) -> DataFrame:
    stats = statistics(validate_many(_three(spark, folder, catalog.STANDARD)))
    return stats.select(
        "suite", "evaluated", "successful", "unsuccessful",
        F.round("success_percent", 6).alias("success_percent"),
        F.round("success_percent_declared", 6).alias("success_percent_declared"),
        "success", "success_declared",
    )


def val_failed_rules(spark: SparkSession, folder: str) -> DataFrame:
    results = validate_many(_three(spark, folder, catalog.STANDARD))
    return failed_rules(results).select("suite", "idx", "expectation_type", "unexpected_count")


def val_unexpected_rows(spark: SparkSession, folder: str) -> DataFrame:
    bad = unexpected_rows(entity(spark, folder, "patients"), catalog.patients())
    rules = F.array_join(F.transform("violations", lambda v: v.cast("string")), ",")
    return bad.select("patient_id", rules.alias("rules"))


OUTER_SPACE = "expect_column_values_without_outer_space"
register_rule(OUTER_SPACE, lambda df, p: F.trim(field(p["column"])) != field(p["column"]))


def custom_rule(spark: SparkSession, folder: str) -> DataFrame:
    suite = Suite("check").add(OUTER_SPACE, column="last_name").add(OUTER_SPACE, column="city")
    return validate(entity(spark, folder, "patients"), suite).select(*COLUMNS)


QUERIES = {key: _check(table, suite) for key, (table, suite) in CHECKS.items()} | {
    "val_date_parseable": val_date_parseable,
    "val_date_forms": val_date_forms,
    "val_builtin_suites": val_builtin_suites,
    "val_all_suites": val_all_suites,
    "val_success_percent": val_success_percent,
    "val_failed_rules": val_failed_rules,
    "val_unexpected_rows": val_unexpected_rows,
    "custom_rule": custom_rule,
}


# ---- the same in SQL -----------------------------------------------------------------------

COLUMNS_OF = {
    "patients": [*catalog.PATIENT_COLUMNS, "balance"],
    "treatments": catalog.TREATMENT_COLUMNS,
    "lab_results": catalog.LAB_RESULT_COLUMNS,
}
TEXT_COLUMNS = {"drug_code", "mrn"}


def _quote(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _within(value: str, p: dict) -> str:
    tests = [f"{value} >= {p['min_value']}" if "min_value" in p else "",
             f"{value} <= {p['max_value']}" if "max_value" in p else ""]
    return " AND ".join(t for t in tests if t) or "true"


def _bad_row(rule: Rule, table: str) -> str:
    """SQL that is true for rows that break a row-wise rule (as observed)."""
    p, c = rule.params, rule.params.get("column")
    if rule.kind == S.NOT_NULL:
        return f"{c} IS NULL"
    if rule.kind == S.IN_SET:
        members = ", ".join(_quote(v) for v in p["value_set"] if v is not None)
        return f"{c} NOT IN ({members})"
    if rule.kind == S.REGEX:
        return f"NOT regexp_matches({c}, '^(?:{p['regex']})')"
    if rule.kind == S.BETWEEN:
        return f"NOT ({_within(c, p)})"
    if rule.kind == S.PAIR_GREATER:
        return f"cast({p['column_A']} AS timestamp) < cast({p['column_B']} AS timestamp)"
    if rule.kind == S.DATE_PARSEABLE:
        return f"{c} IS NOT NULL AND try_cast({c} AS timestamp) IS NULL"
    if rule.kind == OUTER_SPACE:
        return f"trim({c}) <> {c}"
    raise ValueError(rule.kind)


def rule_sql(table: str, suite: Suite, idx: int, rule: Rule, columns: list[str]) -> str:
    """One result row of a rule."""
    p, c, kind = rule.params, rule.params.get("column"), rule.kind
    head = (
        f"SELECT '{suite.name}' AS suite, {idx} AS idx, '{kind}' AS expectation_type, "
        f"{_quote(rule.column) if rule.column else 'cast(NULL AS varchar)'} AS \"column\", "
        "count(*) AS element_count, "
    )
    no_count, no_error = "cast(NULL AS bigint)", "cast(NULL AS varchar) AS error"

    def tail(nulls, bad, ok, declared, status="evaluated", error=no_error):
        return (
            head + f"{nulls} AS null_count, {bad} AS unexpected_count, {ok} AS success, "
            f"{declared} AS success_declared, '{status}' AS status, {error} FROM {table}"
        )

    if kind == S.EXISTS:
        found = str(c in columns).lower()
        return tail(no_count, no_count, found, found)
    if kind == S.COLUMN_SET:
        off = set(p["column_set"]) - set(columns)
        off |= (set(columns) - set(p["column_set"])) if p["exact_match"] else set()
        off_count = f"cast({len(off)} AS bigint)"
        return tail(no_count, off_count, "true", str(not off).lower(), "skipped")
    if kind == S.TYPE_LIST:
        return tail(no_count, no_count, "true", "true", "skipped")
    if kind == S.ROW_COUNT:
        ok = _within("count(*)", p)
        return tail(no_count, no_count, ok, ok)
    if c is not None and c not in columns:
        return tail(no_count, no_count, "false", "false", "missing_column")
    if kind == S.UNIQUE:
        again = (
            f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} "
            f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
        )
        nulls = f"count(*) - count({c})"
        return tail(nulls, f"cast({again} AS bigint)", f"{again} = 0 AND {nulls} <= 1", f"{again} = 0")
    if kind == S.UNIQUE_PROPORTION:
        share = f"(count(DISTINCT {c}) * 1.0e0 / nullif(count({c}), 0))"
        return tail(f"count(*) - count({c})", no_count, "true",
                    f"coalesce({_within(share, p)}, true)", "skipped")
    considered = f"count({c})"
    nulls = f"count(*) - count({c})"
    if kind == S.NOT_NULL:
        considered = "count(*)"
    if kind == S.PAIR_GREATER:
        considered = f"count(*) FILTER (WHERE {p['column_A']} IS NOT NULL AND {p['column_B']} IS NOT NULL)"
        nulls = f"count(*) - {considered}"
    if kind == S.BETWEEN and c in TEXT_COLUMNS:
        some = f"count({c}) > 0"
        return (
            head + f"{nulls} AS null_count, cast(0 AS bigint) AS unexpected_count, "
            f"NOT ({some}) AS success, NOT ({some}) AS success_declared, "
            f"CASE WHEN {some} THEN 'error' ELSE 'evaluated' END AS status, "
            f"CASE WHEN {some} THEN 'type' END AS error FROM {table}"
        )
    bad = f"count(*) FILTER (WHERE {_bad_row(rule, table)})"
    bad_declared = bad
    if kind == S.PAIR_GREATER and not p["or_equal"]:
        bad_declared = bad.replace(" < ", " <= ")
    declared = (
        f"coalesce(({considered} - {bad_declared}) * 1.0e0 / nullif({considered}, 0) "
        f">= {rule.mostly}, true)"
    )
    status = "skipped" if kind == S.DATE_PARSEABLE else "evaluated"
    return tail(nulls, bad, "true" if status == "skipped" else f"{bad} = 0", declared, status)


def suite_sql(table: str, suite: Suite, columns: list[str] | None = None) -> str:
    names = columns or COLUMNS_OF[table]
    return "\nUNION ALL\n".join(
        rule_sql(table, suite, i, r, names) for i, r in enumerate(suite.rules)
    )


def _all_sql(suites) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS dataset, t.* FROM ({suite_sql(n, suites[s]())}) t"
        for n, s in catalog.DATASET_SUITES.items()
    )


ENTITIES = with_entities("patients", "treatments", "lab_results")
ORACLES = {
    key: with_entities(table) + suite_sql(table, suite) for key, (table, suite) in CHECKS.items()
} | {
    "val_date_parseable": f"WITH dated AS ({TEXT_DATES})\n"
    + suite_sql("dated", Suite("check").date_parseable("start_text"), ["start_text"]),
    "val_date_forms": f"""WITH dated AS ({MIXED_DATES_SQL})
SELECT 'expect_column_values_to_be_dateutil_parseable' AS expectation_type, count(*) AS element_count,
 count(*) - count(start_text) AS null_count, count(*) FILTER (WHERE start_text IS NOT NULL AND d IS NULL)
 AS unexpected_count FROM dated
UNION ALL SELECT 'expect_column_pair_values_A_to_be_greater_than_B', count(*), count(*) - count(d),
 count(*) FILTER (WHERE e < d) FROM dated""",
    "val_builtin_suites": ENTITIES + _all_sql(catalog.STANDARD_SHORT),
    "val_all_suites": ENTITIES + _all_sql(catalog.STANDARD),
    "val_success_percent": ENTITIES + f"""
SELECT suite, count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
 count(*) FILTER (WHERE NOT success) AS unsuccessful,
 round(100.0e0 * count(*) FILTER (WHERE success) / count(*), 6) AS success_percent,
 round(100.0e0 * count(*) FILTER (WHERE success_declared) / count(*), 6) AS success_percent_declared,
 bool_and(success) AS success, bool_and(success_declared) AS success_declared
FROM ({_all_sql(catalog.STANDARD)}) GROUP BY suite""",
    "val_failed_rules": ENTITIES + f"""
SELECT suite, idx, expectation_type, unexpected_count
FROM ({_all_sql(catalog.STANDARD)}) WHERE NOT success""",
    "custom_rule": with_entities("patients") + suite_sql(
        "patients",
        Suite("check").add(OUTER_SPACE, column="last_name").add(OUTER_SPACE, column="city"),
    ),
}


def _unexpected_sql() -> str:
    marks = []
    for i, rule in enumerate(catalog.patients().rules):
        if rule.kind in (S.COLUMN_SET, S.ROW_COUNT):
            continue
        if rule.kind == S.UNIQUE:
            c = rule.params["column"]
            bad = f"{c} IN (SELECT {c} FROM patients GROUP BY {c} HAVING count(*) > 1)"
        else:
            bad = _bad_row(rule, "patients")
            if rule.kind == S.PAIR_GREATER:
                bad = bad.replace(" < ", " <= ")
        marks.append(f"CASE WHEN {bad} THEN '{i}' END")
    return with_entities("patients") + (
        f"SELECT * FROM (SELECT patient_id, concat_ws(',', {', '.join(marks)}) AS rules "
        "FROM patients) WHERE rules <> ''"
    )


ORACLES["val_unexpected_rows"] = _unexpected_sql()
