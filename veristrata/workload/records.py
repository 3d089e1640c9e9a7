"""Queries on record constraints, derived fields and references between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.functions import coding
from veristrata.operators import integrity
from veristrata.operators.records import (
    ENTITIES,
    inconsistent_flags,
    quarantined_rows,
    standardize,
    tiered_round,
    violation_counts,
    with_derived_status,
    with_range_flags,
)
from veristrata.workload.common import AS_OF, entities, entity, rounded, with_entities

# A moment between the treatments' dates, so that all states occur.
MID_DATES = "1998-06-01 00:00:00"


def _violations(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return violation_counts(entity(spark, folder, name), name, AS_OF)

    return run


# Faults put into the lab results, as the same text for both engines.
LAB_FAULTS = {
    "result_unit": "CASE WHEN result_id LIKE '%7' THEN repeat('u', 60) ELSE result_unit END",
    "test_category": "CASE WHEN result_id LIKE '%13' THEN 'unheard of' ELSE test_category END",
    "specimen_type": "CASE WHEN result_id LIKE '%21' THEN NULL ELSE specimen_type END",
    "performing_lab": "CASE WHEN result_id LIKE '%40' THEN repeat('l', 201) ELSE performing_lab END",
    "patient_id": "CASE WHEN result_id LIKE '%99' THEN NULL ELSE patient_id END",
}


def rec_violations_faulty_labs(spark: SparkSession, folder: str) -> DataFrame:
    labs = entity(spark, folder, "lab_results").withColumns({c: F.expr(e) for c, e in LAB_FAULTS.items()})
    return violation_counts(labs, "lab_results", AS_OF)


def rec_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    bad = quarantined_rows(entity(spark, folder, "patients"), "patients", AS_OF)
    return bad.select("patient_id", F.array_join("violations", ",").alias("rules"))


def rec_standardize(spark: SparkSession, folder: str) -> DataFrame:
    clean = standardize(entity(spark, folder, "patients"), "patients")
    return clean.select("patient_id", "last_name", "race", "ethnicity", "city", "phone")


def rec_plain_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids given as 16 bytes, as the text of a UUID; enumerations as text."""
    given = entity(spark, folder, "patients").withColumn("patient_id", F.unhex(F.md5(F.col("patient_id").cast("binary"))))
    return standardize(given, "patients", as_text=True).select("patient_id", "gender", "race", "cancer_type")


def rec_range_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = with_range_flags(entity(spark, folder, "lab_results"))
    return flagged.groupBy("test_code", "derived_abnormal", "derived_critical").agg(
        F.count(F.lit(1)).alias("rows")
    )


def rec_status_from_dates(spark: SparkSession, folder: str) -> DataFrame:
    derived = with_derived_status(entity(spark, folder, "treatments"), MID_DATES)
    return derived.groupBy("derived_status").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("derived_cycles").alias("cycles")
    )


def rec_tiered_round(spark: SparkSession, folder: str) -> DataFrame:
    labs = entity(spark, folder, "lab_results")
    return rounded(
        labs.groupBy(tiered_round(F.col("result_value")).alias("rounded")).agg(
            F.count(F.lit(1)).alias("rows")
        )
    )


def rec_flag_consistency(spark: SparkSession, folder: str) -> DataFrame:
    return inconsistent_flags(with_range_flags(entity(spark, folder, "lab_results")),
                              "is_abnormal", "derived_critical")


def ref_integrity_orphans(spark: SparkSession, folder: str) -> DataFrame:
    t = entities(spark, folder)
    found = integrity.orphans(t["treatments"], t["patients"], "patient_id")
    return found.select("treatment_id", "patient_id")


def ref_orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    t = entities(spark, folder)
    return integrity.orphan_keys(t["treatments"], t["patients"], "patient_id")


def children_per_parent(spark: SparkSession, folder: str) -> DataFrame:
    """Over parents of which every third is there twice: they count once, with their children once."""
    t = entities(spark, folder)
    twice = t["patients"].union(t["patients"].where(F.pmod(F.xxhash64("patient_id"), F.lit(3)) == 0))
    return rounded(integrity.children_per_parent(twice, t["treatments"], "patient_id"))


def lookup_reference_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.check_lab_reference(entity(spark, folder, "lab_results"))


def lookup_diagnosis_codes(spark: SparkSession, folder: str) -> DataFrame:
    wrong = integrity.diagnosis_mismatches(entity(spark, folder, "patients"))
    return wrong.select("patient_id", "cancer_type", "primary_diagnosis_code")


QUERIES = {f"rec_violations_{n}": _violations(n) for n in ENTITIES} | {
    "rec_violations_faulty_labs": rec_violations_faulty_labs,
    "rec_quarantine": rec_quarantine,
    "rec_standardize": rec_standardize,
    "rec_plain_texts": rec_plain_texts,
    "rec_range_flags": rec_range_flags,
    "rec_status_from_dates": rec_status_from_dates,
    "rec_tiered_round": rec_tiered_round,
    "rec_flag_consistency": rec_flag_consistency,
    "ref_integrity_orphans": ref_integrity_orphans,
    "ref_orphan_keys": ref_orphan_keys,
    "children_per_parent": children_per_parent,
    "lookup_reference_ranges": lookup_reference_ranges,
    "lookup_diagnosis_codes": lookup_diagnosis_codes,
}


# ---- the same in SQL -----------------------------------------------------------------------

NOT_TEXT = {
    "date_of_birth", "primary_diagnosis_date", "dosage", "start_date", "end_date",
    "cycles_planned", "cycles_completed", "is_abnormal", "is_critical", "collection_datetime",
    "result_datetime",
}


def _conditions(name: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for f in ENTITIES[name]:
        c = f.name if f.name in NOT_TEXT else f"trim({f.name})"
        if f.default is not None:
            default = f"'{f.default}'" if isinstance(f.default, str) else str(f.default).lower()
            c = f"coalesce({c}, {default})"
        if f.required:
            found[f"{f.name}.required"] = f"{c} IS NULL"
        if f.min_length is not None:
            found[f"{f.name}.min_length"] = f"length({c}) < {f.min_length}"
        if f.max_length is not None:
            found[f"{f.name}.max_length"] = f"length({c}) > {f.max_length}"
        if f.pattern is not None:
            found[f"{f.name}.pattern"] = f"NOT regexp_matches({c}, '{f.pattern}')"
        if f.members is not None:
            members = ", ".join(f"'{m}'" for m in f.members)
            found[f"{f.name}.member"] = f"{c} NOT IN ({members})"
        if f.at_least is not None:
            found[f"{f.name}.at_least"] = f"{c} < {f.at_least}"
        if f.not_future:
            found[f"{f.name}.not_future"] = f"{c} > date '{AS_OF[:10]}'"
        if f.not_before is not None:
            found[f"{f.name}.not_before"] = f"{c} < {f.not_before}"
    return found


def _violations_sql(name: str, more: str = "", table: str | None = None) -> str:
    parts = [
        f"SELECT '{rule}' AS rule, count(*) AS rows FROM {table or name} WHERE {bad}"
        for rule, bad in _conditions(name).items()
    ]
    return with_entities(name).rstrip() + more + "\nSELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE rows > 0"


def _values(rows: list[tuple]) -> str:
    def cell(v: object) -> str:
        return f"'{v}'" if isinstance(v, str) else f"{v}e0"

    return ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)


_DIFFERS = "count(*) FILTER (WHERE r.name IS NOT NULL AND {a} IS DISTINCT FROM {b}) AS {c}"
ORACLES = {f"rec_violations_{n}": _violations_sql(n) for n in ENTITIES} | {
    "rec_violations_faulty_labs": _violations_sql(
        "lab_results",
        ", faulty AS (SELECT * REPLACE ("
        + ", ".join(f"{e} AS {c}" for c, e in LAB_FAULTS.items()) + ") FROM lab_results)",
        "faulty",
    ),
    "rec_quarantine": with_entities("patients")
    + "SELECT * FROM (SELECT patient_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN {b} THEN '{r}' END" for r, b in _conditions("patients").items())
    + ") AS rules FROM patients) WHERE rules <> ''",
    "rec_standardize": with_entities("patients") + """
SELECT patient_id, trim(last_name) AS last_name, coalesce(race, 'U') AS race,
 coalesce(ethnicity, 'U') AS ethnicity, trim(city) AS city, trim(phone) AS phone FROM patients""",
    "rec_plain_texts": with_entities("patients") + """
SELECT concat_ws('-', substr(m, 1, 8), substr(m, 9, 4), substr(m, 13, 4), substr(m, 17, 4), substr(m, 21, 12)) AS patient_id,
 trim(gender) AS gender, coalesce(trim(race), 'U') AS race, trim(cancer_type) AS cancer_type
FROM (SELECT *, md5(patient_id) AS m FROM patients)""",
    "rec_range_flags": with_entities("lab_results") + """
SELECT test_code, result_value < reference_range_low OR result_value > reference_range_high
 AS derived_abnormal, result_value < 0.5e0 * reference_range_low
 OR result_value > 2.0e0 * reference_range_high AS derived_critical, count(*) AS rows
FROM lab_results GROUP BY 1, 2, 3""",
    "rec_status_from_dates": with_entities("treatments") + f"""
SELECT derived_status, count(*) AS rows, cast(sum(derived_cycles) AS bigint) AS cycles FROM (
 SELECT CASE WHEN end_date < d THEN 'completed' WHEN start_date > d THEN 'planned'
  ELSE 'in_progress' END AS derived_status,
  CASE WHEN end_date < d THEN cycles_planned WHEN start_date > d THEN 0
  ELSE cast(floor((d - start_date) * 1.0e0 / nullif(end_date - start_date, 0) * cycles_planned)
   AS int) END AS derived_cycles
 FROM (SELECT *, date '{MID_DATES[:10]}' AS d FROM treatments)) GROUP BY derived_status""",
    "rec_tiered_round": with_entities("lab_results") + """
SELECT CASE WHEN result_value < 1 THEN round(result_value, 3)
 WHEN result_value < 10 THEN round(result_value, 2)
 WHEN result_value < 100 THEN round(result_value, 1) ELSE round(result_value, 0) END AS rounded,
 count(*) AS rows FROM lab_results GROUP BY 1""",
    "rec_flag_consistency": with_entities("lab_results") + """
SELECT count(*) FILTER (WHERE c) AS critical_rows,
 count(*) FILTER (WHERE c AND NOT is_abnormal) AS inconsistent_rows, count(*) AS row_count
FROM (SELECT *, result_value < 0.5e0 * reference_range_low
 OR result_value > 2.0e0 * reference_range_high AS c FROM lab_results)""",
    "ref_integrity_orphans": with_entities("patients", "treatments") + """
SELECT treatment_id, patient_id FROM treatments t WHERE patient_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM patients p WHERE p.patient_id = t.patient_id)""",
    "ref_orphan_keys": with_entities("patients", "treatments") + """
SELECT patient_id, count(*) AS rows FROM treatments t WHERE patient_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM patients p WHERE p.patient_id = t.patient_id) GROUP BY 1""",
    "children_per_parent": with_entities("patients", "treatments") + """
SELECT count(*) AS parents, cast(sum(n) AS bigint) AS linked_children,
 round(sum(n) * 1.0e0 / count(*), 6) AS children_per_parent,
 count(*) FILTER (WHERE n = 0) AS childless_parents
FROM (SELECT p.patient_id, count(t.treatment_id) AS n FROM patients p
 LEFT JOIN treatments t ON p.patient_id = t.patient_id GROUP BY 1)""",
    "lookup_reference_ranges": with_entities("lab_results")[:-1] + f""",
r(code, name, category, unit, low, high) AS (VALUES {_values(coding.LAB_TESTS)})
SELECT test_code, count(*) AS rows, count(*) FILTER (WHERE r.name IS NULL) AS unknown_rows,
 {_DIFFERS.format(a='test_name', b='r.name', c='name_differs')},
 {_DIFFERS.format(a='result_unit', b='r.unit', c='unit_differs')},
 {_DIFFERS.format(a='reference_range_low', b='r.low', c='low_differs')},
 {_DIFFERS.format(a='reference_range_high', b='r.high', c='high_differs')}
FROM lab_results l LEFT JOIN r ON l.test_code = r.code GROUP BY test_code""",
    "lookup_diagnosis_codes": with_entities("patients")[:-1] + f""",
r(kind, code) AS (VALUES {_values([(t, c) for t, cs in coding.DIAGNOSIS_CODES.items() for c in cs])})
SELECT patient_id, cancer_type, primary_diagnosis_code FROM patients p WHERE NOT EXISTS (
 SELECT 1 FROM r WHERE r.kind = p.cancer_type AND r.code = p.primary_diagnosis_code)""",
}
