"""Record constraints: which rules each row breaks, quarantine of bad rows, derived fields."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.functions import coding
from veristrata.functions.columns import field, is_string, normalize_missing
from veristrata.functions.text import strip


@dataclass(frozen=True)
class Field:
    """Constraints of one column of an entity."""

    name: str
    required: bool = False
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    members: tuple[str, ...] | None = None
    at_least: float | None = None
    not_future: bool = False
    not_before: str | None = None
    default: Any = None

    def broken(self, as_of: str, present: set[str]) -> dict[str, Column]:
        """Rule id -> TRUE where the row breaks it; a missing value only breaks ``required``."""
        c = field(self.name)
        rules: dict[str, Column] = {}
        if self.required:
            rules["required"] = c.isNull()
        if self.min_length is not None:
            rules["min_length"] = F.char_length(c) < self.min_length
        if self.max_length is not None:
            rules["max_length"] = F.char_length(c) > self.max_length
        if self.pattern is not None:
            rules["pattern"] = ~c.rlike(self.pattern)
        if self.members is not None:
            rules["member"] = ~c.isin(*self.members)
        if self.at_least is not None:
            rules["at_least"] = c < F.lit(self.at_least)
        if self.not_future:
            rules["not_future"] = c > F.lit(as_of).cast("timestamp_ntz").cast("date")
        if self.not_before is not None and self.not_before in present:
            rules["not_before"] = c < field(self.not_before)
        return {f"{self.name}.{rule}": bad for rule, bad in rules.items()}


# The constraints of the three entities, in column order.
ENTITIES: dict[str, list[Field]] = {
    "patients": [
        Field("mrn", True, 6, 20),
        Field("first_name", True, 1, 100),
        Field("last_name", True, 1, 100),
        Field("date_of_birth", True, not_future=True),
        Field("gender", True, members=tuple(coding.GENDERS)),
        Field("race", members=tuple(coding.RACES), default="U"),
        Field("ethnicity", members=tuple(coding.ETHNICITIES), default="U"),
        Field("address_line1", True, max_length=200),
        Field("city", True, max_length=100),
        Field("state", True, 2, 2),
        Field("zip_code", True, pattern=coding.ZIP),
        Field("phone", pattern=coding.PHONE),
        Field("email", max_length=255),
        Field("primary_diagnosis_code", True, pattern=coding.ICD10),
        Field("primary_diagnosis_date", True, not_future=True),
        Field("cancer_type", True, members=tuple(coding.CANCER_TYPES)),
        Field("cancer_stage", True, pattern=coding.STAGE),
    ],
    "treatments": [
        Field("patient_id", True),
        Field("treatment_type", True, members=tuple(coding.TREATMENT_TYPES)),
        Field("treatment_name", True, max_length=200),
        Field("drug_code", pattern=coding.NDC),
        Field("drug_name", max_length=200),
        Field("dosage", at_least=0.0),
        Field("dosage_unit", max_length=20),
        Field("route", max_length=50),
        Field("start_date", True),
        Field("end_date", not_before="start_date"),
        Field("status", members=tuple(coding.TREATMENT_STATUSES), default="planned"),
        Field("cycles_planned", at_least=1),
        Field("cycles_completed", at_least=0),
        Field("treating_physician", True, max_length=200),
        Field("facility_name", True, max_length=200),
        Field("notes", max_length=2000),
    ],
    "lab_results": [
        Field("patient_id", True),
        Field("test_code", True, max_length=20),
        Field("test_name", True, max_length=200),
        Field("test_category", True, members=tuple(coding.LAB_CATEGORIES)),
        Field("result_unit", max_length=50),
        Field("result_text", max_length=500),
        Field("is_abnormal", default=False),
        Field("is_critical", default=False),
        Field("specimen_type", True, max_length=100),
        Field("collection_datetime", True),
        Field("result_datetime", True),
        Field("performing_lab", True, max_length=200),
        Field("ordering_physician", True, max_length=200),
    ],
}


def standardize(df: DataFrame, entity: str, as_text: bool = False) -> DataFrame:
    """Texts without white space at the ends, and defaults in place of missing values. With ``as_text`` ids and closed
    enumerations become text, whatever their type: 16 bytes are written as a UUID."""
    defaults = {f.name: f.default for f in ENTITIES[entity] if f.default is not None}
    enumerations = {f.name for f in ENTITIES[entity] if f.members is not None}
    df = normalize_missing(df)
    projected = []
    for f in df.schema.fields:
        c = field(f.name)
        if as_text and (f.name in enumerations or f.name.endswith("_id")):
            c = strip(plain_text(c, f.dataType))
        elif is_string(f.dataType):
            c = strip(c)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]))
        projected.append(c.alias(f.name))
    return df.select(*projected)


def plain_text(value: Column, data_type: T.DataType) -> Column:
    """A value as text; 16 bytes as the text of a UUID, other bytes as hexadecimal digits."""
    if not isinstance(data_type, T.BinaryType):
        return value.cast("string")
    digits = F.lower(F.hex(value))
    parts = [F.substring(digits, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.octet_length(value) == 16, F.concat_ws("-", *parts)).otherwise(digits)


def with_violations(df: DataFrame, entity: str, as_of: str) -> DataFrame:
    """Standardized rows with ``violations``, the ids of the rules each row breaks."""
    df = standardize(df, entity)
    present = set(df.columns)
    broken: dict[str, Column] = {}
    for f in ENTITIES[entity]:
        if f.name in present:
            broken |= f.broken(as_of, present)
        elif f.required:
            broken[f"{f.name}.required"] = F.lit(True)
    marks = [F.when(bad, F.lit(rule)) for rule, bad in broken.items()]
    return df.withColumn("violations", F.array_compact(F.array(*marks)))


def valid_rows(df: DataFrame, entity: str, as_of: str) -> DataFrame:
    return with_violations(df, entity, as_of).filter(F.size("violations") == 0).drop("violations")


def quarantined_rows(df: DataFrame, entity: str, as_of: str) -> DataFrame:
    return with_violations(df, entity, as_of).filter(F.size("violations") > 0)


def violation_counts(df: DataFrame, entity: str, as_of: str) -> DataFrame:
    """``(rule, rows)`` for the rules that are broken at all."""
    return (
        with_violations(df, entity, as_of)
        .select(F.explode("violations").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def range_flags(
    value: Column, low: Column, high: Column, critical_low: float = 0.5, critical_high: float = 2.0
) -> tuple[Column, Column]:
    """Abnormal: outside the range. Critical: below half its low end or above twice its high end."""
    abnormal = (value < low) | (value > high)
    critical = (value < low * F.lit(critical_low)) | (value > high * F.lit(critical_high))
    return abnormal, critical


def with_range_flags(
    df: DataFrame,
    value: str = "result_value",
    low: str = "reference_range_low",
    high: str = "reference_range_high",
) -> DataFrame:
    abnormal, critical = range_flags(field(value), field(low), field(high))
    return df.withColumns({"derived_abnormal": abnormal, "derived_critical": critical})


def with_derived_status(
    df: DataFrame,
    as_of: str,
    start: str = "start_date",
    end: str = "end_date",
    planned: str = "cycles_planned",
) -> DataFrame:
    """Status and completed cycles that follow from the dates of a treatment."""
    today = F.lit(as_of).cast("timestamp_ntz").cast("date")
    finished, ahead = field(end) < today, field(start) > today
    elapsed = F.datediff(today, field(start)).cast("double")
    total = F.datediff(field(end), field(start)).cast("double")
    running = F.floor(F.try_divide(elapsed, total) * field(planned)).cast("int")
    return df.withColumns(
        {
            "derived_status": F.when(finished, "completed").when(ahead, "planned").otherwise(
                "in_progress"
            ),
            "derived_cycles": F.when(finished, field(planned)).when(ahead, F.lit(0)).otherwise(
                running
            ),
        }
    )


def tiered_round(value: Column) -> Column:
    """Fewer digits for larger values: three below 1, two below 10, one below 100, else none."""
    return (
        F.when(value < 1, F.bround(value, 3))
        .when(value < 10, F.bround(value, 2))
        .when(value < 100, F.bround(value, 1))
        .otherwise(F.bround(value, 0))
    )


def inconsistent_flags(
    df: DataFrame, abnormal: str = "is_abnormal", critical: str = "is_critical"
) -> DataFrame:
    """Critical results that are not marked abnormal, counted against all critical results."""
    wrong = field(critical) & ~field(abnormal)
    return df.agg(
        F.count(F.when(field(critical), 1)).alias("critical_rows"),
        F.count(F.when(wrong, 1)).alias("inconsistent_rows"),
        F.count(F.lit(1)).alias("row_count"),
    )
