"""Planting known faults in a table, to see whether a suite finds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veristrata.functions.columns import field
from veristrata.functions.hashing import md5_fraction, md5_number

# The kinds of fault per entity.
KINDS = {
    "patients": ["invalid_mrn", "future_date", "invalid_code"],
    "treatments": ["negative_dosage", "end_before_start"],
    "lab_results": ["negative_value", "result_before_collection"],
}


def _replacements(as_of: str) -> dict[str, tuple[str, Column]]:
    today = F.lit(as_of).cast("timestamp_ntz").cast("date")
    return {
        "invalid_mrn": ("mrn", F.lit("INVALID")),
        "future_date": ("primary_diagnosis_date", F.date_add(today, 30)),
        "invalid_code": ("primary_diagnosis_code", F.lit("INVALID")),
        "negative_dosage": ("dosage", F.lit(-100.0)),
        "end_before_start": ("end_date", F.date_sub(field("start_date"), 10)),
        "negative_value": ("result_value", F.lit(-999.0)),
        "result_before_collection": (
            "result_datetime", F.col("collection_datetime") - F.expr("INTERVAL 5 HOURS")
        ),
    }


def inject_faults(
    df: DataFrame, entity: str, key: str, rate: float, as_of: str, seed: int = 42
) -> DataFrame:
    """Overwrite one field in about ``rate`` of the rows; ``fault`` names what was done to a row.

    Rows and faults are chosen by hashes of the key: no state, no shuffle, the same on every run.
    """
    kinds = KINDS[entity]
    chosen = md5_fraction(str(seed), field(key)) < F.lit(rate)
    pick = md5_number(f"{seed}-kind", field(key)) % F.lit(len(kinds))
    fault = F.when(chosen, F.element_at(F.array(*(F.lit(k) for k in kinds)), (pick + 1).cast("int")))
    marked = df.withColumn("fault", fault)
    replaced: dict[str, Column] = {}
    for kind in kinds:
        name, value = _replacements(as_of)[kind]
        replaced[name] = F.when(
            F.col("fault") == kind, value.cast(df.schema[name].dataType)
        ).otherwise(field(name))
    return marked.withColumns(replaced)
