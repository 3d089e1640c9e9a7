"""The three entities as views over the star-schema tables, with planted faults.

The text runs unchanged on Spark and on ANSI engines, so a check can inline it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PATIENTS_SQL = """
SELECT concat('P', cast(c_custkey AS string)) AS patient_id,
 CASE WHEN c_custkey % 101 = 7 THEN 'INVALID' ELSE concat('MRN', lpad(cast(c_custkey AS string), 8, '0')) END AS mrn,
 CASE WHEN c_custkey % 3 = 0 THEN 'Alice' WHEN c_custkey % 3 = 1 THEN 'BOB' ELSE 'O''Neil' END AS first_name,
 CASE WHEN c_custkey % 97 = 1 THEN NULL WHEN c_custkey % 83 = 2 THEN '  ' ELSE c_name END AS last_name,
 date '1940-01-01' + cast((c_custkey * 37) % 20000 AS int) AS date_of_birth,
 CASE WHEN c_custkey % 211 = 3 THEN 'X' WHEN c_custkey % 4 = 0 THEN 'M' WHEN c_custkey % 4 = 1 THEN 'F' WHEN c_custkey % 4 = 2 THEN 'O' ELSE 'U' END AS gender,
 CASE WHEN c_nationkey % 3 = 0 THEN 'W' WHEN c_nationkey % 3 = 1 THEN 'B' ELSE 'A' END AS race,
 CASE WHEN c_nationkey % 2 = 0 THEN 'H' ELSE 'N' END AS ethnicity,
 concat(cast(c_custkey AS string), ' Main St') AS address_line1,
 c_mktsegment AS city,
 CASE WHEN c_custkey % 59 = 0 THEN 'Mass' ELSE 'MA' END AS state,
 CASE WHEN c_custkey % 131 = 9 THEN 'bad' ELSE lpad(cast((c_custkey * 7919) % 100000 AS string), 5, '0') END AS zip_code,
 CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('555-123-', lpad(cast(c_custkey % 10000 AS string), 4, '0')) END AS phone,
 CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE concat('user', cast(c_custkey AS string), '@example.com') END AS email,
 CASE WHEN c_custkey % 103 = 5 THEN 'INVALID' WHEN c_custkey % 3 = 0 THEN 'C50.1' WHEN c_custkey % 3 = 1 THEN 'C61' ELSE 'C34.9' END AS primary_diagnosis_code,
 CASE WHEN c_custkey % 107 = 11 THEN date '2099-12-31' WHEN c_custkey % 109 = 12 THEN date '1930-01-01' ELSE date '2019-01-01' + cast((c_custkey * 13) % 1800 AS int) END AS primary_diagnosis_date,
 CASE WHEN c_custkey % 223 = 4 THEN 'unknown' WHEN c_custkey % 3 = 0 THEN 'breast' WHEN c_custkey % 3 = 1 THEN 'prostate' ELSE 'lung' END AS cancer_type,
 CASE WHEN c_custkey % 227 = 6 THEN 'V' WHEN c_custkey % 5 = 0 THEN 'I' WHEN c_custkey % 5 = 1 THEN 'IIA' WHEN c_custkey % 5 = 2 THEN 'III' WHEN c_custkey % 5 = 3 THEN 'IVB' ELSE 'IV' END AS cancer_stage,
 c_acctbal AS balance,
 timestamp '2024-01-01 00:00:00' + interval '1' hour * cast(c_custkey AS int) AS created_at,
 timestamp '2024-02-01 00:00:00' + interval '1' hour * cast(c_custkey AS int) AS updated_at
FROM customer
"""

TREATMENTS_SQL = """
SELECT concat('T', cast(o_orderkey AS string)) AS treatment_id,
 CASE WHEN o_orderkey % 997 = 0 THEN 'P-missing' ELSE concat('P', cast(o_custkey AS string)) END AS patient_id,
 CASE WHEN o_orderkey % 3 = 0 THEN 'chemotherapy' WHEN o_orderkey % 3 = 1 THEN 'radiation' ELSE 'surgery' END AS treatment_type,
 CASE WHEN o_orderkey % 3 = 0 THEN 'AC-T' WHEN o_orderkey % 3 = 1 THEN 'IMRT' ELSE 'Lobectomy' END AS treatment_name,
 CASE WHEN o_orderkey % 3 <> 0 THEN NULL WHEN o_orderkey % 27 = 0 THEN 'bad' ELSE concat('00015-', lpad(cast(o_orderkey % 10000 AS string), 4, '0'), '-30') END AS drug_code,
 CASE WHEN o_orderkey % 3 <> 0 THEN NULL ELSE 'Paclitaxel' END AS drug_name,
 CASE WHEN o_orderkey % 3 <> 0 THEN NULL WHEN o_orderkey % 109 = 2 THEN -100.0e0 ELSE o_totalprice END AS dosage,
 CASE WHEN o_orderkey % 3 <> 0 THEN NULL ELSE 'mg/m2' END AS dosage_unit,
 CASE WHEN o_orderkey % 3 <> 0 THEN NULL WHEN o_orderkey % 45 = 0 THEN 'Oral' ELSE 'IV' END AS route,
 cast(o_orderdate AS date) AS start_date,
 CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderkey % 113 = 4 THEN cast(o_orderdate AS date) - 10 ELSE cast(o_orderdate AS date) + cast(o_orderkey % 180 + 1 AS int) END AS end_date,
 CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'in_progress' ELSE 'planned' END AS status,
 CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE cast(o_orderkey % 53 + 1 AS int) END AS cycles_planned,
 CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE cast(o_orderkey % 53 AS int) END AS cycles_completed,
 concat('Dr. ', o_orderpriority) AS treating_physician,
 'Cancer Center' AS facility_name,
 CASE WHEN o_orderkey % 10 < 7 THEN NULL ELSE 'Treatment ongoing.' END AS notes,
 o_orderdate AS created_at,
 o_orderdate AS updated_at
FROM orders
"""

LAB_RESULTS_SQL = """
SELECT concat('R', cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string)) AS result_id,
 concat('P', cast(l_suppkey AS string)) AS patient_id,
 CASE WHEN l_partkey % 3 = 0 THEN '6690-2' WHEN l_partkey % 3 = 1 THEN '789-8' ELSE '2160-0' END AS test_code,
 CASE WHEN l_partkey % 3 = 0 THEN 'WBC' WHEN l_partkey % 3 = 1 THEN 'RBC' ELSE 'Creatinine' END AS test_name,
 CASE WHEN l_partkey % 3 = 2 THEN 'chemistry' ELSE 'hematology' END AS test_category,
 CASE WHEN l_partkey % 199 = 1 THEN -999.0e0 WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 3 = 2 THEN 0.4e0 + l_quantity / 50.0e0 ELSE 3.0e0 + l_quantity / 5.0e0 END AS result_value,
 CASE WHEN l_partkey % 3 = 2 THEN 'mg/dL' ELSE '10^3/uL' END AS result_unit,
 cast(NULL AS string) AS result_text,
 CASE WHEN l_partkey % 3 = 2 THEN 0.6e0 ELSE 4.5e0 END AS reference_range_low,
 CASE WHEN l_partkey % 3 = 0 THEN 11.0e0 WHEN l_partkey % 3 = 1 THEN 5.5e0 ELSE 1.2e0 END AS reference_range_high,
 l_quantity > 45 AS is_abnormal,
 l_quantity > 48 AS is_critical,
 CASE WHEN l_partkey % 3 = 2 THEN 'Serum' WHEN l_partkey % 307 = 1 THEN 'Saliva' ELSE 'Whole Blood' END AS specimen_type,
 l_shipdate AS collection_datetime,
 CASE WHEN l_orderkey % 89 = 6 THEN l_shipdate - interval '5' hour ELSE l_shipdate + interval '1' hour * cast(l_linenumber AS int) END AS result_datetime,
 CASE WHEN l_returnflag = 'R' THEN 'LabCorp' ELSE 'Quest Diagnostics' END AS performing_lab,
 'Dr. Johnson' AS ordering_physician,
 l_shipdate AS created_at
FROM lineitem
"""

SQL = {"patients": PATIENTS_SQL, "treatments": TREATMENTS_SQL, "lab_results": LAB_RESULTS_SQL}
BASE_TABLE = {"patients": "customer", "treatments": "orders", "lab_results": "lineitem"}
KEY = {"patients": "patient_id", "treatments": "treatment_id", "lab_results": "result_id"}


def base(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the data folder; Parquet keeps column pruning and pushdown to the scan."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def entity(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of ``patients``, ``treatments``, ``lab_results`` over the tables of a folder."""
    table = BASE_TABLE[name]
    text = SQL[name].replace(f"FROM {table}", "FROM {source}")
    return spark.sql(text, source=base(spark, folder, table))


def entities(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: entity(spark, folder, name) for name in SQL}
