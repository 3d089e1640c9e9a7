"""Closed value sets, code patterns and reference tables of the oncology entities (data only)."""

from __future__ import annotations

# Closed value sets of the entities, in their documented order.
GENDERS = ["M", "F", "O", "U"]
RACES = ["W", "B", "A", "N", "P", "O", "U"]
ETHNICITIES = ["H", "N", "U"]
CANCER_TYPES = [
    "breast", "lung", "colorectal", "prostate", "melanoma",
    "lymphoma", "leukemia", "pancreatic", "ovarian", "bladder",
]
TREATMENT_TYPES = [
    "chemotherapy", "radiation", "surgery", "immunotherapy", "targeted_therapy", "hormone_therapy",
]
TREATMENT_STATUSES = ["planned", "in_progress", "completed", "cancelled", "on_hold"]
LAB_CATEGORIES = ["hematology", "chemistry", "tumor_marker", "coagulation", "urinalysis"]
ROUTES = ["IV", "PO", "IM", "SC", "IT", "Topical"]
SPECIMENS = [
    "Whole Blood", "EDTA Blood", "Serum", "Plasma", "Citrated Plasma", "Urine", "24-Hour Urine",
]

# Code patterns.
MRN = r"^MRN\d{8}$"
STATE = r"^[A-Z]{2}$"
ZIP = r"^\d{5}(-\d{4})?$"
PHONE = r"^\d{3}-\d{3}-\d{4}$"
ICD10 = r"^[A-Z]\d{2}(\.\d{1,4})?$"
ICD10_ONCOLOGY = r"^C\d{2}(\.\d{1,4})?$|^D0[0-4](\.\d{1,4})?$"
ICD10_ONCOLOGY_LOOSE = r"^C\d{2}.*$|^D0[0-4].*$"
STAGE = r"^(I|II|III|IV)(A|B|C)?$"
NDC = r"^\d{5}-\d{4}-\d{2}$"
LOINC = r"^\d{4,5}-\d$"
LAB_TEST_CODE = r"^\d{4,5}(-\d)?$"

# Diagnosis codes that belong to each cancer type.
DIAGNOSIS_CODES = {
    "breast": ["C50.0", "C50.1", "C50.2", "C50.3", "C50.4", "C50.5", "C50.9"],
    "lung": ["C34.0", "C34.1", "C34.2", "C34.3", "C34.9"],
    "colorectal": ["C18.0", "C18.2", "C18.7", "C19", "C20"],
    "prostate": ["C61"],
    "melanoma": ["C43.0", "C43.3", "C43.4", "C43.5", "C43.9"],
    "lymphoma": ["C81.0", "C81.1", "C82.0", "C83.0", "C85.9"],
    "leukemia": ["C91.0", "C91.1", "C92.0", "C92.1", "C95.0"],
    "pancreatic": ["C25.0", "C25.1", "C25.2", "C25.9"],
    "ovarian": ["C56.1", "C56.2", "C56.9"],
    "bladder": ["C67.0", "C67.1", "C67.2", "C67.9"],
}

# Laboratory tests as (code, name, category, unit, low, high).
LAB_TESTS = [
    ("6690-2", "WBC", "hematology", "10^3/uL", 4.5, 11.0),
    ("789-8", "RBC", "hematology", "10^6/uL", 4.5, 5.5),
    ("718-7", "Hemoglobin", "hematology", "g/dL", 12.0, 17.5),
    ("4544-3", "Hematocrit", "hematology", "%", 36.0, 50.0),
    ("777-3", "Platelets", "hematology", "10^3/uL", 150.0, 400.0),
    ("751-8", "Neutrophils", "hematology", "%", 40.0, 70.0),
    ("731-0", "Lymphocytes", "hematology", "%", 20.0, 40.0),
    ("2160-0", "Creatinine", "chemistry", "mg/dL", 0.6, 1.2),
    ("3094-0", "BUN", "chemistry", "mg/dL", 7.0, 20.0),
    ("1742-6", "ALT", "chemistry", "U/L", 7.0, 56.0),
    ("1920-8", "AST", "chemistry", "U/L", 10.0, 40.0),
    ("1975-2", "Bilirubin Total", "chemistry", "mg/dL", 0.1, 1.2),
    ("2951-2", "Sodium", "chemistry", "mEq/L", 136.0, 145.0),
    ("2823-3", "Potassium", "chemistry", "mEq/L", 3.5, 5.0),
    ("2039-6", "CEA", "tumor_marker", "ng/mL", 0.0, 3.0),
    ("10834-0", "CA-125", "tumor_marker", "U/mL", 0.0, 35.0),
    ("19195-7", "PSA", "tumor_marker", "ng/mL", 0.0, 4.0),
    ("83112-5", "CA 19-9", "tumor_marker", "U/mL", 0.0, 37.0),
    ("31993-7", "AFP", "tumor_marker", "ng/mL", 0.0, 10.0),
]
