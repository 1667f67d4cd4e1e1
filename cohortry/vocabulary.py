"""Domains, labels and clinical code lists that define the results."""

from __future__ import annotations

# Condition category -> member flag column.
CONDITION_FLAGS = {
    "diabetes_t2": "cc_diabetes",
    "chf": "cc_chf",
    "ckd": "cc_ckd",
    "copd": "cc_copd",
    "alzheimers": "cc_alzheimers",
    "depression": "cc_depression",
    "ihd": "cc_ihd",
    "osteoporosis": "cc_osteoporosis",
    "arthritis": "cc_arthritis",
    "stroke": "cc_stroke",
    "hypertension": "cc_hypertension",
    "hyperlipidemia": "cc_hyperlipidemia",
    "cancer_solid": "cc_cancer",
    "obesity": "cc_obesity",
    "afib": "cc_afib",
    "anxiety": "cc_anxiety",
    "asthma": "cc_asthma",
}

# Encounter class -> claim type; any other class is outpatient.
CLAIM_TYPE_BY_CLASS = {
    "inpatient": "inpatient",
    "emergency": "emergency",
    "urgentcare": "outpatient",
    "outpatient": "outpatient",
    "ambulatory": "outpatient",
    "office": "carrier",
    "wellness": "carrier",
    "home": "carrier",
}
DEFAULT_CLAIM_TYPE = "outpatient"
CLAIM_TYPES = ["inpatient", "emergency", "outpatient", "carrier"]

# Risk tiers in reporting order.
RISK_TIERS = ["high", "rising_cost", "moderate", "low"]

QUADRANTS = ["High Value", "Low Value", "Complex High Cost", "Complex Managed"]

SEXES = ["M", "F", "U"]

# Care-gap measures: type -> (label, definition).
GAP_MEASURES = {
    "diabetes_a1c": (
        "HbA1c Testing — Diabetes",
        "Diabetic members without HbA1c measurement procedure",
    ),
    "diabetes_eye_exam": (
        "Retinal Eye Exam — Diabetes",
        "Diabetic members without retinal/fundoscopy exam",
    ),
    "high_risk_med_review": (
        "Medication Review — 5+ Active Drugs",
        "Members on 5+ medications without medication reconciliation",
    ),
    "readmission_30d": (
        "30-Day All-Cause Readmission",
        "Inpatient admit within 30 days of prior discharge",
    ),
}
GAP_TYPES = list(GAP_MEASURES)

# Service -> (codes that close the gap, codes whose date is reported). The second list is
# shorter on purpose, so a gap can be closed without a date.
SERVICE_CODES = {
    "a1c": (["43396009", "444796002", "59408-5"], ["43396009", "444796002"]),
    "eye_exam": (["252779009", "6615001", "410453006", "410451008"], ["252779009", "6615001"]),
    "med_review": (["182836005", "428191000124101", "reconcil"], ["182836005", "428191000124101"]),
}

# Score and tier constants.
SCORE_CAP = "5.0"
HIGH_SCORE = "1.5"
HIGH_ADMITS = 3
HIGH_ER_VISITS = 5
MODERATE_SCORE = "0.8"
MODERATE_CONDITIONS = 4
MODERATE_PMPM = 1000
RISING_CONDITIONS = 2
RISING_ADMITS = 1
RISING_ER_VISITS = 2
LIFETIME_EPOCH = "1950-01-01"
SPEND_SPLIT = ("0.4", "0.3", "0.3")
MIN_DRUGS = 5
READMISSION_DAYS = (1, 30)
MIN_ATTRIBUTED_MEMBERS = 5
