"""Declared column schemas. Sources are always read with one of these, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
WEIGHT = T.DecimalType(9, 3)


TEXT = T.StringType()
DATE = T.DateType()
INSTANT = T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PATIENTS = _schema(
    Id=TEXT,
    BIRTHDATE=DATE,
    DEATHDATE=DATE,
    GENDER=TEXT,
    RACE=TEXT,
    ETHNICITY=TEXT,
    STATE=TEXT,
    CITY=TEXT,
    ZIP=TEXT,
    HEALTHCARE_EXPENSES=MONEY,
    HEALTHCARE_COVERAGE=MONEY,
)

ENCOUNTERS = _schema(
    Id=TEXT,
    PATIENT=TEXT,
    PROVIDER=TEXT,
    PAYER=TEXT,
    START=INSTANT,
    STOP=INSTANT,
    ENCOUNTERCLASS=TEXT,
    REASONCODE=TEXT,
    REASONDESCRIPTION=TEXT,
    CODE=TEXT,
    DESCRIPTION=TEXT,
    BASE_ENCOUNTER_COST=MONEY,
    TOTAL_CLAIM_COST=MONEY,
    PAYER_COVERAGE=MONEY,
)

CONDITIONS = _schema(PATIENT=TEXT, ENCOUNTER=TEXT, START=DATE, STOP=DATE, CODE=TEXT, DESCRIPTION=TEXT)

PROCEDURES = _schema(PATIENT=TEXT, ENCOUNTER=TEXT, DATE=DATE, CODE=TEXT, DESCRIPTION=TEXT, BASE_COST=MONEY)

MEDICATIONS = _schema(
    PATIENT=TEXT,
    ENCOUNTER=TEXT,
    PAYER=TEXT,
    START=DATE,
    STOP=DATE,
    CODE=TEXT,
    DESCRIPTION=TEXT,
    BASE_COST=MONEY,
    PAYER_COVERAGE=MONEY,
    TOTALCOST=MONEY,
    DISPENSES=T.LongType(),
    REASONCODE=TEXT,
    REASONDESCRIPTION=TEXT,
)

PROVIDERS = _schema(Id=TEXT)

RAW_TABLES = {
    "patients": PATIENTS,
    "encounters": ENCOUNTERS,
    "conditions": CONDITIONS,
    "procedures": PROCEDURES,
    "medications": MEDICATIONS,
    "providers": PROVIDERS,
}

# The seed is written with a floating weight and used with an exact one.
CONDITION_MAP_SEED = _schema(
    snomed_code=TEXT,
    condition_category=TEXT,
    condition_label=TEXT,
    hcc_category=TEXT,
    hcc_weight=T.DoubleType(),
)

AUDIT_LOG = T.StructType(
    [
        T.StructField("run_timestamp", T.TimestampType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("check_type", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("check_result", T.StringType(), False),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("null_rate_pct", T.DoubleType(), True),
        T.StructField("details", T.StringType(), True),
    ]
)

# The older beneficiary summary layout, 23 text and 9 numeric columns.
BENEFICIARY_TEXT_COLUMNS = [
    "DESYNPUF_ID",
    "BENE_BIRTH_DT",
    "BENE_DEATH_DT",
    "BENE_SEX_IDENT_CD",
    "BENE_RACE_CD",
    "BENE_ESRD_IND",
    "SP_STATE_CODE",
    "BENE_COUNTY_CD",
    "BENE_HI_CVRAGE_TOT_MONS",
    "BENE_SMI_CVRAGE_TOT_MONS",
    "BENE_HMO_CVRAGE_TOT_MONS",
    "PLAN_CVRG_MOS_NUM",
    "SP_ALZHDMTA",
    "SP_CHF",
    "SP_CHRNKIDN",
    "SP_CNCR",
    "SP_COPD",
    "SP_DEPRESSN",
    "SP_DIABETES",
    "SP_ISCHMCHT",
    "SP_OSTEOPRS",
    "SP_RA_OA",
    "SP_STRKETIA",
]
BENEFICIARY_AMOUNT_COLUMNS = [
    "MEDREIMB_IP",
    "BENRES_IP",
    "PPPYMT_IP",
    "MEDREIMB_OP",
    "BENRES_OP",
    "PPPYMT_OP",
    "MEDREIMB_CAR",
    "BENRES_CAR",
    "PPPYMT_CAR",
]

BENEFICIARY_SUMMARY = T.StructType(
    [T.StructField(name, T.StringType()) for name in BENEFICIARY_TEXT_COLUMNS]
    + [T.StructField(name, T.DoubleType()) for name in BENEFICIARY_AMOUNT_COLUMNS]
)
