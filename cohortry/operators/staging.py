"""Typed staging tables, one per raw table. Each is a single projection with a pushed-down key filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.dates import last_day_of_year, years_crossed
from cohortry.functions.keys import surrogate_key
from cohortry.functions.text import title_words
from cohortry.schemas import MONEY
from cohortry.vocabulary import CLAIM_TYPE_BY_CLASS, DEFAULT_CLAIM_TYPE


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _money(name: str) -> Column:
    return F.coalesce(F.col(name).cast(MONEY), F.lit(0).cast(MONEY))


KEPT = "_kept"
"""Where raw columns are carried along: whether the row has its keys, and so belongs to the staging table."""


def carried_name(raw_column: str) -> str:
    return f"_raw_{raw_column}"


def _staged(raw: DataFrame, keys: Sequence[str], columns: Sequence[Column], carried: Sequence[str] | None) -> DataFrame:
    """The rows that have their ``keys``. With ``carried`` all rows, marked by ``KEPT``, and those raw columns, for checks of the raw table."""
    if carried is None:
        for name in keys:
            raw = raw.where(F.col(name).isNotNull())
        return raw.select(*columns)
    kept = reduce(Column.__and__, [F.col(name).isNotNull() for name in keys])
    return raw.select(*columns, kept.alias(KEPT), *[F.col(name).alias(carried_name(name)) for name in carried])


def claim_type_of(encounter_class: Column) -> Column:
    """Claim type of a lower-case encounter class; unknown and missing classes are outpatient."""
    mapped = None
    for claim_type in dict.fromkeys(CLAIM_TYPE_BY_CLASS.values()):
        classes = [c for c, t in CLAIM_TYPE_BY_CLASS.items() if t == claim_type]
        hit = encounter_class.isin(classes)
        mapped = F.when(hit, claim_type) if mapped is None else mapped.when(hit, claim_type)
    return mapped.otherwise(DEFAULT_CLAIM_TYPE)


def stg_members(patients: DataFrame, year: int, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per patient, with age at the end of the measurement year."""
    born = F.col("BIRTHDATE").cast("date")
    gender = F.upper("GENDER")
    expenses, coverage = _money("HEALTHCARE_EXPENSES"), _money("HEALTHCARE_COVERAGE")
    columns = [
        _text("Id").alias("member_id"),
        born.alias("date_of_birth"),
        F.col("DEATHDATE").cast("date").alias("death_date"),
        years_crossed(last_day_of_year(year), born).alias("age_at_year_end"),
        F.when(gender.isin("M", "F"), gender).otherwise("U").alias("sex"),
        title_words(_text("RACE")).alias("race"),
        title_words(_text("ETHNICITY")).alias("ethnicity"),
        _text("STATE").alias("state"),
        _text("CITY").alias("city"),
        _text("ZIP").alias("zip_code"),
        expenses.alias("total_healthcare_expenses"),
        coverage.alias("total_healthcare_coverage"),
        (expenses - coverage).cast(MONEY).alias("total_out_of_pocket"),
        F.col("DEATHDATE").isNotNull().alias("is_deceased"),
        F.lit(year).alias("measurement_year"),
    ]
    return _staged(patients, ["Id"], columns, carried)


def stg_encounters(encounters: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per encounter with its claim type and cost split."""
    start, stop = F.col("START").cast("timestamp"), F.col("STOP").cast("timestamp")
    encounter_class = F.lower(_text("ENCOUNTERCLASS"))
    paid, covered = _money("TOTAL_CLAIM_COST"), _money("PAYER_COVERAGE")
    columns = [
        _text("Id").alias("encounter_id"),
        _text("PATIENT").alias("member_id"),
        _text("PROVIDER").alias("provider_id"),
        _text("PAYER").alias("payer_id"),
        start.alias("service_start_ts"),
        stop.alias("service_end_ts"),
        F.to_date(start).alias("service_date"),
        F.to_date(stop).alias("service_end_date"),
        encounter_class.alias("encounter_class"),
        claim_type_of(encounter_class).alias("claim_type"),
        _text("REASONCODE").alias("reason_snomed_code"),
        _text("REASONDESCRIPTION").alias("reason_description"),
        _text("CODE").alias("encounter_snomed_code"),
        _text("DESCRIPTION").alias("encounter_description"),
        _money("BASE_ENCOUNTER_COST").alias("base_encounter_cost"),
        paid.alias("paid_amount"),
        covered.alias("payer_coverage"),
        (paid - covered).cast(MONEY).alias("member_paid_amount"),
        F.year(start).alias("service_year"),
    ]
    return _staged(encounters, ["Id", "PATIENT", "START"], columns, carried)


def stg_conditions(conditions: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per diagnosis onset; open-ended ones are active."""
    onset = F.col("START").cast("date")
    columns = [
        surrogate_key("PATIENT", "CODE", "START").alias("condition_id"),
        _text("PATIENT").alias("member_id"),
        _text("ENCOUNTER").alias("encounter_id"),
        onset.alias("onset_date"),
        F.col("STOP").cast("date").alias("resolution_date"),
        _text("CODE").alias("snomed_code"),
        _text("DESCRIPTION").alias("condition_description"),
        F.col("STOP").isNull().alias("is_active"),
        F.year(onset).alias("onset_year"),
    ]
    return _staged(conditions, ["PATIENT", "CODE"], columns, carried)


def stg_procedures(procedures: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per procedure; the single raw date is both start and end."""
    performed = F.col("DATE").cast("date")
    columns = [
        surrogate_key("PATIENT", "CODE", "DATE", "ENCOUNTER").alias("procedure_id"),
        _text("PATIENT").alias("member_id"),
        _text("ENCOUNTER").alias("encounter_id"),
        performed.alias("procedure_date"),
        performed.alias("procedure_end_date"),
        _text("CODE").alias("snomed_code"),
        _text("DESCRIPTION").alias("procedure_description"),
        _money("BASE_COST").alias("base_cost"),
        F.year(performed).alias("procedure_year"),
    ]
    return _staged(procedures, ["PATIENT"], columns, carried)


def stg_medications(medications: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per prescription; the key needs six columns to be unique."""
    columns = [
        surrogate_key("PATIENT", "CODE", "START", "ENCOUNTER", "STOP", "TOTALCOST").alias("rx_id"),
        _text("PATIENT").alias("member_id"),
        _text("ENCOUNTER").alias("encounter_id"),
        _text("PAYER").alias("payer_id"),
        F.col("START").cast("date").alias("start_date"),
        F.col("STOP").cast("date").alias("stop_date"),
        _text("CODE").alias("rxnorm_code"),
        _text("DESCRIPTION").alias("drug_description"),
        _money("BASE_COST").alias("base_cost"),
        _money("PAYER_COVERAGE").alias("payer_coverage"),
        _money("TOTALCOST").alias("total_drug_cost"),
        F.coalesce(F.col("DISPENSES").cast("bigint"), F.lit(1).cast("bigint")).alias("dispenses"),
        _text("REASONCODE").alias("reason_snomed_code"),
        _text("REASONDESCRIPTION").alias("reason_description"),
        F.col("STOP").isNull().alias("is_active"),
    ]
    return _staged(medications, ["PATIENT", "CODE"], columns, carried)
