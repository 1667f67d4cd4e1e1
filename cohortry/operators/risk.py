"""Member utilization, risk profile and risk tiers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.dates import as_date, months_crossed
from cohortry.functions.numeric import ratio
from cohortry.schemas import MONEY, WEIGHT
from cohortry.vocabulary import (
    CONDITION_FLAGS,
    HIGH_ADMITS,
    HIGH_ER_VISITS,
    HIGH_SCORE,
    LIFETIME_EPOCH,
    MODERATE_CONDITIONS,
    MODERATE_PMPM,
    MODERATE_SCORE,
    RISING_ADMITS,
    RISING_CONDITIONS,
    RISING_ER_VISITS,
)

MEMBER_COLUMNS = [
    "member_id",
    "measurement_year",
    "age_at_year_end",
    "sex",
    "race",
    "ethnicity",
    "state",
    "city",
    "is_deceased",
]
VISIT_COUNTS = ["total_encounters", "ip_admit_count", "er_visit_count", "office_visit_count"]
DRUG_COUNTS = ["distinct_drugs", "active_medications"]


def encounter_util(encounters: DataFrame) -> DataFrame:
    """Visits, spend and last visit per member.

    The distinct count is planned on (member, encounter) first, so one member with a large share of
    the encounters is spread over tasks and reaches the member-level step pre-aggregated.
    """
    of_type = F.col("claim_type")
    return encounters.groupBy("member_id").agg(
        F.count_distinct("encounter_id").alias("total_encounters"),
        F.count_if(of_type == "inpatient").alias("ip_admit_count"),
        F.count_if(of_type == "emergency").alias("er_visit_count"),
        F.count_if(of_type == "carrier").alias("office_visit_count"),
        F.sum("paid_amount").alias("total_encounter_cost"),
        F.max("service_date").alias("last_encounter_date"),
    )


def med_summary(medications: DataFrame) -> DataFrame:
    """Distinct drugs, open prescriptions and drug cost per member."""
    return medications.groupBy("member_id").agg(
        F.count_distinct("rxnorm_code").alias("distinct_drugs"),
        F.count_if("is_active").alias("active_medications"),
        F.sum("total_drug_cost").alias("total_rx_cost"),
    )


def pmpm_lifetime(expenses: Column, death_date: Column, as_of: Column) -> Column:
    """Expenses per month elapsed since the fixed lifetime epoch, up to death or ``as_of``."""
    months = months_crossed(F.coalesce(death_date, as_of), as_date(LIFETIME_EPOCH))
    return ratio(expenses, F.greatest(months, F.lit(1)), 2)


def pmpm_by_age(expenses: Column, age: Column) -> Column:
    """Expenses per month of age; members under one year count as one."""
    years = F.greatest(F.coalesce(age, F.lit(1)), F.lit(1))
    return ratio(expenses, years * 12, 2)


def member_pmpm(members: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Both per-member-per-month cost measures."""
    expenses = F.col("total_healthcare_expenses")
    return members.select(
        "member_id",
        pmpm_lifetime(expenses, F.col("death_date"), as_date(as_of)).alias("cost_pmpm_lifetime"),
        pmpm_by_age(expenses, F.col("age_at_year_end")).alias("cost_pmpm"),
    )


def risk_tier() -> Column:
    """Tier of a profile row. The rules are tried in this order: high, moderate, rising cost, low."""
    score, admits, er = F.col("hcc_risk_score"), F.col("ip_admit_count"), F.col("er_visit_count")
    conditions, pmpm = F.col("condition_count"), F.col("cost_pmpm")
    high = (
        (score >= F.lit(HIGH_SCORE).cast(WEIGHT))
        | (admits >= HIGH_ADMITS)
        | (er >= HIGH_ER_VISITS)
        | (F.col("cc_cancer") == 1)
    )
    moderate = (
        (score >= F.lit(MODERATE_SCORE).cast(WEIGHT)) | (conditions >= MODERATE_CONDITIONS) | (pmpm >= MODERATE_PMPM)
    )
    rising = (conditions >= RISING_CONDITIONS) & ((admits >= RISING_ADMITS) | (er >= RISING_ER_VISITS))
    return F.when(high, "high").when(moderate, "moderate").when(rising, "rising_cost").otherwise("low")


def mart_member_risk_profile(
    members: DataFrame, flags: DataFrame, utilization: DataFrame, drugs: DataFrame, as_of: str | dt.date
) -> DataFrame:
    """One row per member: demographics, flags, utilization, cost and tier.

    All three right sides already hold one row per member and are partitioned by it after their
    aggregation, so the star costs one shuffle of the member table.
    """
    joined = (
        members.join(flags, "member_id", "left")
        .join(utilization, "member_id", "left")
        .join(drugs, "member_id", "left")
    )
    none = F.lit(0)
    zero_money = F.lit(0).cast(MONEY)
    expenses = F.coalesce("total_healthcare_expenses", zero_money)
    profile = joined.select(
        *MEMBER_COLUMNS,
        *[F.coalesce(flag, none).alias(flag) for flag in CONDITION_FLAGS.values()],
        F.coalesce("confirmed_condition_count", none).alias("condition_count"),
        F.coalesce("hcc_risk_score", F.lit(0).cast(WEIGHT)).alias("hcc_risk_score"),
        *[F.coalesce(name, none).alias(name) for name in VISIT_COUNTS + DRUG_COUNTS],
        F.coalesce("total_encounter_cost", zero_money).alias("total_encounter_cost"),
        F.coalesce("total_rx_cost", zero_money).alias("total_rx_cost"),
        expenses.alias("total_healthcare_expenses"),
        pmpm_lifetime(expenses, F.col("death_date"), as_date(as_of)).alias("cost_pmpm_lifetime"),
        pmpm_by_age(expenses, F.col("age_at_year_end")).alias("cost_pmpm"),
    )
    return profile.withColumn("risk_tier", risk_tier())
