"""Diagnosis categories, member condition summary and member flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.codes import condition_flag
from cohortry.schemas import WEIGHT
from cohortry.vocabulary import CONDITION_FLAGS, SCORE_CAP


def typed_condition_map(seed: DataFrame) -> DataFrame:
    """The code-to-category seed with text codes and exact weights."""
    return seed.select(
        F.col("snomed_code").cast("string").alias("snomed_code"),
        "condition_category",
        "condition_label",
        "hcc_category",
        F.col("hcc_weight").cast(WEIGHT).alias("hcc_weight"),
    )


def condition_map_usage(seed: DataFrame, conditions: DataFrame) -> DataFrame:
    """The typed seed with how many diagnoses use each code; unused codes count 0."""
    used = conditions.groupBy("snomed_code").agg(F.count("*").alias("diagnoses"))
    return (
        typed_condition_map(seed)
        .join(used, "snomed_code", "left")
        .withColumn("diagnoses", F.coalesce("diagnoses", F.lit(0)))
    )


def int_dx_code_flags(conditions: DataFrame, seed: DataFrame) -> DataFrame:
    """Every diagnosis with its category and weight; unmapped codes keep NULLs.

    No broadcast hint: Spark compares the seed's size with its broadcast threshold itself and
    otherwise joins by shuffle, where adaptive execution splits a code that dominates the table.
    """
    diagnoses = conditions.where(F.col("snomed_code").isNotNull()).select(
        "condition_id",
        "member_id",
        "encounter_id",
        F.col("onset_date").alias("service_date"),
        F.col("onset_year").alias("service_year"),
        F.col("snomed_code").alias("dx_code"),
        "condition_description",
        "is_active",
        "resolution_date",
    )
    mapping = typed_condition_map(seed).withColumnRenamed("snomed_code", "dx_code")
    joined = diagnoses.join(mapping, "dx_code", "left")
    return joined.select(
        *diagnoses.columns[:-1], "condition_category", "condition_label", "hcc_category", "hcc_weight"
    )


def int_member_condition_summary(dx: DataFrame) -> DataFrame:
    """One row per member and category. Every occurrence adds its weight."""
    return (
        dx.where(F.col("condition_category").isNotNull())
        .groupBy("member_id", "condition_category")
        .agg(
            F.count_distinct("dx_code").alias("distinct_codes"),
            F.count("*").alias("total_occurrences"),
            F.min("service_date").alias("first_dx_date"),
            F.max("service_date").alias("last_dx_date"),
            F.max(F.col("is_active").cast("int")).alias("currently_active"),
            F.sum("hcc_weight").alias("raw_hcc_contribution"),
        )
    )


def int_member_chronic_flags(summary: DataFrame) -> DataFrame:
    """One row per member: condition flags, number of categories, capped and raw score.

    Categories outside the known domain count as conditions but have no flag. The input holds one
    row per member and category, so counting rows counts categories.
    """
    raw_score = F.coalesce(F.sum("raw_hcc_contribution"), F.lit(0).cast(WEIGHT))
    return summary.groupBy("member_id").agg(
        *[condition_flag(category).alias(flag) for category, flag in CONDITION_FLAGS.items()],
        F.count("condition_category").alias("confirmed_condition_count"),
        F.round(F.least(raw_score, F.lit(SCORE_CAP).cast(WEIGHT)), 3).cast(WEIGHT).alias("hcc_risk_score"),
        raw_score.cast("decimal(19,3)").alias("hcc_risk_score_raw"),
    )
