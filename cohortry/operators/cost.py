"""Cost and utilization by risk tier."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.numeric import mean, percent, ratio
from cohortry.vocabulary import RISK_TIERS, SPEND_SPLIT


def tier_rank(tier: str | Column = "risk_tier") -> Column:
    """Reporting position of a tier; unknown tiers come last."""
    column = F.col(tier) if isinstance(tier, str) else tier
    ranks = None
    for position, name in enumerate(RISK_TIERS, start=1):
        ranks = F.when(column == name, position) if ranks is None else ranks.when(column == name, position)
    return ranks.otherwise(len(RISK_TIERS) + 1)


def mart_cost_utilization(profile: DataFrame, split: tuple[str, str, str] = SPEND_SPLIT) -> DataFrame:
    """One row per tier and year: member count, average costs, rates per 1,000 and population shares.

    ``split`` are the fixed inpatient, outpatient and professional parts of encounter cost. The
    share windows run on the aggregated rows, a handful per year.
    """
    inpatient, outpatient, professional = (F.lit(Decimal(part)) for part in split)
    members = F.count_distinct("member_id")

    def per_thousand(name: str) -> Column:
        return ratio((F.sum(name) * 1000).cast("decimal(30,6)"), members, 1)

    def spend_part(part: Column) -> Column:
        return ratio((F.sum("total_encounter_cost") * part).cast("decimal(30,6)"), F.count("total_encounter_cost"), 2)

    tiers = profile.groupBy("risk_tier", "measurement_year").agg(
        members.alias("member_count"),
        mean("cost_pmpm", 2).alias("avg_cost_pmpm"),
        F.round(F.sum("total_healthcare_expenses"), 2).alias("total_cost_ytd"),
        spend_part(inpatient).alias("avg_inpatient_spend"),
        spend_part(outpatient).alias("avg_outpatient_spend"),
        spend_part(professional).alias("avg_professional_spend"),
        mean("total_rx_cost", 2).alias("avg_rx_spend"),
        per_thousand("ip_admit_count").alias("ip_admits_per_1000"),
        per_thousand("er_visit_count").alias("er_visits_per_1000"),
        per_thousand("distinct_drugs").alias("rx_fills_per_1000"),
        mean("hcc_risk_score", 3).alias("avg_hcc_risk_score"),
        mean("condition_count", 1).alias("avg_condition_count"),
        mean("distinct_drugs", 1).alias("avg_distinct_drugs"),
        mean("age_at_year_end", 1).alias("avg_age"),
        percent(F.col("sex") == "F").alias("pct_female"),
    )
    same_year = Window.partitionBy("measurement_year")

    def share(name: str) -> Column:
        part, whole = F.col(name), F.sum(name).over(same_year)
        return ratio((part * 100).cast("decimal(30,6)"), whole.cast("decimal(30,6)"), 1)

    return tiers.select(
        "*",
        share("member_count").alias("pct_of_population"),
        share("total_cost_ytd").alias("pct_of_total_cost"),
    ).orderBy("measurement_year", tier_rank())
