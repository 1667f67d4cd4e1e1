"""Provider attribution, spend, top condition and efficiency scorecard.

``claims`` is the claim-line spine or the smaller claim panel; both give the same results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.numeric import RATIO_TYPE, ratio
from cohortry.functions.quantiles import exact_medians
from cohortry.vocabulary import MIN_ATTRIBUTED_MEMBERS

RATE_TYPE = "decimal(18,9)"


def billable_claims(claims: DataFrame) -> DataFrame:
    """Claim lines with a provider."""
    return claims.where("provider_npi is not null and provider_npi <> ''")


def primary_provider(claims: DataFrame) -> DataFrame:
    """The provider with most claims per member; the smaller id wins a tie.

    Only the best row per member and task is shuffled (window group limit).
    """
    visits = (
        billable_claims(claims)
        .groupBy("member_id", "provider_npi")
        .agg(F.count_distinct("claim_id").alias("claim_count"))
    )
    best = Window.partitionBy("member_id").orderBy(F.desc("claim_count"), "provider_npi")
    return visits.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")


def provider_spend(claims: DataFrame) -> DataFrame:
    """Spend and distinct members per provider, over everyone the provider ever saw.

    Lines are reduced to (provider, member) first: a provider with a large share of all lines is
    spread by member, and two distinct counts become plain sums.
    """
    pairs = (
        billable_claims(claims)
        .groupBy("provider_npi", "member_id")
        .agg(
            F.sum("paid_amount").alias("paid_amount"),
            F.max((F.col("claim_type") == "inpatient").cast("int")).alias("inpatient"),
        )
    )
    return pairs.groupBy("provider_npi").agg(
        F.sum("paid_amount").cast("decimal(28,2)").alias("total_spend"),
        F.count("member_id").alias("attributed_member_count"),
        F.sum("inpatient").alias("members_with_ip"),
    )


def provider_top_condition(dx: DataFrame, claims: DataFrame) -> DataFrame:
    """Most frequent condition category per provider over all (diagnosis, claim line) pairs of an encounter.

    Pairs are never formed: both sides are counted per encounter and the counts multiplied. The
    alphabetically first category wins a tie.
    """
    diagnoses = (
        dx.where("condition_category is not null and encounter_id is not null")
        .groupBy(F.col("encounter_id").alias("claim_id"), "condition_category")
        .agg(F.count("*").alias("diagnoses"))
    )
    line_count = F.sum("lines") if "lines" in claims.columns else F.count("*")
    lines = billable_claims(claims).groupBy("claim_id", "provider_npi").agg(line_count.alias("lines"))
    pairs = (
        lines.join(diagnoses, "claim_id")
        .groupBy("provider_npi", "condition_category")
        .agg(F.sum(F.col("diagnoses") * F.col("lines")).alias("pair_count"))
    )
    best = Window.partitionBy("provider_npi").orderBy(F.desc("pair_count"), "condition_category")
    return pairs.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")


def gap_closure_by_member(gaps: DataFrame) -> DataFrame:
    """Share of a member's measures that are closed."""
    closed = F.count_if(F.col("gap_open") == 0).cast("decimal(18,0)")
    return gaps.groupBy("member_id").agg((closed / F.count("*")).cast(RATE_TYPE).alias("gap_closure_rate"))


def provider_assembled(
    primary: DataFrame, profile: DataFrame, spend: DataFrame, closure: DataFrame, top_condition: DataFrame
) -> DataFrame:
    """One row per primary provider with averages over the members attributed to it.

    Member averages are formed before the provider-grain tables are joined, so those joins are one
    to one and a provider with very many members does not skew them.
    """
    panel = (
        primary.select("member_id", "provider_npi")
        .join(profile.select("member_id", "hcc_risk_score", "cost_pmpm", "condition_count"), "member_id")
        .join(closure, "member_id", "left")
        .groupBy("provider_npi")
        .agg(
            F.sum("hcc_risk_score").alias("score_sum"),
            F.count("hcc_risk_score").alias("score_rows"),
            F.sum("cost_pmpm").alias("cost_sum"),
            F.count("cost_pmpm").alias("cost_rows"),
            F.sum("gap_closure_rate").alias("rate_sum"),
            F.count("gap_closure_rate").alias("rate_rows"),
            F.sum("condition_count").cast("decimal(28,0)").alias("condition_sum"),
            F.count("condition_count").alias("condition_rows"),
        )
    )
    joined = panel.join(spend, "provider_npi").join(
        top_condition.select("provider_npi", F.col("condition_category").alias("top_condition")),
        "provider_npi",
        "left",
    )
    # Mean cost over mean score; the counts differ only where one of the two is missing.
    cost_per_unit = ratio(
        (F.col("cost_sum") * F.col("score_rows")).cast(RATIO_TYPE),
        (F.col("score_sum") * F.col("cost_rows")).cast(RATIO_TYPE),
        2,
    )
    return joined.select(
        "provider_npi",
        "attributed_member_count",
        ratio(F.col("score_sum"), F.col("score_rows"), 3).alias("avg_hcc_score"),
        ratio(F.col("cost_sum"), F.col("cost_rows"), 2).alias("avg_cost_pmpm"),
        F.round("total_spend", 2).alias("total_attributed_spend"),
        cost_per_unit.alias("cost_per_hcc_unit"),
        ratio(F.col("rate_sum") * 100, F.col("rate_rows"), 1).alias("gap_closure_rate_pct"),
        ratio(F.col("condition_sum"), F.col("condition_rows"), 1).alias("avg_condition_count"),
        "top_condition",
    )


def provider_quadrants(assembled: DataFrame) -> DataFrame:
    """Every assembled provider with the population medians and its quadrant.

    Reads ``assembled`` several times; pass a written table. Both medians are one-row tables, so
    their broadcast has a fixed size.
    """
    cost, score = F.col("avg_cost_pmpm"), F.col("avg_hcc_score")
    median_cost, median_score = F.col("median_cost"), F.col("median_hcc")
    quadrant = (
        F.when((cost <= median_cost) & (score >= median_score), "High Value")
        .when((cost > median_cost) & (score < median_score), "Low Value")
        .when((cost > median_cost) & (score >= median_score), "Complex High Cost")
        .otherwise("Complex Managed")
    )
    return (
        # One row, so the broadcast has a fixed size.
        assembled.crossJoin(F.broadcast(exact_medians(assembled, {"avg_cost_pmpm": "median_cost", "avg_hcc_score": "median_hcc"})))
        .withColumn("efficiency_quadrant", quadrant)
    )


def mart_provider_efficiency(assembled: DataFrame, min_members: int = MIN_ATTRIBUTED_MEMBERS) -> DataFrame:
    """The scorecard of providers with enough members. Medians are taken before this filter."""
    return provider_quadrants(assembled).where(F.col("attributed_member_count") >= min_members)
