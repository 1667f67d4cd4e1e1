"""Report tables over the marts, one function per table. Nothing is collected here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.numeric import mean, percent, ratio
from cohortry.functions.quantiles import exact_medians, exact_quantiles
from cohortry.functions.text import display_label
from cohortry.operators.cost import tier_rank
from cohortry.vocabulary import GAP_TYPES, RISK_TIERS

SAMPLE_FRACTION = 0.25
SAMPLE_SEED = 42


def _of_year(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("measurement_year") == year)


def _tier_domain(df: DataFrame) -> DataFrame:
    tiers = ", ".join(f"({position}, '{tier}')" for position, tier in enumerate(RISK_TIERS, start=1))
    return df.sparkSession.sql(f"select * from values {tiers} as tiers(tier_rank, risk_tier)")


def _rate(flag: str, digits: int = 6, half_even: bool = False) -> Column:
    """Average of a 0/1 column in percent, rounded once."""
    return ratio((F.sum(flag) * 100).cast("decimal(30,6)"), F.count(flag), digits, half_even)


# Population


def report_population_kpis(profile: DataFrame, year: int) -> DataFrame:
    """Members, high-risk count and share, mean score and cost."""
    high = F.col("risk_tier") == "high"
    return _of_year(profile, year).agg(
        F.count("*").alias("total_members"),
        F.count_if(high).alias("high_risk_members"),
        percent(high).alias("high_risk_pct"),
        mean("hcc_risk_score", 6).alias("avg_hcc_score"),
        mean("cost_pmpm", 6).alias("avg_cost_pmpm"),
    )


def report_tier_distribution(profile: DataFrame, year: int) -> DataFrame:
    """Members per tier over the fixed tier domain; absent tiers count 0."""
    counts = _of_year(profile, year).groupBy("risk_tier").agg(F.count("*").alias("member_count"))
    return (
        _tier_domain(profile)
        .join(counts, "risk_tier", "left")
        .select("tier_rank", "risk_tier", F.coalesce("member_count", F.lit(0)).alias("member_count"))
        .orderBy("tier_rank")
    )


def report_top_conditions(profile: DataFrame, year: int, limit: int | None = None) -> DataFrame:
    """All conditions by falling prevalence, with display names; flags are found by their prefix.

    A caller that shows fewer passes ``limit``.
    """
    flags = [name for name in profile.columns if name.startswith("cc_")]
    rates = _of_year(profile, year).agg(*[mean(flag, 6).alias(flag) for flag in flags])
    ranked = (
        rates.unpivot([], flags, "flag", "prevalence")
        .select(
            "flag",
            display_label(F.col("flag"), "cc_").alias("condition"),
            "prevalence",
            (F.col("prevalence") * 100).alias("prevalence_pct"),
        )
        .orderBy(F.desc("prevalence"), "flag")
    )
    return ranked if limit is None else ranked.limit(limit)


def report_hcc_box(profile: DataFrame, year: int) -> DataFrame:
    """Box-plot numbers of positive scores per tier, with exact quartiles."""
    scores = _of_year(profile, year).where(F.col("hcc_risk_score") > 0)
    return box_plot(scores, "risk_tier", "hcc_risk_score")


def box_plot(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers (the last values within one and a half interquartile ranges) and outliers per group of a decimal column.

    Groups of any number, size and values: quartiles are found without a state per value (``exact_quantiles``), and
    the whiskers are one more aggregation. Rows without a value or a group are left out.
    """
    rows = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    boxes = exact_quantiles(rows, [group], value, {"q1": "0.25", "median": "0.5", "q3": "0.75"})
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5).cast("decimal(2,1)")
    exact = F.col(value).cast("decimal(28,6)")
    inside = exact.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        rows.select(group, value).join(boxes, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.count("*").alias("member_count"),
            F.min(F.when(inside, exact)).alias("lower_whisker"),
            F.max(F.when(inside, exact)).alias("upper_whisker"),
            F.count_if(~inside).alias("outlier_count"),
        )
    )


def report_claim_cost_box(encounters: DataFrame) -> DataFrame:
    """Box-plot numbers of the paid amount per provider; encounters without a provider are left out."""
    return box_plot(encounters, "provider_id", "paid_amount").withColumnRenamed("member_count", "claim_count")


# Care gaps


def report_gaps_with_tier(gaps: DataFrame, profile: DataFrame, year: int) -> DataFrame:
    """Gap rows of a year with the member's tier of that year, if any."""
    tiers = _of_year(profile, year).select("member_id", "risk_tier")
    return _of_year(gaps, year).join(tiers, "member_id", "left")


def report_gap_kpis(gaps_with_tier: DataFrame) -> DataFrame:
    """Opportunities, open share and open share among high-risk members; 0 where there are none."""
    high = F.col("risk_tier") == "high"
    high_open = F.sum(F.when(high, F.col("gap_open")))
    nothing = F.lit(0).cast("decimal(28,6)")
    return gaps_with_tier.agg(
        F.count("*").alias("gap_opportunities"),
        F.coalesce(F.sum("gap_open"), F.lit(0)).alias("open_gaps"),
        F.coalesce(ratio((F.sum("gap_open") * 100).cast("decimal(30,6)"), F.count("*"), 6), nothing).alias(
            "open_rate_pct"
        ),
        F.coalesce(ratio((high_open * 100).cast("decimal(30,6)"), F.count_if(high), 6), nothing).alias(
            "high_risk_open_rate_pct"
        ),
    )


def report_gap_rate_by_tier(gaps_with_tier: DataFrame) -> DataFrame:
    """Open share per measure and tier."""
    return (
        gaps_with_tier.where(F.col("risk_tier").isNotNull())
        .groupBy("gap_type", "risk_tier")
        .agg(_rate("gap_open").alias("gap_rate_pct"))
        .withColumn("gap_type_label", display_label(F.col("gap_type")))
    )


def report_gap_summary(gaps_with_tier: DataFrame) -> DataFrame:
    """Distinct eligible members, open gaps and open share per measure, highest share first."""
    return (
        gaps_with_tier.groupBy("gap_type")
        .agg(
            F.count_distinct("member_id").alias("eligible_members"),
            F.sum("gap_open").alias("open_gaps"),
            _rate("gap_open", 1, half_even=True).alias("gap_rate_pct"),
        )
        .withColumn("gap_type_label", display_label(F.col("gap_type")))
        .orderBy(F.desc("gap_rate_pct"), "gap_type")
    )


def report_gap_heatmap(gaps_with_tier: DataFrame) -> DataFrame:
    """Open share by tier (rows, fixed order) and measure (columns); empty cells are NULL."""
    cells = gaps_with_tier.groupBy("risk_tier").pivot("gap_type", GAP_TYPES).agg(_rate("gap_open"))
    return _tier_domain(gaps_with_tier).join(cells, "risk_tier", "left").orderBy("tier_rank")


# Cost and utilization


def report_cost_kpis(cost: DataFrame, year: int) -> DataFrame:
    """Total cost, cost of the high tier and its ratio to the low tier; 0 where a tier is absent."""
    nothing = F.lit(0).cast("decimal(25,2)")

    def of_tier(tier: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("risk_tier") == tier, F.col("avg_cost_pmpm"))), nothing)

    totals = _of_year(cost, year).agg(
        F.sum("total_cost_ytd").alias("total_cost"), of_tier("high").alias("high_pmpm"), of_tier("low").alias("low_pmpm")
    )
    multiple = ratio(F.col("high_pmpm"), F.col("low_pmpm"), 6)
    return totals.select(
        "total_cost",
        "high_pmpm",
        F.when(F.col("low_pmpm") > 0, multiple).otherwise(F.lit(0).cast("decimal(28,6)")).alias("cost_ratio"),
    )


def report_cost_by_tier(cost: DataFrame, year: int) -> DataFrame:
    """Cost per tier, most expensive first, with the tier's reporting position."""
    return (
        _of_year(cost, year)
        .select("measurement_year", tier_rank().alias("tier_rank"), "risk_tier", "avg_cost_pmpm")
        .orderBy(F.desc("avg_cost_pmpm"), "tier_rank")
    )


def report_utilization_by_tier(cost: DataFrame, year: int) -> DataFrame:
    """Inpatient admissions and emergency visits per 1,000 members in long form."""
    return (
        _of_year(cost, year)
        .select(
            tier_rank().alias("tier_rank"),
            "risk_tier",
            F.col("ip_admits_per_1000").alias("IP"),
            F.col("er_visits_per_1000").alias("ER"),
        )
        .unpivot(["tier_rank", "risk_tier"], ["IP", "ER"], "visit_type", "per_1000")
        .orderBy("tier_rank", F.desc("visit_type"))
    )


def report_member_sample(
    profile: DataFrame, year: int, fraction: float = SAMPLE_FRACTION, seed: int = SAMPLE_SEED
) -> DataFrame:
    """A reproducible random sample of about ``fraction`` of the members.

    A member belongs to it if the first 32 bits of a seeded digest fall below that share: the same members at any
    size and partitioning, in one pass without a sort.
    """
    digest = F.md5(F.concat(F.col("member_id"), F.lit(f"-{seed}")).cast("binary"))
    lot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    columns = ["member_id", "hcc_risk_score", "cost_pmpm", "risk_tier", "condition_count", "age_at_year_end"]
    return _of_year(profile, year).select(*columns).where(lot < int(fraction * 2**32))


def report_key_insight(cost: DataFrame, year: int) -> DataFrame:
    """The tier with the highest cost, its cost and its population share."""
    return (
        _of_year(cost, year)
        .orderBy(F.desc("avg_cost_pmpm"), tier_rank())
        .limit(1)
        .select("risk_tier", "avg_cost_pmpm", "pct_of_population")
    )


# Providers


def report_top_providers(efficiency: DataFrame, limit: int | None = None) -> DataFrame:
    """All providers by falling number of attributed members; a caller that shows fewer passes ``limit``."""
    ranked = efficiency.orderBy(F.desc("attributed_member_count"), "provider_npi")
    return ranked if limit is None else ranked.limit(limit)


def report_provider_kpis(efficiency: DataFrame) -> DataFrame:
    """Providers, how many are high value, and their mean gap closure."""
    return efficiency.agg(
        F.count("*").alias("providers"),
        F.count_if(F.col("efficiency_quadrant") == "High Value").alias("high_value_providers"),
        mean("gap_closure_rate_pct", 6).alias("avg_gap_closure_pct"),
    )


def report_provider_quadrant_points(efficiency: DataFrame) -> DataFrame:
    """Scatter points with the medians over the same providers; ``efficiency`` is read several times."""
    medians = exact_medians(efficiency, {"avg_cost_pmpm": "shown_median_cost", "avg_hcc_score": "shown_median_hcc"})
    points = efficiency.select(
        "provider_npi",
        "avg_hcc_score",
        "avg_cost_pmpm",
        "attributed_member_count",
        "efficiency_quadrant",
        "gap_closure_rate_pct",
        "top_condition",
    )
    # One row, so the broadcast has a fixed size.
    return points.crossJoin(F.broadcast(medians))


def report_provider_scorecard(efficiency: DataFrame) -> DataFrame:
    """The scorecard columns in display form; halves round to even, as in the displayed table."""
    return efficiency.select(
        F.col("provider_npi").alias("npi"),
        F.col("attributed_member_count").alias("members"),
        F.bround("avg_cost_pmpm", 0).alias("avg_pmpm"),
        F.round("avg_hcc_score", 3).alias("avg_hcc_score"),
        F.col("gap_closure_rate_pct").alias("gap_closure_pct"),
        "top_condition",
        F.col("efficiency_quadrant").alias("quadrant"),
    )


def as_display_numbers(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for consumers that cannot take decimals."""
    return df.select(
        *[F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name) for name, kind in df.dtypes]
    )
