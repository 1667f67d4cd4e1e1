from __future__ import annotations

from decimal import Decimal

from cohortry.operators import reports
from cohortry.vocabulary import GAP_TYPES, RISK_TIERS


def cost_rows(spark, *records):
    columns = "risk_tier string, measurement_year int, avg_cost_pmpm decimal(25,2), total_cost_ytd decimal(28,2), pct_of_population decimal(25,1)"
    return spark.createDataFrame([(t, y, Decimal(p), Decimal(c), Decimal("50.0")) for t, y, p, c in records], columns)


def test_tier_distribution_is_complete_and_ordered(spark):
    profile = spark.createDataFrame([("low", 2000), ("low", 2000), ("high", 2000), ("moderate", 1999)], "risk_tier string, measurement_year int")
    found = reports.report_tier_distribution(profile, 2000).collect()
    assert [(r["risk_tier"], r["member_count"]) for r in found] == [("high", 1), ("rising_cost", 0), ("moderate", 0), ("low", 2)]
    assert [r["risk_tier"] for r in found] == RISK_TIERS


def test_cost_kpis_without_a_low_tier(spark):
    (row,) = reports.report_cost_kpis(cost_rows(spark, ("high", 2000, "9.00", "90.00")), 2000).collect()
    assert (row["total_cost"], row["high_pmpm"], row["cost_ratio"]) == (Decimal("90.00"), Decimal("9.00"), 0)
    both = cost_rows(spark, ("high", 2000, "9.00", "90.00"), ("low", 2000, "2.00", "1.00"), ("low", 1999, "1.00", "1.00"))
    (row,) = reports.report_cost_kpis(both, 2000).collect()
    assert row["cost_ratio"] == Decimal("4.5")


def test_key_insight_breaks_ties_by_tier_order(spark):
    rows = cost_rows(spark, ("low", 2000, "9.00", "1.00"), ("rising_cost", 2000, "9.00", "1.00"), ("high", 1999, "99.00", "1.00"))
    assert reports.report_key_insight(rows, 2000).head()["risk_tier"] == "rising_cost"


def test_gap_reports(spark):
    gaps = spark.createDataFrame(
        [("a", "diabetes_a1c", 1, "high"), ("b", "diabetes_a1c", 0, "high"), ("c", "readmission_30d", 0, None)],
        "member_id string, gap_type string, gap_open int, risk_tier string",
    )
    kpis = reports.report_gap_kpis(gaps).head()
    assert (kpis["gap_opportunities"], kpis["open_gaps"], float(kpis["high_risk_open_rate_pct"])) == (3, 1, 50.0)
    empty = reports.report_gap_kpis(gaps.limit(0)).head()
    assert (empty["open_rate_pct"], empty["high_risk_open_rate_pct"]) == (0, 0)
    heat = reports.report_gap_heatmap(gaps).collect()
    assert [r["risk_tier"] for r in heat] == RISK_TIERS
    assert set(GAP_TYPES) < set(heat[0].asDict())
    assert float(heat[0]["diabetes_a1c"]) == 50.0 and heat[0]["readmission_30d"] is None and heat[1]["diabetes_a1c"] is None
    summary = reports.report_gap_summary(gaps).collect()
    assert [r["gap_type_label"] for r in summary] == ["Diabetes A1C", "Readmission 30D"]


def test_member_sample_does_not_depend_on_partitioning(spark):
    profile = spark.range(5000).selectExpr(
        "cast(id as string) as member_id", "2000 as measurement_year", "0.5 as hcc_risk_score", "1.0 as cost_pmpm",
        "'low' as risk_tier", "1 as condition_count", "40 as age_at_year_end",
    )
    one = {r["member_id"] for r in reports.report_member_sample(profile.coalesce(1), 2000, fraction=0.1).collect()}
    many = {r["member_id"] for r in reports.report_member_sample(profile.repartition(9), 2000, fraction=0.1).collect()}
    assert one == many and 400 < len(one) < 600
    assert one != {r["member_id"] for r in reports.report_member_sample(profile, 2000, fraction=0.1, seed=7).collect()}
    # A share at every size: a part of the members is drawn as they are drawn among all.
    few = {r["member_id"] for r in reports.report_member_sample(profile.where("cast(member_id as int) < 1000"), 2000, fraction=0.1).collect()}
    assert few == {m for m in one if int(m) < 1000}
    assert reports.report_member_sample(profile, 2000, fraction=1.0).count() == 5000


def test_reports_have_no_cap(spark):
    providers = spark.range(1000).selectExpr(
        "cast(id as string) as provider_npi", "cast(id as decimal(9,3)) as avg_hcc_score", "cast(id * 3 as decimal(18,2)) as avg_cost_pmpm",
        "id as attributed_member_count", "if(id >= 400, 'High Value', 'Low Value') as efficiency_quadrant",
        "cast(50 as decimal(9,1)) as gap_closure_rate_pct", "'x' as top_condition",
    )
    assert reports.report_top_providers(providers).count() == 1000 and reports.report_top_providers(providers, limit=7).count() == 7
    kpis = reports.report_provider_kpis(providers).head()
    assert (kpis["providers"], kpis["high_value_providers"]) == (1000, 600)
    point = reports.report_provider_quadrant_points(providers).head()
    assert (float(point["shown_median_cost"]), float(point["shown_median_hcc"])) == (1498.5, 499.5)
    assert reports.report_provider_scorecard(providers).count() == 1000


def test_scores_box_and_display_numbers(spark):
    scores = [1, 2, 3, 4, 100]
    profile = spark.createDataFrame([("low", 2000, Decimal(s)) for s in scores] + [("low", 2000, Decimal(0))], "risk_tier string, measurement_year int, hcc_risk_score decimal(9,3)")
    row = reports.report_hcc_box(profile, 2000).head()
    assert [float(row[c]) for c in ("q1", "median", "q3", "lower_whisker", "upper_whisker")] == [2, 3, 4, 1, 4]
    assert (row["member_count"], row["outlier_count"]) == (5, 1)
    shown = reports.as_display_numbers(profile)
    assert dict(shown.dtypes)["hcc_risk_score"] == "double"
