"""Staging, spine, conditions, risk, gaps and providers on hand-computed and random inputs."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortry import schemas
from cohortry.operators import claims, codes, conditions, cost, gaps, providers, risk, staging
from cohortry.vocabulary import CONDITION_FLAGS


def day(text):
    return dt.date.fromisoformat(text)


def raw(spark, schema, *records):
    """Rows of a raw table given as dicts; unnamed columns are NULL."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


# Staging


def test_members(spark, rows):
    patients = raw(
        spark,
        schemas.PATIENTS,
        {"Id": "1", "BIRTHDATE": day("1960-12-31"), "GENDER": "m", "RACE": "WHITE", "ETHNICITY": "non-hispanic"},
        {"Id": "2", "BIRTHDATE": day("2023-06-01"), "GENDER": "X", "HEALTHCARE_EXPENSES": Decimal("10.00")},
        {"Id": "3", "DEATHDATE": day("2001-01-01"), "HEALTHCARE_COVERAGE": Decimal("4.00"), "GENDER": "F"},
        {"Id": None},
    )
    first, second, third = rows(staging.stg_members(patients, 2023))
    assert (first["age_at_year_end"], first["sex"], first["race"], first["ethnicity"]) == (63, "M", "White", "Non-Hispanic")
    assert (second["age_at_year_end"], second["sex"], second["total_out_of_pocket"]) == (0, "U", Decimal("10.00"))
    assert (third["is_deceased"], third["total_out_of_pocket"], third["sex"]) == (True, Decimal("-4.00"), "F")
    assert first["measurement_year"] == 2023 and not first["is_deceased"]


@pytest.mark.parametrize(
    "encounter_class, expected",
    [("UrgentCare", "outpatient"), ("snf", "outpatient"), (None, "outpatient"), ("Inpatient", "inpatient"),
     ("EMERGENCY", "emergency"), ("wellness", "carrier"), ("home", "carrier"), ("office", "carrier")],
)
def test_claim_types(spark, encounter_class, expected):
    encounters = raw(
        spark,
        schemas.ENCOUNTERS,
        {"Id": "e", "PATIENT": "p", "START": dt.datetime(2020, 5, 1, 23, 59), "ENCOUNTERCLASS": encounter_class,
         "TOTAL_CLAIM_COST": Decimal("100.00"), "PAYER_COVERAGE": Decimal("80.00")},
        {"Id": "no start", "PATIENT": "p"},
        {"PATIENT": "p", "START": dt.datetime(2020, 5, 1)},
    )
    (row,) = staging.stg_encounters(encounters).collect()
    assert row["claim_type"] == expected
    assert row["member_paid_amount"] == Decimal("20.00") and row["base_encounter_cost"] == 0
    assert row["service_date"] == day("2020-05-01") and row["service_end_date"] is None and row["service_year"] == 2020


def test_medications_default_to_one_dispense(spark):
    (row,) = staging.stg_medications(
        raw(spark, schemas.MEDICATIONS, {"PATIENT": "p", "CODE": "c"}, {"PATIENT": "p"}, {"CODE": "c"})
    ).collect()
    assert row["dispenses"] == 1 and row["is_active"] and row["total_drug_cost"] == 0


# Spine


def small_world(spark, seed=0, members=6, encounters=40, lines=160, hot=False):
    """Random encounters, diagnoses and procedures with unknown encounters, strangers and repeats."""
    draw = random.Random(seed)

    def member():
        return "m0" if hot and draw.random() < 0.4 else f"m{draw.randrange(members)}"

    def encounter():
        return draw.choice([None, "unknown", *(f"e{draw.randrange(encounters)}" for _ in range(12))])

    enc = [
        {
            "Id": f"e{i}",
            "PATIENT": member(),
            "PROVIDER": draw.choice([None, "", "p1", "p2", "p3"]),
            "START": (start := dt.datetime(2000, 1, 1) + dt.timedelta(days=draw.randrange(120))),
            "STOP": draw.choice([None, start + dt.timedelta(days=draw.randrange(-3, 12))]),
            "ENCOUNTERCLASS": draw.choice(["inpatient", "inpatient", "emergency", "office", None]),
            "TOTAL_CLAIM_COST": Decimal(draw.randrange(10_000)) / 100,
        }
        for i in range(encounters)
    ]
    cond = [
        {"PATIENT": member(), "ENCOUNTER": encounter(), "START": day("2000-02-01"), "CODE": str(draw.randrange(8))}
        for _ in range(lines)
    ]
    proc = [
        {"PATIENT": member(), "ENCOUNTER": encounter(), "DATE": day("2000-03-01"), "CODE": str(draw.randrange(9))}
        for _ in range(lines)
    ]
    seed_map = spark.createDataFrame(
        [("1", "chf", "CHF", "H1", 0.1), ("2", "ckd", "CKD", "H2", 0.25), ("3", "chf", "CHF", "H1", 0.3),
         ("4", "rare", "Rare", "H9", None)],
        schemas.CONDITION_MAP_SEED,
    )
    return (
        staging.stg_encounters(raw(spark, schemas.ENCOUNTERS, *enc)),
        staging.stg_conditions(raw(spark, schemas.CONDITIONS, *cond)),
        staging.stg_procedures(raw(spark, schemas.PROCEDURES, *proc)),
        seed_map,
    )


def test_spine_equals_separate_joins_and_keeps_spend(spark, rows):
    enc, cond, proc, seed_map = small_world(spark)
    spine = claims.int_claims_unioned(enc, cond, proc)
    headers = spine.where("claims_line_id = claim_id")
    apart = headers.unionByName(claims.claims_dx_lines(cond, enc)).unionByName(claims.claims_procedure_lines(proc, enc))
    assert rows(spine) == rows(apart)
    assert spine.agg(F.sum("paid_amount")).head()[0] == enc.agg(F.sum("paid_amount")).head()[0]
    assert spine.where("claim_id = 'unknown'").count() == 0
    scored = conditions.int_dx_code_flags(cond, seed_map)
    assert scored.count() == cond.count() and scored.where("encounter_id = 'unknown'").count() > 0


@pytest.mark.parametrize("seed", range(3))
def test_claim_panel_equals_the_counted_spine(spark, rows, seed):
    enc, cond, proc, seed_map = small_world(spark, seed=seed, hot=True)
    spine, panel = claims.int_claims_unioned(enc, cond, proc), claims.claim_panel(enc, cond, proc)
    keys = ["claim_id", "member_id", "provider_npi", "claim_type"]
    counted = spine.groupBy(*keys).agg(F.count("*").alias("lines"), F.sum("paid_amount").alias("paid_amount"))
    summed = panel.groupBy(*keys).agg(F.sum("lines").alias("lines"), F.sum("paid_amount").alias("paid_amount"))
    assert rows(counted) == rows(summed)
    mapped = conditions.int_dx_code_flags(cond, seed_map)
    assert rows(providers.primary_provider(spine)) == rows(providers.primary_provider(panel))
    assert rows(providers.provider_spend(spine)) == rows(providers.provider_spend(panel))
    assert rows(providers.provider_top_condition(mapped, spine)) == rows(providers.provider_top_condition(mapped, panel))


# Conditions and score


def dx(spark, *records):
    columns = "member_id string, dx_code string, service_date date, is_active boolean, condition_category string, hcc_weight decimal(9,3)"
    return spark.createDataFrame(
        [(m, c, day("2000-01-01"), True, cat, None if w is None else Decimal(w)) for m, c, cat, w in records], columns
    )


def test_scores_and_flags(spark, rows):
    flags = rows(
        conditions.int_member_chronic_flags(
            conditions.int_member_condition_summary(
                dx(
                    spark,
                    ("a", "1", "chf", "0.3"),
                    ("a", "1", "chf", "0.3"),
                    ("b", "1", "cancer_solid", "7.2"),
                    ("c", "9", "rare", None),
                    ("c", "8", "diabetes_t2", None),
                    ("d", "7", None, "1.0"),
                )
            )
        )
    )
    by_member = {r["member_id"]: r for r in flags}
    assert set(by_member) == {"a", "b", "c"}
    assert by_member["a"]["hcc_risk_score"] == Decimal("0.600") and by_member["a"]["confirmed_condition_count"] == 1
    assert (by_member["b"]["hcc_risk_score"], by_member["b"]["hcc_risk_score_raw"]) == (Decimal("5.000"), Decimal("7.200"))
    assert by_member["b"]["cc_cancer"] == 1
    assert by_member["c"]["hcc_risk_score"] == 0 and by_member["c"]["confirmed_condition_count"] == 2
    assert sum(by_member["c"][flag] for flag in CONDITION_FLAGS.values()) == 1 and by_member["c"]["cc_diabetes"] == 1


# Risk tiers

QUIET = {"hcc_risk_score": "0", "ip_admit_count": 0, "er_visit_count": 0, "cc_cancer": 0, "condition_count": 0, "cost_pmpm": "0"}


@pytest.mark.parametrize(
    "profile, tier",
    [
        ({"hcc_risk_score": "1.5"}, "high"),
        ({"hcc_risk_score": "1.499"}, "moderate"),
        ({"cc_cancer": 1}, "high"),
        ({"condition_count": 4}, "moderate"),
        ({"condition_count": 2, "ip_admit_count": 1, "cost_pmpm": "999.99"}, "rising_cost"),
        ({"condition_count": 2, "er_visit_count": 1}, "low"),
        ({"condition_count": 2, "er_visit_count": 2}, "rising_cost"),
        ({"condition_count": 1, "ip_admit_count": 2}, "low"),
        ({"cost_pmpm": "1000"}, "moderate"),
        ({"ip_admit_count": 3}, "high"),
        ({"er_visit_count": 5}, "high"),
    ],
)
def test_risk_tiers(spark, profile, tier):
    values = {**QUIET, **profile}
    columns = [
        F.lit(Decimal(v)).alias(k) if isinstance(v, str) else F.lit(v).alias(k) for k, v in values.items()
    ]
    assert spark.range(1).select(*columns).select(risk.risk_tier().alias("t")).head()["t"] == tier


def test_pmpm_divisors(spark):
    members = staging.stg_members(
        raw(
            spark,
            schemas.PATIENTS,
            {"Id": "baby", "BIRTHDATE": day("2023-06-01"), "HEALTHCARE_EXPENSES": Decimal("120.00")},
            {"Id": "dead", "BIRTHDATE": day("1923-06-01"), "DEATHDATE": day("1950-03-01"), "HEALTHCARE_EXPENSES": Decimal("10.00")},
        ),
        2023,
    )
    found = {r["member_id"]: r for r in risk.member_pmpm(members, "2001-12-31").collect()}
    assert found["baby"]["cost_pmpm"] == Decimal("10.00")
    assert found["baby"]["cost_pmpm_lifetime"] == Decimal("0.19")
    assert found["dead"]["cost_pmpm_lifetime"] == Decimal("5.00")


# Readmissions


def stays(spark, *records):
    return spark.createDataFrame(
        [(m, e, day(a), d and day(d), "inpatient") for m, e, a, d in records],
        "member_id string, encounter_id string, service_date date, service_end_date date, claim_type string",
    )


@pytest.mark.parametrize(
    "admit, expected",
    [("2020-01-10", 0), ("2020-01-11", 1), ("2020-02-09", 1), ("2020-02-10", 0), ("2020-01-09", 0)],
)
def test_readmission_window(spark, admit, expected):
    found = gaps.readmission_flags(
        stays(spark, ("a", "1", "2020-01-05", "2020-01-10"), ("a", "2", admit, admit), ("b", "3", "2020-01-20", None))
    ).collect()
    by_member = {r["member_id"]: r for r in found}
    assert by_member["a"]["had_readmission"] == expected
    assert by_member["a"]["readmission_date"] == (day(admit) if expected else None)
    assert by_member["b"]["had_readmission"] == 0


@pytest.mark.parametrize("seed", range(4))
def test_readmissions_equal_the_plain_window(spark, rows, seed):
    enc, *_ = small_world(spark, seed=seed, members=3, encounters=120, hot=True)
    window = Window.partitionBy("member_id").orderBy("service_date", "encounter_id")
    apart = F.date_diff("service_date", F.lag("service_end_date").over(window))
    plain = (
        enc.where("claim_type = 'inpatient'")
        .withColumn("hit", F.coalesce(apart.between(1, 30), F.lit(False)))
        .groupBy("member_id")
        .agg(
            F.max(F.col("hit").cast("int")).alias("had_readmission"),
            F.max(F.when(F.col("hit"), F.col("service_date"))).alias("readmission_date"),
        )
    )
    assert rows(gaps.readmission_flags(enc)) == rows(plain)


# Care gaps


def profile_rows(spark, *records):
    return spark.createDataFrame(records, "member_id string, measurement_year int, cc_diabetes int, distinct_drugs bigint")


def test_gap_closure_rules(spark):
    profile = profile_rows(spark, ("d1", 2000, 1, 0), ("d2", 2000, 1, 5), ("n", 2000, 0, 4), ("r", 2000, 0, 6))
    procedures = staging.stg_procedures(
        raw(
            spark,
            schemas.PROCEDURES,
            {"PATIENT": "d1", "CODE": "59408-5", "DATE": day("2000-01-01")},
            {"PATIENT": "d2", "CODE": "43396009", "DATE": day("1999-01-01")},
            {"PATIENT": "d2", "CODE": "reconcil", "DATE": day("2000-01-01")},
            {"PATIENT": "r", "CODE": "reconciliation", "DATE": day("2000-01-01")},
            {"PATIENT": "n", "CODE": "43396009", "DATE": day("2000-01-01")},
        )
    )
    encounters = stays(spark, ("n", "1", "2000-01-01", "2000-01-02"), ("n", "2", "2000-01-10", "2000-01-12"))

    def measured(**options):
        found = gaps.mart_care_gaps(profile, procedures, encounters, **options).collect()
        return {(r["member_id"], r["gap_type"]): (r["gap_open"], r["last_service_date"]) for r in found}

    result = measured()
    assert result[("d1", "diabetes_a1c")] == (0, None)
    assert result[("d2", "diabetes_a1c")] == (0, day("1999-01-01"))
    assert result[("d1", "diabetes_eye_exam")] == (1, None)
    assert result[("d2", "high_risk_med_review")] == (0, None)
    assert result[("r", "high_risk_med_review")] == (1, None)
    assert ("n", "diabetes_a1c") not in result and ("n", "high_risk_med_review") not in result
    assert {m for m, g in result if g == "readmission_30d"} == {"d1", "d2", "n", "r"}
    assert result[("n", "readmission_30d")] == (1, day("2000-01-10"))
    assert measured(year=2000)[("d2", "diabetes_a1c")] == (1, None)
    assert {m for m, g in measured(inpatient_only=True) if g == "readmission_30d"} == {"n"}
    keys = [r["gap_id"] for r in gaps.mart_care_gaps(profile, procedures, encounters).collect()]
    assert len(keys) == len(set(keys)) == len(result)


# Cost


def test_cost_shares_per_year(spark):
    columns = (
        "member_id string, risk_tier string, measurement_year int, cost_pmpm decimal(18,2), total_healthcare_expenses"
        " decimal(18,2), total_encounter_cost decimal(28,2), total_rx_cost decimal(28,2), ip_admit_count bigint,"
        " er_visit_count bigint, distinct_drugs bigint, hcc_risk_score decimal(9,3), condition_count bigint,"
        " age_at_year_end int, sex string"
    )

    def member(name, tier, year, sex="F"):
        money = Decimal("10.00")
        return (name, tier, year, money, money, money, money, 1, 2, 3, Decimal("0.500"), 1, 40, sex)

    profile = spark.createDataFrame(
        [member("a", "low", 2000), member("b", "high", 2000, "M"), member("c", "high", 2000), member("a", "low", 2001)], columns
    )
    found = [r.asDict() for r in cost.mart_cost_utilization(profile, split=("0.5", "0.25", "0.25")).collect()]
    assert [(r["measurement_year"], r["risk_tier"]) for r in found] == [(2000, "high"), (2000, "low"), (2001, "low")]
    assert [r["pct_of_population"] for r in found] == [Decimal("66.7"), Decimal("33.3"), Decimal("100.0")]
    assert found[0]["pct_female"] == 50.0 and found[0]["avg_inpatient_spend"] == Decimal("5.00")
    assert found[0]["er_visits_per_1000"] == Decimal("2000.0")


# Providers


@pytest.mark.parametrize("seed", range(4))
def test_top_condition_equals_the_pair_join(spark, rows, seed):
    enc, cond, proc, seed_map = small_world(spark, seed=seed, hot=True)
    spine, mapped = claims.int_claims_unioned(enc, cond, proc), conditions.int_dx_code_flags(cond, seed_map)
    best = Window.partitionBy("provider_npi").orderBy(F.desc("pair_count"), "condition_category")
    pairs = (
        mapped.where("condition_category is not null")
        .join(providers.billable_claims(spine).select("claim_id", "provider_npi"), F.col("encounter_id") == F.col("claim_id"))
        .groupBy("provider_npi", "condition_category")
        .agg(F.count("*").alias("pair_count"))
    )
    plain = pairs.withColumn("n", F.row_number().over(best)).where("n = 1").drop("n")
    assert rows(providers.provider_top_condition(mapped, spine)) == rows(plain)


@pytest.mark.parametrize("seed", range(3))
def test_spend_equals_direct_distinct_counts(spark, rows, seed):
    enc, cond, proc, _ = small_world(spark, seed=seed, hot=True)
    spine = claims.int_claims_unioned(enc, cond, proc)
    plain = providers.billable_claims(spine).groupBy("provider_npi").agg(
        F.sum("paid_amount").cast("decimal(28,2)").alias("total_spend"),
        F.count_distinct("member_id").alias("attributed_member_count"),
        F.count_distinct(F.when(F.col("claim_type") == "inpatient", F.col("member_id"))).alias("members_with_ip"),
    )
    assert rows(providers.provider_spend(spine)) == rows(plain)


def test_attribution_tie_goes_to_the_smaller_id(spark):
    visits = [(f"c{i}", "m", "p2" if i % 2 else "p1") for i in range(6)]
    spine = spark.createDataFrame(visits, "claim_id string, member_id string, provider_npi string")
    (row,) = providers.primary_provider(spine).collect()
    assert (row["provider_npi"], row["claim_count"]) == ("p1", 3)


def test_scorecard_of_a_zero_score_panel(spark):
    primary = spark.createDataFrame([("m", "p", 1)], "member_id string, provider_npi string, claim_count bigint")
    profile = spark.createDataFrame(
        [("m", Decimal("0.000"), Decimal("10.00"), 0)],
        "member_id string, hcc_risk_score decimal(9,3), cost_pmpm decimal(25,2), condition_count bigint",
    )
    spend = spark.createDataFrame(
        [("p", Decimal("5.00"), 1, 0)],
        "provider_npi string, total_spend decimal(28,2), attributed_member_count bigint, members_with_ip bigint",
    )
    closure = spark.createDataFrame([], "member_id string, gap_closure_rate decimal(18,9)")
    top = spark.createDataFrame([], "provider_npi string, condition_category string, pair_count bigint")
    (row,) = providers.provider_assembled(primary, profile, spend, closure, top).collect()
    assert row["cost_per_hcc_unit"] is None and row["gap_closure_rate_pct"] is None and row["top_condition"] is None
    assert row["avg_cost_pmpm"] == Decimal("10.00")


def test_quadrants_use_medians_of_all_providers(spark):
    assembled = spark.createDataFrame(
        [
            ("small", 1, Decimal("1.00"), Decimal("0.100")),
            ("even", 9, Decimal("2.00"), Decimal("0.200")),
            ("costly", 9, Decimal("3.00"), Decimal("0.150")),
            ("unscored", 9, None, None),
        ],
        "provider_npi string, attributed_member_count bigint, avg_cost_pmpm decimal(25,2), avg_hcc_score decimal(25,3)",
    )
    found = {r["provider_npi"]: r for r in providers.mart_provider_efficiency(assembled).collect()}
    assert "small" not in found
    assert found["even"]["median_cost"] == Decimal("2") and found["even"]["median_hcc"] == Decimal("0.15")
    assert found["even"]["efficiency_quadrant"] == "High Value"
    assert found["costly"]["efficiency_quadrant"] == "Complex High Cost"
    assert found["unscored"]["efficiency_quadrant"] == "Complex Managed"


# Codes


@pytest.mark.parametrize("include_subcodes", [False, True])
@pytest.mark.parametrize("broadcast_limit", ["-1", "10MB"])
def test_range_join_equals_the_nested_loop(spark, rows, include_subcodes, broadcast_limit):
    draw = random.Random(3)

    def code():
        return "".join(draw.choice("ABCé19.") for _ in range(draw.randrange(0, 4)))

    coded = spark.createDataFrame([(i, code()) for i in range(300)] + [(999, None)], "id int, code string")
    ranges = spark.createDataFrame(
        [(*((code(), code()) if i % 9 == 0 else sorted((code(), code()))), f"r{i}") for i in range(40)],
        "low_code string, high_code string, label string",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        fast = rows(codes.code_range_join(coded, ranges, "code", include_subcodes=include_subcodes))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    condition = "low_code <= high_code and code >= low_code and (code <= high_code"
    condition += " or (high_code <> '' and startswith(code, high_code)))" if include_subcodes else ")"
    plain = rows(coded.join(ranges, F.expr(condition)))
    assert fast == plain and fast


def test_wide_codes(spark):
    wide = spark.createDataFrame([(1, "a", None, ""), (2, None, "b", "c")], "id int, dx1 string, dx2 string, dx3 string")
    found = sorted(tuple(r) for r in codes.wide_codes_to_long(wide, ["id"], ["dx1", "dx2", "dx3"]).collect())
    assert found == [(1, "dx1", "a"), (2, "dx2", "b"), (2, "dx3", "c")]
