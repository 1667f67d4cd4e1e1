"""Plan shapes that keep the operators scalable, and results that do not depend on partitioning."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cohortry.operators import claims, gaps, providers, risk
from starcheck import bind
from starcheck.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture
def setting(spark):
    """``setting(key, value)`` for one test."""
    changed = {}

    def put(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["mart_member_risk_profile", "mart_care_gaps", "mart_cost_utilization", "mart_provider_efficiency", "report_gap_heatmap"]
)
def test_results_do_not_depend_on_shuffle_partitions(spark, rows, setting, name):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = []
    for partitions, broadcast in (("1", "10MB"), ("7", "-1")):
        setting("spark.sql.shuffle.partitions", partitions)
        setting("spark.sql.autoBroadcastJoinThreshold", broadcast)
        found.append(rows(REGISTRY[name](spark, SF)))
    assert found[0] == found[1] and found[0]


def test_only_bounded_tables_are_broadcast_by_hint(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    data = bind.datasets(spark, SF)
    for df in (data.int_dx_code_flags, data.mart_care_gaps, data.int_claims_unioned, data.mart_member_risk_profile):
        plan = physical(df)
        # The binding itself broadcasts one scalar, the number of suppliers. The spine broadcasts its heavy claims to both sides of
        # its join: rows of a sketch of bounded size.
        heavy = plan.count("BroadcastHashJoin [claim_id")
        assert heavy == (2 if "approx_top_k" in plan else 0)
        crossed = plan.count("BroadcastNestedLoopJoin BuildRight, Cross")
        assert plan.count("BroadcastExchange") + plan.count("ReusedExchange") >= crossed + heavy >= plan.count("BroadcastExchange")
        assert "CartesianProduct" not in plan


def test_small_code_map_is_broadcast_without_a_hint(spark):
    assert "BroadcastHashJoin" in physical(bind.datasets(spark, SF).int_dx_code_flags)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Encounters, conditions and procedures as Parquet, so that scans show their pushdown."""
    folder = str(tmp_path_factory.mktemp("written"))
    data = bind.datasets(spark, SF)
    for name in ("stg_encounters", "stg_conditions", "stg_procedures"):
        getattr(data, name).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("stg_encounters", "stg_conditions", "stg_procedures")}


def test_service_codes_reach_the_scan(written):
    plan = physical(gaps.member_services(written["stg_procedures"]))
    assert re.search(r"PushedFilters: \[[^\]]*In\(snomed_code", plan)
    assert "ReadSchema: struct<member_id:string,procedure_date:date,snomed_code:string>" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_spine_readers_prune_columns_and_push_filters(written):
    spine = claims.int_claims_unioned(written["stg_encounters"], written["stg_conditions"], written["stg_procedures"])
    plan = physical(providers.provider_spend(spine))
    assert "dx_description" not in plan and "condition_description" not in plan and "service_date" not in plan
    assert len(re.findall(r"PushedFilters: \[[^\]]*IsNotNull\(provider_id\)", plan)) == 2


def test_best_row_per_group_is_limited_before_the_shuffle(written):
    spine = claims.int_claims_unioned(written["stg_encounters"], written["stg_conditions"], written["stg_procedures"])
    plan = physical(providers.primary_provider(spine))
    assert plan.count("WindowGroupLimit") == 2


def test_no_window_gathers_all_stays_of_a_member(written):
    plan = physical(gaps.readmission_flags(written["stg_encounters"]))
    per_member, per_day = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert per_day.startswith("member_id") and "service_date" in per_day
    assert per_member.startswith("member_id") and "service_date" not in per_member
    # Days are reduced before their shuffle; the only window comes after it.
    assert plan.count("Window [") == 1 and plan.index("Window [") < plan.index("partial_max_by")
    assert plan.index(per_day) < plan.index("partial_max_by")


def test_distinct_encounters_are_spread_before_the_member_step(written):
    plan = physical(risk.encounter_util(written["stg_encounters"]))
    final, spread = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert "encounter_id" in spread and "encounter_id" not in final


def test_a_dominant_encounter_is_dealt_into_pieces(spark, setting):
    """A third of all diagnoses sit in one encounter: its lines are joined in pieces, whatever adaptive execution does."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    setting("spark.sql.shuffle.partitions", "16")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    lines = 60_000
    conditions = spark.range(lines).repartition(8).select(
        F.md5(F.col("id").cast("string")).alias("condition_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 3000)).alias("encounter_id"),
        F.lit("m").alias("member_id"),
        F.lit("1").alias("snomed_code"),
        F.lit("text").alias("condition_description"),
    )
    encounters = (
        spark.range(3000)
        .select(F.concat(F.lit("e"), "id").alias("encounter_id"))
        .unionByName(spark.range(1).select(F.lit("hot").alias("encounter_id")))
        .selectExpr(
            "encounter_id", "date'2000-01-01' as service_date", "date'2000-01-02' as service_end_date", "'p' as provider_id",
            "'carrier' as claim_type", "2000 as service_year", "'office' as encounter_class",
        )
    )
    joined = claims.claims_dx_lines(conditions, encounters)
    assert joined.agg(F.count("claims_line_id")).head()[0] == lines
    assert "SortMergeJoin [claim_id" in physical(joined) and "_piece" in physical(joined)
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < lines / 6
