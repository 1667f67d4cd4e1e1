"""The build's scans, checks inside writes, shuffle sizes and scratch tables."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cohortry import session
from cohortry.operators import quality
from cohortry.plans import sizing
from cohortry.plans.build import STAGED, build, stage_table
from cohortry.schemas import RAW_TABLES
from cohortry.sources import readers
from starcheck import bind
from starcheck.queries import REGISTRY

SF = "/root/testdata/sf0.001"
KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The raw tables as Parquet, so that their scans can be told by folder."""
    folder = str(tmp_path_factory.mktemp("raw"))
    for table in (*RAW_TABLES, "condition_map"):
        bind.DERIVED[table](spark, SF).write.parquet(f"{folder}/{table}")
    return folder


def raw_of(spark, folder):
    return readers.RawTables(lambda table: readers.read_table(spark, folder, table))


def final_plans(spark, since):
    """Final plans of the SQL executions from number ``since`` on."""
    store = spark._jsparkSession.sharedState().statusStore()
    listed = store.executionsList()
    found = [listed.apply(k) for k in range(listed.size())]
    return [x.physicalPlanDescription().split("+- == Initial Plan ==")[0] for x in found if x.executionId() >= since]


def test_build_scans_each_raw_table_once(spark, stored, tmp_path):
    spark.conf.unset(KEY)
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    since = listed.apply(listed.size() - 1).executionId() + 1
    result = build(spark, raw_of(spark, stored), str(tmp_path / "out"), bind.YEAR, bind.AS_OF, "run", dt.datetime(2001, 12, 31), gate=False, max_stale_days=365)
    assert result.marts["mart_member_risk_profile"].count() == 150
    plans = final_plans(spark, since)
    for table in RAW_TABLES:
        scans = sum(len(re.findall(rf"Location: InMemoryFileIndex \[file:{re.escape(stored)}/{table}\]", plan)) for plan in plans)
        assert scans == 1, (table, scans)
    # The stages' shuffles were planned from what staging measured.
    assert int(spark.conf.get(KEY)) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.unset(KEY)


def test_checks_inside_the_write_have_the_same_verdicts(spark, stored):
    raw = raw_of(spark, stored)
    broken = raw.encounters.unionByName(raw.encounters.limit(3)).withColumn("PATIENT", F.when(F.col("Id") != "1", F.col("PATIENT")))
    tables = {**raw.as_dict(), "encounters": broken}
    found = readers.RawTables(lambda table: tables[table])
    data = bind.datasets(spark, SF)
    data.raw = found
    for name, source in STAGED.items():
        staged = stage_table(found, name, bind.YEAR)
        lazy = {source: tables[source], name: getattr(data, name)}
        checks = [c for c in quality.RAW_CHECKS + quality.STAGING_CHECKS if c.table in lazy]
        expected = sorted(tuple(r) for r in quality.run_checks(lazy, checks).select("check_type", "table_name", "column_name", "failing", "check_result").collect())
        assert sorted(staged.raw_results + staged.results) == expected
        assert staged.rows.columns == lazy[name].columns and staged.rows.count() == lazy[name].count()
    # Staging leaves a row without its patient out; the raw check still counts that row's id.
    uniques = [r for r in stage_table(found, "stg_encounters", bind.YEAR).raw_results if r[0] == "unique"]
    assert uniques == [("unique", "encounters", "Id", 3, "fail")]


def test_unique_checks_of_a_table_are_one_grouping(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", None), (2, "b", None), (2, None, 3.0)], "x int, y string, z double")
    wide = quality.duplicated_values(df, {"x": F.col("x"), "y": F.col("y"), "z": F.col("z")})
    assert tuple(wide.first()) == (2, 1, 0)
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_shuffles_are_planned_from_measured_sizes(spark):
    measure = sizing.Measure()
    measure.on(spark.range(100).select("id", F.lit("abcd").alias("t"))).write.format("noop").mode("overwrite").save()
    assert measure.size() == sizing.TableSize(100, {"id": 0.0, "t": 4.0})
    wide = {"encounter_id": 20.0, "member_id": 20.0, "condition_description": 60.0}
    sizes = {name: sizing.TableSize(10**10, wide) for name in STAGED}
    try:
        sizing.plan_stage(spark, "spine", sizes)
        planned = int(spark.conf.get(KEY))
        assert planned == -(-sizing.stage_bytes("spine", sizes) // session.SHUFFLE_TARGET_BYTES) > 20_000
        sizing.plan_stage(spark, "care_gaps", sizes)
        assert int(spark.conf.get(KEY)) < planned
    finally:
        spark.conf.unset(KEY)


def test_scratch_tables_go_with_their_last_reader(spark):
    session.release_scratch(spark)
    kept = session.materialize(spark.range(10), "kept")
    derived = kept.groupBy((F.col("id") % 3).alias("k")).count()
    del kept
    assert session.sweep_scratch(spark, collect=True) == 1 and derived.count() == 3
    del derived
    for name in ("mart_provider_efficiency", "report_hcc_box", "ingest_roundtrip", "report_stored_cost_by_tier", "code_range_join"):
        assert REGISTRY[name](spark, SF).collect()
    assert session.sweep_scratch(spark, collect=True) == 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(session._session_scratch(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not files.exists(folder) or not list(files.listStatus(folder))
