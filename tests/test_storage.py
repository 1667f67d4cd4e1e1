"""CSV loading, landing folders, marts, audit log, export and the gated build."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortry import schemas, session
from cohortry.operators import quality
from cohortry.plans.build import build
from cohortry.sources import readers, writers
from starcheck import bind

SF = "/root/testdata/sf0.001"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_rules(spark, tmp_path):
    write(tmp_path / "c.csv", 'PATIENT,ENCOUNTER,START,STOP,CODE,DESCRIPTION\np,e,2020-01-01,,59408-5,"two\nlines ""q"""\np,e,2020-01-02,,428191000124101\n')
    first, second = sorted(readers.read_csv(spark, str(tmp_path / "c.csv"), schemas.CONDITIONS).collect(), key=lambda r: r["START"])
    assert first["DESCRIPTION"] == 'two\nlines "q"' and first["CODE"] == "59408-5" and first["STOP"] is None
    assert second["CODE"] == "428191000124101" and second["DESCRIPTION"] is None


def test_csv_is_bound_by_name(spark, tmp_path):
    write(tmp_path / "c.csv", "NOTE,CODE,stop,START,DESCRIPTION,ENCOUNTER,PATIENT\nx,59408-5,,2020-01-01,d,e,p\n")
    assert writers.load_csv(spark, str(tmp_path / "c.csv"), schemas.CONDITIONS, str(tmp_path / "raw"), "conditions") == 1
    row = readers.read_table(spark, str(tmp_path / "raw"), "conditions").head()
    assert (row["PATIENT"], row["CODE"], str(row["START"])[:10], row["STOP"], row["NOTE"]) == ("p", "59408-5", "2020-01-01", None, "x")
    write(tmp_path / "m.csv", "PATIENT,CODE\np,c\n")
    with pytest.raises(readers.SchemaError, match="ENCOUNTER"):
        readers.read_csv(spark, str(tmp_path / "m.csv"), schemas.CONDITIONS)


def test_bad_values_are_set_aside_and_fail_the_load(spark, tmp_path):
    write(tmp_path / "c.csv", "PATIENT,ENCOUNTER,START,STOP,CODE,DESCRIPTION\np,e,not-a-date,,1,d\nq,e,2020-01-02,,1,d\n")
    with pytest.raises(writers.LoadError, match="1 rows"):
        writers.load_csv(spark, str(tmp_path / "c.csv"), schemas.CONDITIONS, str(tmp_path / "raw"), "conditions")
    bad = readers.read_rejected(spark, str(tmp_path / "raw"), "conditions").head()
    assert (bad["PATIENT"], bad["START"], bad["_misfits"]) == ("p", "not-a-date", "START")
    assert not readers.is_published(spark, str(tmp_path / "raw/conditions"))
    assert writers.load_csv(spark, str(tmp_path / "c.csv"), schemas.CONDITIONS, str(tmp_path / "raw"), "conditions", max_rejected=1) == 1


def test_ingest_of_a_run_date(spark, tmp_path):
    for table, schema in {**schemas.RAW_TABLES, "condition_map": schemas.CONDITION_MAP_SEED}.items():
        first = ["x" if f.dataType.simpleString() == "string" else "" for f in schema.fields]
        folder = Path(readers.landing_folder(str(tmp_path / "in"), table, "2020-01-01"))
        write(folder / "part.csv", ",".join(schema.fieldNames()) + "\n" + ",".join(first) + "\n")
    raw = writers.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), run_date="2020-01-01", splittable=["encounters"])
    assert raw.encounters.count() == 1


def test_a_built_year_leaves_the_others(spark, tmp_path):
    for year in (2000, 2001, 2001):
        mart = spark.createDataFrame([(f"m{year}", year)], "member_id string, measurement_year int")
        writers.write_mart(mart, str(tmp_path), "m", year)
    for year in (2000, 2001):
        assert [r["member_id"] for r in readers.read_mart(spark, str(tmp_path), "m", year).collect()] == [f"m{year}"]


def test_landing_folders_prune_by_run_date(spark, tmp_path):
    for run_date, code in (("2020-01-01", "a"), ("2020-02-01", "b")):
        folder = readers.landing_folder(str(tmp_path), "providers", run_date)
        spark.createDataFrame([(code,)], schemas.PROVIDERS).write.option("header", True).csv(folder)
    landed = readers.read_landed_csv(spark, str(tmp_path), "providers", schemas.PROVIDERS)
    assert sorted((r["Id"], str(r["ds"])) for r in landed.collect()) == [("a", "2020-01-01"), ("b", "2020-02-01")]
    one = readers.read_landed_csv(spark, str(tmp_path), "providers", schemas.PROVIDERS, "2020-02-01")
    assert [r["Id"] for r in one.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(ds" in one._jdf.queryExecution().toString()


def test_ingest_replaces_and_counts(spark, tmp_path):
    headers = {**schemas.RAW_TABLES, "condition_map": schemas.CONDITION_MAP_SEED}
    for table, schema in headers.items():
        names = schema.fieldNames()
        first = ["x" if f.dataType.simpleString() == "string" else "" for f in schema.fields]
        write(tmp_path / "in" / f"{table}.csv", ",".join(names) + "\n" + ",".join(first) + "\n")
    for _ in range(2):
        raw = writers.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert {name: df.count() for name, df in raw.as_dict().items()} == dict.fromkeys(schemas.RAW_TABLES, 1)
    assert raw.encounters.schema == schemas.ENCOUNTERS and raw.condition_map.head()["snomed_code"] == "x"


def test_beneficiary_layout(spark, tmp_path):
    kinds = [f.dataType.simpleString() for f in schemas.BENEFICIARY_SUMMARY.fields]
    assert (kinds.count("string"), kinds.count("double")) == (23, 9)
    write(tmp_path / "b.csv", ",".join(schemas.BENEFICIARY_SUMMARY.fieldNames()) + "\n" + ",".join(["007"] * 23 + ["1.5"] * 9) + "\n")
    row = readers.read_csv(spark, str(tmp_path / "b.csv"), schemas.BENEFICIARY_SUMMARY).head()
    assert row["DESYNPUF_ID"] == "007" and row["PPPYMT_CAR"] == 1.5


def test_yearly_marts_are_partitioned(spark, tmp_path):
    mart = spark.createDataFrame([("a", 2000), ("b", 2001)], "member_id string, measurement_year int")
    back = writers.write_mart(mart, str(tmp_path), "m")
    assert sorted(tuple(r) for r in back.select("member_id", "measurement_year").collect()) == [("a", 2000), ("b", 2001)]
    one = readers.read_mart(spark, str(tmp_path), "m", 2001)
    assert one.count() == 1 and "_loaded_at" in one.columns
    assert "PartitionFilters: [isnotnull(measurement_year" in one._jdf.queryExecution().toString()


def audit_row(day):
    return (dt.datetime.combine(day, dt.time(6)), f"run {day}", "row_count", "t", None, "pass", 1, None, None)


def test_audit_log_appends_and_expires(spark, tmp_path):
    path = str(tmp_path / "audit")
    assert readers.read_audit_log(spark, path).count() == 0
    today = dt.date(2020, 12, 31)
    days = [today - dt.timedelta(days=n) for n in (0, 365, 366, 400)]
    for day in days:
        writers.append_audit(spark.createDataFrame([audit_row(day)], schemas.AUDIT_LOG), path)
    assert readers.read_audit_log(spark, path).count() == 4
    assert writers.current_audit(spark, path, today).count() == 2
    assert writers.expire_audit(spark, path, today) == sorted(str(d) for d in days[2:])
    left = readers.read_audit_log(spark, path)
    assert sorted(r["run_date"] for r in left.collect()) == sorted(days[:2])
    assert left.where("_inserted_at is null").count() == 0


def test_audit_rows_need_their_required_values(spark, tmp_path):
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.AUDIT_LOG.fields)
    row = list(audit_row(dt.date(2020, 1, 1)))
    row[5] = None
    with pytest.raises(Exception, match="audit rows need check_result"):
        writers.append_audit(spark.createDataFrame([tuple(row)], nullable), str(tmp_path / "audit"))


def test_report_export(spark, tmp_path):
    report = spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int").repartition(2)
    writers.export_report(report, str(tmp_path / "r"), order_by=["k"])
    (part,) = (tmp_path / "r").glob("*.csv")
    assert part.read_text() == "k,n\na,1\nb,2\n"


def test_large_shuffles_start_with_more_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        session.configure(spark, shuffled_bytes=10 * 2**30)
        assert spark.conf.get(key) == "80"
    finally:
        spark.conf.unset(key)


def test_materialize_leaves_no_shuffled_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    kept = session.materialize(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), "test", drop_shuffled=True)
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and spark.conf.get(session.SHUFFLE_CLEANUP, None) == setting
    assert kept.agg(F.sum("count")).first()[0] == 1000


def test_materialize_uses_the_named_folder(spark):
    folder = session.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert folder == (named.rstrip("/") if named else spark.sparkContext.getCheckpointDir())
    kept = session.materialize(spark.range(10).withColumn("x", F.lit(1)), "test")
    path = kept.inputFiles()[0]
    assert kept.count() == 10 and folder.removeprefix("file:") in path
    session.release_scratch(spark)
    assert not Path(path.removeprefix("file://")).exists()


MART_ROWS = {
    "mart_member_risk_profile": 150,
    "mart_care_gaps": 339,
    "mart_cost_utilization": 4,
    "mart_provider_efficiency": 10,
}


@pytest.fixture
def run_build(spark, tmp_path):
    def run(raw, day, **options):
        options = {"max_stale_days": 365, **options}
        return build(spark, raw, str(tmp_path / "out"), bind.YEAR, bind.AS_OF, f"run-{day}", dt.datetime(2001, 12, day), **options)

    return run


def cleaned(spark):
    """The bound tables without missing genders and repeated keys."""
    keys = {
        "conditions": ["PATIENT", "CODE", "START"],
        "procedures": ["PATIENT", "CODE", "DATE", "ENCOUNTER"],
        "medications": ["PATIENT", "CODE", "START", "ENCOUNTER", "STOP", "TOTALCOST"],
    }

    def read(table):
        df = bind.DERIVED[table](spark, SF)
        return df.fillna("U", ["GENDER"]) if table == "patients" else df.dropDuplicates(keys[table]) if table in keys else df

    return readers.RawTables(read)


def test_gate_stops_before_the_next_layer(spark, tmp_path, run_build):
    raw = bind.raw_tables(spark, SF)
    with pytest.raises(quality.QualityError, match="not_null patients.GENDER"):
        run_build(raw, 1)
    assert not (tmp_path / "out").exists()


def test_ungated_build_is_repeatable_and_audited(spark, tmp_path, run_build):
    raw = bind.raw_tables(spark, SF)
    result = run_build(raw, 2, gate=False)
    assert {name: mart.count() for name, mart in result.marts.items()} == MART_ROWS
    assert result.audit.count() == 4 + 13 + 1
    assert quality.overall_result(result.audit).head()["check_result"] == "pass"
    again = run_build(raw, 3, gate=False)
    assert again.marts["mart_care_gaps"].count() == MART_ROWS["mart_care_gaps"]
    log = readers.read_audit_log(spark, str(tmp_path / "out" / "audit"))
    assert log.count() == 36 and quality.prior_run_counts(log).count() == 4


def test_gated_build_of_clean_tables(spark, tmp_path, run_build):
    raw = cleaned(spark)
    assert run_build(raw, 4).marts["mart_member_risk_profile"].count() == 150
    # Stale data fails the run, and the failure is in the log all the same.
    with pytest.raises(quality.QualityError, match="freshness stg_encounters"):
        run_build(raw, 5, max_stale_days=30)
    log = readers.read_audit_log(spark, str(tmp_path / "out" / "audit"))
    assert [r["run_id"] for r in log.where("check_result = 'fail'").collect()] == ["run-5"]


def test_two_years_are_built_side_by_side(spark, tmp_path):
    raw, out = cleaned(spark), str(tmp_path / "out")
    for year in (bind.YEAR, bind.YEAR + 1):
        result = build(spark, raw, out, year, f"{year}-12-31", f"run-{year}", dt.datetime(year, 12, 31), gate=False)
        for mart in MART_ROWS:
            assert {r["measurement_year"] for r in result.marts[mart].select("measurement_year").distinct().collect()} == {year}
    for mart, rows in MART_ROWS.items():
        kept = readers.read_mart(spark, f"{out}/marts", mart, bind.YEAR)
        assert kept.count() == (rows if mart != "mart_care_gaps" else kept.count()) > 0
        assert readers.read_mart(spark, f"{out}/marts", mart, bind.YEAR + 1).count() > 0
