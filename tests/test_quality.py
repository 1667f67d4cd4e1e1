from __future__ import annotations

import datetime as dt

import pytest

from cohortry import schemas
from cohortry.operators import quality
from cohortry.operators.quality import Check


def counts(spark, **tables):
    return spark.createDataFrame(list(tables.items()) or [], "table_name string, row_count bigint")


def test_default_suite_size():
    kinds = [check.kind for check in quality.DEFAULT_SUITE]
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        "unique": 13,
        "not_null": 40,
        "accepted_values": 6,
        "accepted_range": 13,
    }


def test_checks_report_failing_rows(spark):
    t = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 9), (None, None, None), (None, "z", 5), ("b", "x", -1)], "k string, v string, n int"
    )
    checks = [
        quality.unique("t", "k"),
        *quality.not_null("t", "k", "v"),
        quality.accepted_values("t", "v", ["x", "y"]),
        quality.accepted_range("t", "n", 0, 5),
        quality.accepted_range("t", "n", -1),
    ]
    found = [(r["check_type"], r["column_name"], r["failing"], r["check_result"]) for r in quality.run_checks({"t": t}, checks).collect()]
    assert sorted(found) == sorted(
        [
            ("unique", "k", 1, "fail"),
            ("not_null", "k", 2, "fail"),
            ("not_null", "v", 1, "fail"),
            ("accepted_values", "v", 1, "fail"),
            ("accepted_range", "n", 2, "fail"),
            ("accepted_range", "n", 0, "pass"),
        ]
    )


def test_unique_checks_shuffle_digests_in_half_their_length(spark):
    """Digests are shuffled as bytes, and texts that look alike stay apart."""
    digest = "00" * 8 + "41" * 8
    t = spark.createDataFrame([(digest, 1), (digest, 1), ("A" * 8, 2), (digest.upper(), 2), (None, 3), (None, None)], "k string, n int")
    counted = quality.duplicated_values(t, {"k": t["k"], "n": t["n"]})
    assert counted.collect() == [(1, 2)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "unhex" in plan and "hashpartitioning(no" in plan
    assert quality.duplicated_values(t, {"k": t["k"]}).collect() == [(1,)]


def test_gate_names_the_failed_checks(spark):
    t = spark.createDataFrame([("a",), (None,)], "k string")
    quality.enforce(quality.run_checks({"t": t}, [quality.unique("t", "k")]))
    with pytest.raises(quality.QualityError, match="not_null t.k"):
        quality.enforce(quality.run_checks({"t": t}, [Check("t", "k", "not_null")]))


def test_row_count_drops(spark):
    current = counts(spark, at_limit=90, over=89, new=7, was_empty=0, grown=200)
    prior = counts(spark, at_limit=100, over=100, was_empty=0, grown=100, gone=5)
    found = {r["table_name"]: r for r in quality.row_count_drop(current, prior).collect()}
    assert {t: r["check_result"] for t, r in found.items()} == {
        "at_limit": "pass",
        "over": "fail",
        "new": "pass",
        "was_empty": "pass",
        "grown": "pass",
    }
    assert float(found["over"]["drop_pct"]) == 11.0 and found["new"]["prior_count"] == 7
    assert quality.row_count_drop(current, prior, max_drop_pct=20).where("check_result = 'fail'").count() == 0


def test_null_rates(spark):
    t = spark.range(100).selectExpr("if(id < 1, null, id) as one", "if(id < 2, null, id) as two")
    found = {r["column_name"]: (r["null_rows"], float(r["null_rate_pct"]), r["check_result"]) for r in quality.null_rates("t", t, ["one", "two"]).collect()}
    assert found == {"one": (1, 1.0, "pass"), "two": (2, 2.0, "fail")}
    (empty, _) = quality.null_rates("t", t.limit(0), ["one", "two"]).collect()
    assert empty["check_result"] == "empty" and empty["null_rate_pct"] is None


@pytest.mark.parametrize("as_of, expected", [("2020-03-31", "pass"), ("2020-04-01", "fail")])
def test_freshness(spark, as_of, expected):
    t = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2019, 1, 1),), (None,)], "d date")
    (row,) = quality.freshness("t", t, "d", as_of).collect()
    assert row["check_result"] == expected and row["max_date"] == dt.date(2020, 1, 1)
    (nothing,) = quality.freshness("t", t.limit(0), "d", as_of).collect()
    assert nothing["check_result"] == "fail"


def test_prior_run_is_the_latest_run_of_any_check(spark):
    def logged(run, kind, table, count):
        return (dt.datetime(2020, 1, run), f"r{run}", kind, table, None, "pass", count, None, None)

    log = spark.createDataFrame(
        [logged(1, "row_count", "a", 5), logged(2, "row_count", "a", 6), logged(2, "null_rate", "a", None)], schemas.AUDIT_LOG
    )
    assert [tuple(r) for r in quality.prior_run_counts(log).collect()] == [("a", 6)]
    later = log.unionByName(spark.createDataFrame([logged(3, "freshness", "a", None)], schemas.AUDIT_LOG))
    assert quality.prior_run_counts(later).count() == 0
    assert quality.prior_run_counts(log.limit(0)).count() == 0


def test_duplicate_groups(spark):
    t = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    found = {r["key_columns"]: r["duplicate_groups"] for r in quality.duplicate_groups(t, [["k"], ["k", "v"]]).collect()}
    assert found == {"k": 1, "k, v": 1}
    assert quality.duplicate_groups(t.distinct(), [["k", "v"]]).head()["duplicate_groups"] == 0


def test_schema_contract(spark):
    t = spark.createDataFrame([("a", 1, 2.0), (None, 2, None)], "Id string, CODE int, EXTRA double")
    expected = schemas._schema(Id=schemas.TEXT, CODE=schemas.TEXT, START=schemas.DATE)
    found = {r["column_name"]: (r["status"], r["filled_rows"]) for r in quality.schema_contract("t", t, expected).collect()}
    assert found == {"Id": ("ok", 1), "CODE": ("type_mismatch", 2), "START": ("missing", None), "EXTRA": ("unexpected", 1)}


def test_audit_rows_log_the_real_result(spark):
    drops = quality.row_count_drop(counts(spark, a=1), counts(spark, a=100))
    t = spark.createDataFrame([("x", dt.date(2020, 1, 1))], "k string, d date")
    audit = quality.audit_rows(
        dt.datetime(2020, 1, 2), "run", drops, [quality.null_rates("t", t, ["k"])], quality.freshness("t", t, "d", "2020-01-02")
    )
    found = {r["check_type"]: (r["check_result"], r["details"]) for r in audit.collect()}
    assert found == {
        "row_count": ("fail", "row_count=1"),
        "null_rate": ("pass", "null_rate=0.000%"),
        "freshness": ("pass", "max_date=2020-01-01, days_stale=1"),
    }
    assert audit.columns == schemas.AUDIT_LOG.fieldNames()
    assert quality.overall_result(audit).head()["check_result"] == "fail"
    assert quality.overall_result(audit.where("check_type <> 'row_count'")).head()["check_result"] == "pass"
