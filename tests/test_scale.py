"""Range index, heavy claims, grouped quantiles, footers and single rounding, against plain definitions."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cohortry.functions import quantiles
from cohortry.operators import claims, codes, quality, reports
from cohortry.sources import footers, published


@pytest.fixture
def setting(spark):
    changed = {}

    def put(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Code ranges


@pytest.mark.parametrize("index_bytes", [codes.INDEX_BYTES, 0])
@pytest.mark.parametrize("subcodes", [False, True])
def test_many_overlapping_ranges_equal_the_nested_loop(spark, index_bytes, subcodes):
    rng = random.Random(5)

    def code():
        return "".join(rng.choice("ABCDE01239é") for _ in range(rng.randrange(1, 6)))

    coded = [(i, code()) for i in range(150)] + [(900, "A"), (901, ""), (902, None)]
    pairs = [(code(), code()) for _ in range(10_000)]
    pairs = [(*(p if k % 50 == 0 else sorted(p, key=str.encode)), k) for k, p in enumerate(pairs)] + [(None, "Z", -1), ("", "", -2), ("A", "A", -3)]
    ranges = spark.createDataFrame(pairs, "low_code string, high_code string, label int")
    joined = codes.code_range_join(spark.createDataFrame(coded, "id int, code string"), ranges, "code", include_subcodes=subcodes, index_bytes=index_bytes)
    assert joined.columns == ["id", "code", "low_code", "high_code", "label"]
    found = defaultdict(set)
    total = 0
    for r in joined.select("id", "label").collect():
        found[r["id"]].add(r["label"])
        total += 1
    expected = defaultdict(set)
    for i, c in coded:
        for low, high, label in pairs:
            if c is not None and low is not None:
                b, lo, hi = c.encode(), low.encode(), high.encode()
                if lo <= b and (b <= hi or (subcodes and hi and b.startswith(hi))):
                    expected[i].add(label)
    assert found == expected and total == sum(map(len, expected.values())) > 100_000
    # Equality alone decides: what the join gives is the result.
    joins = [line for line in physical(joined).split("\n") if "HashJoin [_level" in line or "MergeJoin [_level" in line]
    assert joins and all(line.split("Inner")[1].split("Build")[0].strip(" ,") == "" for line in joins)


def test_ranges_of_nothing(spark):
    coded = spark.createDataFrame([(1, "A")], "id int, code string")
    none = spark.createDataFrame([], "low_code string, high_code string, label int")
    assert codes.code_range_join(coded, none, "code").collect() == []
    assert codes.code_range_join(coded.limit(0), spark.createDataFrame([("A", "B", 1)], none.schema), "code").collect() == []


# Heavy claims


def test_a_heavy_claim_is_spread_without_the_skew_join(spark, setting):
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", "16")
    lines = 90_000
    conditions = spark.range(lines).repartition(8).select(
        F.md5(F.col("id").cast("string")).alias("condition_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 4000)).alias("encounter_id"),
        F.concat(F.lit("m"), F.col("id") % 50).alias("member_id"),
        F.lit("1").alias("snomed_code"),
        F.lit("text").alias("condition_description"),
    )
    encounters = spark.range(4000).select(F.concat(F.lit("e"), "id").alias("encounter_id")).unionByName(spark.range(1).select(F.lit("hot").alias("encounter_id")))
    encounters = encounters.selectExpr(
        "encounter_id", "date'2000-01-01' as service_date", "date'2000-01-02' as service_end_date", "'p' as provider_id",
        "'carrier' as claim_type", "2000 as service_year", "'office' as encounter_class",
    )
    joined = claims.claims_dx_lines(conditions, encounters)
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == lines and len(sizes) == 16
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    assert joined.select("claims_line_id").distinct().count() == lines
    heavy = {r["claim_id"]: r["pieces"] for r in claims.heavy_claims(conditions.select(F.col("encounter_id").alias("claim_id")), 16).collect()}
    assert set(heavy) == {"hot"} and 80 <= heavy["hot"] <= 92


def test_lines_without_a_claim_are_dropped_and_none_is_heavy(spark):
    empty = spark.createDataFrame([], "claim_id string")
    assert claims.heavy_claims(empty, 4).collect() == []
    nulls = spark.createDataFrame([(None,)] * 5, "claim_id string")
    assert claims.heavy_claims(nulls, 4).collect() == []


# Quantiles


def _quantile(values, share):
    position = (len(values) - 1) * Fraction(share)
    low = position.numerator // position.denominator
    high = min(low + 1, len(values) - 1)
    exact = Fraction(values[low]) + (Fraction(values[high]) - Fraction(values[low])) * (position - low)
    return (Decimal(exact.numerator) / Decimal(exact.denominator)).quantize(Decimal("0.000001"), ROUND_HALF_UP)


@pytest.mark.parametrize("small", [quantiles.SMALL_GROUP, 300])
def test_grouped_quantiles_are_exact(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "SMALL_GROUP", small)
    rng = random.Random(8)
    groups = {"hot": 20_000, "two": 2, "one": 1, "four": 4, "five": 5, "few": 700, None: 30}
    rows = [(g, Decimal(rng.randrange(-(10**9), 10**9)).scaleb(-6)) for g, n in groups.items() for _ in range(n)]
    rows += [("ties", Decimal("1.500000"))] * 2_000 + [("ties", Decimal(k)) for k in range(40)] + [("nulls", None)] * 3 + [("few", None)]
    df = spark.createDataFrame(rows, "provider string, paid decimal(28,6)").repartition(6)
    shares = {"q1": "0.25", "median": "0.5", "q3": "0.75", "least": "0", "most": "1", "p999": "0.999"}
    found = {r["provider"]: r for r in quantiles.exact_quantiles(df, ["provider"], "paid", shares).collect()}
    values = defaultdict(list)
    for g, v in rows:
        if v is not None:
            values[g].append(v)
    assert set(found) == set(values)
    for g, own in values.items():
        own.sort()
        assert found[g]["n"] == len(own)
        for name, share in shares.items():
            assert found[g][name] == _quantile(own, share), (g, name)


def test_no_state_holds_a_groups_values(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("decimal(28,6)").alias("v"))
    plan = physical(quantiles.exact_quantiles(df, ["g"], "v", {"median": "0.5"}))
    assert "percentile_approx" in plan and "percentile(" not in plan and "collect_list(v" not in plan
    assert quantiles.exact_quantiles(df.limit(0), ["g"], "v", {"median": "0.5"}).count() == 0


# Footers


def test_freshness_of_a_published_table_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000, numPartitions=3).selectExpr("'y' as other", "date_add(date'2001-01-01', cast(id % 300 as int)) as day", "cast(id % 2 as int) as part", "'x' as text")
    published.publish(df, path, "part")
    folder = next(iter(published.Store(spark, path).manifest().parts.values()))
    plan = physical(footers.extremes(spark, f"{path}/{folder}", "day", df.drop("part").schema))
    assert "PushedAggregation: [MIN(day), MAX(day)]" in plan
    stored = footers.stored_freshness(spark, path, "t", "day", "2001-12-31").collect()
    assert stored == quality.freshness("t", df, "day", "2001-12-31").collect()
    assert footers.stored_counts(spark, {"t": path}).collect() == quality.row_counts({"t": df}).collect()


def test_parts_without_statistics_are_scanned(spark, tmp_path, setting):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("b",), (None,), ("c",)], "name string")  # text statistics are not used
    published.publish(df, path)
    assert footers.newest(spark, path, "name") == "c"
    nulls = str(tmp_path / "n")
    published.publish(spark.createDataFrame([(None,)], "day date"), nulls)
    assert footers.newest(spark, nulls, "day") is None
    row = footers.stored_freshness(spark, nulls, "n", "day", "2001-12-31").head()
    assert row["max_date"] is None and row["check_result"] == "fail"
    published.publish(spark.createDataFrame([], "day date"), nulls)
    assert footers.newest(spark, nulls, "day") is None
    with pytest.raises(published.PublishError, match="never published"):
        footers.newest(spark, str(tmp_path / "missing"), "day")


# Rounding


def test_gap_shares_are_rounded_once(spark):
    rows = spark.range(2_000_001).select(
        F.lit("diabetes_a1c").alias("gap_type"), F.col("id").alias("member_id"), (F.col("id") < 3000).cast("int").alias("gap_open"), F.lit("low").alias("risk_tier")
    )
    assert reports.report_gap_summary(rows).head()["gap_rate_pct"] == Decimal("0.1")
    for part, rate in ((1, "0.0"), (3, "0.2"), (5, "0.2"), (7, "0.4")):  # twentieths of a percent: exact halves go to the even digit
        some = spark.range(2000).select(
            F.lit("g").alias("gap_type"), F.col("id").alias("member_id"), (F.col("id") < part).cast("int").alias("gap_open"), F.lit("low").alias("risk_tier")
        )
        assert reports.report_gap_summary(some).head()["gap_rate_pct"] == Decimal(rate)
