from __future__ import annotations

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortry.functions import codes, dates, keys, numeric, quantiles, text
from cohortry.functions.quantiles import exact_median


def value(spark, column):
    return spark.range(1).select(column.alias("v")).head()["v"]


def date(text_value):
    return F.lit(text_value).cast("date")


@pytest.mark.parametrize(
    "later, earlier, expected",
    [("2023-12-31", "1960-12-31", 63), ("2023-12-31", "1960-01-01", 63), ("2021-01-01", "2020-12-31", 1)],
)
def test_years_are_counted_at_new_year(spark, later, earlier, expected):
    assert value(spark, dates.years_crossed(date(later), date(earlier))) == expected


@pytest.mark.parametrize(
    "later, earlier, expected",
    [("2020-02-01", "2020-01-31", 1), ("2020-01-31", "2020-01-01", 0), ("2001-12-31", "1950-01-01", 623)],
)
def test_months_are_counted_at_month_ends(spark, later, earlier, expected):
    assert value(spark, dates.months_crossed(date(later), date(earlier))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("NON-HISPANIC", "Non-Hispanic"),
        ("white", "White"),
        ("o_x a/b", "O_X A/B"),
        ("tab\there (now)", "Tab\tHere (Now)"),
        ("o'brien", "O'brien"),
        ("élan vital", "Élan Vital"),
        ("", ""),
        (None, None),
    ],
)
def test_title_words(spark, raw, expected):
    assert value(spark, text.title_words(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize("name", ["cc_diabetes", "diabetes_a1c", "readmission_30d", "high_risk_med_review"])
def test_display_labels_match_python_title_case(spark, name):
    expected = name.replace("cc_", "").replace("_", " ").title()
    assert value(spark, text.display_label(F.lit(name), "cc_")) == expected


def test_surrogate_key_separates_nulls_empties_and_borders(spark):
    inputs = [("a", None), ("a", ""), (None, "a"), ("a-b", "c"), ("a", "b-c"), ("", "a")]
    df = spark.createDataFrame(inputs, "x string, y string")
    found = [r["k"] for r in df.select(keys.surrogate_key("x", "y").alias("k")).collect()]
    assert len(set(found)) == len(inputs)
    spread = [r["k"] for r in df.repartition(5).select(keys.surrogate_key("x", "y").alias("k")).collect()]
    assert sorted(spread) == sorted(found)


def test_surrogate_key_can_reproduce_other_conventions(spark):
    import hashlib

    key = keys.surrogate_key(F.lit("a"), F.lit(None), separator="-", null_token="none")
    assert value(spark, key) == hashlib.md5(b"a-none").hexdigest()


def test_code_ranges(spark):
    df = spark.createDataFrame([("E119",), ("E13",), ("E131",), ("E14",), (None,)], "code string")
    narrow = df.where(codes.code_in_range("code", "E11", "E13"))
    wide = df.where(codes.code_in_range("code", "E11", "E13", include_subcodes=True))
    assert sorted(r["code"] for r in narrow.collect()) == ["E119", "E13"]
    assert sorted(r["code"] for r in wide.collect()) == ["E119", "E13", "E131"]
    assert df.where(codes.code_in("code", ["E14", "E13"])).count() == 2


def test_ratio_is_exact_and_null_safe(spark):
    assert value(spark, numeric.ratio(F.lit(Decimal("2.345")), F.lit(1), 2)) == Decimal("2.35")
    assert value(spark, numeric.ratio(F.lit(Decimal("1.00")), F.lit(0), 2)) is None
    assert value(spark, numeric.ratio(F.lit(Decimal("12344999.60")), F.lit(10_000_000), 3)) == Decimal("1.234")
    assert value(spark, numeric.ratio(F.lit(Decimal("-12345000.00")), F.lit(10_000_000), 3)) == Decimal("-1.235")
    assert value(spark, numeric.ratio(F.lit(2), F.lit(3), 6)) == Decimal("0.666667")


@pytest.mark.parametrize("size", [0, 1, 2, 3, 10, 999, 40_000])
def test_exact_median(spark, size):
    random.seed(size)
    values = [Decimal(random.choice([random.randint(0, 10**9), random.randint(0, 50)])) / 100 for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x decimal(18,2)").repartition(7)
    found = exact_median(df, "x", "m").head()["m"]
    assert found == (statistics.median(values) if values else None)


@pytest.mark.parametrize("few", [10_000, 3])
def test_exact_medians_of_long_decimals(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW_VALUES", few)
    base = Decimal("98765432109876543.000001")
    rows = [(base, base + Decimal(k) / 1000000, None) for k in range(40)]
    df = spark.createDataFrame(rows, "a decimal(28,6), b decimal(28,6), c decimal(28,6)").repartition(3)
    found = quantiles.exact_medians(df, {"a": "same", "b": "near", "c": "none"}).head()
    # 19.5 steps lie between two six-digit values; halves are rounded up.
    assert (found["same"], found["near"], found["none"]) == (base, base + Decimal("0.000020"), None)


def test_packed_keys_are_short_and_come_back(spark):
    digest = "0123456789abcdef" * 2
    texts = ["", "a", digest, digest.upper(), digest[:-1] + "g", digest + "\n", digest[1:] + "\n", "\x01" + "a" * 16, "é" * 16, "0" * 32, None]
    df = spark.createDataFrame([(t,) for t in texts], "k string").select("k", keys.packed_key(F.col("k")).alias("p"))
    found = [(r["k"], r["b"], r["p"]) for r in df.withColumn("b", keys.unpacked_key(F.col("p"))).collect()]
    assert all(k == b for k, b, _ in found) and [k for k, _, _ in found] == texts
    assert len({bytes(p) for _, _, p in found if p is not None}) == len(texts) - 1
    assert [len(p) for k, _, p in found if k in (digest, "0" * 32)] == [17, 17]
