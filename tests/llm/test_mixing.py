"""Pareto mixing: unequal inclusion, equal rows, odd tables, and the query's SQL on rows of its own."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortry.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def _by_size(rows):
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    return taken, target


def test_of_equal_rows_as_many_enter_as_the_target_asks_for(spark):
    rows = [(7, "ten words " * 5, "a")] * 400 + [(1000 + i, "ten words " * 5 + f"and {i}", "b") for i in range(800)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    # Sources a (weight 5) and b (2): a is full at twice its size, b has the rest.
    taken, target = _by_size(mixing.mix_sources(docs).collect())
    assert taken["a"] == target["a"] == 8000 and abs(taken["b"] - target["b"]) <= 6
    mixed = mixing.mix_sources(docs, share=0.7).collect()
    taken, target = _by_size(mixed)
    assert 0 < target["a"] < 8000 and abs(taken["a"] - target["a"]) <= 5 and len(mixed) == len(rows)
    equal = Counter(r["copies"] for r in mixed if r["source"] == "a")
    assert len(equal) == 2 and max(equal) - min(equal) == 1
    again = mixing.mix_sources(docs.repartition(2), share=0.7).collect()
    assert Counter(map(str, mixed)) == Counter(map(str, again))
    assert Counter(r["doc_id"] for r in mixed for _ in range(r["copies"])) == Counter(r["doc_id"] for r in again for _ in range(r["copies"]))


def test_equal_rows_in_many_blocks_with_columns_that_cannot_be_grouped(spark):
    n = 3 * mixing.BLOCK + 17
    docs = spark.range(n).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"), F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    mixed = mixing.mix_sources(docs)
    found = {r["copies"]: r["n"] for r in mixed.groupBy("copies").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(found.values()) == n and abs(sum(c * k for c, k in found.items()) - 1.5 * n) <= 1
    assert mixed.columns == ["doc_id", "text", "source", "m", "size", "source_size", "target", "copies", "taken"]
    assert mixed.where("m['k'] = 1").count() == n


def test_copies_rise_with_the_size_and_sum_to_the_target():
    words = {0: 30, 2: 900, 3: 5000, 5: 4000}
    for target in (0.0, 100.0, 5000.0, 12000.0, 19000.0, 19860.0):
        copies = mixing.inclusion(words, target)
        assert sum(copies[t] * n for t, n in words.items()) == pytest.approx(target)
        assert [copies[t] for t in sorted(words)] == sorted(copies.values()) and max(copies.values()) <= 2
        free = [t for t in words if copies[t] < 2]
        assert all(copies[t] == pytest.approx(copies[free[0]] * 2.0 ** (t - free[0])) for t in free)


def test_long_documents_enter_more_often(spark):
    rows = [(i, " ".join(["w"] * (1 if i % 2 else 64)), "s") for i in range(4000)] + [(9000 + i, "x y", "t") for i in range(90000)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(4), share=0.05, weights=(1.0, 2.0)).where("source = 's'").collect()
    taken, target = _by_size(mixed)
    assert abs(taken["s"] - target["s"]) <= 32
    share = defaultdict(list)
    for r in mixed:
        share[r["size"]].append(r["copies"])
    short, long = (sum(share[n]) / len(share[n]) for n in (1, 64))
    # In proportion to the root of the size: eight times as often (tiers 0 and 3).
    assert 0 < short < long < 1 and 5 < long / short < 12


def test_query_equals_its_sql_on_odd_rows(spark, corpus, tmp_path):
    rows = [(i, t, s) for i, t, _, s in corpus] + [(400 + i, None, "nothing") for i in range(3)]
    rows += [(500, "of equal rows some enter", "s2")] * 40 + [(501, "a " * 9000, "s2"), (502, "b c", "\U0001f600"), (503, "d e", "￮")]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = mixing.op4_mixing(spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    expected = duck.execute(mixing.OP4_SQL).fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(expected) and len(expected) == len(rows)
