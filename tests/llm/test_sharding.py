"""Interleaved shards: counts, mixture, slots, repeated rows and odd tables."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortry.llm import sharding


def _check(rows, plan, shards):
    """Sizes and checksums are the texts', counts differ by one at most, slots are gapless, every shard holds each source's share."""
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in plan) == expected
    slots = defaultdict(list)
    for r in plan:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for k in range(shards):
        assert sorted(slots[k]) == list(range(counts[k]))
    of = Counter(s for *_, s in rows)
    held = Counter((r["_stratum"], r["shard"]) for r in plan)
    for source, n in of.items():
        for k in range(shards):
            assert abs(held["" if source is None else f"={source}", k] - n / shards) <= 2 + n * len(of) / len(rows)


@pytest.mark.parametrize("bucket", [50_000, 7])
def test_shards_hold_every_row_in_proportion(documents, corpus, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    plan = sharding.shard_plan(documents, 8).collect()
    _check(corpus, plan, 8)
    again = sharding.shard_plan(documents.repartition(7), 8).collect()
    assert Counter(map(str, plan)) == Counter(map(str, again))
    other = sharding.shard_plan(documents, 8, "another seed").collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in other} != {(r["doc_id"], r["shard"], r["slot"]) for r in plan}


@pytest.mark.parametrize("chunk", [1_000, 3])
def test_shards_of_a_hot_row_and_many_sources(spark, monkeypatch, chunk):
    monkeypatch.setattr(sharding, "COPY_CHUNK", chunk)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    rows = [(None, "again and again", "hot")] * 200 + [(i, f"text {i % 50}", "even") for i in range(200)]
    rows += [(1000 + i, None, f"alone {i}") for i in range(200)] + [(7, "x" * 200_000, None), (7, "", None)]
    plan = sharding.shard_plan(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), 10).collect()
    _check(rows, plan, 10)
    # The sources of one row are spread as well.
    alone = Counter(r["shard"] for r in plan if r["_stratum"].startswith("=alone"))
    assert len(alone) == 10 and max(alone.values()) <= 45


def test_fewer_rows_than_shards_and_none(spark, no_documents):
    rows = [(1, "a", "s"), (2, "b", "s"), (3, "c", "t")]
    plan = sharding.shard_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len({r["shard"] for r in plan}) == 3 and {r["slot"] for r in plan} == {0}
    assert sharding.shard_plan(no_documents).count() == 0 and sharding.shard_documents(no_documents).count() == 0


def test_documents_are_placed_whole(spark, documents, corpus, tmp_path):
    clashing = documents.withColumns({"slot": F.lit("s"), "copy": F.lit("c"), "_task": F.lit("t"), "text_crc32": F.lit("d"), "_before": F.lit("b")})
    placed = sharding.shard_documents(clashing, 5)
    assert placed.columns == [*(c for c in clashing.columns if c != "slot"), "shard", "slot"]
    found = placed.collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in found) == Counter((i, t, s) for i, t, _, s in corpus)
    assert len({(r["shard"], r["slot"]) for r in found}) == len(corpus)
    assert {(r["copy"], r["_task"], r["text_crc32"], r["size"]) for r in found} == {("c", "t", "d", "x")}
    plan = sharding.shard_plan(documents, 5).collect()
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in plan if r["doc_id"] != 5) == Counter(
        (r["doc_id"], r["shard"], r["slot"]) for r in found if r["doc_id"] != 5
    )
    sharding.write_shards(documents, str(tmp_path / "out"), 5)
    files = sorted(tmp_path.glob("out/shard=*/*.parquet"))
    assert len({f.parent.name for f in files}) == 5
    for file in files:
        slots = [r["slot"] for r in spark.read.parquet(str(file)).collect()]
        assert slots == sorted(slots)


def test_shards_run_no_python(documents):
    plan = sharding.shard_plan(documents)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
