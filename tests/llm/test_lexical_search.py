"""Ranked lexical search against a term-by-term count in whole numbers."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortry.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranked(docs, items, k):
    found = [(i, Counter(_terms(t)), len(_terms(t))) for i, t in docs]
    n = sum(size > 0 for *_, size in found)
    total = sum(size for *_, size in found)
    df = Counter(t for _, counts, _ in found for t in counts)
    out = []
    for item, text in items:
        scored = []
        for i, counts, size in found:
            score = 0
            for t in _terms(text):
                if t in counts:
                    m = 75 + 25 * size * n // total
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def items(corpus):
    texts = [t for _, t, *_ in corpus if t][:12]
    rows = [(k, t[:200]) for k, t in enumerate(texts)]
    rows += [(50, None), (51, ""), (52, "..."), (53, "W1 w1 W1. w2 É é ñ\x85x"), (53, "w3"), (None, "w4 w5"), (54, "w7 " * 5000), (55, "nowhere")]
    return rows


@pytest.mark.parametrize(("exact", "cells", "tile"), [(1 << 53, 16_000_000, 128), (1 << 37, 4_000, 3)])
def test_search_equals_brute_force(spark, documents, corpus, items, monkeypatch, exact, cells, tile):
    monkeypatch.setattr(lexical_search, "EXACT", exact)
    monkeypatch.setattr(lexical_search, "ITEM_CELLS", cells)
    monkeypatch.setattr(lexical_search, "TILE_DOCS", tile)
    monkeypatch.setattr(lexical_search, "TILE_TERMS", 2048 if tile > 3 else 5)
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, doc_id int")
    rows = lexical_search.search(documents, table, 7).collect()
    docs = [(i, t) for i, t, *_ in corpus]
    assert Counter(map(tuple, rows)) == Counter(_ranked(docs, items, 7))


def test_partial_sums_stay_exact():
    """No item's sum over a vocabulary tile can reach 2^53, and the tiles carry every count."""
    items = lexical_search.Items([1, 2], ["a " * 3_000_000 + "b c d", "b b c"])
    weight = np.full(len(items.keys), 25_000, dtype=np.int64)
    carried = np.zeros((2, len(items.keys)))
    tiles = items.tiles(weight)
    assert len(tiles) > 5
    for terms, matrix in tiles:
        assert (matrix @ (weight[terms] * float(lexical_search.TOP_IMPACT)) < lexical_search.EXACT).all()
        for column, term in enumerate(terms):
            carried[:, term] += matrix[:, column]
    expected = np.zeros_like(carried)
    expected[items.item, items.term] = items.count
    assert (carried == expected).all() and carried.sum() == 3_000_006


def test_terms_are_cut_as_bytes():
    text = "Ab-c_9É\x85 ÀB\x7fz[]x\n\n1"
    terms = lexical_search.Terms(pa.array([text, None, "", "--"]))
    assert [terms.bytes[a:b].tobytes().decode() for a, b in zip(terms.word_start, terms.word_end, strict=True)] == _terms(text)
    assert terms.n_words.tolist() == [len(_terms(text)), 0, 0, 0]


def test_ties_go_to_the_smaller_id_and_copies_all_count(spark):
    docs = [(i, "same text here") for i in range(60, 0, -1)] + [(5, "same text here")] * 3 + [(None, "same text here"), (99, "other words")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = lexical_search.search(table, spark.createDataFrame([(1, "text")], "item_id long, text string")).orderBy("rank").collect()
    assert [r["doc_id"] for r in rows] == [1, 2, 3, 4, 5, 5, 5, 5, *range(6, 18)] and len({r["score"] for r in rows}) == 1


def test_search_of_odd_tables(spark, documents, no_documents, items):
    none = spark.createDataFrame([], "item_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.search(documents, none).count() == 0
    assert lexical_search.search(no_documents, table).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "--")], "doc_id long, text string")
    assert lexical_search.search(empty, table).count() == 0
    long = spark.createDataFrame([(1, "filler words " * 50_000 + "needle"), (2, "hay")], "doc_id long, text string")
    one = spark.createDataFrame([(8, "NEEDLE")], "item_id long, text string")
    assert [(r["item_id"], r["doc_id"]) for r in lexical_search.search(long, one).collect()] == [(8, 1)]
