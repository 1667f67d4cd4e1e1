"""Operators that look at one text at a time, against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from cohortry.llm import quality_rules, quality_trees, token_counts, toxicity
from cohortry.llm.base import Texts, calibrate, labelled_ids, labelled_texts, mix64

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_of_a_batch():
    column = pa.array(["a b", None, "", " x\ty\n", "\x85 é"])
    texts = Texts(column)
    assert [[w.decode() for w in texts.words(i)] for i in range(5)] == [["a", "b"], [], [], ["x", "y"], ["\x85", "é"]]
    assert texts.n_words.tolist() == [2, 0, 0, 2, 2]
    sliced = Texts(column.slice(3, 2))
    assert sliced.n_words.tolist() == [2, 2] and np.array_equal(sliced.word_hash(), texts.word_hash()[2:])
    assert Texts(pa.array([], pa.string())).n == 0


def test_token_counts_equal_the_library(documents, corpus):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = Counter(map(tuple, token_counts.count_tokens(documents, path).collect()))
    assert found == Counter((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in corpus)


def test_token_counts_without_broadcast_words(documents, corpus, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_HOT_BYTES", 0)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(documents, path).where("doc_id is not null").collect()}
    assert found == {i: len(model.encode(t or "")) for i, t, *_ in corpus if i is not None}


def test_token_counts_tell_texts_of_one_short_hash_apart(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = spark.range(300_000).select(F.repeat(F.concat(F.lit("word "), F.col("id").cast("string")), (F.col("id") % 3 + 1).cast("int")).alias("text"))
    pairs = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("both")).where("size(both) = 2 and length(both[0]) != length(both[1])")
    both = pairs.first()["both"]
    found = token_counts.count_tokens(spark.createDataFrame([(None, t) for t in both], "doc_id long, text string"), path).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in found) == sorted((len(t), len(model.encode(t))) for t in both)


def test_pre_tokens_rebuild_the_text():
    for text in ("a b", " a", "a ", "  a\n\n b", "▁x ▁▁ y", "\n", " "):
        assert "".join(token_counts._pre_tokens(text)) == "▁" + text.replace(" ", "▁")


def _base(text):
    words = WORD.findall(text or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(runs)
    covered = {j for i, r in enumerate(runs) if many[r] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def labels(spark, corpus):
    rows = [(i, int(i % 10 != 1), int(i % 7 == 0)) for i, *_ in corpus if i is not None and i < 90]
    return spark.createDataFrame([*rows, (9999, 1, 1), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


def test_quality_rules_count_like_brute_force(documents, corpus, labels):
    rows = quality_rules.judge_quality(documents, labels).collect()
    assert Counter((r["doc_id"], *(r[c] for c in quality_rules.BASE)) for r in rows) == Counter((i, *_base(t)) for i, t, *_ in corpus)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["probability"] <= 1


@pytest.mark.parametrize("score", [lambda d, b: quality_trees.score_quality(d, b), lambda d, b: toxicity.score_toxicity(d, b), lambda d, b: quality_rules.judge_quality(d, b)])
def test_scores_of_odd_rows_and_tables(spark, documents, no_documents, corpus, labels, score):
    assert score(documents, labels).count() == len(corpus)
    assert score(no_documents, labels).count() == 0
    assert score(documents, labels.limit(0)).count() == len(corpus)
    assert score(documents, labels.where("toxic = 1 and quality = 1")).count() == len(corpus)


def test_a_labelled_id_on_many_rows_counts_once(spark, labels, documents, monkeypatch):
    ids = {r["doc_id"] for r in labelled_ids(labels, "quality", 1000).collect()}
    many = documents.where("doc_id is not null and doc_id < 90").dropDuplicates(["doc_id"]).select("doc_id", "text")
    hot = min(ids & {r["doc_id"] for r in many.collect()})
    many = many.union(spark.range(500).select(F.lit(hot), F.concat(F.lit("another text "), "id")))
    texts, label = labelled_texts(many, labels, "quality", 1000, 20_000)
    assert len(texts) == len(label) <= len(ids)
    sizes = []
    whole = quality_trees.fit
    monkeypatch.setattr(quality_trees, "fit", lambda x, *rest: (sizes.append(len(x)), whole(x, *rest))[1])
    assert quality_trees.score_quality(many, labels).count() == many.count()
    assert sizes == [len(texts)]


def test_held_out_rows_are_the_fifth_by_checksum(documents, labels):
    for r in quality_trees.score_quality(documents, labels).collect():
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1


def test_toxicity_finds_misspellings_never_seen():
    rng = np.random.default_rng(0)
    calm = [f"{a}{b}" for a in ("lor", "mip", "dol", "sit", "ame", "con") for b in ("um", "et", "ur", "is", "ant")]
    foul = ["grobnak", "grobnaks", "grobnaky", "grobnaken"]
    texts, label = [], []
    for i in range(240):
        words = list(rng.choice(calm, 60))
        if i % 4 == 0:
            words[int(rng.integers(60))] = str(rng.choice(foul[:3]))
        texts.append(" ".join(words))
        label.append(int(i % 4 == 0))
    model = toxicity.fit(pa.array(texts), np.array(label), 180, 60)
    fresh = [" ".join(rng.choice(calm, 80)) for _ in range(20)]
    clean = model.score(Texts(pa.array(fresh)))
    assert (clean < 0.5).all()
    assert (model.score(Texts(pa.array([f + " grobnakken " + f for f in fresh]))) > 3 * clean.max()).all()


def test_toxicity_does_not_depend_on_the_word_offset():
    logit = np.zeros(toxicity.BUCKETS)
    grams = toxicity._grams(Texts(pa.array(["grobnak"])))
    logit[grams[1]] = 5.0
    model = toxicity.Model(logit, -1.0)
    found = model.margin(Texts(pa.array([" ".join(["xy"] * k + ["grobnak", "grobnak"] + ["xy"] * (20 - k)) for k in range(21)])))
    assert np.allclose(found, found[0]) and np.isclose(found[0], model.margin(Texts(pa.array(["grobnak grobnak"])))[0])


def test_held_out_accuracy(spark, sf):
    folder = sf.replace("0.001", "0.1")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    right = [int(r["predicted"] == labels[r["doc_id"]]["quality"]) for r in quality_trees.op3_quality_trees(spark, folder).where("held_out").collect() if r["doc_id"] in labels]
    assert np.mean(right) > 0.97
    right = [int(r["predicted"] == labels[r["doc_id"]]["toxic"]) for r in toxicity.op7_toxicity(spark, folder).where("held_out").collect() if r["doc_id"] in labels]
    assert np.mean(right) > 0.93


def test_forest_arrays_walk_like_a_loop():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    forest = quality_trees.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), np.ones(300))
    for row, margin in zip(x[:40], forest.margin(x[:40]), strict=True):
        total = forest.start
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        assert abs(total - margin) < 1e-9


ODD_TEXTS = [
    None, "", " \n\t ", "a", "One two, two! ONE", "x\n\nsame line here\nsame line here\nsame line here\n", "é ü 中文 – dash", "a b c d e " * 30,
    "# $5 <b>(x)</b> [y] {z} a/b\\c @me - _ = + ~ 100%", "no\u00a0break " * 9, " ".join(f"W{k}w" for k in range(4000)), "z" * 30_000,
]


def _statistics(text):
    text = text or ""
    words, raw = WORD.findall(text), text.encode()
    size, n = max(len(raw), 1), max(len(words), 1)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    again = {j for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    upper, lower = (sum(low <= b <= low + 25 for b in raw) for low in (65, 97))
    share = lambda chars: sum(b in chars.encode() for b in raw) / size
    return {
        "words": np.log1p(len(words)), "word_bytes": sum(len(w.encode()) for w in words) / n, "upper": upper / max(upper + lower, 1),
        "breaks": text.count("\n") / n, "repeated_lines": (len(lines) - len(set(lines))) / (1 + text.count("\n")),
        "distinct_words": len(set(words)) / n, "repeated_words": len(again) / n, "short_words": sum(len(w.encode()) == 1 for w in words) / n,
        "non_ascii": sum(b > 127 for b in raw) / size, "marks": share("!?"), "symbols": share("#*$%&|<>"), "digits": share("0123456789"),
        "stops": share(".,;:"), "brackets": share("()[]{}"), "slashes": share("/\\@"), "joiners": share("-_=+~"),
    }


def test_quality_statistics_equal_brute_force(corpus):
    texts = ODD_TEXTS + [r[1] for r in corpus]
    found = quality_trees.statistics(Texts(pa.array(texts, pa.string())))
    assert sorted(found) == sorted(quality_trees.STATISTICS)
    for i, text in enumerate(texts):
        for name, value in _statistics(text).items():
            assert abs(found[name][i] - value) < 1e-9, (i, name)


def test_first_split_has_the_largest_gain():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 40, (500, 3)).astype(float)
    label, weight = ((x[:, 1] > 17) ^ (rng.random(500) < 0.1)).astype(float), rng.uniform(0.5, 2, 500)
    forest = quality_trees.fit(x, label, weight)
    p = 1 / (1 + np.exp(-forest.start))
    g, h = weight * (p - label), np.full(500, p * (1 - p)) * weight

    def gain(feature, cut):
        left = x[:, feature] <= cut
        parts = [(g[m].sum(), h[m].sum()) for m in (left, ~left, left | ~left)]
        a, b, whole = (s**2 / (t + quality_trees.RIDGE) for s, t in parts)
        return a + b - whole

    best = max(gain(f, c) for f in range(3) for c in range(40))
    assert forest.feature[0, 0] == 1 and np.isclose(gain(int(forest.feature[0, 0]), forest.cut[0, 0]), best)


def test_toxic_margins_equal_brute_force(corpus):
    logit = np.random.default_rng(3).normal(size=toxicity.BUCKETS).astype(np.float32)
    model = toxicity.Model(logit, -0.5)
    texts = [t for t in ODD_TEXTS if t is None or len(t) < 20_000] + [r[1] for r in corpus[:60]]

    def value(word):
        raw, found = b" " + bytes(b + 32 if 65 <= b <= 90 else b for b in word.encode()) + b" ", []
        for span in toxicity.SPANS:
            for k in range(len(raw) - span + 1):
                total = 0
                for b in raw[k : k + span]:
                    total = (total * 257 + b) % (1 << 64)
                found.append(float(logit[int(mix64(np.array([(total + span) % (1 << 64)], np.uint64))[0]) % toxicity.BUCKETS]))
        return sum(found) / max(len(found), 1)

    known = {w: value(w) for t in texts for w in set(WORD.findall(t or ""))}
    for text, margin in zip(texts, model.margin(Texts(pa.array(texts, pa.string()))), strict=True):
        words = [known[w] for w in WORD.findall(text or "")]
        passages = [sum(words[k : k + 8]) / 8 for k in range(max(len(words) - 7, min(len(words), 1)))]
        assert abs(margin - (max(passages, default=0.0) - 0.5)) < 1e-6, text


def test_calibration_recovers_a_slope():
    rng = np.random.default_rng(2)
    logit = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * logit + 1)))).astype(float)
    slope, intercept = calibrate(logit, y, np.ones(len(y)))
    assert abs(slope - 0.5) < 0.05 and abs(intercept - 1) < 0.1
