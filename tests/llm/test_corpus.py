"""Operators that compare documents, against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortry.llm import learned_partitions, line_chunks, mixing, near_duplicates, packing, queries, recompression, toxicity
from cohortry.llm.base import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _distinct(corpus):
    """The corpus without repeated ids and null ids, in order of the ids."""
    return sorted({r[0]: r for r in corpus if r[0] is not None}.values())


def _windows_removed(rows):
    seen, out = set(), {}
    for i, text, *_ in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("hot", [2_000, 2])
def test_substring_dedup(documents, corpus, monkeypatch, hot):
    monkeypatch.setattr(recompression, "HOT", hot)
    expected = _windows_removed(_distinct(corpus))
    rows = recompression.dedup_substrings(documents).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]) == expected[r["doc_id"]]


def test_substring_dedup_tells_texts_of_one_short_hash_apart(spark):
    prefix = " ".join(f"w{k}" for k in range(25))
    texts = spark.range(200_000).select(F.concat(F.lit(prefix + " "), "id").alias("text"))
    pair = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("both")).where("size(both) = 2").first()["both"]
    rows = recompression.dedup_substrings(spark.createDataFrame([(None, t) for t in pair], "doc_id long, text string")).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 25]


def test_substring_dedup_of_nothing(no_documents):
    assert recompression.dedup_substrings(no_documents).count() == 0


def _linked(rows, threshold=0.8):
    sets = {}
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    links, parent = Counter(), {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    return {i: (top(i), links[i]) for i in sets}


@pytest.mark.parametrize("block", [400, 3])
def test_near_duplicates(spark, documents, corpus, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rows = _distinct(corpus)
    single = documents.where("doc_id is not null").dropDuplicates(["doc_id"])
    classes = near_duplicates.near_classes(single).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in classes} == _linked(rows)
    copies = {r["doc_id"]: r["n_copies"] for r in classes}
    assert copies[5] == copies[103] == 7 and copies[304] == copies[305] == 2 and copies[200] == copies[300] == 1


def test_near_duplicates_of_odd_tables(documents, no_documents, corpus):
    assert near_duplicates.near_classes(no_documents).count() == 0
    assert near_duplicates.near_classes(documents).count() == sum(r[0] is not None for r in corpus)
    kept = near_duplicates.keep_one_of_each(documents)
    assert kept.columns == documents.columns
    roots = {c for c, _ in _linked(_distinct(corpus)).values()}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({**dict.fromkeys(roots, 1), None: 2})


def _linked_rows(rows, threshold=0.8):
    """(id, text) rows as documents of their own: the sorted (id, class, links), rows of one id in one class."""
    runs = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (text.split() for _, text in rows)]
    near = [[len(a & b) >= threshold * len(a | b) - 1e-9 for b in runs] for a in runs]
    top = [i for i, _ in rows]
    while True:
        new = [min(top[j] for j in range(len(rows)) if near[i][j] or rows[i][0] == rows[j][0]) for i in range(len(rows))]
        if new == top:
            return sorted((i, c, sum(n) - 1) for (i, _), c, n in zip(rows, top, near, strict=True))
        top = new


@pytest.mark.parametrize("block", [400, 7])
def test_near_duplicates_of_repeated_ids(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng = np.random.default_rng(9)
    prose = lambda: [f"w{k}" for k in rng.integers(0, 10**6, 60)]

    def changed(words, k):
        return " ".join([*words[:k], f"other{k}", *words[k + 1 :]])

    one, two = prose(), prose()
    rows = [(1, " ".join(one))] * 2 + [(2, changed(one, 0))]
    # An id on a third of the rows: copies, near copies and texts of their own, some met under other ids.
    rows += [(9, " ".join(two))] * 15 + [(9, changed(two, k)) for k in (0, 1, 58, 59)] + [(9, " ".join(prose())) for _ in range(6)]
    rows += [(3, rows[-1][1]), (4, " ".join(two)), (12, changed(two, 2))] + [(20 + k, " ".join(prose())) for k in range(45)]
    classes = near_duplicates.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in classes.collect()) == _linked_rows(rows)


def test_prefixes_are_shortened_to_the_recall():
    none, odds = np.zeros(8), near_duplicates.meeting_odds
    assert [near_duplicates.prefix_length(0, none, none, t, 0.999) for t in (0.8, 0.99, 0.1)] == [5, 8, 1]
    # Very similar pairs allow longer prefixes, a pair that met at three values only needs short ones.
    close = 1000 * odds(0.97)
    assert near_duplicates.prefix_length(1000, np.full(8, 1000.0), close) == 8
    assert near_duplicates.prefix_length(1000, np.array([1000.0] * 3 + [998] * 5), close) == 3
    assert near_duplicates.prefix_length(1000, np.full(8, 1000.0), 1000 * odds(0.8)) == 5


def _similar_texts(n, seed):
    """Texts of 30 to 80 words, each other one a changed copy of the one before."""
    rng, texts = np.random.default_rng(seed), []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 10**6, rng.integers(30, 80))]
        if k % 2:
            words = texts[-1].split()
            words[rng.integers(len(words))] = f"new{k}"
        texts.append(" ".join(words))
    return texts


def test_sample_sees_the_links_of_all_texts(monkeypatch):
    texts = _similar_texts(60, 4) + ["", "two words", "two words"]
    sample = texts[::3]
    value, starts = near_duplicates.shingle_sets(Texts(pa.array(texts)))
    labels = near_duplicates.label_sets(value, starts)
    probe = near_duplicates.Probe(sample, 0.8)
    seen = probe.compare(value, starts, labels)
    sets = [set(value[starts[i] : starts[i + 1]].tolist()) for i in range(len(texts))]
    total = 0
    for i, a in enumerate(sets):
        linked = [j for j in range(0, len(texts), 3) if sets[j] != a and a and len(sets[j] & a) >= 0.8 * len(sets[j] | a)]
        deepest = [max(next((d for d in range(8) if labels[i, t, d] != labels[j, t, d]), 8) for t in range(20)) for j in linked]
        assert seen[i, 0] == len(linked)
        assert seen[i, 1:9].tolist() == [sum(d >= k for d in deepest) for k in range(1, 9)]
        total += len(linked)
    assert total > 5
    assert not near_duplicates.Probe([], 0.8).compare(value, starts, labels).any()


def test_forest_finds_the_pairs_of_an_exact_join(spark):
    texts = _similar_texts(400, 8)
    rows = list(enumerate(texts))
    found = near_duplicates.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    links = {i: n for i, (_, n) in _linked(rows).items()}
    assert sum(r["n_links"] for r in found) >= 0.99 * sum(links.values()) > 100
    assert all(r["n_links"] <= links[r["doc_id"]] for r in found)


def test_links_that_the_forest_misses_are_found(spark):
    """Pairs just at the threshold that share no prefix in any tree, among pairs of all sizes at and below it."""
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(12_000):
        words = [f"w{k}" for k in rng.integers(0, 10**6, 29)]
        texts += [" ".join(words[:24]), " ".join(words)]  # 20 of 25 runs
    labels = near_duplicates.label_sets(*near_duplicates.shingle_sets(Texts(pa.array(texts))))
    missed = np.flatnonzero(~(labels[::2, :, :5] == labels[1::2, :, :5]).all(axis=2).any(axis=1))
    assert len(missed)
    rows = [text for k in missed.tolist() for text in texts[2 * k : 2 * k + 2]]
    for n in (1, 3, 4, 5, 9, 10, 11, 14, 25, 60, 61, 200):
        for more in range(1, 2 + n // 3):
            words = [f"w{k}" for k in rng.integers(0, 10**6, n + 4 + more)]
            rows += [" ".join(words[:n]), " ".join(words[: n + more]), " ".join(["common"] * 5 + words[:n])]
    rows = list(enumerate(rows))
    found = near_duplicates.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found} == _linked(rows)


def test_shared_members_alone_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BUCKET_MEMBERS", 2000)
    monkeypatch.setattr(near_duplicates, "FLUSH_MEMBERS", 500)
    unlike = lambda value, starts: np.random.default_rng(len(value)).integers(0, 1 << 16, (len(starts) - 1, 20, 8)).astype(">u2")
    monkeypatch.setattr(near_duplicates, "label_sets", unlike)
    rows = list(enumerate([*_similar_texts(200, 5), *_similar_texts(40, 5)]))
    found = near_duplicates.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found} == _linked(rows)


def test_common_runs_do_not_join_neighbourhoods(spark, monkeypatch):
    """Texts of which each shares common phrases with many others, none of them linked: nothing is left to verify."""
    rng, written, keep = np.random.default_rng(11), {}, near_duplicates.materialize

    def noted(df, label):
        written[label] = keep(df, label)
        return written[label]

    monkeypatch.setattr(near_duplicates, "materialize", noted)
    phrases = [[f"p{k}x{x}" for x in range(9)] for k in range(40)]
    rows = []
    for i in range(600):
        one, two = (phrases[k] for k in rng.choice(40, 2, replace=False))
        own = [f"w{x}" for x in rng.integers(0, 10**6, 24)]
        rows.append((i, " ".join([*own[:8], *one, *own[8:16], *two, *own[16:]])))
    assert not any(n for _, n in _linked(rows).values())
    found = near_duplicates.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert all(r["class_id"] == r["doc_id"] and r["n_links"] == 0 for r in found)
    assert written["neighbourhoods"].count() < 20


@pytest.mark.parametrize("threshold", [0.45, 0.8, 0.93, 1.0])
@pytest.mark.parametrize("bucket", [4_000_000, 50])
def test_linked_sets_share_a_name_and_have_like_sketches(monkeypatch, threshold, bucket):
    monkeypatch.setattr(near_duplicates, "BUCKET_MEMBERS", bucket)
    rng, pairs = np.random.default_rng(12), []
    for n in [*range(1, 60), 100, 333, 1000, 4000]:
        for _ in range(6):
            # As different as linked sets can be, in members of the one, of the other or of both.
            left = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            gone = rng.integers(0, int(n * (1 - threshold) + 1e-6) + 1)
            more = int((n - gone) / threshold + 1e-6) - n
            right = np.concatenate((left[gone:], rng.integers(0, 1 << 63, rng.integers(0, more + 1) if more > 0 else 0, dtype=np.uint64)))
            assert n - gone >= threshold * len(np.union1d(left, right)) - 1e-6
            pairs += [np.sort(left), np.sort(right)]
    sizes = np.array([len(x) for x in pairs])
    value, starts = np.concatenate(pairs), np.concatenate(([0], np.cumsum(sizes)))
    bounds = near_duplicates.size_bounds(int(sizes.max()), threshold)
    signer = near_duplicates.Signer(bounds, np.histogram(sizes, [*bounds[:-1], np.inf])[0], threshold)
    text, bucket, name = signer.names(value, sizes)
    names = [set() for _ in pairs]
    for t, b, x in zip(text.tolist(), bucket.tolist(), name.tolist(), strict=True):
        names[t].add((b, x))
    assert all(names[k] & names[k + 1] for k in range(0, len(pairs), 2))
    left = np.arange(0, len(pairs), 2)
    bits = near_duplicates._Sketches(near_duplicates.set_sketches(value, starts)).differ(left, left + 1)
    assert all(n <= len(np.setxor1d(pairs[k], pairs[k + 1])) for k, n in zip(left.tolist(), bits.tolist(), strict=True))


def test_blocks_of_several_tiles_are_verified_whole(monkeypatch):
    monkeypatch.setattr(near_duplicates, "TILE", 5)
    rng = np.random.default_rng(13)
    core = [rng.integers(0, 1 << 40, 30) for _ in range(3)]
    sets = [np.unique(np.concatenate((core[k % 3][: rng.integers(26, 31)], rng.integers(0, 1 << 40, rng.integers(0, 4))))) for k in range(32)]
    near = np.array([[len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) for b in sets] for a in sets]) & ~np.eye(32, dtype=bool)
    copies, ids = rng.integers(1, 4, 32), rng.permutation(32) - 16
    links = np.zeros(32, int)
    for low, high in ((0, 0), (0, 1), (1, 1)):
        at = [k for k in range(32) if k // 16 in (low, high)]
        rows = pd.DataFrame({"block": [k // 16 for k in at], "low": low, "high": high, "set1": ids[at], "set2": 0, "copies": copies[at]})
        rows["shingles"] = [sets[k] for k in at]
        found = near_duplicates._verify(rows, 0.8)
        links[at] += found["links"].to_numpy()
        mine = near[np.ix_(at, at)] & (True if low == high else np.not_equal.outer(np.array(at) // 16, np.array(at) // 16))
        root = list(range(len(at)))
        for _ in at:
            root = [min([root[i], *(root[j] for j in np.flatnonzero(mine[i]))], key=lambda k: ids[at][k]) for i in range(len(at))]
        assert found["root"].tolist() == ids[at][root].tolist()
    assert links.tolist() == (near @ copies).tolist() and near.any()


def test_unrelated_texts_of_one_id_stay(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(7, one, 0), (7, two, 1), (7, two, 2), (8, three, 3), (9, one + " end", 4), (5, three, 5), (6, "", 6), (6, "", 7), (6, None, 8), (None, one, 9)]
    kept = near_duplicates.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, place long").repartition(3)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(7, one), (7, two), (5, three), (6, ""), (6, None), (None, one)])


def test_components_are_those_of_a_search(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 150, (90, 2))] + [(1000 + k, 1001 + k) for k in range(40)]
    parent = {}

    def top(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    found = near_duplicates.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: top(i) for i in parent}


def _chunks(text):
    """(first line, lines, chunk) of all boundary sets."""
    digest = lambda s: hashlib.md5(s.encode()).hexdigest()
    lines = text.split("\n")
    digits = [digest(str(int(digest(x)[:15], 16))) for x in lines]
    for k in range(line_chunks.SETS):
        starts = [i for i in range(len(lines)) if i == 0 or digits[i][k] in "01234" or digits[i - 1][16 + k] in "01234"]
        for i, j in zip(starts, [*starts[1:], len(lines)]):
            if sum(bool(WORD.search(x)) for x in lines[i:j]) > 1:
                yield i, j - i, "\n".join(lines[i:j])


def test_line_chunks(documents, corpus):
    first, chunks, expected = {}, {}, {}
    for i, text, *_ in sorted(_distinct(corpus)):
        chunks[i] = set(_chunks(text or ""))
        for at, _, chunk in chunks[i]:
            first[chunk] = min(first.get(chunk, (i, at)), (i, at))
    for i, text, *_ in _distinct(corpus):
        lines = [] if text is None else text.split("\n")
        gone = {k for at, n, chunk in chunks[i] if first[chunk] != (i, at) for k in range(at, at + n)}
        kept = [x for k, x in enumerate(lines) if k not in gone]
        expected[i] = (None if text is None else "\n".join(kept), len(lines), len(gone))
    rows = line_chunks.dedup_lines(documents).collect()
    assert len(rows) == len(corpus) and sum(r["n_removed"] for r in rows) > 0
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["text"], r["n_lines"], r["n_removed"]) == expected[r["doc_id"]]


def test_line_chunks_of_long_texts_and_frequent_lines(spark):
    long = [f"line {k} of a long text" for k in range(60000)]
    frequent = ["the same line everywhere", ""]
    rows = [(1, "\n".join(long)), (2, "\n".join(["other words", *long[20000:50000], "and others"]))]
    rows += [(10 + i, "\n".join([f"own line {i}", *frequent, f"own line {i} again"])) for i in range(3000)]
    found = {r["doc_id"]: r for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found[1]["n_removed"] == 0 and found[1]["n_lines"] == 60000
    left = found[2]["text"].split("\n")
    assert left[0] == "other words" and left[-1] == "and others" and len(left) < 20
    assert all(found[10 + i]["text"] == rows[2 + i][1] for i in range(3000))  # one worded line is no multi-line chunk


def test_line_chunks_of_nothing(no_documents):
    done = line_chunks.dedup_document_lines(no_documents)
    assert done.columns == no_documents.columns and done.count() == 0


def test_passages_shared_by_different_documents_go(spark):
    rng = np.random.default_rng(8)
    line = lambda: " ".join(f"w{k}" for k in rng.integers(0, 10**6, 12))
    passages = [[line() for _ in range(2 + k % 4)] for k in range(80)]
    texts = [[*(line() for _ in range(rng.integers(1, 5))), *p, *(line() for _ in range(rng.integers(1, 5)))] for p in [*passages, *passages]]
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, ""), (0, "\n".join(texts[0]))]
    done = line_chunks.dedup_document_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert not re.search("Python|Pandas|Arrow", done._jdf.queryExecution().toString())
    found = done.collect()
    assert len(found) == len(rows)
    kept = {r["doc_id"]: r["text"] for r in found}
    assert kept[900] is None and kept[901] == "" and all(kept[i] == "\n".join(texts[i]) for i in range(80))
    touched = removed = 0
    for i, passage in enumerate(passages, 80):
        left = kept[i].split("\n")
        assert [x for x in left if x not in passage] == [x for x in texts[i] if x not in passage]
        touched += any(x not in left for x in passage)
        removed += sum(x not in left for x in passage)
    assert touched >= 0.8 * len(passages) and removed >= 0.75 * sum(map(len, passages))


def test_line_chunks_run_no_python(documents):
    plan = line_chunks.dedup_lines(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_mixing(documents, no_documents, corpus):
    rows = mixing.mix_sources(documents).collect()
    assert len(rows) == len(corpus)
    size = defaultdict(int)
    for _, text, _, source in corpus:
        size[source] += len(WORD.findall(text or ""))
    target = mixing.source_targets(list(size.items()))
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    taken = Counter()
    for r in rows:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-5
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, words in size.items():
        longest = max(len(WORD.findall(t or "")) for _, t, _, s in corpus if s == source)
        assert abs(taken[source] - target[source]) <= longest
    again = mixing.mix_sources(documents.repartition(7)).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))
    repeated = Counter(r["doc_id"] for r in mixing.take_mix(documents).collect())
    assert repeated == +Counter({i: sum(r["copies"] for r in rows if r["doc_id"] == i) for i in {r["doc_id"] for r in rows}})
    assert mixing.mix_sources(no_documents).count() == 0


def test_targets_are_capped_and_reshared():
    found = mixing.source_targets([("b", 100), ("a", 10), (None, 400), ("c", 90)])
    # a (weight 5) and b (2) are full; c (1) and null (5) share the rest.
    assert found["a"] == 20 and found["b"] == pytest.approx(200) and found["c"] == pytest.approx((900 - 220) / 6)
    assert sum(found.values()) == pytest.approx(900)


def test_packing_is_whole_and_tight(documents, no_documents, corpus):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(documents).collect()
    texts = {i: t for i, t, *_ in corpus}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    copies = Counter(i for i, *_ in corpus)
    for i, text in texts.items():
        if i is None:
            continue
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        spans = sorted((r["start"], r["length"]) for r in pieces[i])[:: copies[i]]
        assert [s for s, _ in spans] == np.cumsum([0, *(n for _, n in spans)])[:-1].tolist() and sum(n for _, n in spans) == len(ids)
        for r in pieces[i]:
            assert r["doc_tokens"] == len(ids) and zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *(n for _, n in places)])[:-1].tolist() and sum(n for _, n in places) <= 2048
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= 1.03 * total / 2048 + 1
    assert packing.pack(no_documents).count() == 0


def test_column_generation_nears_the_bound():
    rng = np.random.default_rng(5)
    sizes, counts = np.unique(np.minimum(rng.geometric(1 / 80, 30_000), 256), return_counts=True)
    plan = packing.plan_sequences(dict(zip(sizes.tolist(), counts.tolist(), strict=True)), 256)
    held = Counter()
    for pattern, n in plan:
        assert sum(k * m for k, m in pattern.items()) <= 256
        held.update({k: m * n for k, m in pattern.items()})
    assert held == dict(zip(sizes.tolist(), counts.tolist(), strict=True))
    assert sum(n for _, n in plan) <= 1.01 * (sizes * counts).sum() / 256 + 2


def _exact(vectors, query, k=20):
    ids = np.array([i for i, _ in vectors])
    score = np.array([sum(a * b for a, b in zip(query[1], v, strict=True)) for _, v in vectors])
    order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != query[0]]
    return [int(ids[j]) for j in order[:k]]


def test_nearest_of_a_small_table_are_exact(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=4).astype("float32").astype(float).tolist()) for i in range(60)]
    good += [(100 + i, good[3][1]) for i in range(40)]
    bad = [(900, None), (901, [0.0] * 4), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan")] * 4), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [1.0]), (None, [1.0] * 4), (906, [])]
    table = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id long, embedding array<float>, rank int")
    found = defaultdict(list)
    for r in learned_partitions.nearest(table, table["vec_id"] % 20 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert set(found) == {0, 20, 40, 100, 120}
    for q in found:
        assert found[q] == _exact(good, (q, dict(good)[q]))
    assert learned_partitions.nearest(table.limit(0), table["vec_id"] % 20 == 0).count() == 0


def test_nearest_splits_the_queries_of_a_part(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "QUERY_BLOCK", 40, raising=False)
    monkeypatch.setattr(learned_partitions, "BLOCK", 100)
    whole = learned_partitions._best

    def bounded(queries, *rest):
        assert len(queries) < 100
        return whole(queries, *rest)

    monkeypatch.setattr(learned_partitions, "_best", bounded)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).astype("float32").astype(float).tolist()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(240)]
    found = defaultdict(list)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for r in learned_partitions.nearest(table, F.lit(True), parts=1).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert len(found) == 300
    for i, v in rows[::7]:
        assert found[i] == _exact(rows, (i, v))


def test_nearest_recall(spark, sf):
    folder = sf.replace("0.001", "0.1")
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], dtype=float)
    found = defaultdict(set)
    for r in learned_partitions.op2_learned_partitions(spark, folder).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = []
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hits.append(len(found[q] & set(ids[np.argsort(-score)[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(queries.REGISTRY) <= names and "pipeline" in names
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.REGISTRY} == set(range(1, 14))


def test_pipeline(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    ids, docs = {r["doc_id"] for r in documents.collect()}, documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf), "test")
        assert docs.columns == documents.columns
        assert {r["doc_id"] for r in docs.collect()} <= ids
    assert len(toxic) == 0 or len(toxic & {r["doc_id"] for r in docs.collect()}) < len(toxic)
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == Counter(r["doc_id"] for r in docs.collect())


def test_stages_keep_columns_of_any_name(spark, corpus):
    names = ["runs", "removed", "draw", "size", "_class", "toxic_score", "copies", "_row", "_key", "labels"]
    rows = [(i, t, "en", s, len(t or ""), *(f"{n} {i}" for n in names)) for i, t, _, s in _distinct(corpus)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(60)], "doc_id long, quality int, toxic int")
    for stage in (lambda d: toxicity.keep_civil(d, labels), line_chunks.dedup_document_lines, near_duplicates.keep_one_of_each, mixing.take_mix):
        done = stage(docs)
        assert done.columns == docs.columns
        for r in done.collect():
            assert all(r[n] == f"{n} {r['doc_id']}" for n in names)
    assert line_chunks.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_removed"]


def test_nothing_is_toxic_without_labels_of_both_classes(spark, documents, corpus):
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (one, one.limit(0)):
        assert toxicity.keep_civil(documents, labels).count() == len(corpus)
