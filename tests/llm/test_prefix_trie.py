"""The conversation trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pandas as pd
import pytest

from cohortry.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 long, part int, size string"


def _rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [(r, t) for *_, r, t in sorted(own)] for c, own in turns.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in plain}
    return {c: plain.get(c - c % 100, [])[: heads[c]] + plain[c][heads[c] :] for c in plain}


def _trie(rows):
    full = _rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(own) - 1) * (len(path[-1][1]) if path else 0)
            leaves[path[:d]] += children[path] == 0
    return sorted(
        (
            own[0], len(path), members[path[:-1]][0] if path else -1, len(own), children[path], leaves[path], saved[path],
            hashlib.sha256(",".join(str(c) for c in own if len(full[c]) == len(path)).encode()).hexdigest(),
        )
        for path, own in members.items()
    )


def _found(df):
    return sorted(tuple(-1 if v is None else v for v in row) for row in df.collect())


@pytest.fixture(scope="module")
def conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 260), 1005, 1103, 7_000_000_000]:
        if c == 200:
            continue  # conversations without a first one
        for k in range(rng.randrange(0, 9)):
            # Few distinct turns, so that conversations share beginnings; ends differ.
            text = None if rng.random() < 0.05 else f"turn {k} of {rng.randrange(3)} é" if rng.random() < 0.8 else f"own {c} {k}"
            rows.append((c, k if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), text))
    long = [(c, k, "user", f"step {k}") for c in (300, 301, 302) for k in range(150 + c % 3)]
    copies = [(400 + c, k, "user", f"common {k}") for c in range(100) for k in range(8)]
    twice = [(500, 1, "user", "again")] * 3 + [(500, 1, "user", "before")]
    rows += long + copies + twice + [(None, 1, "user", "lost"), (600, 0, "user", "x" * 100_000), (601, 9, "user", "")]
    return rows


@pytest.mark.parametrize(("ids", "turns", "hot"), [(3_200, 64, 1_000), (70, 7, 5)])
def test_trie_equals_brute_force(spark, conversations, monkeypatch, ids, turns, hot):
    monkeypatch.setattr(prefix_trie, "LEAST_HOT", hot)
    table = spark.createDataFrame([(*r, "d", 1, 2, "s") for r in conversations], SCHEMA).repartition(5)
    assert _found(prefix_trie.conversation_trie(table, ids, turns)) == _trie(conversations)


def test_trie_of_one_conversation_with_most_turns(spark):
    """Its turns span partitions, parts and blocks; a third of all rows are equal."""
    rows = [(7, k, "user", f"step {k}") for k in range(900)] + [(7, 900, "user", "stuck")] * 900 + [(c, 0, "user", "hi") for c in range(100, 200)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    turns = prefix_trie.numbered_turns(table).where("conv_id = 7").collect()
    assert sorted(r["pos"] for r in turns) == list(range(1800))
    assert _found(prefix_trie.conversation_trie(table)) == _trie(rows)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.conversation_trie(none).count() == 0
    lost = spark.createDataFrame([(None, 1, "user", "a", "", 1, 1, "")], SCHEMA)
    assert prefix_trie.conversation_trie(lost).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")][: zlib.crc32(str(c).encode()) % 6]
    found = _found(prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert found == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())] == _trie(rows)


def test_a_shard_lists_popcounts_and_ends():
    """Two conversations share a turn, a third one branches off; keys are those given."""
    rows = [(1, 2, 0, 11, 1), (1, 2, 1, 12, 2), (2, 1, 0, 11, 1), (3, 2, 0, 11, 1), (3, 2, 1, 13, 3)]
    frame = pd.DataFrame(rows, columns=["conv_id", "size", "pos", "turn_key", "k1"]).assign(k2=0, e1=0, e2=0, chars=4, shard=0, part=0)
    nodes = {(r.depth, r.k1): (r.n, r.low, r.p1, r.ends) for r in prefix_trie.shard_nodes(frame).itertuples()}
    assert nodes == {(0, 0): (3, 1, 0, ""), (1, 1): (3, 1, 0, "2"), (2, 2): (1, 1, 1, "1"), (2, 3): (1, 3, 1, "3")}
