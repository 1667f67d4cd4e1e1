"""Conversation prefix trie from vertical bitmaps.

Conversations are sequences of turns; a node of the trie is a distinct sequence of first turns, its members the conversations
that begin with it. Conversations are dealt into shards of ``SHARD_IDS`` ids and ``SHARD_TURNS`` positions. A shard indexes
(position, turn) to the bitset of its conversations with that turn there. From the nodes that enter the shard it descends
depth first: a node's bitset intersected with the postings of the next position gives its children, their popcounts and the
list of members that end there. A node of one member needs no more bitsets, its conversation is its only path.

A node is known in all shards by its depth and the exclusive or of hashes of its (position, turn) pairs, 128 bits, which
sums over windows give natively. Merging the shards adds the popcounts and takes the smallest member, the node's owner. The
nodes of one owner follow one another on its path, so sums over subtrees are sums along an owner's nodes, plus each owner's
total sent once to every node above its first: as many rows as there are turns at most, added up by node.

Hot keys. Turns are numbered and hashed per conversation and block of positions, with block totals carried over, so a
conversation with a third of all turns is many blocks. A node that very many conversations share is one row per shard, and sums to
it are partial before their shuffle. Its list of ends has one row per shard too, a run of ids, which one task digests as
a stream, since a digest has an order; nothing collects them. Parents of very many first nodes are looked up by broadcast,
of which there are at most ``2 ** 16``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.base import small_batches
from cohortry.session import materialize

SHARD_IDS, SHARD_TURNS = 3_200, 64
"""Conversation ids and positions of one shard: at most about 200,000 turns, without their texts."""
BRANCH, HEADS = 100, 6
"""A conversation begins with up to ``HEADS - 1`` turns of the first one of its ``BRANCH`` ids."""
HOT_PARENTS = 1 << 16
LEAST_HOT = 1_000
"""Parents of more children than one in ``HOT_PARENTS`` nodes, and than this, are broadcast."""
BATCH_RUNS = 1_000
"""Runs of ids handed to a Python worker at once, each of ``SHARD_IDS`` ids at most."""


def _hash(*parts: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *parts)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_key, other_key, chars): the turns of every conversation, from position 0.

    Turns are dealt out by range, equal ones by their task as well, so that a long conversation spans many partitions; the number of
    its turns in the partitions before is added to the number within one.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _hash(role, text, seed=1).alias("turn_key"),
        _hash(text, role, seed=2).alias("other_key"),
        F.length(text).alias("chars"),
    )
    order = ["turn", "turn_key", "other_key"]
    ranged = turns.repartitionByRange("conv_id", *order, F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "turns")
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("conv_id", "_part").orderBy(*order)
    placed = ranged.join(before.drop("_n"), ["conv_id", "_part"]).withColumn("pos", F.col("_before") + F.row_number().over(inside) - 1)
    return placed.select("conv_id", "pos", "turn_key", "other_key", "chars")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, size, pos, turn_key, other_key, chars) of the rebuilt conversations; one without turns has a row with pos -1.

    Conversation c takes the first h turns of conversation ``c - c % BRANCH``, then its own after its first h, h being
    ``crc32(c) % HEADS``.
    """
    turns = materialize(turns, "numbered")
    turn = F.struct("pos", "turn_key", "other_key", "chars")
    first = turns.where((F.col("pos") < HEADS - 1) & (F.col("conv_id") % BRANCH == 0))
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("head"))  # HEADS - 1 turns at most
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    sizes = sizes.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int"))
    plan = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % BRANCH).join(heads, "base", "left")
    none = F.array().cast("array<struct<pos:bigint,turn_key:bigint,other_key:bigint,chars:int>>")
    plan = plan.withColumn("head", F.slice(F.coalesce("head", none), F.lit(1), F.col("h")))
    plan = plan.withColumn("size", F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    plan = materialize(plan.select("conv_id", "h", "head", "size"), "branches")
    taken = plan.select("conv_id", "size", F.inline("head"))
    own = turns.join(plan.select("conv_id", "size", "h", F.size("head").alias("taken")), "conv_id").where(F.col("pos") >= F.col("h"))
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")).select(*taken.columns)
    empty = plan.where("size = 0").selectExpr("conv_id", "size", "-1L as pos", "0L as turn_key", "0L as other_key", "0 as chars")
    return taken.unionByName(own).unionByName(empty)


def paths(rebuilt: DataFrame, shard_ids: int = SHARD_IDS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The rebuilt turns with ``shard``, ``part`` (block of positions) and the keys (k1, k2) of the node each turn leads to.

    A key is the exclusive or of the hashes of the turns up to there, each with its position; (e1, e2) is the key at
    the part's start.
    """
    rows = rebuilt.withColumns({
        "shard": F.floor(F.col("conv_id") / shard_ids),
        "part": F.floor(F.greatest("pos", F.lit(0)) / shard_turns),
        "x1": F.when(F.col("pos") < 0, 0).otherwise(_hash("turn_key", "other_key", "pos", seed=3)),
        "x2": F.when(F.col("pos") < 0, 0).otherwise(_hash("other_key", "turn_key", "pos", seed=4)),
    })
    rows = materialize(rows.drop("other_key"), "rebuilt")
    blocks = rows.groupBy("conv_id", "part").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    entry = [F.coalesce(F.bit_xor(b).over(earlier), F.lit(0)).alias(e) for b, e in (("b1", "e1"), ("b2", "e2"))]
    blocks = blocks.select("conv_id", "part", *entry)
    upto = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keys = {k: F.col(e).bitwiseXOR(F.bit_xor(x).over(upto)) for k, e, x in (("k1", "e1", "x1"), ("k2", "e2", "x2"))}
    return rows.join(blocks, ["conv_id", "part"]).withColumns(keys).drop("x1", "x2")


_NODE = "k1 long, k2 long, depth long, p1 long, p2 long, n long, low long, chars long, shard long, ends string"


def shard_nodes(rows: pd.DataFrame, turns: int = SHARD_TURNS) -> pd.DataFrame:
    """The nodes of one shard and part: key, depth, parent's key, popcount, smallest member, length of the last text, ends.

    ``ends`` are the ids of the members that end there, ascending, joined by commas. The nodes that enter the part are
    found by the part before, but for the root.
    """
    rows = rows.sort_values(["conv_id", "pos"], kind="stable")
    ids, first = np.unique(rows["conv_id"].to_numpy(), return_index=True)
    pos, turn, chars = rows["pos"].to_numpy(), rows["turn_key"].to_numpy(), rows["chars"].to_numpy()
    k1, k2 = rows["k1"].to_numpy(), rows["k2"].to_numpy()
    size, part, shard = rows["size"].to_numpy()[first], int(rows["part"].iloc[0]), int(rows["shard"].iloc[0])
    last = np.append(first[1:], len(rows))
    begin = part * turns

    # The index: the bitset of the conversations with a turn at a position.
    member = np.repeat(np.arange(len(ids)), last - first)
    index: dict[tuple[int, int], int] = {}
    there = [0] * (turns + 1)
    for m, p, t in zip(member.tolist(), pos.tolist(), turn.tolist(), strict=True):
        if p >= 0:
            index[p, t] = index.get((p, t), 0) | 1 << m
            there[p - begin] |= 1 << m
    ending: dict[int, int] = {}
    for m, s in enumerate(size.tolist()):
        ending[s] = ending.get(s, 0) | 1 << m

    def members(bits: int) -> list[int]:
        found = []
        while bits:
            low = bits & -bits
            found.append(low.bit_length() - 1)
            bits ^= low
        return found

    out: list[tuple] = []
    singles: list[np.ndarray] = []  # places of turns that lead to a node of one member

    def row_of(m: int, depth: int) -> int:
        return int(first[m]) + depth - 1 - begin

    def node(bits: int, depth: int, key: tuple[int, int], parent: tuple[int, int]) -> None:
        low = (bits & -bits).bit_length() - 1
        ends = ",".join(str(ids[m]) for m in members(bits & ending.get(depth, 0)))
        length = int(chars[row_of(low, depth)]) if depth else 0
        out.append((*key, depth, *parent, bits.bit_count(), int(ids[low]), length, shard, ends))

    # The nodes that enter: members of one key at the part's start.
    entering: dict[tuple[int, int], int] = {}
    for m, at in enumerate(first.tolist()):
        key = (int(rows["e1"].iat[at]), int(rows["e2"].iat[at]))
        entering[key] = entering.get(key, 0) | 1 << m
    if part == 0:
        node((1 << len(ids)) - 1, 0, (0, 0), (0, 0))
    stack = [(bits, begin, key) for key, bits in entering.items()]
    while stack:
        bits, depth, key = stack.pop()
        rest = bits & there[depth - begin]
        while rest:
            m = (rest & -rest).bit_length() - 1
            at = row_of(m, depth + 1)
            child = rest & index[depth, int(turn[at])]
            rest ^= child
            if child & (child - 1):
                below = (int(k1[at]), int(k2[at]))
                node(child, depth + 1, below, key)
                if depth + 1 < begin + turns:
                    stack.append((child, depth + 1, below))
            else:
                singles.append(np.arange(at, int(last[m])))

    at = np.concatenate(singles) if singles else np.zeros(0, np.int64)
    same = at > first[member[at]]  # the turn before lies in this part
    before = np.maximum(at - 1, 0)
    entry = [np.where(same, k[before], rows[e].to_numpy()[at]) for k, e in ((k1, "e1"), (k2, "e2"))]
    owner = ids[member[at]]
    ends = np.where(size[member[at]] == pos[at] + 1, owner.astype(str), "")
    alone = pd.DataFrame({
        "k1": k1[at], "k2": k2[at], "depth": pos[at] + 1, "p1": entry[0], "p2": entry[1], "n": 1, "low": owner, "chars": chars[at], "shard": shard, "ends": ends,
    })
    shared = pd.DataFrame(out, columns=alone.columns) if out else alone.iloc[:0]
    return pd.concat([shared, alone], ignore_index=True)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, ends_sha256) from runs of ids in the order of node and shard, read as a stream."""
    key, digest = None, None
    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for a, b, ends in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ends")), strict=True):
            if (a, b) != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        yield _digest_rows(done)
    if key is not None:
        yield _digest_rows([(*key, digest.hexdigest())])


def _digest_rows(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True)) or [(), (), ()]
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["k1", "k2", "ends_sha256"])


_KEY = ["k1", "k2", "depth"]


def merged_nodes(shards: DataFrame) -> DataFrame:
    """(k1, k2, depth, conv_id, p1, p2, n_convs, chars, n_children, ends_sha256) of every node, over all shards."""
    shards = materialize(shards, "shard-nodes")
    ends = shards.where("ends != ''").select(*_KEY, "shard", "ends").repartition(*_KEY).sortWithinPartitions(*_KEY, "shard")
    ends = ends.select("k1", "k2", "ends").mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")
    nodes = shards.groupBy(*_KEY).agg(
        F.min("low").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.sum("n").alias("n_convs"), F.max("chars").alias("chars")
    )
    nodes = materialize(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    found = nodes.join(children, _KEY, "left").join(ends, ["k1", "k2"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "ends_sha256": F.coalesce("ends_sha256", F.lit(nothing))})


def conversation_trie(conversations: DataFrame, shard_ids: int = SHARD_IDS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    Rows without a conv_id belong to no conversation and are left out. Turns come in the order of ``turn``, null first; rows that tie come in
    the order of a digest of role and text, so repeated rows are repeated turns and reruns agree. Null roles and texts
    are empty; texts of any length are read once, to be hashed. An empty table has no conversation and gives no
    rows, not even a root. Other columns are not read.
    """
    small_batches(conversations.sparkSession, BATCH_RUNS)
    walked = materialize(paths(rebuilt_turns(numbered_turns(conversations)), shard_ids, shard_turns), "paths")

    def nodes_of(rows: pd.DataFrame) -> pd.DataFrame:
        return shard_nodes(rows, shard_turns)

    shards = walked.groupBy("shard", "part").applyInPandas(nodes_of, _NODE)
    nodes = materialize(merged_nodes(shards), "merged")

    # Sums along an owner's nodes, from the deepest up: within a block of depths, and over the blocks below it.
    worth = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    leaf = (F.col("n_children") == 0).cast("long").alias("leaves")
    owned = nodes.select(*_KEY, "conv_id", F.floor(F.col("depth") / shard_turns).alias("block"), worth, leaf)
    blocks = owned.groupBy("conv_id", "block").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"), F.min("depth").alias("top"))
    blocks = materialize(blocks, "owners")
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    below = blocks.select("conv_id", "block", *[F.coalesce(F.sum(c).over(deeper), F.lit(0)).alias(f"{c}_below") for c in ("saved", "leaves")])
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = owned.join(below, ["conv_id", "block"])
    own = own.select(*_KEY, *[(F.sum(c).over(inside) + F.col(f"{c}_below")).alias(c) for c in ("saved", "leaves")])

    # Each owner's total goes to every node above its first one: to the turns of its path that lead there, and to the root.
    owners = blocks.groupBy("conv_id").agg(F.min("top").alias("top"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).where("top > 0")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("top") - 1) / shard_turns))).alias("part")
    turns = walked.select("conv_id", "part", "k1", "k2", (F.col("pos") + 1).alias("depth"))
    above = turns.join(owners.select("*", parts), ["conv_id", "part"]).where(F.col("depth") < F.col("top")).select(*own.columns)
    root = owners.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).where("leaves is not null")
    root = root.selectExpr("0L as k1", "0L as k2", "0L as depth", "saved", "leaves")
    sums = own.unionByName(above).unionByName(root).groupBy(*_KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    # An owner's first node hangs below another owner's; parents of very many such nodes are broadcast.
    tops = nodes.join(owners.select("conv_id", F.col("top").alias("depth")), ["conv_id", "depth"]).select(*_KEY, "p1", "p2")
    many = max(nodes.count() // HOT_PARENTS, LEAST_HOT)
    parent = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parent.where(F.col("n_children") > many).select("p1", "p2", "depth", F.col("parent_conv_id").alias("hot")))
    tops = materialize(tops.join(hot, ["p1", "p2", "depth"], "left"), "first-nodes")
    cold = tops.where("hot is null").drop("hot").join(parent.drop("n_children"), ["p1", "p2", "depth"])
    hung = cold.select(*_KEY, "parent_conv_id").unionByName(tops.where("hot is not null").select(*_KEY, F.col("hot").alias("parent_conv_id")))

    done = nodes.join(sums, _KEY).join(hung, _KEY, "left")
    parent_id = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id")
    return done.select("conv_id", "depth", parent_id, "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP11_SQL = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
tab AS MATERIALIZED (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tab
  FROM (SELECT unnest(range(0, 256)) AS i)),
convs AS (
  SELECT c, c - c % {BRANCH} AS base,
    xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(c::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT),
      lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]), 4294967295)) % {HEADS} AS h
  FROM (SELECT DISTINCT c FROM turns), tab),
rebuilt AS (
  SELECT convs.c, 0 AS half, i, t, chars FROM convs JOIN turns ON turns.c = convs.base AND i <= h
  UNION ALL SELECT convs.c, 1, i, t, chars FROM convs JOIN turns ON turns.c = convs.c AND i > h),
steps AS (SELECT c, t, chars, row_number() OVER (PARTITION BY c ORDER BY half, i) AS d FROM rebuilt),
path AS (
  SELECT c, 0::BIGINT AS d, md5('') AS k, NULL::VARCHAR AS p, 0::BIGINT AS chars FROM convs
  UNION ALL SELECT path.c, steps.d, md5(path.k || steps.t), path.k, steps.chars FROM path JOIN steps ON steps.c = path.c AND steps.d = path.d + 1),
deepest AS (SELECT c, max(d) AS size FROM path GROUP BY c),
nodes AS (
  SELECT d, k, any_value(p) AS p, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = size), '') AS ends
  FROM path JOIN deepest USING (c) GROUP BY d, k),
children AS (SELECT d - 1 AS d, p AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (d, k)),
subtree AS (
  SELECT path.d, path.k, sum((n_convs - 1) * f.chars) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM full_nodes f JOIN path ON path.c = f.conv_id AND path.d <= f.d GROUP BY path.d, path.k)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN subtree USING (d, k) LEFT JOIN full_nodes up ON up.d = f.d - 1 AND up.k = f.p
"""
