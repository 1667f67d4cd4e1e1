"""Approximate nearest neighbours with learned partitions.

On a bounded sample the neighbour graph (largest inner products) is cut into parts of equal size that hold as many of its
edges as possible: labels spread along edges under a capacity. A small network learns, for a vector, how its
neighbours are spread over the parts; it places every row of the table in its most probable part and sends every query
to its most probable ones, as many as the sample needs for the wanted recall. What is found there is ranked by exact inner
products of the original vectors.

A part is split into blocks of about ``BLOCK`` rows by a hash of the id, so one vector with very many copies makes more
blocks, not a larger task. The queries a part is asked are split in the same way, by ``QUERY_BLOCK``; every block of queries meets
every block of rows. The number of parts grows with the table, as far as the sample can tell parts apart. Of equal vectors in a block only the smallest ids can be among the nearest ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.session import materialize

SAMPLE = 6_000
"""Rows the graph and the network are fitted on, at most."""
PARTS, DEGREE, HIDDEN, EPOCHS, RATE = 16, 20, 128, 250, 0.01
BLOCK = 20_000
QUERY_BLOCK = 50_000
"""Queries of a part that one group holds, about."""
ROWS_A_PART, MOST_PARTS = 1_000_000, 64
"""Larger tables are cut into more parts than ``PARTS``, up to about a hundred sampled rows in each."""
RECALL = 0.96
"""Recall on the sample that decides how many parts a query visits."""
NEAREST, EVERY = 20, 20


def usable(column: str) -> Column:
    """Whether a vector takes part: neither null nor zero, and no component null or not finite."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(column).isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(column, lambda x: x != 0), F.lit(False))


def neighbours(points: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """For each query the ``k`` points of largest inner product, its own row (``own``) aside."""
    found = np.zeros((len(queries), k), dtype=np.int64)
    for low in range(0, len(queries), 512):
        score = queries[low : low + 512] @ points.T
        score[np.arange(len(score)), own[low : low + 512]] = -np.inf
        found[low : low + 512] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return found


def balanced_parts(points: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """A part for each node: labels spread along the edges of the symmetric graph, no part above its capacity."""
    n = len(points)
    capacity = -(-n // parts)
    rows = np.repeat(np.arange(n), near.shape[1])
    left, right = np.concatenate((rows, near.ravel())), np.concatenate((near.ravel(), rows))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    centres = unit[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, dtype=np.int64)
    for turn in range(rounds):
        if turn < 10:  # seeds by direction, then edges alone
            wish = unit @ centres.T
        else:
            wish = np.bincount(left * parts + part[right], minlength=n * parts).reshape(n, parts).astype(float)
            wish[np.arange(n), part] += 0.5
        free, todo, part = np.full(parts, capacity), np.arange(n), np.zeros(n, dtype=np.int64)
        wish = wish.copy()
        while len(todo):
            best = wish[todo].argmax(axis=1)
            value = wish[todo, best]
            refused = []
            for p in range(parts):
                mine = todo[best == p]
                mine = mine[np.argsort(-value[best == p], kind="stable")]
                part[mine[: free[p]]] = p
                refused.append(mine[free[p] :])
                free[p] -= min(free[p], len(mine))
            wish[:, free == 0] = -np.inf
            todo = np.concatenate(refused)
        if turn < 10:
            centres = np.stack([unit[part == p].sum(axis=0) for p in range(parts)])
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return part


class Router:
    """One hidden layer and a softmax over parts; the input is the direction of the vector."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    def logits(self, points: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        unit = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-300)
        return np.maximum(unit @ w1 + b1, 0) @ w2 + b2


def train_router(points: np.ndarray, spread: np.ndarray, rng: np.random.Generator) -> Router:
    """Adam on the cross entropy with ``spread``, the share of each point's neighbours in every part."""
    width, parts = points.shape[1], spread.shape[1]
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    weights = [rng.normal(0, 1, (width, HIDDEN)) * np.sqrt(2), np.zeros(HIDDEN), rng.normal(0, 1, (HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS // 10):
        order = rng.permutation(len(unit))
        for low in range(0, len(order), 600):
            rows, step = order[low : low + 600], step + 1
            hidden = np.maximum(unit[rows] @ weights[0] + weights[1], 0)
            logit = hidden @ weights[2] + weights[3]
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - spread[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            grads = [unit[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            for k, g in enumerate(grads):
                g = g + 1e-5 * weights[k]
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                weights[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Router(weights)


def fit(points: np.ndarray, parts: int = PARTS, recall: float = RECALL, k: int = NEAREST, seed: int = 3) -> tuple[Router | None, int, int]:
    """(router, parts, parts a query visits); one part, and no router, for a sample too small to be cut."""
    parts = min(parts, len(points) // (4 * k))
    if parts < 2:
        return None, 1, 1
    rng = np.random.default_rng(seed)
    near = neighbours(points, points, np.arange(len(points)), DEGREE)
    part = balanced_parts(points, near, parts, rng)
    # A point's own part counts as one more neighbour.
    spread = np.bincount((np.arange(len(points))[:, None] * parts + np.hstack((part[near], part[:, None]))).ravel(), minlength=len(points) * parts)
    spread = spread.reshape(len(points), parts) / (DEGREE + 1)
    # A fifth of the sample is left out of the training; it tells how many parts a query has to visit.
    asked = np.arange(0, len(points), 5)
    learned = np.setdiff1d(np.arange(len(points)), asked)
    router = train_router(points[learned], spread[learned], rng)
    logit = router.logits(points)
    place = logit.argmax(axis=1)
    order = np.argsort(-logit[asked], axis=1)
    visit = np.argsort(order, axis=1)  # the turn at which a part is visited
    turn = np.take_along_axis(visit, place[near[asked]], axis=1)
    for probes in range(1, parts + 1):
        if (turn < probes).mean() >= recall:
            break
    return router, parts, probes


def _best(queries: np.ndarray, query_ids: np.ndarray, base: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest base rows of each query, in the order of (score, smaller id)."""
    order = np.argsort(ids, kind="stable")
    base, ids = base[order], ids[order]
    # Of equal vectors only the k + 1 smallest ids matter (one of them may be the query itself).
    _, same = np.unique(base.view(np.dtype((np.void, base.dtype.itemsize * base.shape[1]))).ravel(), return_inverse=True)
    by = np.argsort(same, kind="stable")
    first = np.concatenate(([0], np.flatnonzero(np.diff(same[by])) + 1))
    place = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
    keep = np.sort(by[place <= k])
    base, ids = base[keep], ids[keep]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low in range(0, len(queries), 256):
        part, own = queries[low : low + 256], query_ids[low : low + 256]
        rough = part @ base.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        if rough.shape[1] > k:
            edge = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
        else:
            edge = np.full(len(part), -np.inf)
        slack = 1e-9 * np.maximum(np.abs(rough[np.isfinite(rough)]).max(initial=1.0), 1.0)
        row, column = np.nonzero((rough >= edge[:, None] - slack) & (rough > -np.inf))
        score = (part[row] * base[column]).sum(axis=1)
        rank = np.lexsort((ids[column], -score, row))
        row, column, score = row[rank], column[rank], score[rank]
        start = np.searchsorted(row, np.arange(len(part)))
        near = np.arange(len(row)) - start[row] < k
        found.append((own[row[near]], ids[column[near]], score[near]))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def nearest(embeddings: DataFrame, is_query: Column, k: int = NEAREST, parts: int = PARTS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` marks, its ``k`` nearest other rows.

    ``embeddings`` needs ``vec_id`` and ``embedding``; other columns are not read. Rows without an id, with an unusable vector
    or with another length than the commonest take no part. Rows that share an id are searched as one
    query and are no neighbours of one another; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable("embedding"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("asks"))
    widths = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = widths["width"] if widths else 0
    rows = rows.where(F.size("embedding") == width)
    sample = rows.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    points = np.array([r["embedding"] for r in sample], dtype=float).reshape(len(sample), width)
    parts = max(parts, min(widths["count"] // ROWS_A_PART, MOST_PARTS) if widths else 0)
    router, parts, probes = fit(points, parts, recall, k)

    def route(batches):
        for frame in batches:
            points = np.stack(frame["embedding"].to_numpy()) if len(frame) else np.zeros((0, width))
            if router is None:
                frame["visits"] = [[0]] * len(frame)
            else:
                frame["visits"] = list(np.argsort(-router.logits(points), axis=1, kind="stable")[:, :probes].astype(np.int32))
            yield frame

    # An id's rows and their order of parts are written once: the table itself is the index.
    indexed = rows.mapInPandas(route, "vec_id long, embedding array<double>, asks boolean, visits array<int>")
    indexed = materialize(indexed.withColumn("part", F.col("visits")[0]), "vector-index")
    many = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}  # one row per part
    asked = indexed.where("asks").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.explode("visits").alias("part"))
    asks = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}  # one row per part
    counts = [(p, -(-n // BLOCK), max(1, -(-asks.get(p, 0) // QUERY_BLOCK))) for p, n in many.items()]
    blocks = spark.createDataFrame(counts or [(-1, 1, 1)], "part int, blocks int, query_blocks int")
    blocks = F.broadcast(blocks)  # one row per part

    def own(column: str, count: str) -> Column:
        return F.pmod(F.xxhash64(column), count).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    base = indexed.join(blocks, "part").select("part", every("query_blocks").alias("query_block"), own("vec_id", "blocks").alias("block"), "vec_id", "embedding")
    asked = asked.join(blocks, "part").select("part", own("query_id", "query_blocks").alias("query_block"), every("blocks").alias("block"), "query_id", "query")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _best(np.stack(left["query"].to_numpy()), left["query_id"].to_numpy(), np.stack(right["embedding"].to_numpy()), right["vec_id"].to_numpy(), k)

    meet = ["part", "query_block", "block"]
    found = asked.groupBy(*meet).cogroup(base.groupBy(*meet)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)
