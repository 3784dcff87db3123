"""Approximate nearest neighbours by learned partitions.

On a bounded sample of the vectors a neighbour graph is built and cut into balanced partitions; a small neural network learns to
tell a vector's partition from its components. Every vector is filed under its most probable partition. A query looks into its
most probable partitions, as many as a target recall on part of the sample asks for, and what it finds there is ranked by exact distance.

Partitions are stored in blocks of at most about ``BLOCK_ROWS`` vectors, so a vector that a third of all rows share is no hot group;
queries of a partition come in blocks, too. A task compares one block of queries with one block of vectors and returns the k nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import written

#: Most vectors that the partitions are learned from, chosen by a hash of their id.
SAMPLE = 8192
#: Sampled vectors for each partition, and most partitions.
PER_PARTITION, PARTITIONS = 128, 64
NEIGHBOURS, HIDDEN, EPOCHS = 10, 96, 25
TARGET_RECALL = 0.98
BLOCK_ROWS, QUERY_ROWS = 8192, 2048


def usable(vector: Column, dim: int) -> Column:
    """Neither null nor zero, of ``dim`` components that are all finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dim) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest(queries: np.ndarray, vectors: np.ndarray, k: int, own: tuple[np.ndarray, np.ndarray] | None = None, ids: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and exact distances of the k nearest vectors of each query, ties to smaller ids; with ``own`` = (query ids, vector ids) a query's own id is left out."""
    ids = np.arange(len(vectors)) if ids is None else ids
    rough = (queries**2).sum(1)[:, None] + (vectors**2).sum(1)[None] - 2 * queries @ vectors.T
    out = []
    for i, row in enumerate(rough):
        if own is not None:
            row[own[1] == own[0][i]] = np.inf
        near = np.flatnonzero(np.isfinite(row))
        if len(near) > k:
            # The product is inexact: keep all that rounding could bring among the k nearest.
            limit = np.partition(row[near], k - 1)[k - 1] + 1e-9 * ((queries[i] ** 2).sum() + (vectors**2).sum(1).max())
            near = near[row[near] <= limit]
        exact = np.sqrt(((vectors[near] - queries[i]) ** 2).sum(1))
        order = np.lexsort((ids[near], exact))[:k]
        out.append((near[order], exact[order]))
    return out


def neighbour_graph(sample: DataFrame, vectors: np.ndarray) -> np.ndarray:
    """Row numbers of the nearest other vectors of each row of ``vectors``; blocks of rows are compared in tasks."""
    k, dim = min(NEIGHBOURS, len(vectors) - 1), vectors.shape[1]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("id").to_numpy()
            for start in range(0, len(rows), 512):
                part = rows[start : start + 512]
                found = nearest(vectors[part], vectors, k, own=(part, np.arange(len(vectors))))
                yield pa.record_batch([pa.array(part), pa.array([f[0] for f in found], pa.list_(pa.int64()))], ["id", "near"])

    tasks = max(1, min(32, len(vectors) // 256))
    found = sample.sparkSession.range(0, len(vectors), 1, tasks).mapInArrow(compare, "id long, near array<long>").toArrow()
    graph = np.zeros((len(vectors), k), np.int64)
    graph[found.column("id").to_numpy()] = np.array(found.column("near").to_pylist(), np.int64).reshape(-1, k)
    return graph


def balanced_partitions(vectors: np.ndarray, graph: np.ndarray, count: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """A partition for each vector, ``count`` in all (a power of 2) and none above ``slack`` times its share, with few graph edges between them.

    Starts from halves along the widest direction, then moves vectors to the partition with most of their neighbours, strongest wish first, while there is room.
    """
    parts = np.zeros(len(vectors), np.int64)
    size = 1
    while size < count:
        for p in range(size):
            own = np.flatnonzero(parts == p)
            centred = vectors[own] - vectors[own].mean(0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            parts[own[np.argsort(centred @ axis, kind="stable")[len(own) // 2 :]]] += size
        size *= 2
    room = int(np.ceil(slack * len(vectors) / count))
    for _ in range(rounds):
        wish = np.zeros((len(vectors), count))
        rows = np.repeat(np.arange(len(vectors)), graph.shape[1])
        np.add.at(wish, (rows, parts[graph.ravel()]), 1)
        np.add.at(wish, (graph.ravel(), parts[rows]), 1)
        gain = wish.max(1) - wish[np.arange(len(vectors)), parts]
        sizes = np.bincount(parts, minlength=count)
        target = wish.argmax(1)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[target[i]] < room:
                sizes[parts[i]] -= 1
                sizes[target[i]] += 1
                parts[i] = target[i]
                moved += 1
        if not moved:
            break
    return parts


@dataclass
class Router:
    """A network of one hidden layer; ``probes`` is how many partitions a query looks into."""

    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    probes: int = 1

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((vectors - self.mean) / self.spread @ w1 + b1, 0) @ w2 + b2

    def ranked(self, vectors: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(vectors), axis=1, kind="stable")


def train_router(vectors: np.ndarray, wanted: np.ndarray, seed: int = 0) -> Router:
    """Learns the shares ``wanted`` (rows of probabilities by partition) by Adam on cross entropy."""
    rng = np.random.default_rng(seed)
    spread = vectors.std(0)
    spread[spread < 1e-12] = 1.0
    dim, count = vectors.shape[1], wanted.shape[1]
    layers = [rng.normal(0, np.sqrt(2 / dim), (dim, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, count)), np.zeros(count)]
    router = Router(vectors.mean(0), spread, layers)
    inputs = (vectors - router.mean) / spread
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for epoch in range(EPOCHS):
        rate = 0.004 * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(len(inputs)), max(1, len(inputs) // 128)):
            x = inputs[rows]
            hidden = np.maximum(x @ layers[0] + layers[1], 0)
            out = hidden @ layers[2] + layers[3]
            p = np.exp(out - out.max(1, keepdims=True))
            slope = (p / p.sum(1, keepdims=True) - wanted[rows]) / len(rows)
            back = slope @ layers[2].T * (hidden > 0)
            step += 1
            for i, g in enumerate((x.T @ back, back.sum(0), hidden.T @ slope, slope.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                layers[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return router


def fit(vectors: DataFrame, dim: int, target: float = TARGET_RECALL, seed: int = 0) -> Router:
    """Learns partitions and a router from a sample of ``vectors`` (vec_id, embedding; usable ones)."""
    chosen = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
    sample = np.unique(matrix(chosen.column("embedding"), dim), axis=0) if chosen.num_rows else np.zeros((0, dim))
    sample = sample[np.random.default_rng(seed).permutation(len(sample))]
    count = 2 ** int(np.log2(max(1, min(PARTITIONS, len(sample) // PER_PARTITION))))
    if count == 1:
        return Router(np.zeros(dim), np.ones(dim), [np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])
    graph = neighbour_graph(vectors, sample)
    parts = balanced_partitions(sample, graph, count)
    shares = np.zeros((len(sample), count))
    np.add.at(shares, (np.repeat(np.arange(len(sample)), graph.shape[1]), parts[graph.ravel()]), 0.5 / graph.shape[1])
    shares[np.arange(len(sample)), parts] += 0.5
    # The last quarter is not learned from; its neighbours tell how many partitions a query needs.
    learned = len(sample) * 3 // 4
    router = train_router(sample[:learned], shares[:learned], seed)
    filed, ranked = router.ranked(sample)[:, 0], router.ranked(sample[learned:])
    at = (ranked[:, None, :] == filed[graph[learned:]][:, :, None]).argmax(2)
    recall = (at[:, :, None] < np.arange(1, count + 1)).mean((0, 1))
    router.probes = int(np.argmax(recall >= target)) + 1
    return router


def _filed(vectors: DataFrame, router: Router, dim: int, probes: int) -> DataFrame:
    """``vec_id, embedding, part``: a row for each of the vector's ``probes`` most probable partitions."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = router.ranked(matrix(batch.column("embedding"), dim))[:, :probes].astype(np.int32) if len(batch) else np.zeros((0, 1), np.int32)
            yield pa.record_batch([batch.column("vec_id"), batch.column("embedding"), pa.array(list(parts), pa.list_(pa.int32()))], ["vec_id", "embedding", "parts"])

    return vectors.mapInArrow(file, "vec_id long, embedding array<double>, parts array<int>").select("vec_id", "embedding", F.explode("parts").alias("part"))


def _counts(frame: DataFrame, rows: int) -> dict[int, int]:
    """Blocks of each partition: at most ``PARTITIONS`` rows reach the driver."""
    return {r["part"]: -(-r["count"] // rows) for r in frame.groupBy("part").count().collect()}


def _number(blocks: dict[int, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in (blocks or {-1: 1}).items() for x in pair]), F.col("part"))


def _search(vectors: DataFrame, queries: DataFrame, router: Router, dim: int, k: int, probes: int) -> DataFrame:
    """``query_id, vec_id, score``: the k nearest of each block."""
    filed = written(_filed(vectors, router, dim, 1), "filed")
    asked = written(_filed(queries, router, dim, probes), "asked")
    blocks, sheets = _counts(filed, BLOCK_ROWS), _counts(asked, QUERY_ROWS)
    sheets = {p: n for p, n in sheets.items() if p in blocks}
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = filed.where(F.col("part").isin(list(sheets))).withColumn("block", F.pmod(F.xxhash64("vec_id"), _number(blocks)).cast("int")).withColumn("sheet", every(_number(sheets)))
    right = asked.where(F.col("part").isin(list(sheets))).withColumn("sheet", F.pmod(F.xxhash64("vec_id"), _number(sheets)).cast("int")).withColumn("block", every(_number(blocks)))

    def compare(stored: pa.Table, asking: pa.Table) -> pa.Table:
        ids, names = stored.column("vec_id").to_numpy(), asking.column("vec_id").to_numpy()
        rows = []
        if len(ids) and len(names):
            points = matrix(stored.column("embedding"), dim)
            found = nearest(matrix(asking.column("embedding"), dim), points, k, own=(names, ids), ids=ids)
            rows = [(np.full(len(at), name), ids[at], far) for name, (at, far) in zip(names, found, strict=True)]
        columns = [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0) for i in range(3)]
        return pa.table([pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(np.float64))], ["query_id", "vec_id", "score"])

    keys = ["part", "block", "sheet"]
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, target: float = TARGET_RECALL, seed: int = 0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest vectors found for each query by Euclidean distance in double precision, ties to smaller ids.

    Both tables have ``vec_id, embedding``. Rows with a null id, and vectors that are null, zero, of another length than most or hold a null or non-finite component, take no part.
    A query's own id is no candidate; rows of one id are one vector if equal, and each of them counts if not. Queries that find fewer than k look into all partitions, so
    fewer are returned only if there are no more.
    """
    # Equal rows of one id would take the places of its neighbours in a block.
    vectors, queries = (frame.select("vec_id", "embedding").distinct() for frame in (vectors, queries))
    sizes = vectors.where(F.col("embedding").isNotNull()).groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = sizes["dim"] if sizes else 0
    take = lambda frame: frame.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"), dim)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors, queries = take(vectors), take(queries)
    router = fit(vectors, dim, target, seed)
    ranked = written(_ranked(_search(vectors, queries, router, dim, k, router.probes), k), "nearest")
    partitions = router.layers[-1].shape[0]
    if router.probes == partitions:
        return ranked
    full = ranked.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    short = written(queries.join(full, "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return ranked
    again = _ranked(_search(vectors, short, router, dim, k, partitions), k)
    return ranked.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").union(again)
