"""Exact top-k search by integer inner product: a three-phase uniform threshold over lists of partial scores.

The components of a vector are cut into ``LISTS`` groups; for a query each group is a list of partial scores, and a score is the sum over the lists.
Vectors lie in blocks and every block sees all sheets of queries.

1. Each block gathers the best partial scores of each list, completes these few candidates and sends their best scores. The k-th of them over all
   blocks is a safe cutoff: k vectors reach it.
2. The cutoff goes back to all blocks. A vector can only reach it if one of its partial scores is the cutoff divided by the number of lists or more, the
   uniform threshold. Blocks collect these entries; what an entry hasn't sent is below the threshold, which bounds its score from above.
3. Entries whose bound reaches the cutoff are resolved exactly on the integer vectors, and those that reach it are ranked.

After the second phase only about k entries for each query leave the blocks altogether.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import unused, written

LISTS = 4
#: Vectors of a block, queries of a sheet, and queries whose scores a task holds at once.
BLOCK_ROWS, SHEET_ROWS, AT_ONCE = 4096, 8192, 128
#: Sums of products up to here are exact in double precision.
EXACT = 2**53


def scaled(vector: Column, factor: int = 256) -> Column:
    """Each component times ``factor``, rounded down; the product is taken in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("double"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _exact(vectors: np.ndarray, query: np.ndarray) -> list[int]:
    """Integer inner products of rows with a query, whatever their size."""
    if len(vectors) == 0:
        return []
    most = np.abs(vectors).max(initial=0) * np.abs(query).max(initial=0) * max(1, len(query))
    if most < EXACT:
        return [int(s) for s in vectors @ query]
    wide = [int(x) for x in query]
    return [sum(int(x) * y for x, y in zip(row, wide, strict=True)) for row in vectors]


class Lists:
    """The lists of partial scores of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.cuts = np.unique(np.linspace(0, vectors.shape[1], LISTS + 1).astype(int))
        self.lists = max(1, len(self.cuts) - 1)

    def partial(self, queries: np.ndarray) -> np.ndarray:
        """List, query, vector. Doubles, so beyond ``EXACT`` they are off by less than :meth:`slack`."""
        pairs = list(zip(self.cuts[:-1], self.cuts[1:], strict=True)) or [(0, 0)]
        return np.stack([queries[:, a:b] @ self.vectors[:, a:b].T for a, b in pairs])

    def slack(self, queries: np.ndarray) -> np.ndarray:
        """For each query, more than rounding can take from a score; 0 where all sums are exact."""
        most = np.abs(queries).max(axis=1, initial=0) * np.abs(self.vectors).max(initial=0) * max(1, self.vectors.shape[1])
        return np.where(most < EXACT, 0.0, most * 1e-9)

    def resolved(self, rows: np.ndarray, query_id: int, query: np.ndarray) -> list[tuple[int, int]]:
        """Best ``k`` of ``rows`` by exact score, then smaller id; an id has its best row, the query's own id has none."""
        best: dict[int, int] = {}
        rows = rows[self.ids[rows] != query_id]
        for vec_id, score in zip(self.ids[rows].tolist(), _exact(self.vectors[rows], query), strict=True):
            best[vec_id] = max(score, best.get(vec_id, score))
        return sorted(best.items(), key=lambda found: (-found[1], found[0]))[: self.k]

    def gathered(self, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Phase 1: for each query the best exact scores among the heads of the lists."""
        partial = self.partial(queries)
        most = min(self.k + 1, len(self.ids))
        heads = np.argpartition(-partial, most - 1, axis=2)[:, :, :most]
        for q, query_id in enumerate(query_ids.tolist()):
            yield q, self.resolved(np.unique(heads[:, q]), query_id, queries[q])

    def collected(self, query_ids: np.ndarray, queries: np.ndarray, cutoffs: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Phases 2 and 3: entries at the uniform threshold whose bound reaches the cutoff, resolved."""
        partial = self.partial(queries)
        threshold = (cutoffs - self.slack(queries)) / self.lists
        sent = partial >= threshold[None, :, None]
        bound = np.where(sent, partial, threshold[None, :, None]).sum(axis=0)
        # Bounds are sums of rounded thirds and quarters: one unit is more than they can be off while scores are exact.
        reach = sent.any(axis=0) & (bound >= (cutoffs - self.slack(queries) - 1)[:, None])
        for q, query_id in enumerate(query_ids.tolist()):
            found = self.resolved(np.flatnonzero(reach[q]), query_id, queries[q])
            yield q, [(vec_id, score) for vec_id, score in found if score >= cutoffs[q]]


def _blocked(vectors: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Vectors once for each sheet and queries once for each block, with the columns that bring them together."""
    n_blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    n_sheets = max(1, -(-queries.count() // SHEET_ROWS))
    place = lambda frame, n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    width = F.size("vector").alias("width")
    left = vectors.select("vec_id", "vector", width, place(vectors, n_blocks).alias("block"), every(n_sheets).alias("sheet"))
    right = queries.select("*", width, place(queries, n_sheets).alias("sheet"), every(n_blocks).alias("block"))
    return left, right, ["width", "block", "sheet"]


def _lowered(cutoffs: np.ndarray) -> np.ndarray:
    """Null cutoffs, of queries for which fewer than k vectors are known, let all in; those beyond ``EXACT`` may have been rounded up."""
    cutoffs = np.where(np.isnan(cutoffs), -np.inf, cutoffs)
    return np.where(np.abs(cutoffs) < EXACT, cutoffs, cutoffs - np.abs(cutoffs, where=np.isfinite(cutoffs), out=np.zeros_like(cutoffs)) * 1e-15)


FOUND = "query long, vec_id long, score decimal(38,0)"


def _scan(k: int):
    """Cogroup function: a block of vectors against a sheet of queries; queries with a cutoff are in their second phase."""

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            lists = Lists(left.column("vec_id").to_numpy(), _matrix(left.column("vector").combine_chunks()), k)
            ids, queries = right.column("vec_id").to_numpy(), _matrix(right.column("vector").combine_chunks())
            names = right.column("query").to_numpy()
            cutoffs = _lowered(right.column("cutoff").to_numpy(zero_copy_only=False).astype(float)) if "cutoff" in right.schema.names else None
            step = max(1, AT_ONCE * BLOCK_ROWS // max(BLOCK_ROWS, len(lists.ids)))
            for start in range(0, len(ids), step):
                some = slice(start, start + step)
                rows = lists.gathered(ids[some], queries[some]) if cutoffs is None else lists.collected(ids[some], queries[some], cutoffs[some])
                out.extend((int(names[start + q]), vec_id, score) for q, found in rows for vec_id, score in found)
        columns = list(zip(*out, strict=True)) or [[], [], []]
        types = (pa.int64(), pa.int64(), pa.decimal128(38, 0))
        columns[2] = [Decimal(score) for score in columns[2]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query", "vec_id", "score"])

    return scan


def search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` (vec_id, vector) the ``k`` rows of ``vectors`` (vec_id, vector) with the largest inner product.

    Components are integers held as doubles; scores are exact integers. Ties go to the smaller vec_id, ranks start at 1; all candidates are returned if there are fewer. Rows without
    a vec_id or a usable vector take no part. A query's candidates have another vec_id and as many components as it has. Equal rows of one id are one; of several vectors
    of one id the best score counts, and of several query vectors of one id the best of each candidate. A score beyond a long raises an error.
    """
    plain = lambda frame: frame.select("vec_id", "vector").where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()
    vectors = written(plain(vectors), "topk-vectors")
    queries = written(plain(queries).withColumn("query", F.monotonically_increasing_id()), "topk-queries")
    left, right, keys = _blocked(vectors, queries)
    scan = lambda sheet: left.groupBy(*keys).cogroup(sheet.groupBy(*keys)).applyInArrow(_scan(k), FOUND)
    heads = scan(right).groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    cutoffs = heads.withColumn("place", place).where(F.col("place") == k).select("query", F.col("score").cast("double").alias("cutoff"))
    cutoffs = written(cutoffs, "topk-cutoffs")
    found = scan(_blocked(vectors, queries.join(cutoffs, "query", "left"))[1])
    named = found.join(queries.select("query", F.col("vec_id").alias("query_id")), "query")
    best = named.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def with_neighbours(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``queries`` with ``neighbours``: its k best as an array of structs (vec_id, score), best first; [] without any. A column of that name is replaced."""
    own = [c for c in queries.columns if c.lower() != "neighbours"]
    listed = search(vectors, queries, k).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    key = unused(queries, "query_id")
    listed = listed.select(F.col("query_id").alias(key), F.transform("found", lambda f: F.struct(f["vec_id"].alias("vec_id"), f["score"].alias("score"))).alias("neighbours"))
    joined = queries.select(*own).join(listed, queries["vec_id"] == listed[key], "left")
    return joined.select(*own, F.coalesce("neighbours", F.array().cast("array<struct<vec_id:bigint,score:bigint>>")).alias("neighbours"))
