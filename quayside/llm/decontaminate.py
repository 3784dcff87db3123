"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A document's sketch is a one-permutation MinHash: the range of hashes is cut into bins and each bin keeps its smallest hash. Documents
are partitioned by size into powers of two, and a partition has ``BINS_PER_SHINGLE`` bins for each shingle its documents can
have, so a short passage leaves as many of its shingles in the sketch of a long document as in that of a short one: each
survives with a chance of 0.79 or more. A document is a candidate for an item if its sketch has any of the item's shingles; an item with
``WHOLE_BELOW`` shingles or more of which 80 % are in a document is missed with a chance under 0.22 ** 7. Shorter items are compared with all shingles instead.
Candidates are verified by counting the item's shingles in the whole document.

Texts are not shuffled: the index of items goes to the tasks, in blocks of bounded size and one pass over the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quayside.llm.tables import unused, written
from quayside.llm.words import longs, shingle_sets, sliced

BINS_PER_SHINGLE = 2
WHOLE_BELOW = 8
#: Most item shingles in one block of the index: 24 MB.
INDEX_SHINGLES = 1_500_000


def item_sets(items: DataFrame, n: int) -> DataFrame:
    """``item_id, grams`` of the items that have words; rows of one id and text are one item."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, ids in sliced(batch.column("text"), batch.column("item_id")):
                yield pa.record_batch([ids, pa.array([longs(s) for s in shingle_sets(text, n)], pa.list_(pa.int64()))], ["item_id", "grams"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(scan, f"item_id {kind}, grams array<long>").where(F.size("grams") > 0).distinct()


def sketch(grams: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin; ``grams`` are sorted and distinct."""
    bits = max(1, int(len(grams) * BINS_PER_SHINGLE - 1).bit_length())
    bins = grams >> np.uint64(64 - bits)
    return grams[np.flatnonzero(np.diff(bins, prepend=bins[:1] + np.uint64(1)))] if len(grams) else grams


class Index:
    """Items by shingle: sorted shingles with item numbers, those of short items apart."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.long_ = self._sorted([i for i, s in enumerate(sets) if len(s) >= WHOLE_BELOW])
        self.short = self._sorted([i for i, s in enumerate(sets) if len(s) < WHOLE_BELOW])

    def _sorted(self, chosen: list[int]) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([self.sets[i] for i in chosen]) if chosen else np.zeros(0, np.uint64)
        owners = np.repeat(np.array(chosen, np.int64), [len(self.sets[i]) for i in chosen])
        order = np.argsort(grams, kind="stable")
        return grams[order], owners[order]

    def candidates(self, grams: np.ndarray) -> set[int]:
        found: set[int] = set()
        for (keys, owners), probes in ((self.long_, sketch(grams)), (self.short, grams)):
            if len(keys) and len(probes):
                low = np.searchsorted(keys, probes)
                hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == probes)
                for start, stop in zip(low[hit], np.searchsorted(keys, probes[hit], side="right"), strict=True):
                    found.update(owners[start:stop].tolist())
        return found

    def contained(self, grams: np.ndarray) -> list[tuple[int, int, int]]:
        """Number, shingles found and shingles of each item that is contained in a document."""
        rows = []
        for item in sorted(self.candidates(grams)):
            own = self.sets[item]
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            shared = int((grams[at] == own).sum())
            if 100 * shared >= self.percent * len(own):
                rows.append((item, shared, len(own)))
        return rows


def _searcher(rows: list[dict], id_type, n: int, percent: int):
    """Arrow UDF: the items of this block that each text contains."""
    ids = pa.array([r["item_id"] for r in rows], to_arrow_type(id_type))
    index = Index([np.sort(np.array(r["grams"], np.int64).view(np.uint64)) for r in rows], percent)

    @F.arrow_udf(f"array<struct<item_id:{id_type.simpleString()},shared:int,n_shingles:int>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [index.contained(s) for (part,) in sliced(texts) for s in shingle_sets(part, n)]
            flat = [r for rows in found for r in rows]
            fields = [ids.take(pa.array([r[0] for r in flat], pa.int64())), *(pa.array([r[k] for r in flat], pa.int32()) for k in (1, 2))]
            offsets = np.cumsum([0, *(len(rows) for rows in found)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["item_id", "shared", "n_shingles"]))

    return search


def contained_items(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80, block: int = INDEX_SHINGLES) -> Column | None:
    """Column of the items that ``docs.text`` contains, or None if there is no item."""
    sets = written(item_sets(items, n), "items")
    total = sets.agg(F.sum(F.size("grams"))).first()[0] or 0
    blocks = -(-total // block)
    id_type = sets.schema["item_id"].dataType
    parts = []
    for k in range(blocks):
        rows = sets.where(F.pmod(F.xxhash64("grams"), F.lit(blocks)) == k).toArrow().to_pylist()
        if rows:
            parts.append(_searcher(rows, id_type, n, percent)(F.col("text")))
    return F.concat(*parts) if parts else None


def find(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80, **how) -> DataFrame:
    """``doc_id, item_id, shared, n_shingles``, a row for each document (doc_id, text) and item (item_id, text) whose distinct
    n-word shingles are found in the document to ``percent`` or more.

    Words are lower-cased (A-Z). An item of fewer than n words is one shingle and found only in a document that consists of it; an item or
    text that is null, empty or blank has no shingles and is never found. Equal rows of ``items`` count once, rows of one id with
    different texts are different items; each row of ``docs`` counts.
    """
    column = contained_items(docs, items, n, percent, **how)
    if column is None:
        column = F.array().cast(f"array<struct<item_id:{items.schema['item_id'].dataType.simpleString()},shared:int,n_shingles:int>>")
    return docs.select("doc_id", F.explode(column).alias("found")).select("doc_id", "found.*")


def clean(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80, **how) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    column = contained_items(docs, items, n, percent, **how)
    if column is None:
        return docs
    found = unused(docs, "found")
    return docs.withColumn(found, column).where(F.size(found) == 0).drop(found)
