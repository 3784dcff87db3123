"""Similarity join of word n-gram sets: rare-first prefix filtering with length, positional and suffix filters.

Documents of equal sets are one node. If two sets have Jaccard similarity t or more, their prefixes - the first
|x| - ceil(t |x|) + l grams in one global order - share l grams, so only nodes that share as many prefix grams are compared. The usual
l is 1; a few more make prefixes hardly longer and leave far fewer pairs that share grams by chance.
The order is rare-first by hashed counts over all documents: a table of fixed size, whatever the corpus.

A gram that a group of k near copies shares would give k * k / 2 pairs. So in rounds every node is compared with one pivot
of each of its prefix grams only, the same one for all that share the gram; what links is joined into components, and grams
whose nodes are in one component are done. The last round compares the nodes of different components that are left
under a gram, all of them: as rows where a gram has few, else inside tasks, a block of nodes against a block, by sketches that
rule out nearly every pair that doesn't link and none that does. Each pair is verified once on the whole sets, so the components are exact.

Sets are made anew from the text wherever they are needed and only those of compared nodes are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quayside.llm.components import components
from quayside.llm.tables import bounded_batches, tidied, written
from quayside.llm.words import longs, mixed, shingle_sets, slices

#: Hashed counts of grams; a gram's place in the order is its bucket's count, in steps of an eighth of a power of 2.
BUCKETS = 2**18
#: Bits of the table that tells which nodes are compared; others' sets are not shuffled.
FLAGS = 2**20
#: Rounds of comparison with pivots before all that is left is compared.
PIVOT_ROUNDS = 3
#: Prefix grams that two nodes must share (all that they can, if their sets have fewer).
SHARED = 4
#: Nodes of a gram whose pairs are made as rows; with more, blocks of this many nodes are compared in tasks.
ROWS_BELOW, BLOCK = 24, 512
#: Bits of a sketch for each gram, at least, and of the smallest sketch. At two bits two sets of n grams pass with about 0.18 n different ones
#: where 0.16 n may be; more bits rule out hardly more pairs, and a sketch is sent once for each pair of blocks its node is in.
SKETCH_BITS, SKETCH_LEAST = 2, 512
#: Sets are split so many times by the suffix filter.
SUFFIX_DEPTH = 3


def _set_id(grams: np.ndarray, salt: int) -> int:
    """A number for the whole set: equal sets have equal numbers."""
    return int(longs(mixed(np.array([mixed(grams + np.uint64(salt)).sum(dtype=np.uint64) + np.uint64(len(grams))], np.uint64)))[0])


def _sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of bounded bytes of text, copied out of them."""
    for batch in batches:
        for start, stop in slices(batch.column("text")):
            yield batch.take(pa.array(range(start, stop), pa.int64()))


def _scanned(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """For each document its node, a check on it and its set's size; for each task the counts of gram buckets."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in _sliced(batches):
            sets = shingle_sets(batch.column("text"), n, seed)
            if sets:
                np.add.at(counts, (np.concatenate(sets) % np.uint64(BUCKETS)).astype(np.int64), 1)
            nothing = pa.nulls(len(sets), pa.int64())
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array([_set_id(s, salt) for s in sets], pa.int64()) for salt in (1, 2)), pa.array([len(s) for s in sets], pa.int64()), nothing, nothing],
                ["doc_id", "node", "check", "n_grams", "bucket", "count"],
            )
        found = np.flatnonzero(counts)
        nothing = pa.nulls(len(found), pa.int64())
        yield pa.record_batch(
            [pa.nulls(len(found), id_type), nothing, nothing, nothing, pa.array(found, pa.int64()), pa.array(counts[found])],
            ["doc_id", "node", "check", "n_grams", "bucket", "count"],
        )

    kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    schema = f"doc_id {kind.simpleString()}, node long, check long, n_grams long, bucket long, count long"
    return written(docs.select("doc_id", "text").mapInArrow(scan, schema), "scanned")


def _levels(scanned: DataFrame) -> np.ndarray:
    """Level of each bucket: BUCKETS small numbers at most reach the driver."""
    counted = scanned.where("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()
    counts = np.zeros(BUCKETS, np.float64)
    counts[counted.column("bucket").to_numpy()] = counted.column("count").to_numpy()
    return np.minimum(255, np.round(8 * np.log2(1 + counts))).astype(np.uint16)


def _prefixes(docs: DataFrame, n: int, seed: int, percent: int, levels: np.ndarray) -> DataFrame:
    """``node, n_grams, grams``: each node's prefix, rare grams first."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            rows = []
            for s in shingle_sets(batch.column("text"), n, seed):
                if len(s):
                    first = len(s) - -(-percent * len(s) // 100) + SHARED
                    order = np.lexsort((s, levels[(s % np.uint64(BUCKETS)).astype(np.int64)]))[:first]
                    rows.append((_set_id(s, 1), len(s), longs(s[order])))
            yield pa.record_batch(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["node", "n_grams", "grams"]
            )

    found = docs.select("text").mapInArrow(cut, "node long, n_grams long, grams array<long>")
    return written(found.groupBy("node").agg(F.min("n_grams").alias("n_grams"), F.first("grams").alias("grams")), "prefixes")


def _shared(prefixes: DataFrame) -> DataFrame:
    """``gram, node, n_grams, pos`` of prefix grams that at least two nodes have."""
    every = prefixes.select("node", "n_grams", F.posexplode("grams").alias("pos", "gram"))
    often = every.groupBy("gram").agg(F.count("*").alias("nodes")).where("nodes > 1").select("gram")
    return written(every.join(often, "gram"), "shared")


def passes(percent: int) -> Column:
    """Length and positional filters for a pair (node, n_grams, pos), (other, other_grams, other_pos) under a common gram."""
    n, m, i, j = (F.col(c) for c in ("n_grams", "other_grams", "pos", "other_pos"))
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def _flag(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FLAGS))


def _sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, seed: int, coded: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> DataFrame:
    """``node, grams`` of the nodes in ``pairs``, from one document of each; the grams as ``coded`` gives them, before they are shuffled.

    Most other documents are left out, before their words are looked at, by a table of flags.
    """
    compared = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = written(nodes.join(compared, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "compared")
    found = chosen.select(_flag("doc_id").alias("flag")).distinct().toArrow().column("flag").to_numpy()
    flags = np.zeros(FLAGS, np.bool_)
    flags[found] = True
    packed = np.packbits(flags)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed).astype(np.bool_)
        for batch in batches:
            batch = batch.filter(pa.array(wanted[batch.column("flag").to_numpy()]))
            for part in _sliced([batch]):
                sets = [s for s in shingle_sets(part.column("text"), n, seed) if len(s)]
                yield pa.record_batch([pa.array([_set_id(s, 1) for s in sets], pa.int64()), pa.array([coded(s) for s in sets], pa.binary())], ["node", "grams"])

    picked = docs.select("text", _flag("doc_id").alias("flag")).mapInArrow(pick, "node long, grams binary")
    return picked.join(chosen.select("node"), "node", "left_semi").groupBy("node").agg(F.first("grams").alias("grams"))


def _may_overlap(a: np.ndarray, b: np.ndarray, least: int, depth: int) -> bool:
    """Suffix filter: False only if fewer than ``least`` numbers are in both. Split at a's middle, each part bounds the overlap."""
    return _most(a, b, depth) >= least


def _most(a: np.ndarray, b: np.ndarray, depth: int) -> int:
    if not depth or len(a) < 8 or len(b) < 8:
        return min(len(a), len(b))
    middle = len(a) // 2
    at = int(np.searchsorted(b, a[middle]))
    return _most(a[:middle], b[:at], depth - 1) + _most(a[middle:], b[at:], depth - 1)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, seed: int, percent: int) -> DataFrame:
    """``a, b, overlap`` of the pairs whose whole sets are similar enough."""
    sets = written(_sets(docs, nodes, pairs, n, seed), "sets")
    left, right = sets.toDF("a", "grams_a"), sets.toDF("b", "grams_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, overlaps = [], []
            for row, (x, y) in enumerate(zip(batch.column("grams_a"), batch.column("grams_b"), strict=True)):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                least = -(-percent * (len(a) + len(b)) // (100 + percent))
                if _may_overlap(a, b, least, SUFFIX_DEPTH):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if both >= least:
                        kept.append(row)
                        overlaps.append(both)
            ids = batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))
            yield pa.record_batch([ids.column("a"), ids.column("b"), pa.array(overlaps, pa.int64())], ["a", "b", "overlap"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(verify, "a long, b long, overlap long")


@tidied
def links(docs: DataFrame, n: int = 5, percent: int = 80, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Nodes and enough of their links to give the exact components of all links.

    The first frame has a row ``doc_id, node, n_grams`` for each row of ``docs``, node null without words; the second ``a, b, overlap`` of verified links.
    """
    bounded_batches(docs.sparkSession)
    scanned = _scanned(docs, n, seed)
    # Should two different sets ever get the same number, the numbers are drawn anew.
    if not scanned.where("n_grams > 0").groupBy("node").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").isEmpty():
        return links(docs, n, percent, seed + 1)
    nodes = scanned.where("bucket is null").select("doc_id", F.when(F.col("n_grams") > 0, F.col("node")).alias("node"), "n_grams")
    shared = _shared(_prefixes(docs, n, seed, percent, _levels(scanned)))
    ordered = F.struct(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    found: DataFrame | None = None
    tried: DataFrame | None = None
    active = shared.withColumn("comp", F.col("node"))
    for turn in range(PIVOT_ROUNDS + 1):
        open_ = active.groupBy("gram").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("nodes"), F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("rank"), "node", "n_grams", "pos", "comp")).alias("pivot")
        )
        open_ = open_.where("low <> high")
        if turn < PIVOT_ROUNDS:
            pivots = open_.select("gram", *[F.col(f"pivot.{c}").alias(d) for c, d in (("node", "other"), ("n_grams", "other_grams"), ("pos", "other_pos"), ("comp", "other_comp"))])
            met = active.join(pivots, "gram").where("comp <> other_comp")
        else:
            left = written(active.join(open_.select("gram", "nodes"), "gram"), "left")
            few = left.where(F.col("nodes") < ROWS_BELOW)
            met = few.join(few.select("gram", *[F.col(c).alias(f"other{d}") for c, d in (("node", ""), ("n_grams", "_grams"), ("pos", "_pos"), ("comp", "_comp"))]), "gram").where("comp < other_comp")
        pairs = met.where(passes(percent)).groupBy(ordered.alias("pair"), F.greatest("n_grams", "other_grams").alias("larger")).count()
        # The first l grams that two similar sets share are in both prefixes; a larger set of k grams shares t k at least.
        # A pair with fewer as rows in the last round shares one of the grams that are compared in blocks, or isn't similar.
        pairs = pairs.where(F.col("count") >= F.least(F.lit(SHARED), F.ceil(F.col("larger") * F.lit(percent) / 100))).select("pair.*")
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            fresh = written(_verified(docs, nodes, pairs, n, seed, percent), "verified")
            found = fresh if found is None else found.union(fresh)
            tried = pairs if tried is None else tried.union(pairs)
            if turn < PIVOT_ROUNDS:
                comps = components(found)
                active = written(shared.join(comps, "node", "left").select("gram", "node", "n_grams", "pos", F.coalesce("comp", "node").alias("comp")), "active")
    crowded = written(_crowded_pairs(docs, nodes, left.where(F.col("nodes") >= ROWS_BELOW), n, seed, percent), "crowded")
    if tried is not None:
        crowded = crowded.join(tried, ["a", "b"], "left_anti")
    many = written(_verified(docs, nodes, crowded, n, seed, percent), "verified")
    return nodes, many if found is None else found.union(many)


def odd_sketch(grams: np.ndarray, per_gram: int = 8, least: int = 2048) -> bytes:
    """Parity of the number of grams at each of at least ``per_gram`` bits for each gram, ``least`` at least; a power of 2.

    Every gram that only one of two sets has changes one bit, so no fewer grams differ than bits do.
    """
    bits = 1 << max(least - 1, per_gram * len(grams) - 1).bit_length()
    places, counts = np.unique((grams % np.uint64(bits)).astype(np.int64), return_counts=True)
    odd = np.zeros(bits, np.bool_)
    odd[places] = counts % 2 == 1
    return np.packbits(odd).tobytes()


def _sketches(docs: DataFrame, nodes: DataFrame, chosen: DataFrame, n: int, seed: int) -> DataFrame:
    """``node, sketch`` of the nodes in ``chosen``; sketches are drawn where the texts are read, so no sets are shuffled."""
    pairs = chosen.select(F.col("node").alias("a"), F.col("node").alias("b"))
    return _sets(docs, nodes, pairs, n, seed, lambda grams: odd_sketch(grams, SKETCH_BITS, SKETCH_LEAST)).withColumnRenamed("grams", "sketch")


def _crowded_pairs(docs: DataFrame, nodes: DataFrame, crowded: DataFrame, n: int, seed: int, percent: int) -> DataFrame:
    """``a, b``: pairs of different components under grams with many nodes that may be similar.

    A task gets two blocks of a gram's nodes with their sketches. It looks at two nodes only if the gram is the first of the crowded
    ones that both have, so each pair is looked at once, and returns those whose sketches don't rule out that they link.
    """
    lists = crowded.groupBy("node").agg(F.sort_array(F.collect_set("gram")).alias("crowd"), F.min("comp").alias("comp"), F.min("n_grams").alias("size"))
    lists = written(lists.join(_sketches(docs, nodes, lists, n, seed), "node"), "sketches")
    blocks = F.ceil(F.col("nodes") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    ends = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.struct(F.least(i, own).cast("int").alias("i"), F.greatest(i, own).cast("int").alias("j")))
    dealt = crowded.select("gram", "node", own.alias("own"), F.explode(ends).alias("at"))
    dealt = dealt.join(lists, "node").select("gram", "at.i", "at.j", "own", "node", "comp", "size", F.filter("crowd", lambda g: g < F.col("gram")).alias("before"), "sketch")

    def compare(group: pa.Table) -> pa.Table:
        i, j = (group.column(c)[0].as_py() for c in ("i", "j"))
        own, ids, comps, sizes = (group.column(c).to_numpy() for c in ("own", "node", "comp", "size"))
        before = _incidence([c.values.to_numpy() for c in group.column("before").combine_chunks()])
        raw = [np.frombuffer(v.as_buffer(), np.uint8) for v in group.column("sketch").combine_chunks()]
        widths, folded = _folded(raw)
        left, right = [], []
        for x in np.flatnonzero(own == i):
            least = -(-percent * (sizes + sizes[x]) // (100 + percent))
            hits = (own == j) & (comps != comps[x]) & (least <= np.minimum(sizes, sizes[x])) & ~(before & before[x]).any(axis=1)
            if i == j:
                hits[: x + 1] = False
            others = np.flatnonzero(hits)
            shorter = np.minimum(widths[others], widths[x])
            differ = np.zeros(len(others), np.int64)
            for width in np.unique(shorter):
                same, (place, bits) = shorter == width, folded[width]
                differ[same] = np.bitwise_count(bits[place[others[same]]] ^ bits[place[x]]).sum(axis=1, dtype=np.int64)
            others = others[differ <= sizes[others] + sizes[x] - 2 * least[others]]
            left.append(np.minimum(ids[others], ids[x]))
            right.append(np.maximum(ids[others], ids[x]))
        return pa.table([pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for v in (left, right)], ["a", "b"])

    return dealt.groupBy("gram", "i", "j").applyInArrow(compare, "a long, b long")


def _folded(raw: list[np.ndarray]) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Widths of sketches; for each width the place and bits of all that are as wide or wider, folded to it.

    In a folded sketch each differing gram still changes one bit.
    """
    widths = np.array([len(r) for r in raw], np.int64)
    folded = {}
    for width in np.unique(widths):
        rows = np.flatnonzero(widths >= width)
        place = np.zeros(len(raw), np.int64)
        place[rows] = np.arange(len(rows))
        folded[width] = place, np.stack([np.bitwise_xor.reduce(raw[row].reshape(-1, width), axis=0) for row in rows])
    return widths, folded


def _incidence(lists: list[np.ndarray]) -> np.ndarray:
    """A row of flags for each list: which of all their numbers it has."""
    known = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int64)
    flags = np.zeros((len(lists), len(known)), np.bool_)
    for row, own in enumerate(lists):
        flags[row, np.searchsorted(known, own)] = True
    return flags


@tidied
def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_grams, component_id`` for each row of ``docs``.

    Words are runs of anything but space and U+0009 to U+000D, A-Z lower-cased; a set has the distinct n-grams, or the
    whole sequence if there are fewer words. Two documents link when 100 * intersection >= percent * union.
    ``component_id`` is the smallest doc_id that links reach. Null and empty texts have no grams and link with nothing: their own doc_id. Null doc_ids
    count as larger than others. Other columns are not carried.
    """
    nodes, found = links(docs.select("doc_id", "text"), n, percent)
    comps = components(found)
    placed = nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n_grams").alias("n_grams"))
    placed = placed.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # Written tables on both sides let Spark split the rows of one large component or set.
    placed = written(placed, "placed")
    lowest = written(placed.groupBy("comp").agg(F.min("least").alias("component_id")), "lowest")
    named = written(placed.join(lowest, "comp").select("node", "component_id"), "named")
    return nodes.join(named, "node", "left").select("doc_id", F.coalesce("n_grams", F.lit(0)).alias("n_grams"), F.coalesce("component_id", "doc_id").alias("component_id"))


@tidied
def first_of_groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component, with all columns. Rows with a null id stay; rows of one id go together."""
    joined = join(docs, n, percent)
    gone = joined.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(written(gone, "gone"), "doc_id", "left_anti").select(docs.columns)
