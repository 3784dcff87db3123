"""Near copies by word n-gram sets with built-in functions only: the same links and components as ``ngram_join``, for steps without Python.

Sets are arrays of hashes; documents of equal sets are one node. A gram that only one node has can't be shared, so it only takes a place in its node's
prefix; of the others a prefix holds the rarest, by exact counts. As in ``ngram_join``, nodes are compared with pivots of each of their
prefix grams first and with all nodes of other components under an open gram at last. From round to round pivots double in number, while fewer grams are
open: near copies that link with a share of their group only meet more of it the larger it is, about a root of its size, before the last round.
There, rows of a gram are dealt to pairs of blocks and joined inside them, and the join itself drops the pairs that sketches rule out: of a
crowded gram only pairs that may link become rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.ngram_join import passes
from quayside.llm.tables import BLANKS, lower_ascii, tidied, written

#: Rounds of comparison with pivots, at most, before all that is left is compared. Round i, from 0, has 2 ** i pivots for each gram of 4 ** i nodes or more.
PIVOT_ROUNDS = 6
#: Prefix grams that two nodes must share with one pivot to be compared with it (all that they can, if their sets have fewer).
SHARED = 4
#: Nodes of a block.
BLOCK = 512
#: Columns of a node's prefix gram.
ROW = ["gram", "node", "n_grams", "pos", "comp"]
#: Longs of a sketch: at 1,024 bits sets of 300 grams pass with a few more different grams than may be.
SKETCH = 16


def shingles(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, grams, low, high`` of the rows with words: sorted distinct hashes of the ``n``-word shingles, of the whole sequence if there are fewer words; 128 bits of hash of the set."""
    text = lower_ascii(F.coalesce("text", F.lit("")))
    hashed = docs.select("doc_id", F.transform(F.filter(F.split(text, f"{BLANKS}+"), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("words")).where(F.size("words") > 0)
    starts = F.greatest(F.size("words") - n + 1, F.lit(0))
    every = F.transform(F.arrays_zip(*(F.slice("words", i + 1, starts).alias(f"w{i}") for i in range(n))), lambda x: F.xxhash64(x))
    grams = hashed.select("doc_id", F.when(F.size("words") < n, F.array(F.xxhash64("words"))).otherwise(every).alias("grams"))
    sets = grams.select("doc_id", F.sort_array(F.array_distinct("grams")).alias("grams"))
    return sets.select("doc_id", "grams", F.xxhash64("grams").alias("low"), F.xxhash64(F.lit(1), "grams").alias("high"))


def _prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """``gram, node, n_grams, pos``: the prefix grams of each node that other nodes have, too; ``pos`` counts from the rarest gram."""
    every = nodes.select("node", F.size("grams").alias("n_grams"), F.explode("grams").alias("gram"))
    often = every.groupBy("gram").agg(F.count("*").alias("nodes")).where("nodes > 1")
    lists = every.join(often, "gram").groupBy("node").agg(F.first("n_grams").alias("n_grams"), F.sort_array(F.collect_list(F.struct("nodes", "gram"))).alias("grams"))
    # Grams of one node alone come first.
    alone = F.col("n_grams") - F.size("grams")
    length = _prefix(percent, SHARED)
    cut = lists.select("node", "n_grams", alone.alias("alone"), F.slice("grams", 1, F.greatest(length - alone, F.lit(0))).alias("grams"))
    rows = cut.select("node", "n_grams", "alone", F.posexplode("grams").alias("at", "of"))
    return written(rows.select("of.gram", "node", "n_grams", (F.col("alone") + F.col("at")).alias("pos")), "prefixes")


def _prefix(percent: int, shared: int) -> Column:
    """Length of a prefix of which similar sets share ``shared`` grams, or all that they can."""
    return F.col("n_grams") - F.ceil(F.col("n_grams") * percent / 100).cast("int") + shared


def _least(percent: int, n: Column, m: Column) -> Column:
    """Grams that two similar sets of n and m share, at least."""
    return F.ceil((n + m) * percent / (100 + percent))


def _verified(nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs whose whole sets are similar enough."""
    # Without the sets of other nodes, which need no shuffle.
    sets = nodes.select("node", "grams").join(pairs.select(F.explode(F.array("a", "b")).alias("node")), "node", "left_semi")
    both = pairs.join(sets.toDF("a", "grams_a"), "a").join(sets.toDF("b", "grams_b"), "b")
    shared = F.size(F.array_intersect("grams_a", "grams_b"))
    return both.where((100 + percent) * shared >= percent * (F.size("grams_a") + F.size("grams_b"))).select("a", "b")


def _open(active: DataFrame, turns: Iterable[int] = ()) -> DataFrame:
    """The grams whose nodes are in more than one component, their number of ``nodes``, and a ``pivot`` column with one of the nodes for each of ``turns``."""
    drawn = [F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("rank"), "node", "n_grams", "pos", "comp")).alias(f"p{turn}") for turn in turns]
    grams = active.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("nodes"), *drawn).where("low <> high")
    if not drawn:
        return grams.select("gram", "nodes")
    return grams.select("gram", "nodes", F.explode(F.array_distinct(F.array(*(F.col(f"p{turn}").dropFields("rank") for turn in turns)))).alias("pivot"))


def _met(nodes: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """``a, b, larger``: nodes and the pivots of their grams that are in other components, once for each gram."""
    pivots = pivots.select("gram", *[F.col(f"pivot.{c}").alias(d) for c, d in (("node", "other"), ("n_grams", "other_grams"), ("pos", "other_pos"), ("comp", "other_comp"))])
    met = nodes.join(pivots, "gram").where("comp <> other_comp").where(passes(percent))
    return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), F.greatest("n_grams", "other_grams").alias("larger"))


def _near_pivots(active: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of nodes and pivots, one for each gram, that share as many prefix grams as similar sets do."""
    met = _met(active, _open(active, [1]), percent)
    # Two pivots meet from both ends; that counts twice and at most verifies a pair in vain.
    return met.groupBy("a", "b", "larger").count().where(F.col("count") >= F.least(F.lit(SHARED), F.ceil(F.col("larger") * percent / 100))).select("a", "b")


def _near_more_pivots(crowded: DataFrame, turn: int, percent: int) -> DataFrame:
    """``a, b`` of nodes and the ``2 ** turn`` pivots of one of their grams; near copies share nearly all grams, so most take the same one, in each turn another."""
    drawn = F.min(F.struct(F.xxhash64(F.lit(turn), "gram").alias("rank"), "gram", "pos")).alias("drawn")
    chosen = crowded.groupBy("node", "n_grams", "comp").agg(drawn).select("drawn.gram", "node", "n_grams", "drawn.pos", "comp")
    return _met(chosen, _open(crowded, range(2**turn, 2 ** (turn + 1))), percent).select("a", "b").distinct()


def _sketches(nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """``node, size, s0, s1, ...`` of the ``chosen`` nodes: parity of the number of grams at each bit, so no fewer grams of two sets differ than bits do."""
    grams = nodes.join(chosen, "node", "left_semi").select("node", F.explode("grams").alias("gram"))
    bit, word = F.expr("shiftleft(1L, cast(pmod(gram, 64) as int))"), F.pmod(F.shiftright("gram", 6), F.lit(SKETCH))
    parities = (F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"s{i}") for i in range(SKETCH))
    return written(grams.groupBy("node").agg(F.count("*").cast("int").alias("size"), *parities), "sketches")


def _may_link(percent: int, n: str, m: str) -> Column:
    """The sketches s0, s1, ... and t0, t1, ... of sets of ``n`` and ``m`` grams don't rule out that they are similar."""
    differ = sum((F.bit_count(F.col(f"s{k}").bitwiseXOR(F.col(f"t{k}"))) for k in range(SKETCH)), F.lit(0))
    return differ <= F.col(n) + F.col(m) - 2 * _least(percent, F.col(n), F.col(m))


def _possible(sketches: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that sketches don't rule out: only their whole sets are looked at."""
    names = {"node": "b", "size": "size_b"} | {f"s{k}": f"t{k}" for k in range(SKETCH)}
    both = pairs.join(sketches.withColumnsRenamed({"node": "a", "size": "size_a"}), "a").join(sketches.withColumnsRenamed(names), "b")
    return both.where(_may_link(percent, "size_a", "size_b")).select("a", "b")


def _left(sketches: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of all nodes of different components under a gram that may be similar."""
    # Similar sets share a gram of their shortest prefixes.
    least = active.where(F.col("pos") < _prefix(percent, 1))
    left = written(least.join(_open(least), "gram"), "left")
    blocks = F.ceil(F.col("nodes") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    ends = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.struct(F.least(i, own).cast("int").alias("i"), F.greatest(i, own).cast("int").alias("j")))
    sketched = left.join(sketches.drop("size"), "node")
    dealt = sketched.select("*", own.alias("own"), F.explode(ends).alias("at")).select("gram", "at.i", "at.j", "own", "node", "n_grams", "pos", "comp", *(f"s{k}" for k in range(SKETCH)))
    dealt = written(dealt, "blocks")
    names = {"node": "other", "n_grams": "other_grams", "pos": "other_pos", "comp": "other_comp"} | {f"s{k}": f"t{k}" for k in range(SKETCH)}
    first = dealt.where("own = i").drop("own")
    second = dealt.where("own = j").select("gram", "i", "j", *(F.col(c).alias(d) for c, d in names.items()))
    pairs = first.join(second, ["gram", "i", "j"]).where("comp <> other_comp AND (i < j OR node < other)").where(passes(percent) & _may_link(percent, "n_grams", "other_grams"))
    return written(pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "near")


@tidied
def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, component_id`` of each row of ``docs`` with words; as :func:`ngram_join.join`, which see."""
    sets = written(shingles(docs, n), "sets")
    # A number of its own for each node, so that no two can be taken for one.
    nodes = written(sets.groupBy("low", "high").agg(F.min("doc_id").alias("least"), F.first("grams").alias("grams")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    prefixes = _prefixes(nodes, percent)
    active = prefixes.withColumn("comp", F.col("node"))
    found = tried = sketches = None
    for turn in range(PIVOT_ROUNDS + 1):
        crowded = active
        if turn:
            # A gram whose nodes are in one component is done.
            active = written(active.select(ROW).join(_open(active), "gram"), "active")
            crowded = active.where(F.col("nodes") >= 4**turn)
        last = turn == PIVOT_ROUNDS or crowded.isEmpty()
        if sketches is None and (turn or last):
            # Most nodes are done after the first round.
            sketches = _sketches(nodes, active.select("node").distinct())
        if last:
            pairs = _left(sketches, active.select(ROW), percent)
        elif turn:
            pairs = _possible(sketches, _near_more_pivots(crowded, turn, percent), percent)
        else:
            pairs = _near_pivots(active, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            fresh = written(_verified(nodes, pairs, percent), "verified")
            found, tried = (fresh, pairs) if found is None else (found.union(fresh), tried.union(pairs))
            if not last:
                active = active.drop("comp").join(components(found), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        if last:
            break
    placed = nodes.select("low", "high", "node", "least", F.col("node").alias("comp"))
    if found is not None:
        placed = placed.drop("comp").join(components(found), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # Written tables on both sides let Spark split the rows of one large component or set.
    placed = written(placed.select("low", "high", "least", "comp"), "placed")
    lowest = written(placed.groupBy("comp").agg(F.min("least").alias("component_id")), "lowest")
    named = written(placed.join(lowest, "comp").select("low", "high", "component_id"), "named")
    return sets.select("doc_id", "low", "high").join(named, ["low", "high"]).select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
