"""Mixing sources to target weights by Pareto order sampling. Only built-in functions are used.

A source's target asks for some number of copies of each document on average. The whole copies are certain. For the words that are
still wanted each document has inclusion odds in proportion to its size: p = rate * size, where documents with p of 1 or more are certain and the rate
makes the expected words those wanted. Documents are ranked by their random odds divided by their inclusion odds, (u / (1 - u)) / (p / (1 - p)), and the lowest
ranked are taken until the wanted words are reached: the sample's size is fixed in words, as targets are. The ranking is cut at one value for each source, found
by adding up words over fixed classes of the rank and then within the one class that holds the cut. So
no source is sorted as a whole, and texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import WORD, unused, written

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Equal classes of ranks; the class with a source's cut is sorted in one task.
CLASSES = 65536
#: Most sources whose plan is sent to all tasks, some 10 MB; with more, rows are shuffled by source.
BROADCAST_SOURCES = 100_000
#: The random number of a document is (k + 1/2) / 2**52, k from a digest of seed and doc_id.
DIGITS, RANGE = 13, 2**52


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_steps(seed: int, doc_id: Column) -> Column:
    """k of the document's random number, from 0 to 2**52 - 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: float = MAX_COPIES, share: float = 1.0) -> DataFrame:
    """``source, source_size, weight, target`` for each source of ``sizes`` (source, size).

    Sources by code point, null last, weigh ``weights``, repeating. Together they get ``share`` of all words in proportion to
    their weights; a target stops at ``max_copies`` times its source's size, and the excess goes to the others. The result is
    the level at which min(limit, level * weight) adds up: found by going through the sources
    in order of limit / weight. The windows hold one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = per.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ordered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("limit", F.col("source_size") * F.lit(float(max_copies)))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "n")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    since = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(since)
    # Sources whose limit lies below the level that would be left for them are capped; the first that is not sets the level.
    tried = weighed.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") > F.col("limit"))
    settled = tried.withColumn("settled", F.min(F.when(~F.col("capped"), F.struct((F.col("limit") / F.col("weight")).alias("at"), "n", "level"))).over(everything)["level"])
    target = F.when(F.col("capped"), F.col("limit")).otherwise(F.least(F.col("settled") * F.col("weight"), F.col("limit")))
    return settled.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, seed: int = 0, weights: tuple[float, ...] = WEIGHTS, max_copies: float = MAX_COPIES, share: float = 1.0, classes: int = CLASSES) -> DataFrame:
    """Adds ``size, source_size, target, copies, taken`` to ``docs``: words, words of its source, the source's target, copies taken, words taken.

    Every row is a document of its own; rows equal in doc_id and size are interchangeable. Null texts have size 0; a source without words has
    target 0. The taken words of a source differ from its target by half of the document at its cut at most. Equal seeds give equal results.
    """
    own = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies", "taken")]
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in own], word_count(F.col("text")).alias("size"), random_steps(seed, F.col("doc_id")).alias(step := unused(docs, "step"))
    )
    # Words are counted once for the plan, which needs no text, and once for the rows that carry it.
    sizes = written(keyed.select("source", "size", "doc_id", F.col(step).alias("step")), "sizes")
    plan = written(_cuts(sizes, weights, max_copies, share, classes), "mix")
    plan = plan.withColumnRenamed("source", key := unused(docs, "plan_source"))
    joined = keyed.join(F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan, F.col("source").eqNullSafe(F.col(key)), "left")
    extra = F.coalesce(_place(order_step(F.col(step), F.col("size"), F.col("rate"))) <= F.col("cut"), F.lit(False)).cast("int")
    copies = (F.coalesce("whole", F.lit(0)) + extra).cast("int")
    return joined.select(
        *[F.col(f"`{c}`") for c in own], "size", F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken")
    )


def _place(step: Column) -> Column:
    """Rank within a source; ties by doc_id, nulls first, then by size."""
    return F.struct(step.alias("step"), F.col("doc_id").alias("doc_id"), F.col("size").alias("size"))


def order_step(step: Column, size: Column, rate: Column) -> Column:
    """The rank q of a document as the whole number q / (1 + q) * 2**52: 0 if it is certain, 2**52 if it can't be taken."""
    p, u = rate * size, (step + F.lit(0.5)) / F.lit(float(RANGE))
    # No odds are computed for the certain and the impossible, which would divide by zero.
    within = F.when((p > 0) & (p < 1), p)
    q = (u / (F.lit(1.0) - u)) / (within / (F.lit(1.0) - within))
    return F.when(p >= 1, F.lit(0)).otherwise(F.coalesce(F.floor(q / (F.lit(1.0) + q) * F.lit(float(RANGE))), F.lit(RANGE))).cast("long")


def inclusion_rates(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``rate_source, rate`` of ``goals`` (goal_source, wanted): odds are rate * size, 1 at most, and add up to the wanted words.

    If the documents over some size are certain, the others share what is left in proportion to size: the rate is right for the largest size whose odds it
    doesn't bring over 1. Documents of equal size count together.
    """
    per = sizes.where(F.col("size") > 0).groupBy("source", "size").agg(F.count("*").alias("n"))
    per = per.withColumn("words", F.col("n") * F.col("size")).withColumn("squares", F.col("words").cast("decimal(38,0)") * F.col("size"))
    by_size = Window.partitionBy("source").orderBy(F.desc("size"))
    larger = by_size.rowsBetween(Window.unboundedPreceding, -1)
    certain = F.coalesce(F.sum("words").over(larger), F.lit(0))
    # What is left of the whole: a frame that reaches to the end would be added up anew for each row.
    others = (F.sum("squares").over(Window.partitionBy("source")) - F.coalesce(F.sum("squares").over(larger), F.lit(0))).cast("double")
    tried = per.withColumn("certain", certain).withColumn("others", others).join(goals.select("goal_source", "wanted"), F.col("source").eqNullSafe(F.col("goal_source")))
    tried = tried.withColumn("rate", (F.col("wanted") - F.col("certain")) / F.col("others")).where(F.col("rate") * F.col("size") <= 1)
    return tried.groupBy(F.col("source").alias("rate_source")).agg(F.max_by("rate", "size").alias("rate"))


def _cuts(keyed: DataFrame, weights: tuple[float, ...], max_copies: float, share: float, classes: int) -> DataFrame:
    """Per source: targets, certain whole copies, the rate of inclusion odds and the last place that gets one copy more."""
    goals = targets(keyed.groupBy("source").agg(F.sum("size").alias("size")), weights, max_copies, share)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = goals.withColumn("whole", F.floor(rate).cast("int")).withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
    goals = goals.withColumnRenamed("source", "goal_source")
    rates = inclusion_rates(keyed, goals)
    goals = written(goals.join(rates, F.col("goal_source").eqNullSafe(F.col("rate_source")), "left").drop("rate_source"), "mix-goals")
    known = goals.select(F.col("goal_source").alias("rate_source"), "rate")
    known = F.broadcast(known) if known.count() <= BROADCAST_SOURCES else known
    keyed = keyed.join(known, F.col("source").eqNullSafe(F.col("rate_source")), "left")
    keyed = keyed.select("source", "size", "doc_id", order_step(F.col("step"), F.col("size"), F.col("rate")).alias("step"))
    classed = keyed.withColumn("class", F.floor(F.col("step") / F.lit(RANGE // classes)).cast("int"))
    sums = classed.groupBy("source", "class").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    at = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0))).join(goals, F.col("source").eqNullSafe(F.col("goal_source")))
    at = at.where((F.col("words") > 0) & (F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("words")))
    at = at.select(F.col("source").alias("at_source"), F.col("class").alias("at_class"), "before", "wanted")
    near = classed.join(at, F.col("source").eqNullSafe(F.col("at_source")) & (F.col("class") == F.col("at_class")))
    in_class = Window.partitionBy("source").orderBy("step", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = near.withColumn("through", F.col("before") + F.sum("size").over(in_class))
    # A document is in if that brings the words nearer to what is wanted.
    inside = summed.where(F.col("through") - F.col("size") / 2 <= F.col("wanted"))
    last = inside.groupBy("source").agg(F.max(_place(F.col("step"))).alias("last"))
    ahead = at.groupBy("at_source").agg(F.max("at_class").alias("at_class"))
    ends = ahead.join(last, F.col("at_source").eqNullSafe(F.col("source")), "left")
    start = F.struct(
        (F.col("at_class").cast("long") * F.lit(RANGE // classes) - 1).alias("step"), F.lit(None).cast(keyed.schema["doc_id"].dataType).alias("doc_id"), F.lit(2**62).alias("size")
    )
    # Nothing of the class fits: the cut lies before it.
    ends = ends.select(F.col("at_source").alias("cut_source"), F.coalesce("last", start).alias("cut"))
    return goals.join(ends, F.col("goal_source").eqNullSafe(F.col("cut_source")), "left").select(F.col("goal_source").alias("source"), "source_size", "target", "whole", "rate", "cut")
