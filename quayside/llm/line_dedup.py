"""Line deduplication by ranges of hashes; the result is a keep bitmap for each document, not text.

Lines become (hash, document, position) rows. They are partitioned by ranges of the hash and sorted by
document and position, so that occurrences stream by in order. A hash that a third of all documents share
is cut into slices by document first; what a slice found is one row, and slices are added up afterwards.
Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import near_copies
from quayside.llm.tables import WORD, lower_ascii, text_key, tidied, written

STRIPPED = " \t\n\x0b\x0c\r"
#: Slices that the occurrences of one hash are dealt to, by document.
SLICES = 64
#: A document that loses so many percent of its words to first places elsewhere goes; one that loses as many as the second number goes if it is a near copy.
LOST, SUSPECT = 80, 20


def lines_of(text: Column) -> Column:
    r"""Lines between ``\n``; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """Stripped of white space at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(STRIPPED)))


def occurrences(docs: DataFrame, min_chars: int = 1, counted: bool = False) -> DataFrame:
    """One row for each line whose key has ``min_chars`` code points: 128 bits of hash, document and position; ``counted`` adds the line's words."""
    exploded = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_hash"), F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("pos", "key")
    ).where(F.char_length("key") >= min_chars)
    slice_ = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SLICES)).cast("int")
    words = [F.regexp_count("key", F.lit(WORD)).alias("words")] if counted else []
    return exploded.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), slice_.alias("slice"), "doc_id", "text_hash", "pos", *words)


@tidied
def _repeating(lines: DataFrame, min_docs: int, long: tuple[int, int] | None = None) -> DataFrame:
    """``h1, h2, slice, first`` of the lines that stand in ``min_docs`` documents or more; with ``long`` = (words, documents) those of as many words in as many documents, too."""
    place = F.struct("doc_id", "text_hash", "pos")
    # The ranges serve window and aggregate without another shuffle.
    in_order = Window.partitionBy("h1", "h2", "slice").orderBy("doc_id", "text_hash")
    streamed = lines.repartitionByRange("h1", "h2", "slice").withColumn("nth_doc", F.dense_rank().over(in_order))
    words = [F.max("words").alias("words")] if long else []
    sliced = written(streamed.groupBy("h1", "h2", "slice").agg(F.max("nth_doc").alias("n_docs"), F.min(place).alias("first"), *words), "slices")
    many = F.col("n_docs") >= min_docs
    if long:
        many |= (F.col("words") >= long[0]) & (F.col("n_docs") >= long[1])
    found = sliced.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.min("first").alias("first"), *words).where(many)
    # Back to the slices first, so that no task gets all lines of a hash.
    return written(sliced.select("h1", "h2", "slice").join(found.select("h1", "h2", "first"), ["h1", "h2"]), "repeating")


@tidied
def keep_bitmaps(docs: DataFrame, min_docs: int = 2, min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """``doc_id, text_hash, n_lines, n_dropped, keep_runs`` of every document.

    A line whose key is found in ``min_docs`` documents or more is dropped everywhere, but with ``keep_first`` stays at
    its first place (smallest doc_id, then position; a null doc_id is first). ``keep_runs`` is a run-length coded bitmap: start and length
    of each run of kept lines. Rows of equal doc_id and text are one document and share a bitmap; rows of one
    doc_id with different texts are different documents. Shorter keys, so also empty lines, always stay.
    """
    lines = written(occurrences(docs, min_chars), "lines")
    repeated = lines.join(_repeating(lines, min_docs), ["h1", "h2", "slice"])
    if keep_first:
        repeated = repeated.where(~F.struct("doc_id", "text_hash", "pos").eqNullSafe(F.col("first")))
    return _bitmaps(docs, repeated)


def _bitmaps(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Bitmaps of all documents without the places in ``repeated``."""
    dropped = repeated.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone")).withColumnRenamed("doc_id", "gone_id").withColumnRenamed("text_hash", "gone_hash")
    every = docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), F.size(lines_of(F.col("text"))).alias("n_lines")).distinct()
    joined = every.join(dropped, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left")
    return joined.select("doc_id", "text_hash", *_counts(F.col("n_lines"), F.coalesce("gone", F.array().cast("array<int>"))))


def _counts(n_lines: Column, gone: Column) -> list[Column]:
    """Counts and runs of kept lines between dropped ones."""
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda p: p + 1))
    between = F.arrays_zip(starts.alias("start"), F.concat(gone, F.array(n_lines)).alias("stop"))
    runs = F.transform(F.filter(between, lambda r: r["stop"] > r["start"]), lambda r: F.struct(r["start"].alias("start"), (r["stop"] - r["start"]).alias("length")))
    return [n_lines.cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"), runs.alias("keep_runs")]


def kept_text(text: Column, keep_runs: Column) -> Column:
    r"""The kept lines, joined by ``\n``; ``keep_runs`` is best a column of a table, as it is looked up for each run."""
    gap = lambda r, i: r["start"] - F.when(i > 0, F.get(keep_runs, i - 1)["start"] + F.get(keep_runs, i - 1)["length"]).otherwise(F.lit(0))
    flags = F.flatten(F.transform(keep_runs, lambda r, i: F.concat(F.array_repeat(F.lit(False), gap(r, i)), F.array_repeat(F.lit(True), r["length"]))))
    pairs = F.arrays_zip(lines_of(text).alias("line"), flags.alias("keep"))
    return F.array_join(F.transform(F.filter(pairs, lambda p: F.coalesce(p["keep"], F.lit(False))), lambda p: p["line"]), "\n")


def deduplicate(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with ``text`` reduced to its kept lines and ``n_lines``, ``n_dropped``, ``keep_runs`` added; null texts become empty."""
    return _reduced(docs, keep_bitmaps(docs.select("doc_id", "text"), **how))


def _reduced(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    bitmaps = bitmaps.select(F.col("doc_id").alias("bitmap_id"), F.col("text_hash").alias("bitmap_hash"), "n_lines", "n_dropped", "keep_runs")
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "keep_runs")]
    left = docs.select(*[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own)])
    doc_id, text = (F.col(f"own_{own.index(c)}") for c in ("doc_id", "text"))
    joined = left.join(bitmaps, doc_id.eqNullSafe(F.col("bitmap_id")) & (text_key(text) == F.col("bitmap_hash")), "left")
    return joined.select(*[(kept_text(text, F.col("keep_runs")) if c == "text" else F.col(f"own_{i}")).alias(c) for i, c in enumerate(own)], "n_lines", "n_dropped", "keep_runs")


def _without(rows: DataFrame, gone: DataFrame, text_hash: Column) -> DataFrame:
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (text_hash == F.col("gone_hash")), "left_anti")


@tidied
def _copies(docs: DataFrame, repeated: DataFrame, n: int, percent: int, long_words: int | None) -> DataFrame:
    """``doc_id, text_hash`` of the documents that go as a whole; ``repeated`` are the places of repeated lines, with their words and first place."""
    elsewhere = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")))
    # Equal rows have equal places.
    losses = repeated.where(elsewhere).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("pos", "words")).alias("lost"))
    long = F.exists("lost", lambda x: x["words"] >= long_words) if long_words else F.lit(False)
    losses = losses.select("doc_id", "text_hash", F.aggregate("lost", F.lit(0).cast("long"), lambda total, x: total + x["words"]).alias("lost"), long.alias("long"))
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_hash"))
    sizes = keyed.select(F.col("doc_id").alias("size_id"), F.col("text_hash").alias("size_hash"), F.regexp_count("text", F.lit(WORD)).alias("words")).distinct()
    lost = losses.join(sizes, F.col("doc_id").eqNullSafe(F.col("size_id")) & (F.col("text_hash") == F.col("size_hash")))
    lost = written(lost.where((F.col("lost") > 0) & (F.col("long") | (100 * F.col("lost") >= SUSPECT * F.col("words")))).select("doc_id", "text_hash", (100 * F.col("lost") >= LOST * F.col("words")).alias("goes")), "losses")
    gone, suspects = lost.where("goes").drop("goes"), lost.where("NOT goes").drop("goes")
    # Near copies are told by the whole texts, of those who lose and of those they lose to.
    of = suspects.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"))
    places = repeated.where(elsewhere).join(of, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left_semi")
    holders = _without(places.select("first.doc_id", "first.text_hash").distinct(), gone, F.col("text_hash"))
    both = written(holders.union(suspects).distinct().select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")), "compared")
    if both.isEmpty():
        return gone
    compared = written(keyed.join(both, (F.col("doc_id") == F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left_semi").select("doc_id", "text"), "compared")
    copies = near_copies.join(compared, n, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return written(gone.union(suspects.join(copies, "doc_id", "left_semi")), "copies")


@tidied
def deduplicate_with_documents(docs: DataFrame, min_docs: int = 2, n: int = 5, percent: int = 80, long: tuple[int, int] | None = None) -> DataFrame:
    """As ``deduplicate`` with ``keep_first``, but copies go as documents instead of losing their lines one by one.

    A document goes if ``LOST`` percent of its words, or all, stand in repeated lines that have their first place in another document; and
    if ``SUSPECT`` percent do and it is a near copy, not the first of its group, of documents that lose or hold such lines: similarity of ``percent`` in ``n``-word
    shingles. With ``long`` = (words, documents) lines of as many words are repeated lines in as many documents already, and losing one is enough to be compared. What else such a document holds goes with it. First places are then those in the documents left, so none lies in a document that
    went. Documents without words stay.
    """
    lines = written(occurrences(docs, counted=True), "lines")
    repeated = written(lines.join(_repeating(lines, min_docs, long), ["h1", "h2", "slice"]), "repeated")
    gone = written(_copies(docs, repeated, n, percent, long and long[0]), "gone")
    if not gone.isEmpty():
        docs = _without(docs, gone, text_key(F.col("text")))
        left = _without(repeated.drop("first"), gone, F.col("text_hash"))
        sliced = written(left.groupBy("h1", "h2", "slice").agg(F.min(F.struct("doc_id", "text_hash", "pos")).alias("first")), "slices")
        first = sliced.groupBy("h1", "h2").agg(F.min("first").alias("first"))
        repeated = left.join(sliced.drop("first").join(first, ["h1", "h2"]), ["h1", "h2", "slice"])
    later = repeated.where(~F.struct("doc_id", "text_hash", "pos").eqNullSafe(F.col("first")))
    return _reduced(docs, _bitmaps(docs.select("doc_id", "text"), later))
