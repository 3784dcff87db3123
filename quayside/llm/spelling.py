"""Spelling variant grouping: words at one edit from each other, found by sorted-list dynamic programming.

Words are filed by what a pair at one edit must share. A class is a length ``size``; in it meet the words of that length and those
that are one longer. The place of the edit (the length of the common prefix) falls into one window ``lo..hi`` of the class, so both words have
the same ``lo`` code points before it and the same ``size - hi`` after it. Words with equal ends form a group, and only what is between the ends, the
middles, has to be compared. The first windows are the halves; the window of a group with more than ``GROUP`` words is halved again, so that
a start or an end that a third of all words share is cut up before its words meet in a task. A window of one place holds at most the letters of the alphabet.

In a group the sorted middles are scanned once for each word of the shorter length. The band (three cells) of the edit matrix is kept for
each prefix; the next middle goes on from the row at its common prefix with the last one, and where a row has passed one edit, all
middles that share this prefix are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import lower_ascii, unused, written
from quayside.operators.sizes import broadcast_if_small

#: Maximal runs of these are words.
LETTERS = "A-Za-zÀ-ÿ"
#: A group with more words than this is cut up, if its window has more than one place.
GROUP = 512
#: Stands for more than one edit.
FAR = 2


def count_words(docs: DataFrame, min_chars: int = 7, min_count: int = 2, respelled: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``word, n``: runs of letters in ``docs`` (doc_id, text) with A-Z lower-cased, ``n`` their occurrences in all rows of ``docs``.

    ``respelled(doc_id, run)`` may give the word that stands for a run; it must not be longer. Words under ``min_chars`` code points or
    ``min_count`` occurrences are left out. Null and empty texts have no words; repeated rows count again; other columns are not read.
    """
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))
    word = F.col("run") if respelled is None else respelled(F.col("doc_id"), F.col("run"))
    words = found.select(word.alias("word")).where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _filed(words: DataFrame, windows: Column) -> DataFrame:
    """A row for each word and window (size, lo, hi): equal ``head`` and ``tail`` around the window, and the ``middle`` in it."""
    placed = words.select("word", "n", F.explode(windows).alias("w")).select("word", "n", "w.*")
    rest = F.col("size") - F.col("hi")
    head, tail = F.left("word", F.col("lo")), F.right("word", rest)
    middle = F.substr("word", F.col("lo") + 1, F.length("word") - F.col("lo") - rest)
    filed = placed.select("n", "size", "lo", "hi", head.alias("head"), middle.alias("middle"), tail.alias("tail"))
    return filed.withColumn("key", F.xxhash64("size", "lo", "hi", "head", "tail"))


def _window(size: Column, lo: Column, hi: Column) -> Column:
    return F.struct(size.alias("size"), lo.alias("lo"), hi.alias("hi"))


def _halves(shortest: int) -> Column:
    """The first windows of a word: in the class of its own length, and as the longer word in the class below."""
    size, zero = F.length("word"), F.lit(0)
    middle = lambda c: F.floor(c / 2).cast("int")
    windows = [_window(s, *ends) for s in (size, size - 1) for ends in ((zero, middle(s)), (middle(s), s))]
    return F.filter(F.array(*windows), lambda w: (w["size"] >= shortest) & (w["hi"] > w["lo"]))


def one_edit_apart(middles: list[str], width: int, to_the_end: bool) -> Iterator[tuple[int, int]]:
    """Index pairs of sorted distinct strings of ``width`` and ``width + 1`` at one edit, each once, the first of them of ``width``.

    The edit lies before ``width``, or anywhere if the words end there too.
    """
    shared = [0] * len(middles)  # common prefix with the string before
    for i in range(1, len(middles)):
        a, b = middles[i - 1], middles[i]
        most = min(len(a), len(b))
        k = 0
        while k < most and a[k] == b[k]:
            k += 1
        shared[i] = k
    for i, query in enumerate(middles):
        if len(query) != width:
            continue
        # Cells of one row d: prefixes of d - 1, d and d + 1 of the query; rows[d] is for the first d of the string.
        rows = [(FAR, 0, 1)]
        j = common = 0
        while j < len(middles):
            text = middles[j]
            common = min(common, shared[j])
            del rows[common + 1 :]
            d = len(rows) - 1
            below, same, above = rows[d]
            while d < len(text):
                c = text[d]
                low = min(below + (query[d - 1] != c), same + 1)
                mid = min(same + (query[d] != c), above + 1, low + 1) if d < width else FAR
                high = min(above + (query[d + 1] != c), mid + 1) if d + 1 < width else FAR
                below, same, above = low, mid, high
                d += 1
                if below > 1 and same > 1 and above > 1:
                    break
                rows.append((below, same, above))
            else:
                if (len(text) == width and j > i and same == 1) or (len(text) == width + 1 and below == 1):
                    if to_the_end or _prefix(query, text) < width:
                        yield i, j
                j += 1
                common = len(text)
                continue
            # Strings with the same first d go the same way.
            j += 1
            while j < len(middles) and shared[j] >= d:
                j += 1
            common = d


def _prefix(a: str, b: str) -> int:
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return k


FILED = ["key", "size", "lo", "hi", "head", "tail", "middle", "n"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each group; rows come sorted by group and middle."""
    out: list[tuple] = []
    group: tuple = ()
    rows: list[tuple[str, int]] = []

    def close() -> None:
        if len(rows) > 1:
            _, size, lo, hi, head, tail = group
            for i, j in one_edit_apart([r[0] for r in rows], hi - lo, hi == size):
                out.append((head + rows[i][0] + tail, rows[i][1], head + rows[j][0] + tail, rows[j][1]))

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["a", "a_n", "b", "b_n"])

    for batch in batches:
        for *key, middle, n in zip(*(batch.column(c).to_pylist() for c in FILED), strict=True):
            if tuple(key) != group:
                close()
                group, rows = tuple(key), []
            rows.append((middle, n))
        yield flushed()
        out.clear()
    close()
    yield flushed()


def near_pairs(words: DataFrame, group: int | None = None) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of distinct words of ``words`` (word, n) at exactly one edit, once."""
    group = GROUP if group is None else group
    shortest = words.agg(F.min(F.length("word"))).first()[0] or 0
    todo, pairs = _filed(words, _halves(shortest)), []
    while True:
        todo = written(todo, "spelling-filed")
        crowded = todo.where(F.col("hi") - F.col("lo") > 1).groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > group)
        crowded = written(crowded.select("key"), "spelling-crowded")
        split = not crowded.isEmpty()
        flagged = broadcast_if_small(crowded) if split else None
        ready = todo.join(flagged, "key", "left_anti") if split else todo
        ordered = ready.select(*FILED).repartition("key").sortWithinPartitions(*FILED)
        pairs.append(written(ordered.mapInArrow(_scan, "a string, a_n long, b string, b_n long"), "spelling-pairs"))
        if not split:
            break
        cut = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(_window(F.col("size"), F.col("lo"), cut), _window(F.col("size"), cut, F.col("hi")))
        again = todo.join(flagged, "key", "left_semi").select(F.concat("head", "middle", "tail").alias("word"), "n", halves.alias("halves"))
        todo = _filed(again, F.col("halves"))
    out = pairs[0]
    for more in pairs[1:]:
        out = out.union(more)
    return out


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each row of ``forms`` (word, form), whose forms are followed to the last. Forms grow in n, so there is no cycle."""
    steps = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        above = steps.select(F.col("word").alias("root"), F.col("root").alias("above"))
        jumped = steps.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        jumped = written(jumped, "spelling-roots")
        steps = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return steps


def group_variants(words: DataFrame, ratio: int = 10, group: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``words`` (word, n), both without null.

    Near words differ by exactly one inserted, deleted or replaced code point, by any alphabet. ``form`` is the near word of largest n, the first
    by code points among equal ones, if its n is ``ratio`` times the word's n or more; else null, as is ``form_n``. ``root`` follows forms to the last
    word, and is the word itself without a form. Repeated words count as one with the sum of their n; an empty table gives an empty one. ``ratio`` must be over 1.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1, or forms could go round")
    words = written(words.groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    pairs = near_pairs(words, group)
    sides = F.explode(F.array(*(F.struct(F.col(w).alias("word"), F.col(o).alias("near"), F.col(f"{o}_n").alias("near_n")) for w, o in (("a", "b"), ("b", "a")))))
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near"))
    near = pairs.select(sides.alias("s")).select("s.*").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.minus_n") >= ratio * F.col("n")
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.minus_n")).alias("form_n"),
    )
    known = written(known, "spelling-forms")
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_roots(docs: DataFrame, variants: DataFrame) -> DataFrame:
    """``docs`` with ``variant_words``: the distinct words of each text that have another root, as structs (word, root), ordered; [] without any.

    A column of that name is replaced. Rows of ``docs`` are told apart by position, so null and repeated ids stay as they are.
    """
    own = [c for c in docs.columns if c.lower() != "variant_words"]
    row = unused(docs, "row")
    numbered = written(docs.select(*own).withColumn(row, F.monotonically_increasing_id()), "spelling-docs")
    runs = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]+"), F.lit(0)), lower_ascii))
    found = numbered.select(row, F.explode(runs).alias("word")).join(variants.where("root <> word").select("word", "root"), "word")
    listed = found.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("word", "root"))).alias("variant_words"))
    nothing = F.array().cast("array<struct<word:string,root:string>>")
    return numbered.join(listed, row, "left").select(*own, F.coalesce("variant_words", nothing).alias("variant_words"))
