import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quayside.llm import queries, spelling
from quayside.llm.tables import table
from tests.llm.plain import DOCS, LOWER


def one_edit(a, b):
    """Whether b is a with one code point put in, taken out or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def grouped(words, ratio=10):
    """What ``group_variants`` returns, by comparing all pairs."""
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def counted(rows, min_chars=7, min_count=2):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            check = zlib.crc32(f"{doc_id}:{run}".encode())
            if check % 31 == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if n >= min_count and len(w) >= min_chars}


def rows_of(frame):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect()}


def frame_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def test_whole_query_equals_brute_force(spark, sf_small):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_small, "documents").collect()]
    words = counted(docs)
    assert words
    assert rows_of(queries.op11_spelling(spark, sf_small)) == grouped(words)


@pytest.mark.parametrize("group", [2, 5, 512])
def test_random_words(spark, group):
    rng = random.Random(group)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))): rng.choice([1, 2, 30, 400, 5000]) for _ in range(400)}
    # A third of the words share both their start and their end.
    words |= {"prefix" + "".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) + "suffix": rng.randint(1, 100) for _ in range(200)}
    assert rows_of(spelling.group_variants(frame_of(spark, words), group=group)) == grouped(words)


def test_letters_at_both_ends_and_repeats(spark):
    words = {"aaaaaaa": 100, "aaaaaaaa": 10, "aaaaaaab": 1, "baaaaaaa": 1, "aaaaaa": 10000, "abaaaaa": 5}
    for group in (1, 512):
        assert rows_of(spelling.group_variants(frame_of(spark, words), group=group)) == grouped(words)


def test_ties_and_chains(spark):
    words = {"letters": 1000, "lettersa": 100, "lettersab": 10, "lettersac": 1, "kettles": 1000, "nettles": 1000, "zettles": 3}
    assert rows_of(spelling.group_variants(frame_of(spark, words))) == grouped(words)


def test_long_words_and_single_letters(spark):
    long = "x" * 30000
    words = {long: 100, long + "y": 3, long[:-1] + "z": 2, "a": 50, "b": 5, "ab": 1}
    assert rows_of(spelling.group_variants(frame_of(spark, words))) == grouped(words)


def test_repeated_words_and_empty_table(spark):
    frame = spark.createDataFrame([("lantern", 40), ("lantern", 2), ("lanterm", 4)], "word string, n long")
    assert rows_of(spelling.group_variants(frame)) == grouped({"lantern": 42, "lanterm": 4})
    assert rows_of(spelling.group_variants(frame.limit(0))) == set()
    with pytest.raises(ValueError):
        spelling.group_variants(frame, ratio=1)


TEXTS = [
    (1, "Lantern LANTERN lanterns ÉCOLIER École×÷ x1lantern"),
    (2, None), (3, ""), (None, "lantern, Lantern"), (4, "lantern\nlantern\tlantern"), (4, "lantern\nlantern\tlantern"), (5, "écolier Écolier " * 3),
]


def test_counts_of_words(spark):
    frame = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in TEXTS], DOCS).withColumn("word", F.lit(1)).withColumn("run", F.lit(1))
    found = {r["word"]: r["n"] for r in spelling.count_words(frame, respelled=queries.without_one_letter).collect()}
    assert found == counted([("" if i is None else i, t) for i, t in TEXTS])
    plain = {r["word"]: r["n"] for r in spelling.count_words(frame).collect()}
    # Only A-Z is lower-cased: the two spellings of the French word differ.
    assert plain["lantern"] == 11 and plain["écolier"] == 3 and plain["Écolier"] == 4


def test_long_text(spark):
    text = "lantern " * 200_000 + "q" * 100_000
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.count_words(frame).collect()} == {"lantern": 200_000}


def test_roots_of_documents(spark):
    variants = spelling.group_variants(frame_of(spark, {"lantern": 100, "lanterm": 4}))
    docs = spark.createDataFrame([(1, "a Lanterm lanterm lantern"), (1, None), (None, "none")], "doc_id long, text string").withColumn("row", F.lit(0))
    rows = [(r["doc_id"], [tuple(v) for v in r["variant_words"]]) for r in spelling.with_roots(docs, variants).collect()]
    assert sorted(rows, key=str) == sorted([(1, [("lanterm", "lantern")]), (1, []), (None, [])], key=str)
