import re
from collections import defaultdict

import pytest

from quayside.llm import line_dedup as d

DOCS = [
    (1, "Footer\nalpha\n\nFOOTER \nbeta"), (2, "\tfooter\ngamma"), (3, "footer"), (4, None), (5, ""), (None, "footer\nown"), (6, "alpha \x0b\ndelta\nalpha\n"), (6, "alpha \x0b\ndelta\nalpha\n"),
    (7, "\n".join(["footer", "x"] * 20_000)), (8, "ÀLPHA\nàlpha"), (6, "other text of one id\nfooter"), (9, "x\x1f"),
]


def plain(docs, min_docs, first):
    docs = sorted(set(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    where = defaultdict(list)
    lines = {doc: (doc[1] or "").split("\n") for doc in docs}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate(low)
    for doc in docs:
        for pos, line in enumerate(lines[doc]):
            if key(line):
                where[key(line)].append((doc, pos))
    gone = set()
    for places in where.values():
        if len({doc for doc, _ in places}) >= min_docs:
            gone.update(places[1:] if first else places)
    return {doc: (len(lines[doc]), sum((doc, p) in gone for p in range(len(lines[doc]))), "\n".join(x for p, x in enumerate(lines[doc]) if (doc, p) not in gone)) for doc in docs}


@pytest.mark.parametrize(("min_docs", "first"), [(2, True), (2, False), (4, False), (1, True), (1, False), (99, False)])
def test_against_plain(spark, min_docs, first):
    # With a first place, doc_ids of two texts are ordered by a hash; leave that one out.
    docs = [r for r in DOCS if not first or r != (6, "other text of one id\nfooter")]
    frame = spark.createDataFrame([(*r, "mine", 3) for r in docs], "doc_id long, text string, n_lines string, start long")
    done = d.deduplicate(frame, min_docs=min_docs, keep_first=first)
    assert done.columns == ["doc_id", "text", "start", "n_lines", "n_dropped", "keep_runs"]
    want = plain(docs, min_docs, first)
    rows = done.collect()
    assert len(rows) == len(docs)
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in rows) == sorted((str(doc[0]), *want[doc]) for doc in docs)


def test_runs_are_compressed(spark):
    frame = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "c")], "doc_id long, text string")
    rows = {r["doc_id"]: r["keep_runs"] for r in d.keep_bitmaps(frame, keep_first=False).collect()}
    assert [tuple(r) for r in rows[1]] == [(0, 2), (3, 2)]
    assert rows[2] == []


def test_empty_table(spark):
    assert d.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_plan_is_native(spark, capsys):
    d.deduplicate(spark.createDataFrame(DOCS, "doc_id long, text string")).explain()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", capsys.readouterr().out)


def test_documents_that_go_are_found_without_python(spark, monkeypatch):
    from pyspark.sql import DataFrame, GroupedData

    def none(*_, **__):
        raise AssertionError("Python on the executors")

    for kind, name in ((DataFrame, "mapInArrow"), (DataFrame, "mapInPandas"), (GroupedData, "applyInArrow"), (GroupedData, "applyInPandas")):
        for one in {kind, *kind.__subclasses__()}:
            monkeypatch.setattr(one, name, none)
    base = [f"{'abcdefgh'[i]}{k} word{i} and{k} so{i} on{k}" for i in range(6) for k in range(3)]
    docs = [(i, "\n".join([*base[: i % 18], base[i % 18] + f" changed{i}", *base[i % 18 + 1 :]])) for i in range(30)]
    # Half of its words stand elsewhere first, but it is no copy.
    docs += [(50, "\n".join([*base[:9], *(f"{line} own" for line in "klmnopqrstuvwxyz"[:9])]))]
    rows = d.deduplicate_with_documents(spark.createDataFrame(docs, "doc_id long, text string"), 2, long=(5, 2)).collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 50]
