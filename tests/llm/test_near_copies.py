import random

import pytest

from quayside.llm import near_copies as c
from tests.llm.plain import components as plain_components
from tests.llm.test_ngram_join import texts


@pytest.mark.parametrize(("n", "percent", "turns", "block"), [(4, 85, 2, 512), (5, 80, 0, 5), (5, 80, 1, 3)])
def test_components_like_all_pairs(spark, monkeypatch, n, percent, turns, block):
    for name, value in (("PIVOT_ROUNDS", turns), ("BLOCK", block)):
        monkeypatch.setattr(c, name, value)
    all_texts = dict(enumerate(texts(n)))
    rows = c.join(spark.createDataFrame([(i, t, 1) for i, t in all_texts.items()], "doc_id long, text string, low int"), n, percent).collect()
    want = plain_components(all_texts, n, percent)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: k for i, k in want.items() if (all_texts[i] or "").strip()} and len(rows) < len(want)


def test_without_rows_and_without_links(spark):
    assert c.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = c.join(spark.createDataFrame([(1, "a b c d e f"), (2, "u v w x y z"), (None, "A b c d e f"), (3, None)], "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in rows) == [("1", 1), ("2", 2), ("None", 1)]


def test_group_that_links_in_parts_leaves_few_pairs(spark, monkeypatch):
    """Of copies with one, two or three changed words those with two link with those with one only, and those with three with hardly any."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(320):
        words = list(base)
        for at in rng.sample(range(5, 145), 1 if i % 7 == 0 else 3 if i % 3 == 0 else 2):
            words[at] = f"own{i}at{at}"
        texts[i] = " ".join(words)
    made, old = [], c.written

    def counted(frame, name):
        out = old(frame, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(c, "written", counted)
    rows = c.join(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 5, 80).collect()
    want = plain_components(texts, 5, 80)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want and max(map(list(want.values()).count, set(want.values()))) > 200
    assert made[-1] < 320, made


def test_group_without_links_leaves_few_sets_to_compare(spark, monkeypatch):
    """Copies with four changed words each share most grams, and none links with another: sketches tell that, not whole sets."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(140):
        words = list(base)
        for at in rng.sample(range(5, 145, 7), 4):
            words[at] = f"own{i}at{at}"
        texts[i] = " ".join(words)
    compared, old = [], c._verified

    def counted(nodes, pairs, percent):
        compared.append(pairs.count())
        return old(nodes, pairs, percent)

    monkeypatch.setattr(c, "_verified", counted)
    rows = c.join(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 5, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_components(texts, 5, 80) == {i: i for i in texts}
    # The first round, with one pivot for each gram, has no sketches yet.
    assert sum(compared[1:]) < 140, compared
