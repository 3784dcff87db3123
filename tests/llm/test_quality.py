import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import quality as q
from tests.llm.plain import DOCS


def made(count=500, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(800)]
    docs, labels = [], []
    for i in range(count):
        words = rng.choices(vocabulary, k=rng.randint(30, 200))
        good = i % 4 != 0
        text = ". ".join(" ".join(words[k : k + 9]).capitalize() for k in range(0, len(words), 9))
        if not good:
            text = rng.choice([" ".join([words[0]] * len(words)), " ".join(w.upper() + "!!" for w in words), " | ".join(words[:60]), " ".join(w + "%%%" for w in words)])
        docs.append((i, text, rng.choice(["en", "de"]), "forum" if not good and rng.random() < 0.7 else "news", len(text)))
        labels.append((i, int(good)))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = made()
    frame = spark.createDataFrame([(*d, "mine") for d in docs], DOCS + ", keep string")
    marks = spark.createDataFrame(labels[:250], "doc_id long, quality int")
    rows = q.classify(frame, marks).collect()
    right = [r["keep"] == bool(dict(labels)[r["doc_id"]]) for r in rows if r["doc_id"] >= 250]
    assert len(right) == 250 and np.mean(right) >= 0.97
    kept = q.kept(frame, marks)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in rows if r["keep"])


def test_odd_rows(spark):
    docs, labels = made(200)
    odd = [(900, None, None, None, None), (901, "", "en", "news", 0), (902, " \n ", "", "", -5), (None, docs[1][1], "en", "news", 10), (903, docs[1][1] * 500, "en", "news", 1), (904, "a", "xx", "new", 1), (904, "a", "xx", "new", 1)]
    marks = [*labels, (None, 1), (3, None), (7, 1), (7, 0), (4242, 1), (900, 0)]
    rows = q.classify(spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame(marks, "doc_id long, quality int")).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r["quality_score"] <= 1 for r in rows)


@pytest.mark.parametrize(("marks", "want"), [([], 0.0), ([(i, 1) for i in range(40)], 1.0), ([(1, 0)], 0.0)])
def test_without_both_labels(spark, marks, want):
    rows = q.classify(spark.createDataFrame(made(60)[0], DOCS), spark.createDataFrame(marks, "doc_id long, quality int")).collect()
    assert all(r["quality_score"] == pytest.approx(want, abs=1e-6) for r in rows)


def test_empty_table(spark):
    assert q.classify(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")).count() == 0


def test_each_view_learns_from_the_other():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 3000).astype(float)
    views = tuple(labels[:, None] * 2 + rng.normal(0, s, (3000, 1)) for s in (0.6, 0.8))
    few, rest = slice(0, 24), slice(24, 2000)
    model = q.co_train(tuple(v[few] for v in views), labels[few], tuple(v[rest] for v in views))
    test = slice(2000, 3000)
    scores = model.scores(views[0][test], views[1][test])
    alone = model.content.scores(views[0][test])
    right = lambda s: ((s >= 0.5) == (labels[test] > 0)).mean()
    assert right(scores) > 0.95 and right(scores) >= right(alone) - 0.01


def test_repeated_ids_stay_few_on_the_driver(spark):
    rows = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("some text").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.col("id").alias("n_chars"))
    ids, views = q._sampled(rows, spark.createDataFrame([(7,)], "doc_id long"))
    assert ids == [7] and [len(v) for v in views] == [1, 1]


def test_slices_change_nothing(monkeypatch):
    from quayside.llm import words

    texts = pa.array(["one two three", None, "", "x" * 500, "four\nfive", "!! ?"] * 20)
    whole = q.content(texts)
    monkeypatch.setattr(words.slices, "__defaults__", (100,))
    parts = [q.content(t) for (t,) in words.sliced(texts)]
    assert len(parts) > 20 and (np.vstack(parts) == whole).all()
