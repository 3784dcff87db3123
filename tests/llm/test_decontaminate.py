import random

import numpy as np
import pytest

from quayside.llm import decontaminate as d
from quayside.llm.words import shingle_sets
from tests.llm.plain import grams


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([5, 6, 8, 11, 13, 20, 40, 60, 3, 1] * 4)]
    docs = []
    for i in range(120):
        body = rng.choices(vocabulary, k=rng.choice([10, 100, 1000, 20_000]) if i % 30 == 0 else rng.randint(5, 300))
        passage = list(items[i % len(items)][1].split())
        for _ in range(i % 4):
            passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
        at = rng.randrange(len(body))
        docs.append((i, " ".join(body[:at] + passage + body[at:]) if i % 3 else " ".join(passage)))
    docs += [(500, None), (501, ""), (502, " \n"), (503, items[6][1].upper()), (503, items[6][1].upper()), (None, items[7][1])]
    return docs, [*items, (90, None), (91, ""), (92, " "), (0, items[0][1]), (0, items[1][1])]


@pytest.mark.parametrize("block", [d.INDEX_SHINGLES, 300])
def test_pairs_like_exact_containment(spark, block):
    docs, items = corpus()
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, found int")
    rows = d.find(frame, spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, grams string"), block=block).collect()
    want = []
    for doc, text in docs:
        own = grams(text, 5)
        for item, wanted in {(i, frozenset(grams(t, 5))) for i, t in items}:
            both = len(own & wanted)
            if wanted and 100 * both >= 80 * len(wanted):
                want.append((str(doc), item, both, len(wanted)))
    assert sorted((str(r["doc_id"]), r["item_id"], r["shared"], r["n_shingles"]) for r in rows) == sorted(want) and len(want) > 40


def test_clean_rows_stay_whole(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, found int")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    gone = {str(r["doc_id"]) for r in d.find(frame, wanted).collect()}
    kept = d.clean(frame, wanted)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in docs if str(i) not in gone)


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame([], s) for s in ("doc_id long, text string", "item_id long, text string"))
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert d.find(docs, items).count() == 0 and d.find(some, items).count() == 0 and d.clean(some, items).count() == 1
    assert d.find(docs, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def test_sketch_grows_with_the_document():
    import pyarrow as pa

    rng = random.Random(1)
    for size in (50, 500, 20_000):
        grams_ = shingle_sets(pa.array([" ".join(str(rng.random()) for _ in range(size))]), 5)[0]
        kept = d.sketch(grams_)
        assert len(kept) >= 0.75 * len(grams_) and len(np.unique(kept)) == len(kept) and np.isin(kept, grams_).all()
    assert len(d.sketch(np.zeros(0, np.uint64))) == 0
