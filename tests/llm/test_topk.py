import numpy as np
import pytest

from quayside.llm import topk

SCHEMA = "vec_id long, vector array<double>, label string"


def brute(rows, queries, k):
    """Candidates of each query id by exact integers."""
    best = {}
    for q, query in queries:
        for v, vector in rows:
            if q != v and len(query) == len(vector):
                score = sum(int(a) * int(b) for a, b in zip(query, vector, strict=True))
                best[q, v] = max(score, best.get((q, v), score))
    out = []
    for q in {q for q, _ in best}:
        found = sorted(((-s, v) for (p, v), s in best.items() if p == q))[:k]
        out += [(q, rank, v, -s) for rank, (s, v) in enumerate(found, 1)]
    return sorted(out)


def searched(spark, rows, queries, k):
    frames = [spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in some], SCHEMA) for some in (rows, queries)]
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(*frames, k).collect())


@pytest.mark.parametrize("sizes", [(4096, 8192, 128), (50, 7, 3)])
@pytest.mark.parametrize("dim", [1, 3, 16])
def test_equals_brute_force(spark, monkeypatch, sizes, dim):
    for name, size in zip(("BLOCK_ROWS", "SHEET_ROWS", "AT_ONCE"), sizes, strict=True):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(dim)
    vectors = rng.integers(-40, 40, (300, dim))
    vectors[rng.random(300) < 0.3] = vectors[0]  # a third of all rows share a vector: ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    assert searched(spark, rows, rows[::25], 5) == brute(rows, rows[::25], 5)


def test_all_scores_negative(spark):
    rows = [(i, [-1 - i % 7, 2 + i % 5, 0]) for i in range(60)]
    queries = [(1000, [3, -4, 1])]
    assert searched(spark, rows, queries, 5) == brute(rows, queries, 5)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    rows = [(1, [1, 2]), (2, [3, 4]), (3, [0, 0])]
    assert searched(spark, rows, rows, 5) == brute(rows, rows, 5)
    assert searched(spark, [], rows, 5) == []
    assert searched(spark, rows, [], 5) == []


def test_unusable_vectors_and_other_lengths(spark):
    good = [(1, [1, 2]), (2, [3, 4]), (5, [7]), (6, []), (7, [])]
    bad = [(3, None), (4, [1, None]), (8, [float("nan"), 1]), (9, [float("inf"), 1])]
    null = [(None, [9, 9])]
    assert searched(spark, good + bad + null, good + bad + null, 3) == brute(good, good, 3)


def test_repeated_rows_and_ids(spark):
    rows = [(i, [i, 1]) for i in range(10)] * 3 + [(4, [50, 50])] + [(4, [-50, 2])]
    queries = [(2, [1, 1])] * 2 + [(3, [1, 0]), (3, [0, 1])]
    assert searched(spark, rows, queries, 4) == brute(rows, queries, 4)


def test_one_id_with_many_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    rows = [(7, [100 + i, 1]) for i in range(100)] + [(100 + i, [i, 1]) for i in range(100)]
    queries = [(1, [1, 0]), (7, [1, 0])]
    assert searched(spark, rows, queries, 5) == brute(rows, queries, 5)


def test_scores_beyond_double_precision(spark):
    rows = [(i, [2**30 + i, 2**29 - i, 3]) for i in range(40)]
    queries = [(1000, [2**31, 2**30 + 1, 1])]
    assert searched(spark, rows, queries, 5) == brute(rows, queries, 5)


def test_scaling_rounds_down(spark):
    frame = spark.createDataFrame([([0.1, -0.001, 0.5],)], "v array<float>").select(topk.scaled("v").alias("v"))
    assert frame.first()["v"] == [25.0, -1.0, 128.0]


def test_neighbours_column(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [3.0, 4.0], "b"), (3, None, "c")], "vec_id long, vector array<double>, neighbours string")
    rows = {r["vec_id"]: [tuple(n) for n in r["neighbours"]] for r in topk.with_neighbours(frame, frame, 2).collect()}
    assert rows == {1: [(2, 11)], 2: [(1, 11)], 3: []}
