import numpy as np
import pytest

from quayside.llm import ann as a

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(count=3000, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, dim))
    points = centres[rng.integers(0, 12, count)] + rng.normal(0, 0.25, (count, dim))
    points[rng.random(count) < 0.3] = points[0]  # a vector that a third of all rows share
    return points.astype(np.float32)


def brute(points, ids, query, k):
    far = np.sqrt(((points.astype(float) - query.astype(float)) ** 2).sum(1))
    order = np.lexsort((ids, far))
    return [(int(ids[i]), float(far[i])) for i in order][: k + 1]


def found(rows):
    out = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("limits", [(8192, 2048), (300, 4)])
def test_recall_and_exact_scores(spark, monkeypatch, limits):
    monkeypatch.setattr(a, "BLOCK_ROWS", limits[0])
    monkeypatch.setattr(a, "QUERY_ROWS", limits[1])
    points = clustered()
    ids = np.arange(len(points))
    frame = spark.createDataFrame([(int(i), [float(x) for x in p], 1) for i, p in zip(ids, points, strict=True)], SCHEMA)
    rows = found(a.search(frame, frame.where("vec_id % 50 = 0")).collect())
    assert sorted(rows) == [i for i in range(0, len(points), 50)]
    hits = 0
    for q, near in rows.items():
        want = [x for x in brute(points, ids, points[q], 10) if x[0] != q][:10]
        assert [r[0] for r in near] == list(range(1, 11))
        assert all(s == pytest.approx(np.sqrt(((points[v].astype(float) - points[q].astype(float)) ** 2).sum())) for _, v, s in near)
        assert [(s, v) for _, v, s in near] == sorted((s, v) for _, v, s in near)
        hits += len({v for v, _ in want} & {v for _, v, _ in near})
    assert hits >= 0.9 * 10 * len(rows)
    # Ties at distance 0 go to the smallest ids.
    same = [int(i) for i in ids if (points[i] == points[0]).all()]
    assert [v for _, v, _ in rows[0]] == same[1:11]


def test_unusable_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (100, [3.0, 4.0]), (100, [3.0, 4.0])]
    bad = [(3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (200, [0.0, 0.0]), (300, None)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in good + bad], SCHEMA)
    rows = found(a.search(frame, frame.where("vec_id % 100 = 0")).collect())
    assert {q: [(r[0], r[1]) for r in v] for q, v in rows.items()} == {0: [(1, 2), (2, 1), (3, 100)], 100: [(1, 1), (2, 0), (3, 2)]}
    assert rows[0][2][2] == pytest.approx(np.sqrt(20.0))


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert a.search(frame, frame).count() == 0


def test_partitions_are_balanced():
    points = clustered(1000).astype(float)
    points = np.unique(points, axis=0)
    graph = np.array([f[0] for f in a.nearest(points, points, 5)])
    parts = a.balanced_partitions(points, graph, 8)
    assert np.bincount(parts, minlength=8).max() <= np.ceil(1.1 * len(points) / 8)
    assert (parts[graph] == parts[:, None]).mean() > 0.5


def test_repeated_rows_push_no_neighbours_out(spark):
    points = clustered()
    points[100:] += np.random.default_rng(1).normal(0, 0.01, points[100:].shape).astype(np.float32)
    rows = [(i, [float(x) for x in p], 1) for i, p in enumerate(points)]
    # All rows twice, and one near neighbour of many 2000 times.
    repeated = rows * 2 + [rows[200]] * 2000
    once, often = (spark.createDataFrame(r, SCHEMA) for r in (rows, repeated))
    want = found(a.search(once, once.where("vec_id % 50 = 0")).collect())
    got = found(a.search(often, often.where("vec_id % 50 = 0")).collect())
    assert got == want and all(len(v) == 10 for v in got.values())
