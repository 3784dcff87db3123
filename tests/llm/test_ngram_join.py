import random

import numpy as np
import pytest

from quayside.llm import ngram_join as j
from quayside.llm.components import components
from tests.llm.plain import components as plain_components
from tests.llm.plain import grams


def texts(seed, groups=6, size=12):
    """Chains of near copies, a group that shares a passage, exact copies, and short, blank and null texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(8, 80))
        for _ in range(size):
            out.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randint(0, 2)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
    passage = rng.choices(vocabulary, k=30)
    out += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(25)]
    out += ["The  SAME\ttext here", "the same text HERE\n"] * 3 + ["one two", "one two", "ONE\x0btwo", "one", "", "", None, None, " \n\t", "x " * 5000, "x " * 4000, "a b c d e"]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("n", "percent", "turns", "rows", "block"), [(4, 85, 3, 24, 512), (5, 80, 0, 2, 5), (4, 85, 0, 1000, 512)])
def test_components_like_all_pairs(spark, monkeypatch, n, percent, turns, rows, block):
    for name, value in (("PIVOT_ROUNDS", turns), ("ROWS_BELOW", rows), ("BLOCK", block)):
        monkeypatch.setattr(j, name, value)
    all_texts = dict(enumerate(texts(n)))
    frame = spark.createDataFrame([(i, t, 1, "mine") for i, t in all_texts.items()], "doc_id long, text string, n_grams int, component_id string")
    rows = j.join(frame, n, percent).collect()
    want = plain_components(all_texts, n, percent)
    assert len(set(want.values())) < len(want) - 20
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert {r["doc_id"]: r["n_grams"] for r in rows} == {i: len(grams(t, n)) for i, t in all_texts.items()}


def test_one_of_each_group_stays(spark):
    docs = [(1, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (3, ""), (4, None), (None, "a b c d e f"), (5, "q")]
    kept = j.first_of_groups(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, node int"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "5", "None"] and kept.columns == ["doc_id", "text", "node"]


def test_empty_table(spark):
    assert j.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_filter_never_loses():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 400, 300).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 200))) for _ in range(2))
        assert j._most(a, b, 3) >= len(np.intersect1d(a, b))


def test_sketches_differ_by_no_more_than_their_sets():
    rng = np.random.default_rng(2)
    for size in (5, 100, 3000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 2**63, size // 3).astype(np.uint64)]))
        x, y = (np.frombuffer(j.odd_sketch(v), np.uint8) for v in (a, b))
        width = min(len(x), len(y))
        bits = np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, width), axis=0) ^ np.bitwise_xor.reduce(y.reshape(-1, width), axis=0)).sum()
        differ = len(np.setxor1d(a, b))
        assert 0.9 * differ <= bits <= differ


def test_small_sketches_tell_similar_sets_from_others():
    rng = np.random.default_rng(3)
    draw = lambda k: rng.integers(0, 2**63, k).astype(np.uint64)
    base = [np.unique(draw(size)) for size in (60, 700, 5000, 5200)]
    sets = [*base, *(np.unique(np.concatenate([v[len(v) // 10 :], draw(len(v) // 20)])) for v in base)]
    widths, folded = j._folded([np.frombuffer(j.odd_sketch(v, j.SKETCH_BITS, j.SKETCH_LEAST), np.uint8) for v in sets])
    for x in range(len(sets)):
        for y in range(x):
            place, bits = folded[min(widths[x], widths[y])]
            differ = len(np.setxor1d(sets[x], sets[y]))
            found = np.bitwise_count(bits[place[x]] ^ bits[place[y]]).sum(dtype=np.int64)
            assert found <= differ
            total = len(sets[x]) + len(sets[y])
            if min(len(sets[x]), len(sets[y])) >= 0.85 * max(len(sets[x]), len(sets[y])) and differ > total / 2:
                assert found > total - 2 * -(-85 * total // 185), "unlike sets of like size are ruled out"


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(200, i) for i in range(201, 260)]
    root = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    found = {r["node"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: c for n, c in root.items() if n in found} and set(found) == {n for a, b in links if a != b for n in (a, b)}
