import re
from collections import Counter, defaultdict
from hashlib import md5

import pytest

from quayside.llm import mixing as m


def plain_targets(sizes, weights=(1, 2, 3), most=3, share=1.0):
    """Excess over the limits is shared again and again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()) * share, set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: most * sizes[s] for s in capped} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


DOCS = [(i, f"s{i % 7}" if i % 7 else None, "w " * (1 + i * 37 % 90)) for i in range(400)] + [(400, "tiny", "a b"), (401, "none", ""), (402, "none", None), (403, "long", "x " * 30_000), (None, "s1", "a b c")]


@pytest.mark.parametrize("classes", [4096, 4, 1])
def test_targets_and_words(spark, classes):
    frame = spark.createDataFrame([(*r, "mine", 1) for r in DOCS], "doc_id long, source string, text string, taken string, step long")
    mixed = m.mix(frame, classes=classes)
    assert mixed.columns == ["doc_id", "source", "text", "step", "size", "source_size", "target", "copies", "taken"]
    rows = mixed.collect()
    assert len(rows) == len(DOCS)
    sizes = Counter()
    for _, source, text in DOCS:
        sizes[source] += len((text or "").split())
    want = plain_targets(sizes)
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len((r["text"] or "").split())
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        by[r["source"]].append(r)
    for source, own in by.items():
        assert abs(sum(r["taken"] for r in own) - want[source]) <= max(r["size"] for r in own) / 2 + 1e-6
        # Fewest copies go to the highest ranks of random odds by inclusion odds.
        some = [r for r in own if r["size"]]
        odds = plain_odds([r["size"] for r in some], want[source] % sizes[source] if sizes[source] else 0)
        places = [place(r["doc_id"], p) for r, p in zip(some, odds, strict=True)]
        copies = [r["copies"] for _, r in sorted(zip(places, some, strict=True), key=lambda x: x[0])]
        assert copies == sorted(copies, reverse=True)


def plain_odds(sizes, wanted):
    """Odds in proportion to size; those over 1 are certain and the rest is shared again."""
    certain = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in certain]
        left = wanted - sum(sizes[i] for i in certain)
        rate = left / sum(sizes[i] ** 2 for i in free) if free else 0
        over = {i for i in free if rate * sizes[i] > 1}
        if not over:
            return [1.0 if i in certain else rate * n for i, n in enumerate(sizes)]
        certain |= over


def place(doc_id, p, seed=0):
    u = (int(md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return 0 if p >= 1 else float("inf") if p <= 0 else (u / (1 - u)) / (p / (1 - p))


def test_inclusion_odds_over_many_seeds(spark):
    """How often a document is taken is its inclusion odds, as far as order sampling goes; long ones are certain."""
    sizes = [200] + [1 + i % 12 for i in range(120)]
    docs = [(i, "a", "w " * n) for i, n in enumerate(sizes)] + [(1000 + i, "b", "w " * 10) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string")
    first = m.mix(frame, seed=0).collect()
    goal = next(r for r in first if r["source"] == "a")
    whole, wanted = divmod(goal["target"], goal["source_size"])
    odds = plain_odds(sizes, wanted)
    keyed = frame.where("source = 'a'").select("source", m.word_count(m.F.col("text")).alias("size"), "doc_id")
    goals = spark.createDataFrame([("a", wanted)], "goal_source string, wanted double")
    rate = m.inclusion_rates(keyed, goals).first()["rate"]
    assert [min(1, rate * n) for n in sizes] == pytest.approx(odds)
    # The operator's ranking against the plain one, and the plain one over many seeds.
    taken = {r["doc_id"] for r in first if r["source"] == "a" and r["copies"] > whole}

    def drawn(seed):
        left, chosen = wanted, set()
        for _, i in sorted((place(i, p, seed), i) for i, p in enumerate(odds)):
            if sizes[i] / 2 > left:
                break
            left -= sizes[i]
            chosen.add(i)
        return chosen

    assert taken == drawn(0)
    runs = [drawn(seed) for seed in range(2000)]
    for i, p in enumerate(odds):
        assert sum(i in run for run in runs) / len(runs) == pytest.approx(p, abs=0.06)


def test_reruns_and_seeds(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, source string, text string").drop("text").withColumn("text", m.F.lit("a b c"))
    first, again, other = (sorted((str(r["doc_id"]), r["taken"]) for r in m.mix(f, seed=s).collect()) for f, s in ((frame, 0), (frame.repartition(5), 0), (frame, 1)))
    assert first == again != other


def test_repeated_rows_and_empty_table(spark):
    rows = m.mix(spark.createDataFrame([(1, "a", "x y")] * 3 + [(2, "b", "x")], "doc_id long, source string, text string")).collect()
    assert len(rows) == 4 and len({r["taken"] for r in rows if r["doc_id"] == 1}) == 1
    assert m.mix(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0


def test_plan_is_native(spark, capsys):
    m.mix(spark.createDataFrame(DOCS, "doc_id long, source string, text string")).explain()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", capsys.readouterr().out)
