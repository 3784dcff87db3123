"""The pipeline's stages after the trained one, against plain versions of each on the rows it was given."""

import random

import pytest

import corpus_pipeline as p
from quayside.llm import mixing
from tests.llm.plain import DOCS, components, grams


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(900)]
    line = lambda: " ".join(rng.choices(vocabulary, k=12)).capitalize() + "."
    items = [(i, line() + " " + line()) for i in range(6)]
    docs, labels = [], []
    for i in range(300):
        lines = [line() for _ in range(rng.randint(2, 8))]
        if i % 10 == 1:
            lines = docs[i - 1][1].split("\n")
            lines[-1] += " changed"
        if i % 7 == 3:
            lines.insert(1, "Read more on our site")
        if i % 25 == 6:
            lines.insert(1, items[i % 6][1])
        good = i % 9 != 4
        text = "\n".join(lines) if good else " ".join(w.upper() + "!!" for w in " ".join(lines).split())
        docs.append((i, text, "en", f"s{i % 4}" if i % 11 else None, len(text)))
        labels.append((i, int(good), 0))
    docs += [(300, None, None, None, None), (301, "", "en", "s1", 0), docs[2], docs[2]]
    path = str(tmp_path_factory.mktemp("tables"))
    for name, rows, schema in (("documents", docs, DOCS), ("labels", labels[::2], "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, states = docs.columns, [docs]
    for _, stage in p.STAGES:
        states.append(p.written(stage(spark, states[-1], folder), "stage"))
    assert all(s.columns == columns for s in states[:-1]) and len(p.STAGES) == 5
    rows = [[r.asDict() for r in s.collect()] for s in states]
    given, good, lines, single, clean, mixed = rows
    names = [{r["doc_id"] for r in state} for state in rows]
    # Clean documents stay; shouted ones go.
    bad = {i for i in range(300) if i % 9 == 4}
    assert len(bad & names[1]) <= 0.05 * len(bad) and len(set(range(300)) - bad - names[1]) <= 3
    # Boilerplate stays at its first place only.
    assert len(lines) == len(good)
    assert sum((r["text"] or "").split("\n").count("Read more on our site") for r in lines) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in lines)
    # One of each group of near copies.
    want = components({r["doc_id"]: r["text"] for r in lines}, 5, 80)
    assert names[3] == {i for i, c in want.items() if i == c} and names[3] < names[2]
    # No benchmark item is left, and nothing else is lost.
    items = [grams(r["text"], 5) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {r["doc_id"] for r in single if any(100 * len(g & grams(r["text"], 5)) >= 80 * len(g) for g in items)}
    assert dirty and names[4] == names[3] - dirty
    whole = mixing.mix(states[4]).collect()
    assert names[5] == {r["doc_id"] for r in whole if r["copies"]} and all(r["copies"] > 0 for r in mixed)
    assert sum(r["taken"] for r in mixed) == pytest.approx(sum(r["size"] for r in whole), rel=0.2)
    assert {r["source_size"] for r in mixed} <= {r["source_size"] for r in whole}


def test_run_is_the_stages(spark, folder):
    assert p.run(spark, folder).count() > 100


def lines_of(rng, n, words=12):
    return [" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(words)) for _ in range(n)]


def test_large_groups_of_copies_go_as_documents(spark, folder, tmp_path):
    rng = random.Random(3)
    exact, near, short, own = lines_of(rng, 5), lines_of(rng, 6, 25), lines_of(rng, 3, 40), lines_of(rng, 40)
    menu = lines_of(rng, 1, 5)
    docs = [(1000 + i, "\n".join(exact)) for i in range(14)]
    # One changed line of six; one changed word in a line of three, so that a third of the words is left.
    docs += [(1100 + i, "\n".join([*near[: i % 6], near[i % 6] + f" changed{i}", *near[i % 6 + 1 :]])) for i in range(40)]
    docs += [(1200 + i, "\n".join([*short[: i % 3], short[i % 3] + f" changed{i}", *short[i % 3 + 1 :]])) for i in range(40)]
    # The first copy that goes is the first place of the menu, which stays once in the others.
    docs[1] = (1001, "\n".join([*exact, *menu]))
    docs += [(1300 + i, "\n".join([own[2 * i], *menu, own[2 * i + 1]])) for i in range(12)]
    docs += [(1400, ""), (1401, None)]
    docs += [docs[0], docs[20]]
    frame = spark.createDataFrame([(i, t, "en", "s0", len(t or "")) for i, t in docs], DOCS)
    rows = p.drop_repeated_lines(spark, frame, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == [1000, 1000, 1100, 1200, *range(1300, 1312), 1400, 1401]
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert [texts[i] for i in (1000, 1100, 1200)] == [t for i, t in docs[:-2] if i in (1000, 1100, 1200)]
    assert sum(t.split("\n").count(menu[0]) for t in texts.values()) == 1 and menu[0] in texts[1300]
    path = str(tmp_path)
    frame.where("doc_id < 1400").union(spark.read.parquet(f"{folder}/documents.parquet")).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    left = {r["doc_id"] for r in p.run(spark, path).where("doc_id >= 1000 AND doc_id < 1300").collect()}
    assert left <= {1000, 1100, 1200} and left


def test_passages_in_two_documents_stay_once(spark, folder):
    rng = random.Random(5)
    passage, short, copy = lines_of(rng, 1, 50)[0], lines_of(rng, 1, 49)[0], [*lines_of(rng, 1, 60), *lines_of(rng, 5, 20)]
    own = lines_of(rng, 12, 40)
    docs = [(i, "\n".join([*own[3 * i : 3 * i + 2], passage, short, own[3 * i + 2]])) for i in range(3)]
    # Copies with a passage go or stay as documents.
    docs += [(10, "\n".join(copy)), (11, "\n".join(copy)), (12, "\n".join([copy[0] + " end", *copy[1:]])), (13, "\n".join([*copy[:-1], copy[-1] + " end"]))]
    rows = p.drop_repeated_lines(spark, spark.createDataFrame([(i, t, "en", "s0", len(t)) for i, t in docs], DOCS), folder).collect()
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert [texts[i].split("\n").count(passage) for i in range(3)] == [1, 0, 0]
    assert all(short in texts[i] for i in range(3)) and texts[0] == docs[0][1]
    # A near copy that loses nothing is left to the next stage.
    assert set(texts) == {0, 1, 2, 10, 12} and texts[10] == docs[3][1]
