import os

import pytest

from quayside.config import shared_folder
from quayside.llm import line_dedup, ngram_join
from quayside.llm.tables import CLEANUP_SETTING, tidied, written


def folders(spark):
    path = f"{shared_folder(spark)}/llm"
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def read_by(frame):
    return {file.rsplit("/", 2)[-2] for file in frame.inputFiles()}


def test_step_leaves_what_its_result_reads(spark):
    before = folders(spark)

    @tidied
    def inner():
        gone, left = written(spark.range(5), "gone"), written(spark.range(7), "left")
        return left.join(gone.limit(0), "id", "left_anti") if gone.isEmpty() else left.where("id > 1")

    @tidied
    def outer(fail=False):
        known = folders(spark)
        a = inner()
        assert len(folders(spark) - known) == 1
        b = written(a.selectExpr("id * 2 AS id"), "doubled")
        if fail:
            raise ValueError
        return b, written(b.where("id > 99"), "none")

    two, none = outer()
    assert folders(spark) - before == read_by(two) | read_by(none) and len(read_by(two)) == 1
    assert sorted(r["id"] for r in two.collect()) == [4, 6, 8, 10, 12] and none.count() == 0
    kept = folders(spark)
    with pytest.raises(ValueError):
        outer(fail=True)
    assert len(folders(spark) - kept) == 2
    written(spark.range(3), "alone")
    assert len(folders(spark) - kept) == 3


def test_setting_is_as_before(spark):
    before = spark.conf.get(CLEANUP_SETTING)
    spark.conf.set(CLEANUP_SETTING, "false")
    written(spark.range(3).repartition(2, "id"), "some")
    assert spark.conf.get(CLEANUP_SETTING) == "false"
    spark.conf.unset(CLEANUP_SETTING)
    written(spark.range(3), "some")
    assert spark.conf.get(CLEANUP_SETTING) == before


def test_stages_leave_no_other_tables(spark):
    lines = [" ".join(f"w{(i * 7 + j * j) % 97}" for j in range(12)) for i in range(30)]
    docs = [(i, "\n".join([lines[i % 30], lines[(i * 3 + 1) % 30], f"own line {i} of a few words", lines[(i // 2) % 30] + " end"])) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for step in (lambda: line_dedup.deduplicate_with_documents(frame, min_docs=3, long=(12, 2)), lambda: ngram_join.first_of_groups(frame)):
        before = folders(spark)
        result = step()
        assert folders(spark) - before <= read_by(result)
        assert 0 < len(result.collect()) <= 40
