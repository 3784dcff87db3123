import pyarrow as pa

from quayside.llm import ngram_join, quality
from quayside.llm.tables import BATCH_SETTING, bounded_batches


def most_bytes(frame):
    def scan(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    return max(r["n"] for r in frame.mapInArrow(scan, "n long").collect())


def test_stages_send_batches_of_bounded_bytes(spark):
    long = spark.range(0, 4000, 1, 1).selectExpr("repeat(concat('word', id, ' '), 600) AS text")
    docs = spark.createDataFrame([(i, f"a b c d e f {i}", "en", "s", 13) for i in range(8)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    for stage in (lambda: ngram_join.join(docs), lambda: quality.kept(docs, labels)):
        spark.conf.unset(BATCH_SETTING)
        stage()
        assert most_bytes(long) < 4 << 20


def test_a_bound_of_the_session_stays(spark):
    spark.conf.set(BATCH_SETTING, "1m")
    try:
        bounded_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == "1m"
    finally:
        spark.conf.unset(BATCH_SETTING)
