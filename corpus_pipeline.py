"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination and mixing, each stage written and read again.

A stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``. Every row of the input is a document; see the operators for null
ids, empty texts and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from quayside.llm.tables import table, written

#: A line in this many documents is boilerplate; it stays at its first place only.
BOILERPLATE_DOCS = 10
#: A passage: a line of this many words stays at its first place only if it stands in this many documents.
PASSAGE_WORDS, PASSAGE_DOCS = 50, 2


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in many documents and passages that stand in two, but for the first place of each; n_chars follows the text.

    Documents that hold little else than such lines, or are near copies, go as a whole.
    """
    done = line_dedup.deduplicate_with_documents(docs, min_docs=BOILERPLATE_DOCS, n=5, percent=80, long=(PASSAGE_WORDS, PASSAGE_DOCS))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; documents without words are no copies."""
    return ngram_join.first_of_groups(docs, n=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of their copies."""
    return mixing.mix(docs).where("copies > 0")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
