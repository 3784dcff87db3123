"""Run results of the transformation jobs: one document per run, one row per model."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import schemas
from quayside.functions.time import parse_time
from quayside.operators.quality import counted
from quayside.sources.tables import append_table


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One row per result of run-results documents (:data:`schemas.RUN_DOCUMENT`)."""
    return documents.select(
        F.col("metadata.run_id").alias("run_id"),
        parse_time(F.col("metadata.generated_at")).alias("generated_at"),
        F.inline("results"),
    ).select(
        "run_id",
        "generated_at",
        "unique_id",
        "status",
        "execution_time",
        F.col("adapter_response.rows_affected").alias("rows_affected"),
        "message",
    )


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Flatten the documents at ``path``. Absent keys give null, an absent file no rows."""
    try:
        documents = spark.read.schema(schemas.RUN_DOCUMENT).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.RUN_RESULTS)
    return flatten_documents(documents)


def append_run_log(df: DataFrame, path: str) -> None:
    append_table(df.select(*schemas.RUN_RESULTS.names), path)


def load_run_results(spark: SparkSession, path: str, log: str) -> int:
    """Add the documents at ``path`` to the run log; the number of rows added. Loading a document twice adds its rows twice."""
    rows, added = counted(read_run_results(spark, path), "added")
    append_run_log(rows, log)
    return added.get["rows"]
