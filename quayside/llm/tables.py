"""Reading input tables and cutting lineage with written tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import shared_folder
from quayside.sources.tables import remove

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space that separates words and is stripped from lines: space and U+0009 to U+000D.
BLANKS = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Most bytes of rows that go to a Python worker at once, a little less than ``words.AT_ONCE``.
BATCH_BYTES = 3 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Removes the shuffle files of a query at its end instead of some time after the driver's garbage collection.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders written by the innermost step under way that is ``tidied``.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, name: str, **options: object) -> DataFrame:
    """The frame, written to the shared folder with these ``options`` and read back: a lost executor costs no earlier step.

    Nothing reads the shuffle files of the write again, so they go with it.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        frame.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)
    if (folders := _FOLDERS.get()) is not None:
        folders.append(path)
    return spark.read.schema(frame.schema).parquet(path)


def tidied(step: Callable) -> Callable:
    """A step whose ``written`` tables are removed at its end, but for those that the frames it returns read.

    These go at the end of the step around it, if that is tidied, too. After an error all stay.
    """

    @functools.wraps(step)
    def run(*args, **how):
        token = _FOLDERS.set([])
        try:
            out = step(*args, **how)
            folders = _FOLDERS.get()
        finally:
            _FOLDERS.reset(token)
        frames = out if isinstance(out, tuple) else (out,)
        read = {file.rsplit("/", 2)[-2] for frame in frames for file in frame.inputFiles()}
        outer = _FOLDERS.get()
        for path in folders:
            if path.rsplit("/", 1)[-1] not in read:
                remove(frames[0].sparkSession, path)
            elif outer is not None:
                outer.append(path)
        return out

    return run


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of bounded bytes instead of 10,000 rows, unless the session has a bound already.

    A batch is held in the JVM, outside of its heap, and in the worker; 10,000 long texts take more memory there than the work on them.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def unused(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
