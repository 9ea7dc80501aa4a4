"""What the text operators share: words, folds, written tables, code on the workers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_folder

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and
#: carriage return.  `bytes.split()` cuts at exactly these, and `bytes.lower()` lowers only A-Z.
WORD = r"[^\x20\x09-\x0D]+"
#: Setting by which shuffle files go when the statement that made them ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Setting by which a batch that goes to Python is cut, and at how many bytes: texts may have any length.
BATCH_BYTES, SENT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def prepare(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package, and send a session's rows to them
    in batches of a few MB; a limit that the session sets stays.

    On a cluster the package is installed, or sent with `--py-files`.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, SENT_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    context = spark.sparkContext
    paths = context.environment.get("PYTHONPATH", "").split(":")
    if context.master.startswith("local") and root not in paths:
        context.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe from lost executors."""
    path = path or new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Delete what a statement has shuffled as soon as it ends; worth its time for large shuffles."""
    usual = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, True)
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, usual)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; missing for a missing id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def quoted(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_side(df: DataFrame, rows: int, limit: int = 2_000_000) -> DataFrame:
    """Broadcast `df`, of at most `rows` narrow rows, up to `limit`; join by shuffle beyond."""
    return F.broadcast(df) if rows <= limit else df
