"""Folders for data that must outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    A local session that names none gets a temporary folder, which goes when the process ends; on a
    cluster a machine-local folder would be lost with its machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    _LOCAL.append(tempfile.TemporaryDirectory(prefix="demandloom-"))
    spark.sparkContext.setCheckpointDir(_LOCAL[-1].name)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe from lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(spark: SparkSession, path: str) -> str | None:
    """A path below the shared folder as workers open it, if that folder is a mounted one."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return place.toUri().getPath() if system.getUri().getScheme() == "file" else None


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that this package has written below the shared folder and no longer reads."""
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
