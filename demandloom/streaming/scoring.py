"""Score request files as they arrive.

Features look back only within one request, so nothing has to be kept between micro-batches and
each of them runs the batch operator unchanged.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.records import request_report, score_requests

REQUEST = ("request_id", "arrived")


def request_bodies(files: DataFrame) -> DataFrame:
    """request_id, arrived, body of request files read as whole texts."""
    return files.select(
        F.input_file_name().alias("request_id"),
        F.to_date("_metadata.file_modification_time").alias("arrived"),
        F.col("value").alias("body"),
    )


def day_of(as_of: dt.date | str | None) -> dt.date | str | Column:
    """The day of records without a date: the one given, or that on which their file arrived."""
    return F.col("arrived") if as_of is None else as_of


def write_scored(
    requests: DataFrame, model: PipelineModel, out: str, part: str, as_of: dt.date | str | None
) -> None:
    """Predictions and the report of a batch of requests, each in a folder below `out`."""
    scored = score_requests(requests, model, as_of=day_of(as_of)).drop("arrived")
    scored.write.mode("overwrite").parquet(f"{out}/predictions/{part}")
    request_report(requests).drop("arrived").write.mode("overwrite").parquet(f"{out}/requests/{part}")


def score_stream(
    spark: SparkSession,
    requests: str,
    out: str,
    checkpoint: str,
    model: PipelineModel,
    *,
    as_of: dt.date | str | None = None,
    files_per_batch: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start scoring a folder of request files, one JSON body per file.

    Predictions and reports land in one folder per stream, named after its checkpoint, and
    micro-batch.  A batch that is run again after a failure replaces its folder with the same rows,
    as the day of records without a date comes from their file.
    """
    reader = spark.readStream.option("wholetext", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        write_scored(batch, model, out, f"stream={stream}/batch_id={batch_id}", as_of)

    return (
        request_bodies(reader.text(requests))
        .writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
