"""Scoring job: request files, as one batch or as they arrive, or a table of records."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..operators.records import require_records, score_records
from ..operators.versions import load_version
from ..streaming import score_stream
from ..streaming.scoring import request_bodies, write_scored


def score_files(
    spark: SparkSession,
    requests: str,
    models: str,
    out: str,
    *,
    version: str | None = None,
    as_of: dt.date | str | None = None,
) -> None:
    """Score every request file of a folder with a version (the newest by default).

    `out/predictions` gets one row per record, `out/requests` one per file: how many records it
    has, and the error of a file without any.
    """
    model = load_version(spark, f"{models}/model_versions", version)
    bodies = request_bodies(spark.read.option("wholetext", True).text(requests))
    write_scored(require_records(bodies), model, out, "", as_of)


def score_table(
    spark: SparkSession,
    table: str,
    models: str,
    out: str,
    *,
    form: str = "parquet",
    batch_keys: Sequence[str] = (),
    position: str = "record_pos",
    version: str | None = None,
    as_of: dt.date | str | None = None,
) -> None:
    """Score a table of records: parquet, CSV with a header, or JSON lines.

    Features look back within the records that agree on `batch_keys`, in order of `position`.
    """
    model = load_version(spark, f"{models}/model_versions", version)
    rows = spark.read.options(header=True).format(form).load(table)
    if dict(rows.dtypes)[position] == "string":
        rows = rows.withColumn(position, rows[position].cast("long"))
    scored = score_records(
        require_records(rows),
        model,
        as_of=as_of or dt.date.today(),
        batch_keys=batch_keys,
        position=position,
    )
    scored.write.mode("overwrite").parquet(out)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Score request files or a table of records.")
    given = parser.add_mutually_exclusive_group(required=True)
    given.add_argument("--requests", help="folder of request files")
    given.add_argument("--table", help="table of records")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    parser.add_argument("--batch-keys", nargs="*", default=[])
    parser.add_argument("--position", default="record_pos")
    parser.add_argument("--models", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--version")
    parser.add_argument("--as-of")
    parser.add_argument("--stream-checkpoint", help="score files as they arrive")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("demand-score").getOrCreate()
    if args.table:
        score_table(
            spark,
            args.table,
            args.models,
            args.out,
            form=args.format,
            batch_keys=args.batch_keys,
            position=args.position,
            version=args.version,
            as_of=args.as_of,
        )
    elif args.stream_checkpoint:
        model = load_version(spark, f"{args.models}/model_versions", args.version)
        score_stream(
            spark, args.requests, args.out, args.stream_checkpoint, model, as_of=args.as_of
        ).awaitTermination()
    else:
        score_files(
            spark, args.requests, args.models, args.out, version=args.version, as_of=args.as_of
        )


if __name__ == "__main__":
    main()
