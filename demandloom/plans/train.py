"""Training job: run the pipeline, save the model under a new version, register it."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..operators.model import BoostParams
from ..operators.versions import (
    new_version,
    read_versions,
    recover_versions,
    register_version,
    table_versions,
    version_history,
)
from .pipeline import boost_arguments, boost_params, run_pipeline, source_arguments


def train_version(
    spark: SparkSession,
    source: str,
    models: str,
    *,
    params: BoostParams = BoostParams(),
    row_key: Sequence[str] = (),
    date_format: str | None = None,
    max_rejects: int = 0,
) -> str:
    """Train on a raw CSV and return the version.

    Below `models` each version has a folder with its tables and its model, which nothing
    overwrites.  The version exists from the moment its manifest is written, which is the last step
    but listing it: `models/model_versions` gets a row.  The history up to this version goes into
    its folder.
    """
    version, folder = new_version(spark, models, dt.datetime.now(dt.timezone.utc))
    run = run_pipeline(
        spark,
        source,
        f"{folder}/tables",
        params=params,
        row_key=row_key,
        date_format=date_format,
        max_rejects=max_rejects,
    )
    path = f"{folder}/model"
    run.fitted.model.write().save(path)
    recover_versions(spark, models, f"{models}/model_versions")
    register_version(
        spark,
        f"{models}/model_versions",
        version=version,
        saved_at=dt.datetime.now(dt.timezone.utc),
        metrics=run.fitted.metrics,
        model_path=path,
    )
    history = version_history(table_versions(read_versions(spark, f"{models}/model_versions")))
    history.write.mode("overwrite").parquet(f"{folder}/version_history")
    return version


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train and register a model version.")
    parser.add_argument("--source", required=True)
    parser.add_argument("--models", required=True)
    source_arguments(parser)
    boost_arguments(parser)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("demand-train").getOrCreate()
    print(
        train_version(
            spark,
            args.source,
            args.models,
            params=boost_params(args),
            row_key=args.row_key,
            date_format=args.date_format,
            max_rejects=args.max_rejects,
        )
    )


if __name__ == "__main__":
    main()
