"""The batch pipeline: raw file to model, result detail and indicator tables.

Tables that several steps read are written once and read back, so no step recomputes the steps
before it and an executor that is lost costs the work of its tasks only:

* `parsed`: the text as numbers (profile, missing and row counts come along with its write;
  medians need passes of their own over it);
* `rejects`: rows whose cells do not fit the header, with file and line;
* `features`: cleaned rows with features, read by the split, the fit and the scoring;
* `daily_product_totals`: all baseline indicators;
* `detail`: scored rows, one folder per date, so the latest-day tables read one folder;
* `facts`: sums and counts by (date, season), from one pass over the detail; every other
  indicator is derived from this small table.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import baseline as B
from ..operators import kpi as K
from ..operators import latest as L
from ..operators.cleaning import clean_typed, coerce_numeric, drop_missing_target
from ..operators.features import demand_features
from ..operators.model import BoostParams, Fitted, learning_curve, score, train_demand_model
from ..operators.profile import Observed
from ..operators.results import (
    compile_results,
    holdout_metrics,
    quality_gate,
    scatter_limits,
    scatter_pairs,
)
from ..operators.split import first_test_row, mark_test
from ..schema import NUMERIC, RAW_TO_ENGINE, SERIES, require
from ..sources import files

ROWS_ID = ("date", *SERIES)


@dataclass
class PipelineRun:
    fitted: Fitted
    folder: str
    tables: list[str] = field(default_factory=list)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        if name == "detail":
            return files.read_detail_table(spark, f"{self.folder}/detail")
        return spark.read.parquet(f"{self.folder}/{name}")


def run_pipeline(
    spark: SparkSession,
    source: str,
    folder: str,
    *,
    params: BoostParams = BoostParams(),
    row_key: Sequence[str] = (),
    date_format: str | None = None,
    csv_detail: bool = True,
    max_rejects: int = 0,
) -> PipelineRun:
    """Run all steps on a raw CSV and write every table below `folder`.

    Rows of one series and date are taken in the order of `row_key`, then in the order of the file;
    neither is a model input.  `date_format` is the form of the dates, by default year-month-day; if
    no date of the file has it, that is an error.  Rows whose cells do not fit the header go to the
    table `rejects`, and more than `max_rejects` of them are an error.
    """
    tables: list[str] = []

    def write(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        tables.append(name)
        return spark.read.parquet(f"{folder}/{name}")

    raw = files.read_raw_csv(spark, source, places=True, rejects=True)
    require(raw.columns, RAW_TO_ENGINE.values())
    cells = [c for c in raw.columns if c not in (*files.PLACE_COLUMNS, files.REJECT)]
    write("preview", raw.where(F.col(files.REJECT).isNull()).select(cells).limit(5))
    seen = Observed(coerce_numeric(raw), cells, F.col(files.REJECT).isNull())
    parsed = write("parsed", seen.df)
    write("profile", seen.profile(spark))
    write("missing", seen.null_counts(spark, NUMERIC))
    write("rejects", files.rejected_rows(parsed, len(cells)))
    if seen.left_out > max_rejects:
        raise ValueError(f"{seen.left_out} rows do not fit the header, see {folder}/rejects")
    parsed = parsed.where(F.col(files.REJECT).isNull()).drop(files.REJECT)
    clean = files.with_row_numbers(clean_typed(parsed, date_format))

    ties = [*row_key, files.ROW_NUMBER]
    features = write("features", demand_features(clean, ties=ties))
    if features.isEmpty() and not drop_missing_target(parsed).isEmpty():
        raise ValueError(f"no date has the form {date_format or 'year-month-day'}")

    totals = write("daily_product_totals", B.daily_product_totals(features))
    write("rolling_mape", B.rolling_mape(totals))
    write("rolling_dii", B.rolling_dii(totals))
    write("baseline_kpis", B.baseline_kpis(totals))
    write("scatter_baseline", B.scatter_baseline(totals))

    first = first_test_row(features, ties=ties)
    split = mark_test(features, first)
    fitted = train_demand_model(split, params=params, ignore=ties)
    write("learning_curve", learning_curve(spark, fitted))

    results = compile_results(score(fitted.model, split), keep=["is_test"])
    files.write_detail_table(results, f"{folder}/detail")
    tables.append("detail")
    detail = files.read_detail_table(spark, f"{folder}/detail", extra=["is_test"])

    held_out = detail.where("is_test")
    pairs = scatter_pairs(held_out.select(*ROWS_ID, "units_sold", "model_forecast"))
    pairs = write("scatter_model", pairs)
    write("scatter_limits", scatter_limits(pairs))
    by_day = B.daily_product_totals(held_out, "model_forecast")
    mape = B.baseline_kpis(by_day).select(F.col("mape_overall").alias("mape"))
    write("quality_gate", quality_gate(holdout_metrics(held_out).crossJoin(F.broadcast(mape))))

    facts = write("facts", K.result_facts(detail, "date", "season"))
    season = K.season_summary(facts)
    write("season_summary", season)
    write("global_model_compare", K.global_model_compare(facts))
    write("daily_demand_compare", K.daily_demand_compare(facts))
    write("rolling_dii_compare", K.rolling_dii_compare(facts))
    write("daily_overstock", K.daily_overstock(facts))
    write("daily_precision", K.daily_precision(facts))
    write("overstock_indicators", K.overstock_indicator_table(facts))

    newest = facts.agg(F.max("date")).first()[0]
    day = write("latest_day", L.latest_day(detail, newest))
    write("kpi_summary", L.kpi_summary(day))
    write("stockout_risk", L.stockout_risk(day, SERIES))
    write("overstock_list", L.overstock_list(day, SERIES))
    write("latest_predictions", L.latest_predictions(day))
    write("category_forecast", L.category_forecast(day))

    files.write_report_csv(season, f"{folder}/reports/season")
    if csv_detail:
        files.write_report_csv(detail.drop("is_test"), f"{folder}/reports/detail")
    return PipelineRun(fitted, folder, tables)


def source_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--row-key", nargs="*", default=[])
    parser.add_argument("--date-format", help="form of the dates, such as d/M/yyyy")
    parser.add_argument("--max-rejects", type=int, default=0, help="malformed rows that are borne")


def boost_arguments(parser: argparse.ArgumentParser) -> None:
    default = BoostParams()
    parser.add_argument("--rounds", type=int, default=default.rounds)
    parser.add_argument("--step", type=float, default=default.step)
    parser.add_argument("--depth", type=int, default=default.depth)
    parser.add_argument("--patience", type=int, default=default.patience)


def boost_params(args: argparse.Namespace) -> BoostParams:
    return BoostParams(
        rounds=args.rounds, step=args.step, depth=args.depth, patience=args.patience
    )


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the demand pipeline on a raw CSV.")
    parser.add_argument("--source", required=True)
    parser.add_argument("--out", required=True)
    source_arguments(parser)
    boost_arguments(parser)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("demand-pipeline").getOrCreate()
    run = run_pipeline(
        spark,
        args.source,
        args.out,
        params=boost_params(args),
        row_key=args.row_key,
        date_format=args.date_format,
        max_rejects=args.max_rejects,
    )
    print(f"mae {run.fitted.metrics['mae']:.4f} rmse {run.fitted.metrics['rmse']:.4f}")


if __name__ == "__main__":
    main()
