"""One query per operator over the star-schema tables.

Every query reads whole tables.  Numbers are rounded to six decimals at the very end, so that they
can be compared with another engine whose sums run in another order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import is_finite, parse_number
from ..operators import baseline as B
from ..operators import cleaning as C
from ..operators import features as X
from ..operators import kpi as K
from ..operators import latest as L
from ..operators import model as M
from ..operators import profile as P
from ..operators import records as R
from ..operators import results as S
from ..operators import split as T
from ..operators import versions as V
from ..schema import (
    CATEGORICAL,
    ENGINE_TO_RAW,
    HISTORY,
    IMPUTED,
    NUMERIC,
    RAW_TO_ENGINE,
    RESULT_COLUMNS,
    SERIES,
)
from ..sources import files
from ..sources.scratch import new_folder, written
from ..sources.star import LINE_KEY, SALES_COLUMNS, TIE_BREAK, sales, sales_raw

#: Text that a query writes and reads: a file is read by one task, so its rows are bounded.
TEXT_FILES = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER = C.canonical_order(TIE_BREAK)
TOP_K = 3
STORE = "S001"
AS_OF = "2022-01-01"
# The job's own rounds, step and patience.
TRAINING = M.BoostParams(indexed=("product_id", "category"))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def six(df: DataFrame) -> DataFrame:
    """Round the fractional columns to six decimals, half to even."""
    return df.select(
        *(
            (F.rint(F.col(c) * 1e6) / 1e6).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        )
    )


_MEASURES = ("units_sold", "inventory_level", "demand_forecast", "model_forecast")
_RESULT_INPUT = ("date", *SERIES, "category", "price", "seasonality", *_MEASURES)


def results(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    return S.compile_results(sales(spark, sf_dir, *_RESULT_INPUT), "model_forecast", keep)


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result rows as far as the indicators need them: no column of a dimension."""
    rows = sales(spark, sf_dir, "date", "seasonality", *_MEASURES).select(
        "date",
        F.col("seasonality").alias("season"),
        *(c for c in _MEASURES if c != "demand_forecast"),
        F.col("demand_forecast").alias("baseline_forecast"),
    )
    return S.stockout_flags(S.forecast_errors(rows))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.daily_product_totals(sales(spark, sf_dir, "date", "product_id", *_MEASURES))


def split(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = sales(spark, sf_dir, "date", *SERIES, "units_sold", *columns)
    return T.positional_split(rows, ties=TIE_BREAK)


# Scans, sources, sinks


@query
def csv_scan(spark, sf_dir):
    path = new_folder(spark, "raw-csv")
    files.write_raw_csv(sales_raw(spark, sf_dir), path)
    rows = files.read_raw_csv(spark, path)
    fractions = ("price", "discount", "competitor_pricing")
    return rows.select(
        *(F.col(c).cast("bigint").alias(c) for c in LINE_KEY),
        *(
            (parse_number(F.col(c)) if c in fractions else F.col(c)).alias(c)
            for c in RAW_TO_ENGINE.values()
        ),
    )


@query
def csv_rejects(spark, sf_dir):
    """Rows by what is wrong with their line, with the units of those that fit the header.

    Some lines lose their last cell, some get one more, and in some a quote is not closed.
    """
    path = new_folder(spark, "malformed-csv")
    rows = sales_raw(spark, sf_dir)
    raw = rows.select(
        *(F.regexp_replace(F.col(c).cast("string"), '[",\n]', "").alias(c) for c in rows.columns)
    ).toDF(*(ENGINE_TO_RAW.get(c, c) for c in rows.columns))
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw.columns]
    key = F.col("l_orderkey").cast("bigint") % 7
    line = (
        F.when(key == 1, F.concat_ws(",", *cells[:-1]))
        .when(key == 2, F.concat_ws(",", *cells, F.lit("more")))
        .when(key == 3, F.concat_ws(",", *cells[:-2], F.concat(F.lit('"'), cells[-2]), cells[-1]))
        .otherwise(F.concat_ws(",", *cells))
    )
    # Lines are written as they stand: neither character occurs in them.
    raw.select(line.alias(",".join(raw.columns))).write.options(
        header=True, sep="\x01", quote="\x02", ignoreTrailingWhiteSpace=False, **TEXT_FILES
    ).csv(path)
    parsed = written(C.coerce_numeric(files.read_raw_csv(spark, path, places=True, rejects=True)), "parsed")
    rejects = files.rejected_rows(parsed, len(raw.columns)).groupBy("reason").agg(F.count("*").alias("n"))
    good = parsed.where(F.col(files.REJECT).isNull()).agg(F.count("*").alias("n"), F.sum("units_sold").alias("units"))
    return rejects.select("reason", "n", F.lit(None).cast("double").alias("units")).unionByName(
        good.select(F.lit("none").alias("reason"), "n", "units")
    )


@query
def profile_columns(spark, sf_dir):
    rows = C.coerce_numeric(sales_raw(spark, sf_dir))
    return P.profile_columns(rows)


@query
def preview_rows(spark, sf_dir):
    return six(P.preview_rows(sales(spark, sf_dir), ORDER))


@query
def null_counts(spark, sf_dir):
    return P.null_counts(C.coerce_numeric(sales_raw(spark, sf_dir)), NUMERIC)


@query
def detail_sink_roundtrip(spark, sf_dir):
    path = new_folder(spark, "detail-csv")
    files.write_report_csv(results(spark, sf_dir), path)
    return six(files.read_detail_report(spark, path))


@query
def detail_days_replaced(spark, sf_dir):
    """The detail table, dated by month, after every July came in again with other prices."""
    path = new_folder(spark, "detail")
    rows = results(spark, sf_dir).withColumn("date", F.trunc("date", "month"))
    files.write_detail_table(rows, path)
    late = rows.where(F.month("date") == 7).withColumn("price", F.col("price") + 1)
    files.write_detail_table(late, path, dates_only=True)
    return six(files.read_detail_table(spark, path))


@query
def season_sink_roundtrip(spark, sf_dir):
    path = new_folder(spark, "season-csv")
    files.write_report_csv(season_summary(spark, sf_dir), path)
    return files.read_season_report(spark, path)


@query
def report_detail(spark, sf_dir):
    path = new_folder(spark, "detail-csv")
    files.write_report_csv(results(spark, sf_dir), path)
    return six(files.detail_report(files.read_detail_report(spark, path)))


@query
def report_season(spark, sf_dir):
    return season_sink_roundtrip(spark, sf_dir)


@query
def records_from_json(spark, sf_dir):
    path = new_folder(spark, "records-json")
    rows = sales(spark, sf_dir, *RAW_TO_ENGINE.values())
    raw = rows.select(*LINE_KEY, *(F.col(c).alias(ENGINE_TO_RAW[c]) for c in RAW_TO_ENGINE.values()))
    raw.write.options(**TEXT_FILES).json(path)
    return six(R.normalize_aliases(files.read_json_records(spark, path, raw.schema)))


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry file with one version per month of sales, read back."""
    error = F.col("units_sold") - F.col("model_forecast")
    month = F.date_format("date", "yyyyMM")
    version = F.concat(F.lit("v"), F.col("month"), F.lit("01000000"))
    monthly = (
        sales(spark, sf_dir, "date", "units_sold", "model_forecast")
        .groupBy(month.alias("month"))
        .agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))
        .select(
            F.struct(
                version.alias("version"),
                F.concat("month", F.lit("-saved")).alias("saved_at"),
                F.struct("mae", "rmse").alias("metrics"),
                F.concat(F.lit("models/"), version).alias("model_path"),
            ).alias("entry")
        )
    )
    one = monthly.agg(
        F.sort_array(F.collect_list("entry")).alias("versions"),
        F.max("entry.version").alias("current"),
    )
    path = new_folder(spark, "registry")
    one.select(F.lit("v1.0").alias("version"), "versions", "current").write.json(path)
    return files.read_registry(spark, path)


@query
def registry_scan(spark, sf_dir):
    return six(files.registry_versions(_registry(spark, sf_dir)))


# Cleaning, projections, filters


@query
def coerce_numeric(spark, sf_dir):
    return six(C.coerce_numeric(sales_raw(spark, sf_dir)).select(*LINE_KEY, *NUMERIC))


@query
def drop_missing_target(spark, sf_dir):
    rows = C.drop_missing_target(C.coerce_numeric(sales_raw(spark, sf_dir)))
    return rows.select(*LINE_KEY, "units_sold")


@query
def impute_median(spark, sf_dir):
    rows = written(C.drop_missing_target(C.coerce_numeric(sales_raw(spark, sf_dir))), "typed")
    return six(C.impute_median(rows).select(*LINE_KEY, *IMPUTED))


@query
def parse_dates(spark, sf_dir):
    return C.parse_dates(sales_raw(spark, sf_dir)).select(*LINE_KEY, "date")


@query
def clean_sales(spark, sf_dir):
    return six(C.clean_sales(sales_raw(spark, sf_dir)))


@query
def normalize_aliases(spark, sf_dir):
    """Two spellings of the store, each filled on other lines, and one spelling of the rest."""
    rows = sales(spark, sf_dir, *SERIES, "units_sold")
    odd = F.col("l_linenumber") % 2 == 1
    spelled = rows.select(
        *LINE_KEY,
        F.when(odd, F.col("store_id")).alias("Store"),
        F.when(~odd, F.col("store_id")).alias("StoreID"),
        F.col("product_id").alias("ProductID"),
        F.col("units_sold").alias("Units"),
    )
    return R.normalize_aliases(spelled)


@query
def default_columns(spark, sf_dir):
    """Records as text maps in which lines leave out or spell fields differently."""
    rows = sales(spark, sf_dir, "date", *SERIES, "units_sold", "region", "price")
    n = F.col("l_linenumber")

    def cell(given: Column, column: str) -> Column:
        return F.when(given, F.col(column).cast("string"))

    record = F.map_filter(
        F.create_map(
            F.when(n == 2, "store").otherwise("Store ID"),
            cell(n != 1, "store_id"),
            F.when(n == 2, "product").otherwise("Product"),
            cell(n != 3, "product_id"),
            F.lit("Units_Sold"),
            cell(n != 4, "units_sold"),
            F.lit("Date"),
            cell(n != 5, "date"),
            F.lit("Region"),
            cell(n != 6, "region"),
        ),
        lambda name, value: value.isNotNull(),
    )
    typed = R.typed_records(rows.select(*LINE_KEY, record.alias("record")), AS_OF)
    return typed.select(*LINE_KEY, "date", *SERIES, "units_sold", "region", "price")


@query
def ensure_model_columns(spark, sf_dir):
    rows = sales(spark, sf_dir, "store_id", "units_sold", "discount")
    return six(R.ensure_model_columns(rows, ["store_id", "region"], ["discount", "price"]))


@query
def results_detail(spark, sf_dir):
    return six(results(spark, sf_dir, LINE_KEY))


@query
def forecast_errors(spark, sf_dir):
    rows = sales(spark, sf_dir, "units_sold", "demand_forecast", "model_forecast")
    return S.forecast_errors(rows.withColumnRenamed("demand_forecast", "baseline_forecast"))


@query
def stockout_flags(spark, sf_dir):
    rows = sales(spark, sf_dir, *_MEASURES)
    return S.stockout_flags(rows.withColumnRenamed("demand_forecast", "baseline_forecast"))


def newest_rows(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """The result rows of the latest day, which the fact alone tells."""
    newest = sales(spark, sf_dir, "date").agg(F.max("date")).first()[0]
    return L.latest_day(results(spark, sf_dir, keep), newest)


@query
def latest_day(spark, sf_dir):
    return six(newest_rows(spark, sf_dir, LINE_KEY))


@query
def store_options(spark, sf_dir):
    return L.store_options(sales(spark, sf_dir, "store_id"))


@query
def store_drilldown(spark, sf_dir):
    return L.store_drilldown(sales(spark, sf_dir, "date", *SERIES, *_MEASURES), STORE)


# Aggregations


@query
def daily_product_totals(spark, sf_dir):
    return totals(spark, sf_dir)


@query
def ape_by_product_day(spark, sf_dir):
    return six(B.ape_by_product_day(totals(spark, sf_dir)).select("date", "product_id", "ape"))


@query
def daily_mape(spark, sf_dir):
    return six(B.daily_mape(totals(spark, sf_dir)))


@query
def baseline_kpis(spark, sf_dir):
    return six(B.baseline_kpis(totals(spark, sf_dir)))


@query
def daily_dii(spark, sf_dir):
    return six(B.daily_dii(totals(spark, sf_dir)))


@query
def scatter_baseline(spark, sf_dir):
    return B.scatter_baseline(totals(spark, sf_dir))


@query
def daily_demand_compare(spark, sf_dir):
    return K.daily_demand_compare(K.result_facts(fact_rows(spark, sf_dir), "date"))


@query
def season_summary(spark, sf_dir):
    return K.season_summary(K.result_facts(fact_rows(spark, sf_dir), "season"))


@query
def global_model_compare(spark, sf_dir):
    return K.global_model_compare(K.result_facts(fact_rows(spark, sf_dir)))


@query
def daily_dii_compare(spark, sf_dir):
    return six(K.daily_dii_compare(K.result_facts(fact_rows(spark, sf_dir), "date")))


@query
def daily_overstock(spark, sf_dir):
    return six(K.daily_overstock(K.result_facts(fact_rows(spark, sf_dir), "date")))


@query
def overstock_summary(spark, sf_dir):
    return six(K.overstock_summary(K.result_facts(fact_rows(spark, sf_dir))))


@query
def overstock_indicator_table(spark, sf_dir):
    return K.overstock_indicator_table(K.result_facts(fact_rows(spark, sf_dir)))


@query
def daily_precision(spark, sf_dir):
    return six(K.daily_precision(K.result_facts(fact_rows(spark, sf_dir), "date")))


@query
def kpi_summary(spark, sf_dir):
    return six(L.kpi_summary(newest_rows(spark, sf_dir)))


@query
def category_forecast(spark, sf_dir):
    return L.category_forecast(newest_rows(spark, sf_dir))


@query
def stockout_risk(spark, sf_dir):
    return L.stockout_risk(newest_rows(spark, sf_dir, LINE_KEY), LINE_KEY)


@query
def overstock_list(spark, sf_dir):
    return six(L.overstock_list(newest_rows(spark, sf_dir, LINE_KEY), LINE_KEY))


@query
def latest_predictions(spark, sf_dir):
    day = newest_rows(spark, sf_dir, LINE_KEY)
    return six(L.latest_predictions(day, TIE_BREAK, TOP_K))


@query
def detail_preview(spark, sf_dir):
    rest = [c for c in RESULT_COLUMNS if c not in ("date", *SERIES)]
    return six(files.first_rows(results(spark, sf_dir), 10, ["date", *SERIES, *rest]))


# Windows


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "date", *SERIES, "units_sold")
    return X.demand_features(rows, ties=TIE_BREAK)


@query
def calendar_features(spark, sf_dir):
    return X.calendar_features(sales(spark, sf_dir, "date"))


@query
def lag_features(spark, sf_dir):
    rows = sales(spark, sf_dir, "date", *SERIES, "units_sold")
    return X.history_features(rows, order=["date", *TIE_BREAK], trailing=None)


@query
def trailing_mean_7(spark, sf_dir):
    rows = sales(spark, sf_dir, "date", *SERIES, "units_sold")
    return six(X.history_features(rows, order=["date", *TIE_BREAK], lags=()))


@query
def demand_features(spark, sf_dir):
    return six(_features(spark, sf_dir))


@query
def rolling_mape_30(spark, sf_dir):
    return six(B.rolling_mape(totals(spark, sf_dir)))


@query
def rolling_dii_30(spark, sf_dir):
    return six(B.rolling_dii(totals(spark, sf_dir)))


@query
def rolling_dii_compare_30(spark, sf_dir):
    return six(K.rolling_dii_compare(K.result_facts(fact_rows(spark, sf_dir), "date")))


# Model


@query
def positional_split(spark, sf_dir):
    return split(spark, sf_dir).select(*LINE_KEY, "store_id", "units_sold", "is_test")


@query
def onehot_counts(spark, sf_dir):
    rows = split(spark, sf_dir, *CATEGORICAL).where(~F.col("is_test"))
    # Read by the fit and by the counting.
    train = written(rows.select(*CATEGORICAL), "train")
    prep = M.preprocessor(train, {"categorical": list(CATEGORICAL), "numeric": []})
    return M.category_counts(prep, train, CATEGORICAL)


@query
def standardize_numeric(spark, sf_dir):
    rows = split(spark, sf_dir, *IMPUTED)
    stats = M.numeric_stats(rows.where(~F.col("is_test")), IMPUTED).collect()
    scaled = M.standardize(rows, stats)
    return six(scaled.select(*LINE_KEY, *(c for c in scaled.columns if c.endswith("_scaled"))))


@query
def holdout_metrics(spark, sf_dir):
    rows = split(spark, sf_dir, "model_forecast")
    return six(S.holdout_metrics(rows.where(F.col("is_test"))))


@query
def scatter_model(spark, sf_dir):
    rows = split(spark, sf_dir, "model_forecast").where(F.col("is_test"))
    return S.scatter_pairs(rows).select(*LINE_KEY, "actual", "predicted")


@query
def scatter_limits(spark, sf_dir):
    rows = split(spark, sf_dir, "model_forecast").where(F.col("is_test"))
    return S.scatter_limits(S.scatter_pairs(rows))


@query
def quality_gate(spark, sf_dir):
    columns = [c for c in _MEASURES if c != "units_sold"]
    rows = split(spark, sf_dir, *columns).where(F.col("is_test"))
    by_day = B.daily_product_totals(rows, "model_forecast")
    mape = B.baseline_kpis(by_day).select(F.col("mape_overall").alias("mape"))
    return six(S.quality_gate(S.holdout_metrics(rows).crossJoin(F.broadcast(mape))))


class _Trained:
    """A model trained on one scale, its feature table and its registered version."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        folder = new_folder(spark, "training")
        rows = sales(spark, sf_dir, *(c for c in SALES_COLUMNS if c != "model_forecast"))
        first = T.first_test_row(rows, ties=TIE_BREAK)
        parts = T.mark_test(X.demand_features(rows, ties=TIE_BREAK), first)
        parts.write.parquet(f"{folder}/features")
        self.rows = spark.read.parquet(f"{folder}/features")
        self.fitted = M.train_demand_model(self.rows, params=TRAINING, ignore=LINE_KEY)
        self.table = f"{folder}/model_versions"
        now = dt.datetime.now(dt.timezone.utc)
        self.version = V.version_id(now)
        path = f"{folder}/models/{self.version}"
        self.fitted.model.write().save(path)
        V.register_version(
            spark,
            self.table,
            version=self.version,
            saved_at=now,
            metrics=self.fitted.metrics,
            model_path=path,
        )


@cache
def _trained_once(application: str, sf_dir: str) -> _Trained:
    return _Trained(SparkSession.active(), sf_dir)


def trained(spark: SparkSession, sf_dir: str) -> _Trained:
    return _trained_once(spark.sparkContext.applicationId, sf_dir)


@query
def feature_matrix(spark, sf_dir):
    """Width, filled category slots, nominal indices and the sum of the scaled numbers of each row."""
    t = trained(spark, sf_dir)
    prep = M.PipelineModel(stages=t.fitted.model.stages[:-1])
    slots = vector_to_array("features")
    numbers = len(t.fitted.columns["numeric"])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    nominal = [f"{c}_index" for c in TRAINING.indexed]
    rows = prep.transform(t.rows).withColumn("v", slots)
    coded = F.slice("v", F.lit(1), F.size("v") - numbers)
    indices = sum((F.col(c) for c in nominal), F.lit(0.0))
    return six(
        rows.select(
            *LINE_KEY,
            F.size("v").alias("width"),
            (total(coded) - indices).cast("long").alias("filled"),
            *(F.col(c).cast("long").alias(c) for c in nominal),
            total(F.slice("v", F.size("v") - numbers + 1, F.lit(numbers))).alias("scaled_sum"),
        )
    )


def _against_the_mean(t: _Trained) -> DataFrame:
    """Rows on both sides, and the hold-out error of always predicting the training mean."""
    units, held = F.col("units_sold"), F.col("is_test")
    mean = t.rows.where(~held).agg(F.avg("units_sold")).first()[0]
    miss = F.when(held, units - F.lit(mean))
    return t.rows.agg(
        F.count_if(~held).alias("rows_train"),
        F.count_if(held).alias("rows_valid"),
        F.sqrt(F.avg(miss * miss)).alias("mean_rmse"),
    )


@query
def train_demand_model(spark, sf_dir):
    """What training and hold-out hold, and whether the fit is one that was stopped and has learned."""
    t = trained(spark, sf_dir)
    booster = t.fitted.model.stages[-1]
    total = float(sum(booster.featureImportances.toArray()))
    return six(
        _against_the_mean(t).withColumns(
            {
                "beats_mean": F.lit(t.fitted.metrics["rmse"]) < F.col("mean_rmse"),
                "best_round_kept": F.lit(booster.getNumTrees == t.fitted.best_round),
                "importance": F.lit(total),
            }
        )
    )


@query
def learning_curve(spark, sf_dir):
    """Whether the curve counts its rounds, marks the lowest error as best and ends by patience, or with
    the last round."""
    t = trained(spark, sf_dir)
    curve = M.learning_curve(spark, t.fitted)
    best_round = F.max(F.when(F.col("is_best"), F.col("iteration")))
    facts = curve.agg(
        (F.max("iteration") == F.count("iteration")).alias("counted"),
        (F.max(F.when(F.col("is_best"), -F.col("valid_rmse"))) == -F.min("valid_rmse")).alias("best_is_lowest"),
        (F.max("iteration") == F.least(F.lit(TRAINING.rounds), best_round + TRAINING.patience)).alias("ended_by_patience"),
        (F.min_by("train_rmse", "iteration") > F.max_by("train_rmse", "iteration")).alias("learns"),
        F.max_by("valid_rmse", "is_best").alias("best"),
    )
    joined = _against_the_mean(t).crossJoin(F.broadcast(facts))
    return six(joined.withColumn("below_mean", F.col("best") < F.col("mean_rmse")).drop("best"))


STUMPS = M.BoostParams(
    rounds=3, step=0.5, depth=1, row_share=1.0, column_share=1.0, patience=3, indexed=("seasonality",)
)


@query
def boosted_stumps(spark, sf_dir):
    """Forecasts of the best of three rounds of single cuts: by a number, slots and nominal codes."""
    inputs = ("discount", "weather_condition", "seasonality")
    rows = written(
        split(spark, sf_dir, *inputs).select(*LINE_KEY, "units_sold", *inputs, "is_test"), "stumps"
    )
    fitted = M.train_demand_model(rows, params=STUMPS, ignore=LINE_KEY)
    return six(M.score(fitted.model, rows).select(*LINE_KEY, "is_test", "prediction"))


@query
def score_all(spark, sf_dir):
    t = trained(spark, sf_dir)
    rows = S.compile_results(M.score(t.fitted.model, t.rows), keep=LINE_KEY)
    error = F.col("units_sold") - F.col("model_forecast")
    consistent = (
        (F.col("model_error") == error)
        & (F.col("model_abs_error") == F.abs(error))
        & (F.col("stockout_model") == (F.col("model_forecast") > F.col("inventory_level")))
    )
    return rows.select(
        *LINE_KEY,
        "date",
        "season",
        "units_sold",
        "inventory_level",
        "baseline_error",
        "stockout_actual",
        "stockout_baseline",
        consistent.alias("consistent"),
    )


@query
def train_score_roundtrip(spark, sf_dir):
    """The saved and loaded model against the one in memory, on every row."""
    t = trained(spark, sf_dir)
    loaded = V.load_version(spark, t.table)
    both = M.score(loaded, M.score(t.fitted.model, t.rows).withColumnRenamed("prediction", "first"))
    return both.select(
        *LINE_KEY, "units_sold", "is_test", (F.col("first") == F.col("prediction")).alias("same")
    )


@query
def score_with_version(spark, sf_dir):
    t = trained(spark, sf_dir)
    first = M.score(t.fitted.model, t.rows).withColumnRenamed("prediction", "first")
    scored = V.score_with_version(first, t.table, t.version)
    return scored.select(
        *LINE_KEY,
        "units_sold",
        (F.col("first") == F.col("prediction")).alias("same"),
        (F.col("version") == t.version).alias("served"),
    )


# Record batches, versions


@query
def request_features(spark, sf_dir):
    """One upload per date, its records in order of their order number."""
    rows = sales(spark, sf_dir, "date", *SERIES, "units_sold").withColumn("upload", F.col("date"))
    return six(
        R.request_features(rows, batch_keys=["upload"], position="l_orderkey", ties=TIE_BREAK[1:])
    ).drop("upload")


@query
def score_records(spark, sf_dir):
    """Each record with the number of records of its upload, and whether it got a forecast."""
    rows = sales(spark, sf_dir, *(c for c in RAW_TO_ENGINE.values() if c != "region"))
    t = trained(spark, sf_dir)
    scored = R.score_records(
        rows.withColumn("upload", F.col("date")),
        t.fitted.model,
        as_of=AS_OF,
        batch_keys=["upload"],
        position="l_orderkey",
        ties=TIE_BREAK[1:],
        **t.fitted.columns,
    )
    return scored.select(
        *LINE_KEY,
        *SERIES,
        "date",
        F.count("prediction").over(Window.partitionBy("upload")).alias("n"),
        is_finite(F.col("prediction")).alias("predicted"),
    )


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per date.  On the 7th bodies are broken, on the 8th empty; in even months no
    record has a price, in odd ones those of first lines have none."""
    rows = sales(spark, sf_dir, "date", *SERIES, "units_sold", "price")
    priced = (F.month("date") % 2 == 1) & (F.col("l_linenumber") != 1)
    record = F.struct(
        *LINE_KEY,
        F.col("store_id").alias("Store"),
        F.col("product_id").alias("Product"),
        F.col("units_sold").alias("Units"),
        F.when(priced, F.col("price")).alias("Price"),
    )
    body = F.to_json(F.struct(F.sort_array(F.collect_list(record)).alias("records")))
    day = F.dayofmonth("date")
    return rows.groupBy("date").agg(body.alias("body")).select(
        F.date_format("date", "yyyy-MM-dd").alias("request_id"),
        F.when(day == 7, '{"records": [').when(day == 8, '{"records": []}').otherwise(F.col("body")).alias("body"),
    )


@query
def score_requests(spark, sf_dir):
    """Each request with its error or its number of records, forecasts, known prices and units."""
    bodies = written(request_bodies(spark, sf_dir), "bodies")
    rows = written(R.request_rows(bodies, as_of=AS_OF), "request_rows")
    typed = rows.groupBy("request_id").agg(
        F.count("price").alias("prices"), F.sum("units_sold").alias("units"), F.min("date").alias("first_day")
    )
    t = trained(spark, sf_dir)
    scored = R.score_request_rows(rows, t.fitted.model, ["request_id"])
    forecasts = scored.groupBy("request_id").agg(F.count("prediction").alias("forecasts"))
    return (
        R.request_report(bodies)
        .join(typed, "request_id", "left")
        .join(forecasts, "request_id", "left")
        .select("request_id", F.col("n").cast("long").alias("n"), "error", "prices", "units", "first_day", "forecasts")
    )


@query
def version_history(spark, sf_dir):
    return six(V.version_history(files.registry_versions(_registry(spark, sf_dir))))
