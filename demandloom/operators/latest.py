"""Tables of the most recent day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import above, at_least_zero, total
from ..schema import require

TOP_PER_STORE = 20


def latest_day(df: DataFrame, newest: dt.date | None = None) -> DataFrame:
    """The rows of the greatest date, which a caller may know from a smaller table.

    If not, the date is a scalar subquery, which runs before the scan: a detail table written in one
    folder per date is pruned to the folder of that day, other files to the row groups that
    reach it.
    """
    day = df.agg(F.max("date")).scalar() if newest is None else F.lit(newest)
    return df.where(F.col("date") == day)


def _overstock(day: DataFrame) -> DataFrame:
    units = at_least_zero(F.col("inventory_level") - F.col("model_forecast"))
    return day.withColumn("locked_capital", units * F.col("price"))


def kpi_summary(day: DataFrame) -> DataFrame:
    """One row for the day: date text, rows at risk, total forecast, locked-up capital."""
    at_risk = above(F.col("model_forecast"), F.col("inventory_level"))
    return _overstock(day).agg(
        F.coalesce(F.date_format(F.max("date"), "yyyy-MM-dd"), F.lit("")).alias("day"),
        F.count_if(at_risk).alias("rows_at_risk"),
        total(F.col("model_forecast")).alias("forecast_units"),
        total(F.col("locked_capital")).alias("locked_capital"),
    )


def stockout_risk(day: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Rows whose forecast exceeds the inventory, the largest shortage first."""
    shortage = F.col("model_forecast") - F.col("inventory_level")
    return (
        day.where(F.col("model_forecast") > F.col("inventory_level"))
        .withColumn("shortage", shortage)
        .orderBy(F.col("shortage").desc_nulls_last(), "product_id", *ties)
        .select(
            "product_id",
            "category",
            "inventory_level",
            F.col("model_forecast").alias("forecast"),
            "shortage",
        )
    )


def overstock_list(day: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Rows with capital locked in stock above the forecast, the largest first."""
    return (
        _overstock(day)
        .where(F.col("locked_capital") > 0)
        .orderBy(F.col("locked_capital").desc_nulls_last(), "product_id", *ties)
        .select(
            "product_id",
            "category",
            "inventory_level",
            F.col("model_forecast").alias("forecast"),
            "locked_capital",
        )
    )


def latest_predictions(
    day: DataFrame, ties: Sequence[str] = (), k: int = TOP_PER_STORE
) -> DataFrame:
    """Per store the k rows with the highest forecast, with a risk label.

    Each task keeps k rows per store before anything is shuffled, so a store with most of the
    rows costs no more than another.
    """
    require(day.columns, ["store_id"])
    forecast, stock = F.col("model_forecast"), F.col("inventory_level")
    labelled = day.where(F.col("store_id").isNotNull()).withColumns(
        {
            "shortage": at_least_zero(forecast - stock),
            "at_risk": F.when(above(forecast, stock), "Sí").otherwise("No"),
        }
    )
    order = [forecast.desc_nulls_last(), F.col("product_id"), *(F.col(c) for c in ties)]
    ranked = labelled.withColumn(
        "rank", F.row_number().over(Window.partitionBy("store_id").orderBy(*order))
    )
    shown = [
        "store_id",
        "product_id",
        "category",
        "inventory_level",
        "model_forecast",
        "baseline_forecast",
        "units_sold",
        "price",
        "at_risk",
        "shortage",
    ]
    return (
        ranked.where(F.col("rank") <= k)
        .orderBy("store_id", "rank")
        .select(*(c for c in shown if c in ranked.columns))
    )


def category_forecast(day: DataFrame) -> DataFrame:
    """Total forecast per category, the largest first."""
    return (
        day.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(total(F.col("model_forecast")).alias("forecast_units"))
        .orderBy(F.col("forecast_units").desc_nulls_last(), "category")
    )


def store_options(df: DataFrame) -> DataFrame:
    """The stores that occur, as text, sorted."""
    return (
        df.select(F.col("store_id").cast("string").alias("store_id"))
        .where(F.col("store_id").isNotNull())
        .distinct()
        .orderBy("store_id")
    )


def store_drilldown(df: DataFrame, store: str | None = None) -> DataFrame:
    """The rows of one store, or all rows."""
    return df if store is None else df.where(F.col("store_id").cast("string") == store)
