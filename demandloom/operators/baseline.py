"""Accuracy and stock cover of the forecast that came with the data.

Rows are reduced to (date, product) totals first; everything after that works on those, and the
rolling windows on one row per date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import ratio, total

ROLLING_ROWS = 30


def rolling(rows: int = ROLLING_ROWS) -> WindowSpec:
    """The current and the previous dates, counted in dates that occur.

    Not partitioned: it is for tables with one row per date.
    """
    return Window.orderBy("date").rowsBetween(-(rows - 1), 0)


def daily_product_totals(df: DataFrame, forecast: str = "demand_forecast") -> DataFrame:
    return (
        df.where(F.col("date").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("date", "product_id")
        .agg(
            total(F.col("units_sold")).alias("units"),
            total(F.col(forecast)).alias("forecast"),
            total(F.col("inventory_level")).alias("inventory"),
        )
    )


def ape(units: Column, forecast: Column) -> Column:
    """Absolute error as a share of the units, missing when none were sold."""
    return ratio(F.abs(units - forecast), units)


def ape_by_product_day(totals: DataFrame) -> DataFrame:
    return totals.withColumn("ape", ape(F.col("units"), F.col("forecast")))


def daily_mape(totals: DataFrame) -> DataFrame:
    return ape_by_product_day(totals).groupBy("date").agg(F.avg("ape").alias("mape"))


def rolling_mape(totals: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    return daily_mape(totals).select(
        "date", (F.avg("mape").over(rolling(rows)) * 100.0).alias("rolling_mape")
    )


def daily_dii(totals: DataFrame) -> DataFrame:
    """Days of inventory per date: total inventory over total units."""
    return (
        totals.groupBy("date")
        .agg(F.sum("units").alias("units"), F.sum("inventory").alias("inventory"))
        .withColumn("dii", ratio(F.col("inventory"), F.col("units")))
    )


def rolling_dii(totals: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    return daily_dii(totals).select("date", F.avg("dii").over(rolling(rows)).alias("rolling_dii"))


def baseline_kpis(totals: DataFrame) -> DataFrame:
    """One row: mean of the daily mean errors in percent, and mean inventory over mean units."""
    daily = (
        ape_by_product_day(totals)
        .groupBy("date")
        .agg(
            F.avg("ape").alias("mape"),
            F.sum("units").alias("units"),
            F.sum("inventory").alias("inventory"),
        )
    )
    return daily.agg(
        (F.avg("mape") * 100.0).alias("mape_overall"),
        ratio(F.avg("inventory"), F.avg("units")).alias("dii_average"),
    )


def scatter_baseline(totals: DataFrame) -> DataFrame:
    """Forecast against units per (date, product), with the common upper end of both axes."""
    limit = totals.agg(F.greatest(F.max("forecast"), F.max("units")).alias("axis_limit"))
    return totals.select("date", "product_id", "forecast", "units").crossJoin(F.broadcast(limit))
