"""Row-level results: forecasts, errors, stock-out flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import above, is_finite
from ..schema import RESULT_COLUMNS, require

_NEEDED = (
    "date",
    "store_id",
    "product_id",
    "inventory_level",
    "units_sold",
    "price",
    "category",
    "seasonality",
    "demand_forecast",
)


def _errors(actual: Column, forecast: Column, name: str) -> dict[str, Column]:
    error = actual - forecast
    return {
        f"{name}_error": error,
        f"{name}_abs_error": F.abs(error),
        f"{name}_sq_error": error * error,
    }


def forecast_errors(df: DataFrame) -> DataFrame:
    """Error, absolute error and squared error of the model and of the baseline."""
    units = F.col("units_sold")
    return df.withColumns(
        {
            **_errors(units, F.col("model_forecast"), "model"),
            **_errors(units, F.col("baseline_forecast"), "baseline"),
        }
    )


def stockout_flags(df: DataFrame) -> DataFrame:
    """Whether units, model forecast and baseline forecast exceed the inventory."""
    stock = F.col("inventory_level")
    return df.withColumns(
        {
            "stockout_actual": above(F.col("units_sold"), stock),
            "stockout_model": above(F.col("model_forecast"), stock),
            "stockout_baseline": above(F.col("baseline_forecast"), stock),
        }
    )


def compile_results(
    df: DataFrame, prediction: str = "prediction", keep: Sequence[str] = ()
) -> DataFrame:
    """The result detail of scored rows, `keep` columns in front.

    The forecast is a column of the same row, so nothing has to be lined up by position.  No order
    is imposed here: writers sort within their partitions, and readers that page sort a page.
    """
    require(df.columns, [*_NEEDED, prediction])
    renamed = df.where(F.col("date").isNotNull()).select(
        *keep,
        "date",
        "store_id",
        "product_id",
        "category",
        "price",
        F.col("seasonality").alias("season"),
        "inventory_level",
        "units_sold",
        F.col("demand_forecast").alias("baseline_forecast"),
        F.col(prediction).alias("model_forecast"),
    )
    return stockout_flags(forecast_errors(renamed)).select(*keep, *RESULT_COLUMNS)


def holdout_metrics(df: DataFrame, actual: str = "units_sold", forecast: str = "model_forecast"):
    """One row: mean absolute error and root mean squared error."""
    error = F.col(actual) - F.col(forecast)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def scatter_pairs(
    df: DataFrame, actual: str = "units_sold", forecast: str = "model_forecast"
) -> DataFrame:
    """Rows whose two values are both finite numbers, as (actual, predicted)."""
    a, f = F.col(actual), F.col(forecast)
    return df.where(is_finite(a) & is_finite(f)).select(
        *(c for c in df.columns if c not in (actual, forecast)),
        a.alias("actual"),
        f.alias("predicted"),
    )


def scatter_limits(pairs: DataFrame) -> DataFrame:
    """One row: the lower end (at most 0) and the upper end of both axes."""
    return pairs.agg(
        F.least(F.min("actual"), F.min("predicted"), F.lit(0.0)).alias("axis_min"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("axis_max"),
    )


def quality_gate(
    metrics: DataFrame, *, rmse: float = 30.0, mae: float = 20.0, mape: float = 20.0
) -> DataFrame:
    """Whether the `mae`, `rmse` and `mape` (percent) of one row keep their thresholds."""
    checks = {"mae_ok": ("mae", mae), "rmse_ok": ("rmse", rmse), "mape_ok": ("mape", mape)}
    judged = metrics.withColumns(
        {name: F.coalesce(F.col(c) <= F.lit(limit), F.lit(False)) for name, (c, limit) in checks.items()}
    )
    return judged.withColumn("passed", F.col("mae_ok") & F.col("rmse_ok") & F.col("mape_ok"))
