"""Business indicators of the result detail.

All of them are sums and counts of a dozen row-level measures, grouped by date, by season or not
at all.  `result_facts` takes those sums and counts once; the indicators read them.  A pipeline
takes the facts by (date, season) in one pass over the detail and derives every table from that
small frame; a single indicator takes the facts by its own group, and Catalyst drops the measures
it does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import above, at_least_zero, ratio, round2, total
from .baseline import ROLLING_ROWS, rolling


def _measures() -> dict[str, Column]:
    stock, units = F.col("inventory_level"), F.col("units_sold")
    baseline, model = F.col("baseline_forecast"), F.col("model_forecast")

    def flag(c: Column) -> Column:
        return c.cast("double")

    return {
        "units": units,
        "baseline": baseline,
        "model": model,
        "inventory": stock,
        "ae_model": F.col("model_abs_error"),
        "se_model": F.col("model_sq_error"),
        "ae_baseline": F.col("baseline_abs_error"),
        "se_baseline": F.col("baseline_sq_error"),
        "out_actual": flag(F.col("stockout_actual")),
        "out_model": flag(F.col("stockout_model")),
        "out_baseline": flag(F.col("stockout_baseline")),
        "oos_model": flag(above(model, stock)),
        "oos_baseline": flag(above(baseline, stock)),
        "dii_model": ratio(stock, model),
        "dii_baseline": ratio(stock, baseline),
        "over_model": at_least_zero(stock - model),
        "over_baseline": at_least_zero(stock - baseline),
    }


def result_facts(results: DataFrame, *by: str) -> DataFrame:
    """Sum and count of every measure per group; `season` and `date` can be grouped by."""
    return results.groupBy(*by).agg(
        *(
            part
            for name, c in _measures().items()
            for part in (total(c).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n"))
        )
    )


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(f"{name}_sum"), F.lit(0.0))


def _mean(name: str) -> Column:
    return ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def season_summary(facts: DataFrame) -> DataFrame:
    """Per season: unit totals, error means, stock-out rates, root mean squared errors."""
    summary = (
        facts.where(F.col("season").isNotNull())
        .groupBy("season")
        .agg(
            _sum("units").alias("units_actual"),
            _sum("model").alias("units_model"),
            _sum("baseline").alias("units_baseline"),
            _mean("ae_model").alias("mae_model"),
            _mean("se_model").alias("mse_model"),
            _mean("ae_baseline").alias("mae_baseline"),
            _mean("se_baseline").alias("mse_baseline"),
            _mean("out_actual").alias("stockout_rate_actual"),
            _mean("out_model").alias("stockout_rate_model"),
            _mean("out_baseline").alias("stockout_rate_baseline"),
        )
        .withColumn("rmse_model", F.sqrt("mse_model"))
        .withColumn("rmse_baseline", F.sqrt("mse_baseline"))
    )
    figures = [c for c in summary.columns if c != "season"]
    return summary.select("season", *(round2(F.col(c)).alias(c) for c in figures)).orderBy("season")


def global_model_compare(facts: DataFrame) -> DataFrame:
    """Two rows, baseline and model: errors and stock-out rate over all rows."""
    one = facts.agg(
        *(
            c.alias(f"{name}_{kind}")
            for kind in ("baseline", "model")
            for name, c in (
                ("mae", _mean(f"ae_{kind}")),
                ("rmse", F.sqrt(_mean(f"se_{kind}"))),
                ("rate", _mean(f"out_{kind}")),
            )
        )
    )
    return one.select(
        F.expr(
            "stack(2, 'baseline', mae_baseline, rmse_baseline, rate_baseline, "
            "'model', mae_model, rmse_model, rate_model) as (forecast, mae, rmse, stockout_rate)"
        )
    ).select("forecast", *(round2(F.col(c)).alias(c) for c in ("mae", "rmse", "stockout_rate")))


def _daily(facts: DataFrame):
    return facts.where(F.col("date").isNotNull()).groupBy("date")


def daily_demand_compare(facts: DataFrame) -> DataFrame:
    return (
        _daily(facts)
        .agg(
            _sum("units").alias("units_actual"),
            _sum("baseline").alias("units_baseline"),
            _sum("model").alias("units_model"),
        )
        .orderBy("date")
    )


def daily_dii_compare(facts: DataFrame) -> DataFrame:
    """Per date the mean of the rows' inventory over forecast, for both forecasts."""
    return _daily(facts).agg(
        _mean("dii_baseline").alias("dii_baseline"), _mean("dii_model").alias("dii_model")
    )


def rolling_dii_compare(facts: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    w = rolling(rows)
    return daily_dii_compare(facts).select(
        "date",
        F.avg("dii_baseline").over(w).alias("rolling_dii_baseline"),
        F.avg("dii_model").over(w).alias("rolling_dii_model"),
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, ratio(F.col(part), F.col(whole)) * 100.0)


def daily_overstock(facts: DataFrame) -> DataFrame:
    """Per date the units above the forecast, the inventory, and their share in percent."""
    return (
        _daily(facts)
        .agg(
            _sum("over_baseline").alias("over_baseline"),
            _sum("over_model").alias("over_model"),
            _sum("inventory").alias("inventory"),
        )
        .withColumn("over_pct_baseline", _share("over_baseline", "inventory"))
        .withColumn("over_pct_model", _share("over_model", "inventory"))
        .orderBy("date")
    )


def overstock_summary(facts: DataFrame) -> DataFrame:
    """One row: overall overstock share and mean forecast, for both forecasts."""
    return (
        facts.agg(
            _sum("over_baseline").alias("over_baseline"),
            _sum("over_model").alias("over_model"),
            _sum("inventory").alias("inventory"),
            _mean("baseline").alias("mean_forecast_baseline"),
            _mean("model").alias("mean_forecast_model"),
        )
        .select(
            _share("over_baseline", "inventory").alias("over_pct_baseline"),
            _share("over_model", "inventory").alias("over_pct_model"),
            "mean_forecast_baseline",
            "mean_forecast_model",
        )
    )


def overstock_indicator_table(facts: DataFrame) -> DataFrame:
    """The overstock summary as four (indicator, value) rows, rounded."""
    one = overstock_summary(facts)
    return one.unpivot([], one.columns, "indicator", "value").withColumn(
        "value", round2(F.col("value"))
    )


def daily_precision(facts: DataFrame) -> DataFrame:
    """Per date the out-of-stock rate and both errors, for both forecasts."""
    return (
        _daily(facts)
        .agg(
            _mean("oos_baseline").alias("oos_rate_baseline"),
            _mean("oos_model").alias("oos_rate_model"),
            _mean("ae_baseline").alias("mae_baseline"),
            _mean("ae_model").alias("mae_model"),
            F.sqrt(_mean("se_baseline")).alias("rmse_baseline"),
            F.sqrt(_mean("se_model")).alias("rmse_model"),
        )
        .orderBy("date")
    )
