"""Column names of the data model: raw file header, engine columns, result columns."""

from __future__ import annotations

# Raw header text -> engine column.
RAW_TO_ENGINE = {
    "Date": "date",
    "Store ID": "store_id",
    "Product ID": "product_id",
    "Category": "category",
    "Region": "region",
    "Weather Condition": "weather_condition",
    "Holiday/Promotion": "holiday_promotion",
    "Seasonality": "seasonality",
    "Inventory Level": "inventory_level",
    "Units Sold": "units_sold",
    "Units Ordered": "units_ordered",
    "Demand Forecast": "demand_forecast",
    "Price": "price",
    "Discount": "discount",
    "Competitor Pricing": "competitor_pricing",
}
ENGINE_TO_RAW = {engine: raw for raw, engine in RAW_TO_ENGINE.items()}

TARGET = "units_sold"

# Columns coerced to numbers, and those of them filled with their median.
NUMERIC = (
    "inventory_level",
    "units_sold",
    "units_ordered",
    "demand_forecast",
    "price",
    "discount",
    "competitor_pricing",
)
IMPUTED = tuple(c for c in NUMERIC if c != TARGET)

# Model inputs handled as categories.
CATEGORICAL = (
    "store_id",
    "product_id",
    "category",
    "region",
    "weather_condition",
    "holiday_promotion",
    "seasonality",
)

SERIES = ("store_id", "product_id")

CALENDAR = ("month", "weekday", "day_of_month", "day_of_year")
LAGS = (1, 7, 14)
TRAILING_ROWS = 7
HISTORY = tuple(f"units_lag_{k}" for k in LAGS) + (f"units_ma_{TRAILING_ROWS}",)

RESULT_COLUMNS = (
    "date",
    "store_id",
    "product_id",
    "category",
    "price",
    "season",
    "inventory_level",
    "units_sold",
    "baseline_forecast",
    "model_forecast",
    "model_error",
    "model_abs_error",
    "model_sq_error",
    "baseline_error",
    "baseline_abs_error",
    "baseline_sq_error",
    "stockout_actual",
    "stockout_model",
    "stockout_baseline",
)

RESULT_DDL = (
    "date date, store_id string, product_id string, category string, price double, season string, "
    "inventory_level double, units_sold double, baseline_forecast double, model_forecast double, "
    "model_error double, model_abs_error double, model_sq_error double, baseline_error double, "
    "baseline_abs_error double, baseline_sq_error double, stockout_actual boolean, "
    "stockout_model boolean, stockout_baseline boolean"
)

SEASON_DDL = (
    "season string, units_actual double, units_model double, units_baseline double, "
    "mae_model double, mse_model double, mae_baseline double, mse_baseline double, "
    "stockout_rate_actual double, stockout_rate_model double, stockout_rate_baseline double, "
    "rmse_model double, rmse_baseline double"
)


def require(columns, needed) -> None:
    """Raise a KeyError that names every needed column that is not there."""
    missing = [c for c in needed if c not in columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
