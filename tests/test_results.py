import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from demandloom.operators import baseline as B
from demandloom.operators import kpi as K
from demandloom.operators import latest as L
from demandloom.operators import results as S
from demandloom.plans.queries import six

from compare import normal

D1, D2 = dt.date(2022, 1, 1), dt.date(2022, 1, 2)
DDL = (
    "date date, store_id string, product_id string, category string, price double, "
    "seasonality string, inventory_level double, units_sold double, demand_forecast double, "
    "prediction double"
)
ROWS = [
    (D1, "S1", "P1", "A", 2.0, "Winter", 10.0, 5.0, 4.0, 6.0),
    (D1, "S1", "P2", "B", 3.0, "Winter", 2.0, 5.0, 0.0, 3.0),
    (D2, "S1", "P1", "A", 2.0, "Summer", 4.0, 0.0, 2.0, 1.0),
    (D2, "S2", "P1", None, 1.0, None, 1.0, 3.0, 3.0, 4.0),
    (D2, None, "P3", "B", 1.0, "Summer", 7.0, 1.0, None, 7.0),
    (D2, "S2", "P2", "B", 5.0, "Summer", 9.0, 2.0, 2.0, 5.0),
]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(ROWS, DDL)


@pytest.fixture(scope="module")
def results(data):
    return S.compile_results(data)


def test_missing_columns_are_named(data):
    with pytest.raises(KeyError, match="price"):
        S.compile_results(data.drop("price"))


def test_errors_and_flags(results):
    row = results.where("date = '2022-01-01' and product_id = 'P2'").first()
    assert (row.model_error, row.model_abs_error, row.model_sq_error) == (2.0, 2.0, 4.0)
    assert (row.stockout_actual, row.stockout_model, row.stockout_baseline) == (True, True, False)
    missing = results.where("product_id = 'P3'").first()
    assert missing.baseline_error is None and missing.stockout_baseline is False


def test_season_summary_drops_missing_season(results):
    summary = K.season_summary(K.result_facts(results, "season")).collect()
    assert [r.season for r in summary] == ["Summer", "Winter"]
    winter = summary[1]
    assert (winter.units_actual, winter.units_model, winter.mae_model) == (10.0, 9.0, 1.5)
    assert winter.rmse_model == pytest.approx(round(math.sqrt(2.5), 2))
    assert summary[0].mae_baseline == 1.0


def test_facts_by_date_and_season_give_the_same_tables(results):
    both = K.result_facts(results, "date", "season")
    for table, by in (
        (K.season_summary, ["season"]),
        (K.daily_overstock, ["date"]),
        (K.daily_precision, ["date"]),
        (K.daily_dii_compare, ["date"]),
        (K.overstock_summary, []),
        (K.global_model_compare, []),
    ):
        once = table(K.result_facts(results, *by))
        assert normal(once.columns, six(once).collect()) == normal(
            once.columns, six(table(both)).collect()
        )


def test_seasons_add_up(results):
    known = results.where("season is not null")
    by_season = K.season_summary(K.result_facts(known, "season"))
    assert by_season.agg(F.sum("units_actual")).first()[0] == known.agg(F.sum("units_sold")).first()[0]
    assert by_season.where("rmse_model < mae_model - 0.01").count() == 0


def test_global_compare(results):
    rows = {r.forecast: r for r in K.global_model_compare(K.result_facts(results)).collect()}
    assert list(rows) == ["baseline", "model"]
    assert rows["model"].stockout_rate == round(2 / 6, 2)


def test_overstock(results):
    days = {r.date: r for r in K.daily_overstock(K.result_facts(results, "date")).collect()}
    assert days[D1].over_model == 4.0 and days[D1].over_baseline == 8.0
    assert days[D1].over_pct_model == pytest.approx(4 / 12 * 100)
    none = results.withColumn("inventory_level", F.lit(0.0))
    assert K.overstock_summary(K.result_facts(none)).first().over_pct_model is None


def test_kpi_card(results):
    card = L.kpi_summary(L.latest_day(results)).first()
    assert (card.day, card.rows_at_risk, card.forecast_units) == ("2022-01-02", 1, 17.0)
    assert card.locked_capital == 3 * 2.0 + 0 + 0 + 4 * 5.0
    empty = L.kpi_summary(L.latest_day(results.limit(0))).first()
    assert tuple(empty) == ("", 0, 0.0, 0.0)


def test_latest_lists(results):
    day = L.latest_day(results)
    assert [(r.product_id, r.shortage) for r in L.stockout_risk(day).collect()] == [("P1", 3.0)]
    assert [r.locked_capital for r in L.overstock_list(day).collect()] == [20.0, 6.0]
    assert [tuple(r) for r in L.category_forecast(day).collect()] == [("B", 12.0), ("A", 1.0)]


def test_latest_predictions(results):
    day = L.latest_day(results)
    rows = L.latest_predictions(day, k=1).collect()
    assert [(r.store_id, r.product_id, r.at_risk) for r in rows] == [
        ("S1", "P1", "No"),
        ("S2", "P2", "No"),
    ]
    assert "price" not in L.latest_predictions(day.drop("price")).columns
    with pytest.raises(KeyError):
        L.latest_predictions(day.drop("store_id"))


def test_missing_group_key_is_left_out_of_top_k(spark, results):
    day = L.latest_day(results)
    assert L.latest_predictions(day).where("store_id is null").count() == 0


def test_stores(results):
    assert [r.store_id for r in L.store_options(results).collect()] == ["S1", "S2"]
    assert L.store_drilldown(results, "S2").count() == 2
    assert L.store_drilldown(results).count() == 6


def test_baseline(data):
    totals = B.daily_product_totals(data)
    apes = {(r.date, r.product_id): r.ape for r in B.ape_by_product_day(totals).collect()}
    assert apes[D1, "P1"] == 0.2 and apes[D1, "P2"] == 1.0
    assert apes[D2, "P3"] == 1.0
    kpis = B.baseline_kpis(totals).first()
    daily = [(0.2 + 1.0) / 2, (2 / 3 + 1.0 + 0.0) / 3]
    assert kpis.mape_overall == pytest.approx(sum(daily) / 2 * 100)
    assert kpis.dii_average == pytest.approx(((12 + 21) / 2) / ((10 + 6) / 2))
    assert B.scatter_baseline(totals).first().axis_limit == 5.0


def test_no_units_means_no_ape(spark):
    df = spark.createDataFrame(
        [(D1, "P", 0.0, 1.0, 2.0)],
        "date date, product_id string, units_sold double, demand_forecast double, inventory_level double",
    )
    totals = B.daily_product_totals(df)
    assert B.ape_by_product_day(totals).first().ape is None
    assert B.daily_dii(totals).first().dii is None
    assert tuple(B.baseline_kpis(totals).first()) == (None, None)


def test_rolling_skips_missing(spark):
    days = [(dt.date(2022, 1, i + 1), v) for i, v in enumerate([None, 1.0, None, 3.0])]
    df = spark.createDataFrame(days, "date date, x double")
    rows = df.select("date", F.avg("x").over(B.rolling(2)).alias("m")).orderBy("date").collect()
    assert [r.m for r in rows] == [None, 1.0, 1.0, 3.0]


def test_scatter_keeps_finite_pairs(spark):
    rows = [(1.0, 2.0), (None, 1.0), (math.nan, 1.0), (1.0, math.inf), (-1.0, 5.0)]
    pairs = S.scatter_pairs(spark.createDataFrame(rows, "units_sold double, model_forecast double"))
    assert pairs.count() == 2
    assert tuple(S.scatter_limits(pairs).first()) == (-1.0, 5.0)
    positive = S.scatter_limits(pairs.where("actual > 0")).first()
    assert positive.axis_min == 0.0


def test_quality_gate(spark):
    df = spark.createDataFrame([(20.0, 30.1, None)], "mae double, rmse double, mape double")
    row = S.quality_gate(df).first()
    assert (row.mae_ok, row.rmse_ok, row.mape_ok, row.passed) == (True, False, False, False)
