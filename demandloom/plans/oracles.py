"""The registered queries once more as plain SQL, for another engine to check the results."""

from __future__ import annotations

from ..operators.records import UNKNOWN_CATEGORY, UNKNOWN_ID
from ..schema import CATEGORICAL, IMPUTED, NUMERIC, RAW_TO_ENGINE, RESULT_COLUMNS
from ..sources.star import SALES_COLUMNS
from .queries import AS_OF, STORE, STUMPS, TOP_K, TRAINING

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
TIES = f"{KEY}, units_sold"
ORDER = f"store_id, product_id, date, {TIES}"
RAW = tuple(RAW_TO_ENGINE.values())
DETAIL = ", ".join(RESULT_COLUMNS)
SALES = """sales AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    cast(l_shipdate AS date) AS date,
    concat('S00', cast(n_regionkey AS varchar)) AS store_id,
    p_brand AS product_id, p_type AS category, r_name AS region,
    o_orderpriority AS weather_condition,
    CASE WHEN l_discount >= 0.05::double THEN 1 ELSE 0 END AS holiday_promotion,
    CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Winter'
         WHEN month(l_shipdate) IN (3, 4, 5) THEN 'Spring'
         WHEN month(l_shipdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS seasonality,
    l_quantity - 1 AS units_sold,
    cast((l_orderkey * 7 + l_partkey * 13 + l_linenumber * 31) % 60 AS double) AS inventory_level,
    cast((l_partkey * 17 + l_orderkey) % 200 AS double) AS units_ordered,
    l_quantity + ((l_orderkey * 3 + l_partkey * 5 + l_linenumber) % 11) - 6 AS demand_forecast,
    p_retailprice AS price,
    l_discount * 100 AS discount,
    l_extendedprice / l_quantity AS competitor_pricing,
    l_quantity + ((l_orderkey * 11 + l_partkey * 3 + l_suppkey) % 7) - 4 AS model_forecast
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def r6(x: str) -> str:
    """Six decimals, half to even."""
    return f"round_even(({x}) * 1e6, 0) / 1e6"


def r2(x: str) -> str:
    return f"round_even(({x}) * 1e2, 0) / 1e2"


def six(*columns: str) -> str:
    return ", ".join(f"{r6(c)} AS {c}" for c in columns)


def plain(*columns: str) -> str:
    return ", ".join(columns)


# The rows as they come from a raw file, before and after their cells are typed.
_K = "(l_orderkey + l_partkey + l_linenumber)"
_TEXT = {
    "date": f"CASE WHEN {_K} % 37 = 0 THEN 'not-a-date' WHEN {_K} % 41 = 0 THEN '2022-02-30' "
    f"WHEN {_K} % 53 = 0 THEN strftime(date, '%Y-%m-%dT10:20:30') ELSE strftime(date, '%Y-%m-%d') END",
    "category": f"""CASE WHEN {_K} % 43 = 0 THEN concat('a "', category, '", b') ELSE category END""",
    "region": f"CASE WHEN {_K} % 47 = 0 THEN concat(' ', region, ' ') ELSE region END",
    "holiday_promotion": f"CASE WHEN {_K} % 59 = 0 THEN 'Yes' ELSE cast(holiday_promotion AS varchar) END",
    "units_sold": f"CASE WHEN {_K} % 23 = 0 THEN 'n/a' WHEN {_K} % 29 = 0 THEN '' "
    "ELSE cast(units_sold AS varchar) END",
    "inventory_level": f"CASE WHEN {_K} % 19 = 0 THEN 'bad' "
    "ELSE cast(inventory_level AS varchar) END",
    "price": f"CASE WHEN {_K} % 31 <> 0 THEN cast(price AS varchar) END",
}
SALES_RAW = f"""raw AS (
  SELECT {KEY}, {', '.join(f"{_TEXT.get(c, f'cast({c} AS varchar)')} AS {c}" for c in RAW)}
  FROM sales)"""
TYPED = f"""typed AS (
  SELECT {KEY}, {', '.join(f'try_cast({c} AS double) AS {c}' if c in NUMERIC else c for c in RAW)}
  FROM raw)"""
DAY_OF = r"try_cast(regexp_extract(date, '^(\d{4}-\d{1,2}-\d{1,2})([T ].*)?$', 1) AS date)"
KEPT = "kept AS (SELECT * FROM typed WHERE units_sold IS NOT NULL)"
FILLED = f"""medians AS (
  SELECT {', '.join(f'median({c}) AS m_{c}' for c in IMPUTED)} FROM kept),
filled AS (
  SELECT {KEY}, {', '.join(f'coalesce({c}, m_{c}) AS {c}' if c in IMPUTED else c for c in RAW)}
  FROM kept, medians)"""
CLEAN = f"{SALES}, {SALES_RAW}, {TYPED}, {KEPT}, {FILLED}"

RESULTS = f"""{SALES}, plain_results AS (
  SELECT {KEY}, date, store_id, product_id, category, price, seasonality AS season,
    inventory_level, units_sold, demand_forecast AS baseline_forecast, model_forecast,
    units_sold - model_forecast AS model_error, units_sold - demand_forecast AS baseline_error
  FROM sales),
results AS (
  SELECT *, abs(model_error) AS model_abs_error, model_error * model_error AS model_sq_error,
    abs(baseline_error) AS baseline_abs_error, baseline_error * baseline_error AS baseline_sq_error,
    units_sold > inventory_level AS stockout_actual,
    model_forecast > inventory_level AS stockout_model,
    baseline_forecast > inventory_level AS stockout_baseline,
    greatest(inventory_level - model_forecast, 0) AS over_model,
    greatest(inventory_level - baseline_forecast, 0) AS over_baseline
  FROM plain_results)"""
LATEST = f"""{RESULTS}, latest AS (
  SELECT *, over_model * price AS locked_capital FROM results
  WHERE date = (SELECT max(date) FROM results))"""
SEASON = f"""SELECT season, {', '.join(f'{r2(x)} AS {n}' for x, n in (
    ('sum(units_sold)', 'units_actual'), ('sum(model_forecast)', 'units_model'),
    ('sum(baseline_forecast)', 'units_baseline'),
    ('avg(model_abs_error)', 'mae_model'), ('avg(model_sq_error)', 'mse_model'),
    ('avg(baseline_abs_error)', 'mae_baseline'), ('avg(baseline_sq_error)', 'mse_baseline'),
    ('avg(stockout_actual::int)', 'stockout_rate_actual'),
    ('avg(stockout_model::int)', 'stockout_rate_model'),
    ('avg(stockout_baseline::int)', 'stockout_rate_baseline'),
    ('sqrt(avg(model_sq_error))', 'rmse_model'),
    ('sqrt(avg(baseline_sq_error))', 'rmse_baseline')))}
FROM results GROUP BY season ORDER BY season"""
DETAIL_OF = f"SELECT {DETAIL.replace('price', r6('price') + ' AS price', 1)}"
DETAIL_ORDER = "date, store_id, product_id, " + ", ".join(
    c for c in RESULT_COLUMNS if c not in ("date", "store_id", "product_id")
)


def totals(forecast: str = "demand_forecast", rows: str = "sales") -> str:
    return f"""totals AS (
  SELECT date, product_id, sum(units_sold) AS units, sum({forecast}) AS forecast,
    sum(inventory_level) AS inventory
  FROM {rows} GROUP BY date, product_id),
apes AS (SELECT *, abs(units - forecast) / nullif(units, 0) AS ape FROM totals),
days AS (
  SELECT date, avg(ape) AS mape, sum(units) AS units, sum(inventory) AS inventory,
    sum(inventory) / nullif(sum(units), 0) AS dii
  FROM apes GROUP BY date)"""


TOTALS = f"{SALES}, {totals()}"
ROLLING = "OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
SPLIT = f"""{SALES}, parts AS (
  SELECT *, row_number() OVER (ORDER BY {ORDER})
      > count(*) OVER () - ceil(0.2::double * count(*) OVER ()) AS is_test
  FROM sales)"""
SERIES_WINDOW = f"WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date, {TIES})"
TRAILING = (
    "avg(units_sold) OVER (PARTITION BY store_id, product_id ORDER BY date, "
    f"{TIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
)
CALENDAR = (
    "cast(month(date) AS int) AS month, cast(isodow(date) - 1 AS int) AS weekday, "
    "cast(day(date) AS int) AS day_of_month, cast(dayofyear(date) AS int) AS day_of_year"
)
LAG_COLUMNS = ", ".join(
    f"coalesce(lag(units_sold, {k}) OVER w, 0) AS units_lag_{k}" for k in (1, 7, 14)
)
DII_DAYS = f"""{RESULTS}, dii AS (
  SELECT date, avg(inventory_level / nullif(baseline_forecast, 0)) AS dii_baseline,
    avg(inventory_level / nullif(model_forecast, 0)) AS dii_model
  FROM results GROUP BY date)"""
OVER_TOTALS = """SELECT sum(over_baseline) / sum(inventory_level) * 100 AS over_pct_baseline,
  sum(over_model) / sum(inventory_level) * 100 AS over_pct_model,
  avg(baseline_forecast) AS mean_forecast_baseline, avg(model_forecast) AS mean_forecast_model
FROM results"""
REGISTRY = f"""{SALES}, versions AS (
  SELECT concat('v', strftime(date, '%Y%m'), '01000000') AS version,
    concat(strftime(date, '%Y%m'), '-saved') AS saved_at,
    avg(abs(units_sold - model_forecast)) AS mae,
    sqrt(avg((units_sold - model_forecast) * (units_sold - model_forecast))) AS rmse
  FROM sales GROUP BY 1, 2),
registry AS (
  SELECT cast(row_number() OVER (ORDER BY version) - 1 AS int) AS position, version, saved_at, mae,
    rmse, concat('models/', version) AS model_path,
    version = (SELECT max(version) FROM versions) AS is_current
  FROM versions)"""


def _stacked(columns, select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in columns)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _stumps() -> str:
    """Rounds of the best single cut, found by trying all of them."""
    gain = "sl * sl / (nl + 1) + (s - sl) * (s - sl) / (n - nl + 1) - s * s / (n + 1)"
    ctes = f"""{SPLIT}, round0 AS (SELECT {KEY}, is_test, units_sold::double AS y, discount AS d,
  weather_condition AS w, seasonality AS q,
  (SELECT avg(units_sold) FROM parts WHERE NOT is_test) AS p0 FROM parts)"""
    for k in range(1, STUMPS.rounds + 1):
        ctes += f""",
by_d{k} AS (SELECT d, count(*) AS n, sum(y - p{k - 1}) AS s FROM round{k - 1} WHERE NOT is_test GROUP BY d),
by_w{k} AS (SELECT w, count(*) AS n, sum(y - p{k - 1}) AS s FROM round{k - 1} WHERE NOT is_test GROUP BY w),
by_q{k} AS (SELECT *, row_number() OVER (ORDER BY s / n, q) AS place FROM (
  SELECT q, count(*) AS n, sum(y - p{k - 1}) AS s FROM round{k - 1} WHERE NOT is_test GROUP BY q)),
cuts{k} AS (
  SELECT 0 AS col, NULL::double AS cut, w AS cut_w, NULL::bigint AS place,
    sum(n) OVER () - n AS nl, sum(s) OVER () - s AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM by_w{k}
  UNION ALL SELECT 1, NULL, NULL, place,
    sum(n) OVER (ORDER BY place), sum(s) OVER (ORDER BY place), sum(n) OVER (), sum(s) OVER () FROM by_q{k}
  UNION ALL SELECT 2, d, NULL, NULL,
    sum(n) OVER (ORDER BY d), sum(s) OVER (ORDER BY d), sum(n) OVER (), sum(s) OVER () FROM by_d{k}),
best{k} AS (SELECT * FROM cuts{k} WHERE nl > 0 AND nl < n ORDER BY {gain} DESC, col LIMIT 1),
round{k} AS (SELECT r.*, p{k - 1} + {STUMPS.step} * CASE WHEN CASE col WHEN 0 THEN w <> cut_w
    WHEN 1 THEN q IN (SELECT q FROM by_q{k} o, best{k} b WHERE o.place <= b.place) ELSE d <= cut END
  THEN sl / (nl + {STUMPS.l2}) ELSE (s - sl) / (n - nl + {STUMPS.l2}) END AS p{k}
  FROM round{k - 1} r, best{k})"""
    errors = " UNION ALL ".join(
        f"SELECT {k} AS k, avg((y - p{k}) ** 2) AS e FROM round{STUMPS.rounds} WHERE is_test"
        for k in range(1, STUMPS.rounds + 1)
    )
    ctes += f", kept AS (SELECT k FROM ({errors}) ORDER BY e, k LIMIT 1)"
    chosen = " ".join(f"WHEN {k} THEN p{k}" for k in range(1, STUMPS.rounds + 1))
    return _with(
        ctes, f"SELECT {KEY}, is_test, {r6(f'CASE k {chosen} END')} AS prediction FROM round{STUMPS.rounds}, kept"
    )


def _model_queries() -> dict[str, str]:
    """What holds of any right model, next to figures of the rows it was made from."""
    numbers = (*IMPUTED, "month", "weekday", "day_of_month", "day_of_year")
    numbers += ("units_lag_1", "units_lag_7", "units_lag_14", "units_ma_7")
    nominal = TRAINING.indexed
    hot = [c for c in CATEGORICAL if c not in nominal]
    rows = f"""{SPLIT}, featured AS (
  SELECT *, {CALENDAR}, {LAG_COLUMNS}, coalesce({TRAILING}, 0) AS units_ma_7 FROM parts {SERIES_WINDOW}),
stats AS (SELECT {', '.join(f'avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}' for c in numbers)}
  FROM featured WHERE NOT is_test)"""
    for c in (*hot, *nominal):
        rows += f""",
of_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT cast({c} AS varchar) AS v FROM featured WHERE NOT is_test))"""
    joins = " ".join(f"LEFT JOIN of_{c} ON of_{c}.v = cast(f.{c} AS varchar)" for c in (*hot, *nominal))
    width = " + ".join(f"(SELECT count(*) FROM of_{c})" for c in hot)
    filled = " + ".join(f"(of_{c}.v IS NOT NULL)::int" for c in hot)
    places = ", ".join(
        f"coalesce(of_{c}.place, (SELECT count(*) FROM of_{c})) AS {c}_index" for c in nominal
    )
    scaled = " + ".join(f"(f.{c} - a_{c}) / s_{c}" for c in numbers)
    q = {
        "feature_matrix": _with(
            rows,
            f"SELECT {KEY}, {width} + {len(nominal) + len(numbers)} AS width, {filled} AS filled, "
            f"{places}, {r6(scaled)} AS scaled_sum FROM featured f {joins}, stats",
        )
    }
    mean = f"""{SPLIT}, mean AS (SELECT avg(units_sold) AS m FROM parts WHERE NOT is_test),
one AS (SELECT count(*) FILTER (NOT is_test) AS rows_train, count(*) FILTER (is_test) AS rows_valid,
  sqrt(avg((units_sold - m) * (units_sold - m)) FILTER (is_test)) AS mean_rmse FROM parts, mean)"""
    figures = f"rows_train, rows_valid, {six('mean_rmse')}"
    q["train_demand_model"] = _with(
        mean,
        f"SELECT {figures}, true AS beats_mean, true AS best_round_kept, 1::double AS importance FROM one",
    )
    q["learning_curve"] = _with(
        mean,
        f"SELECT {figures}, true AS counted, true AS best_is_lowest, true AS ended_by_patience, "
        "true AS learns, true AS below_mean FROM one",
    )
    q["boosted_stumps"] = _stumps()
    q["score_all"] = _with(
        RESULTS,
        f"SELECT {KEY}, date, season, units_sold, inventory_level, baseline_error, stockout_actual, "
        "stockout_baseline, true AS consistent FROM results",
    )
    q["train_score_roundtrip"] = _with(SPLIT, f"SELECT {KEY}, units_sold, is_test, true AS same FROM parts")
    q["score_with_version"] = _with(
        SALES, f"SELECT {KEY}, units_sold, true AS same, true AS served FROM sales"
    )
    q["score_records"] = _with(
        SALES,
        f"SELECT {KEY}, store_id, product_id, date, count(*) OVER (PARTITION BY date) AS n, "
        "true AS predicted FROM sales",
    )
    good = "day(date) NOT IN (7, 8)"
    q["score_requests"] = _with(
        SALES,
        f"""SELECT strftime(date, '%Y-%m-%d') AS request_id,
  CASE WHEN {good} THEN count(*) ELSE 0 END AS n,
  CASE day(date) WHEN 7 THEN 'unreadable' WHEN 8 THEN 'empty' END AS error,
  CASE WHEN {good} THEN count(*) FILTER (month(date) % 2 = 0 OR max_line = 1 OR l_linenumber <> 1) END AS prices,
  CASE WHEN {good} THEN sum(units_sold) END AS units,
  CASE WHEN {good} THEN date '{AS_OF}' END AS first_day,
  CASE WHEN {good} THEN count(*) END AS forecasts
FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY date) AS max_line FROM sales) GROUP BY date""",
    )
    return q


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    # Scans, sources, sinks
    token = {c: f"CASE WHEN {c} NOT IN ('', 'n/a') THEN {c} END AS {c}" for c in RAW}
    for c in ("price", "discount", "competitor_pricing"):
        token[c] = f"try_cast({c} AS double) AS {c}"
    q["csv_scan"] = _with(
        f"{SALES}, {SALES_RAW}", f"SELECT {KEY}, {', '.join(token[c] for c in RAW)} FROM raw"
    )
    reason = "CASE l_orderkey % 7 WHEN 1 THEN 'short' WHEN 2 THEN 'long' WHEN 3 THEN 'unclosed' ELSE 'none' END"
    q["csv_rejects"] = _with(
        f"{SALES}, {SALES_RAW}",
        f"SELECT {reason} AS reason, count(*) AS n, CASE WHEN {reason} = 'none' "
        "THEN sum(try_cast(units_sold AS double)) END AS units FROM raw GROUP BY 1",
    )
    line_types = {"l_linenumber": "int"}
    kinds = {c: line_types.get(c, "bigint") for c in KEY.split(", ")}
    kinds.update({c: "double" if c in NUMERIC else "string" for c in RAW})
    q["profile_columns"] = _with(
        f"{SALES}, {SALES_RAW}, {TYPED}",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM typed"
            for c, t in kinds.items()
        ),
    )
    fractions = ("discount", "price", "competitor_pricing")
    sales_six = ", ".join(
        f"{r6(c)} AS {c}" if c in fractions else c for c in (*KEY.split(", "), *SALES_COLUMNS)
    )
    q["preview_rows"] = _with(
        SALES, f"SELECT {sales_six} FROM (SELECT * FROM sales ORDER BY {ORDER} LIMIT 5)"
    )
    q["null_counts"] = _with(
        f"{SALES}, {SALES_RAW}, {TYPED}",
        _stacked(
            NUMERIC,
            "SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing FROM typed",
        ),
    )
    q["detail_sink_roundtrip"] = _with(RESULTS, f"{DETAIL_OF} FROM results")
    late = "* REPLACE (CASE WHEN month(date) = 7 THEN price + 1 ELSE price END AS price, "
    late += "date_trunc('month', date)::date AS date)"
    q["detail_days_replaced"] = _with(f"{RESULTS}, late AS (SELECT {late} FROM results)", f"{DETAIL_OF} FROM late")
    q["season_sink_roundtrip"] = _with(RESULTS, SEASON)
    q["report_season"] = q["season_sink_roundtrip"]
    q["report_detail"] = _with(
        RESULTS,
        f"{DETAIL_OF}, count(*) OVER () AS rows_returned "
        f"FROM (SELECT * FROM results ORDER BY {DETAIL_ORDER} LIMIT 100)",
    )
    records = ", ".join(
        f"{r6(c)} AS {c}" if c in fractions else c for c in (*KEY.split(", "), *RAW)
    )
    q["records_from_json"] = _with(SALES, f"SELECT {records} FROM sales")
    q["registry_scan"] = _with(
        REGISTRY,
        f"SELECT position, version, saved_at, {six('mae', 'rmse')}, model_path, is_current "
        "FROM registry",
    )

    # Cleaning, projections, filters
    q["coerce_numeric"] = _with(
        f"{SALES}, {SALES_RAW}, {TYPED}", f"SELECT {KEY}, {six(*NUMERIC)} FROM typed"
    )
    q["drop_missing_target"] = _with(
        f"{SALES}, {SALES_RAW}, {TYPED}, {KEPT}", f"SELECT {KEY}, units_sold FROM kept"
    )
    q["impute_median"] = _with(CLEAN, f"SELECT {KEY}, {six(*IMPUTED)} FROM filled")
    q["parse_dates"] = _with(
        f"{SALES}, {SALES_RAW}, parsed AS (SELECT {KEY}, {DAY_OF} AS date FROM raw)",
        f"SELECT {KEY}, date FROM parsed WHERE date IS NOT NULL",
    )
    cleaned = {c: c for c in RAW}
    cleaned.update({c: f"{r6(c)} AS {c}" for c in NUMERIC})
    cleaned["date"] = f"{DAY_OF} AS date"
    q["clean_sales"] = _with(
        CLEAN,
        f"SELECT {KEY}, {', '.join(cleaned[c] for c in RAW)} FROM filled "
        f"WHERE {DAY_OF.replace('(date', '(filled.date')} IS NOT NULL",
    )
    q["normalize_aliases"] = _with(
        SALES, f"SELECT {KEY}, store_id, product_id, units_sold FROM sales"
    )
    n = "l_linenumber"
    q["default_columns"] = _with(
        SALES,
        f"""SELECT {KEY},
  CASE WHEN {n} = 5 THEN date '{AS_OF}' ELSE date END AS date,
  CASE WHEN {n} = 1 THEN '{UNKNOWN_ID}' ELSE store_id END AS store_id,
  CASE WHEN {n} = 3 THEN '{UNKNOWN_ID}' ELSE product_id END AS product_id,
  CASE WHEN {n} = 4 THEN 0 ELSE units_sold END AS units_sold,
  CASE WHEN {n} = 6 THEN '{UNKNOWN_CATEGORY}' ELSE region END AS region,
  0::double AS price
FROM sales""",
    )
    q["ensure_model_columns"] = _with(
        SALES,
        f"SELECT {KEY}, store_id, units_sold, {r6('discount')} AS discount, "
        f"'{UNKNOWN_CATEGORY}' AS region, 0::double AS price FROM sales",
    )
    q["results_detail"] = _with(RESULTS, f"{DETAIL_OF}, {KEY} FROM results")
    q["forecast_errors"] = _with(
        RESULTS,
        f"SELECT {KEY}, units_sold, baseline_forecast, model_forecast, model_error, "
        "model_abs_error, model_sq_error, baseline_error, baseline_abs_error, baseline_sq_error "
        "FROM results",
    )
    q["stockout_flags"] = _with(
        RESULTS,
        f"SELECT {KEY}, units_sold, inventory_level, baseline_forecast, model_forecast, "
        "stockout_actual, stockout_model, stockout_baseline FROM results",
    )
    q["latest_day"] = _with(LATEST, f"{DETAIL_OF}, {KEY} FROM latest")
    q["store_options"] = _with(SALES, "SELECT DISTINCT store_id FROM sales ORDER BY 1")
    q["store_drilldown"] = _with(
        SALES,
        f"SELECT {KEY}, date, store_id, product_id, units_sold, inventory_level, demand_forecast, "
        f"model_forecast FROM sales WHERE store_id = '{STORE}'",
    )

    # Aggregations
    q["daily_product_totals"] = _with(TOTALS, "SELECT * FROM totals")
    q["ape_by_product_day"] = _with(TOTALS, f"SELECT date, product_id, {six('ape')} FROM apes")
    q["daily_mape"] = _with(TOTALS, f"SELECT date, {six('mape')} FROM days")
    q["baseline_kpis"] = _with(
        TOTALS,
        f"SELECT {r6('avg(mape) * 100')} AS mape_overall, "
        f"{r6('avg(inventory) / nullif(avg(units), 0)')} AS dii_average FROM days",
    )
    q["daily_dii"] = _with(TOTALS, f"SELECT date, units, inventory, {six('dii')} FROM days")
    q["scatter_baseline"] = _with(
        TOTALS,
        "SELECT date, product_id, forecast, units, "
        "greatest(max(forecast) OVER (), max(units) OVER ()) AS axis_limit FROM totals",
    )
    q["daily_demand_compare"] = _with(
        RESULTS,
        "SELECT date, sum(units_sold) AS units_actual, sum(baseline_forecast) AS units_baseline, "
        "sum(model_forecast) AS units_model FROM results GROUP BY date ORDER BY date",
    )
    q["season_summary"] = _with(RESULTS, SEASON)
    q["global_model_compare"] = _with(
        RESULTS,
        " UNION ALL ".join(
            f"SELECT '{kind}' AS forecast, {r2(f'avg({kind}_abs_error)')} AS mae, "
            f"{r2(f'sqrt(avg({kind}_sq_error))')} AS rmse, "
            f"{r2(f'avg(stockout_{kind}::int)')} AS stockout_rate FROM results"
            for kind in ("baseline", "model")
        ),
    )
    q["daily_dii_compare"] = _with(
        DII_DAYS, f"SELECT date, {six('dii_baseline', 'dii_model')} FROM dii"
    )
    over = ("over_baseline", "over_model")
    q["daily_overstock"] = _with(
        RESULTS,
        f"""SELECT date, {', '.join(f'sum({c}) AS {c}' for c in over)},
  sum(inventory_level) AS inventory,
  {', '.join(
      f"CASE WHEN sum(inventory_level) > 0 THEN {r6(f'sum({c}) / sum(inventory_level) * 100')} END"
      f" AS {c.replace('over_', 'over_pct_')}" for c in over)}
FROM results GROUP BY date ORDER BY date""",
    )
    figures = (
        "over_pct_baseline",
        "over_pct_model",
        "mean_forecast_baseline",
        "mean_forecast_model",
    )
    over_all = f"{RESULTS}, one AS ({OVER_TOTALS})"
    q["overstock_summary"] = _with(over_all, f"SELECT {six(*figures)} FROM one")
    q["overstock_indicator_table"] = _with(
        over_all,
        " UNION ALL ".join(
            f"SELECT '{c}' AS indicator, {r2(c)} AS value FROM one" for c in figures
        ),
    )
    q["daily_precision"] = _with(
        RESULTS,
        "SELECT date, "
        + ", ".join(
            f"{r6(x.format(k=k))} AS {name}_{k}"
            for k in ("baseline", "model")
            for name, x in (
                ("oos_rate", "avg((inventory_level < {k}_forecast)::int)"),
                ("mae", "avg({k}_abs_error)"),
                ("rmse", "sqrt(avg({k}_sq_error))"),
            )
        )
        + " FROM results GROUP BY date ORDER BY date",
    )
    q["kpi_summary"] = _with(
        LATEST,
        "SELECT strftime(max(date), '%Y-%m-%d') AS day, "
        "count(*) FILTER (model_forecast > inventory_level) AS rows_at_risk, "
        f"sum(model_forecast) AS forecast_units, {r6('sum(locked_capital)')} AS locked_capital "
        "FROM latest",
    )
    q["category_forecast"] = _with(
        LATEST,
        "SELECT category, sum(model_forecast) AS forecast_units FROM latest "
        "GROUP BY category ORDER BY forecast_units DESC, category",
    )
    q["stockout_risk"] = _with(
        LATEST,
        "SELECT product_id, category, inventory_level, model_forecast AS forecast, "
        "model_forecast - inventory_level AS shortage FROM latest "
        "WHERE model_forecast > inventory_level ORDER BY shortage DESC",
    )
    q["overstock_list"] = _with(
        LATEST,
        "SELECT product_id, category, inventory_level, model_forecast AS forecast, "
        f"{six('locked_capital')} FROM latest WHERE latest.locked_capital > 0",
    )
    q["latest_predictions"] = _with(
        f"""{LATEST}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY store_id
    ORDER BY model_forecast DESC, product_id, {TIES}) AS rank FROM latest)""",
        f"""SELECT store_id, product_id, category, inventory_level, model_forecast,
  baseline_forecast, units_sold, {six('price')},
  CASE WHEN model_forecast > inventory_level THEN 'Sí' ELSE 'No' END AS at_risk,
  greatest(model_forecast - inventory_level, 0) AS shortage
FROM ranked WHERE rank <= {TOP_K}""",
    )
    q["detail_preview"] = _with(
        RESULTS, f"{DETAIL_OF} FROM (SELECT * FROM results ORDER BY {DETAIL_ORDER} LIMIT 10)"
    )

    # Windows
    q["calendar_features"] = _with(SALES, f"SELECT {KEY}, date, {CALENDAR} FROM sales")
    base = f"{KEY}, date, store_id, product_id, units_sold"
    q["lag_features"] = _with(SALES, f"SELECT {base}, {LAG_COLUMNS} FROM sales {SERIES_WINDOW}")
    trailing = f"{r6(f'coalesce({TRAILING}, 0)')} AS units_ma_7"
    q["trailing_mean_7"] = _with(SALES, f"SELECT {base}, {trailing} FROM sales")
    q["demand_features"] = _with(
        SALES,
        f"SELECT {base}, {CALENDAR}, {LAG_COLUMNS}, {trailing} FROM sales {SERIES_WINDOW}",
    )
    q["rolling_mape_30"] = _with(
        TOTALS, f"SELECT date, {r6(f'avg(mape) {ROLLING} * 100')} AS rolling_mape FROM days"
    )
    q["rolling_dii_30"] = _with(
        TOTALS, f"SELECT date, {r6(f'avg(dii) {ROLLING}')} AS rolling_dii FROM days"
    )
    q["rolling_dii_compare_30"] = _with(
        DII_DAYS,
        f"SELECT date, {r6(f'avg(dii_baseline) {ROLLING}')} AS rolling_dii_baseline, "
        f"{r6(f'avg(dii_model) {ROLLING}')} AS rolling_dii_model FROM dii",
    )

    # Model
    q["positional_split"] = _with(
        SPLIT, f"SELECT {KEY}, store_id, units_sold, is_test FROM parts"
    )
    q["onehot_counts"] = _with(
        SPLIT,
        _stacked(
            CATEGORICAL,
            "SELECT '{c}' AS \"column\", cast({c} AS varchar) AS value, count(*) AS count "
            "FROM parts WHERE NOT is_test GROUP BY 2",
        ),
    )
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in IMPUTED)
    scaled = ", ".join(f"{r6(f'({c} - a_{c}) / s_{c}')} AS {c}_scaled" for c in IMPUTED)
    q["standardize_numeric"] = _with(
        f"{SPLIT}, stats AS (SELECT {stats} FROM parts WHERE NOT is_test)",
        f"SELECT {KEY}, {scaled} FROM sales, stats",
    )
    error = "units_sold - model_forecast"
    errors = f"avg(abs({error})) AS mae, sqrt(avg(({error}) * ({error}))) AS rmse"
    q["holdout_metrics"] = _with(
        f"{SPLIT}, m AS (SELECT {errors} FROM parts WHERE is_test)",
        f"SELECT {six('mae', 'rmse')} FROM m",
    )
    pairs = f"{SPLIT}, pairs AS (SELECT {KEY}, units_sold AS actual, model_forecast AS predicted "
    pairs += "FROM parts WHERE is_test)"
    q["scatter_model"] = _with(pairs, "SELECT * FROM pairs")
    q["scatter_limits"] = _with(
        pairs,
        "SELECT least(min(actual), min(predicted), 0::double) AS axis_min, "
        "greatest(max(actual), max(predicted)) AS axis_max FROM pairs",
    )
    q["quality_gate"] = _with(
        f"{SPLIT}, held AS (SELECT * FROM parts WHERE is_test), "
        f"{totals('model_forecast', 'held')}, m AS (SELECT {errors} FROM held), "
        "p AS (SELECT avg(mape) * 100 AS mape FROM days)",
        f"SELECT {six('mae', 'rmse', 'mape')}, mae <= 20 AS mae_ok, rmse <= 30 AS rmse_ok, "
        "mape <= 20 AS mape_ok, mae <= 20 AND rmse <= 30 AND mape <= 20 AS passed FROM m, p",
    )

    # The trained model: what SQL knows of it
    q |= _model_queries()

    # Record batches, versions
    upload = f"PARTITION BY date, store_id, product_id ORDER BY {TIES}"
    in_upload = ", ".join(
        f"coalesce(lag(units_sold, {k}) OVER ({upload}), 0) AS units_lag_{k}" for k in (1, 7, 14)
    )
    mean = f"avg(units_sold) OVER ({upload} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    q["request_features"] = _with(
        SALES,
        f"SELECT {base}, {CALENDAR}, {in_upload}, {r6(f'coalesce({mean}, 0)')} AS units_ma_7 "
        "FROM sales",
    )
    changes = ", ".join(
        f"{r6(f'{c} - lag({c}) OVER (ORDER BY position)')} AS {c}_change" for c in ("mae", "rmse")
    )
    q["version_history"] = _with(
        REGISTRY,
        f"SELECT position, version, saved_at, {six('mae', 'rmse')}, model_path, is_current, "
        "lag(version) OVER (ORDER BY position) AS previous_version, "
        "lead(version) OVER (ORDER BY position) IS NULL AS is_newest, "
        f"{changes} FROM registry",
    )
    return q
