import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandloom.operators.features import calendar_features, demand_features, history_features
from demandloom.operators.series import CHUNK, HALO, in_chunks

DDL = "store_id string, product_id string, date date, line int, units_sold double"


def panel(spark, seed=1):
    """One series with most rows, one date with most of those, small series, missing keys."""
    rng = random.Random(seed)
    rows = []

    def add(store, product, day, line):
        date = dt.date(2022, 1, 1) + dt.timedelta(days=day)
        rows.append((store, product, date, line, float(rng.randrange(50))))

    for i in range(400):
        add("S1", "hot", rng.randrange(60) if i % 2 else 30, i)
    for i in range(40):
        add("S1", "small", rng.randrange(60), i)
        add("S2", "hot", rng.randrange(5), i)
    for i in range(3):
        add(None, "p", i, i)
        add("S3", None, i, i)
    add("S4", "single", 0, 0)
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DDL)


def plain(df):
    w = Window.partitionBy("store_id", "product_id").orderBy("date", "line")
    known = F.col("store_id").isNotNull() & F.col("product_id").isNotNull()
    out = df
    for k in (1, 7, 14):
        out = out.withColumn(
            f"units_lag_{k}",
            F.coalesce(F.when(known, F.lag("units_sold", k).over(w)), F.lit(0.0)),
        )
    mean = F.avg("units_sold").over(w.rowsBetween(-7, -1))
    return out.withColumn("units_ma_7", F.coalesce(F.when(known, mean), F.lit(0.0)))


def as_set(df, columns):
    return sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))


@pytest.mark.parametrize("max_rows", [1, 3, 10, 50, 10**6])
def test_chunked_equals_plain_window(spark, max_rows):
    df = panel(spark)
    want = plain(df)
    got = history_features(df, order=["date", "line"], max_rows=max_rows)
    assert as_set(got, want.columns) == as_set(want, want.columns)


def test_chunks_are_bounded(spark):
    rows = in_chunks(
        panel(spark),
        ["store_id", "product_id"],
        ["date", "line"],
        lookback=14,
        max_rows=50,
    )
    sizes = rows.where(~F.col(HALO)).groupBy("store_id", "product_id", CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50
    assert rows.where(~F.col(HALO)).count() == panel(spark).count()


def test_date_is_sliced_along_several_columns(spark):
    """All rows on one date; the first tie column mostly has one value."""
    rng = random.Random(3)
    day = dt.date(2022, 1, 1)
    rows = [
        ("S", "p", day, 7 if i % 3 else rng.randrange(10**6), i, float(rng.randrange(50)))
        for i in range(300)
    ]
    ddl = "store_id string, product_id string, date date, first int, line int, units_sold double"
    df = spark.createDataFrame(rows, ddl)
    ties = ["first", "line"]
    w = Window.partitionBy("store_id", "product_id").orderBy("date", *ties)
    want = df.withColumn("units_lag_7", F.coalesce(F.lag("units_sold", 7).over(w), F.lit(0.0)))
    got = demand_features(df, ties=ties, max_rows=20)
    assert as_set(got, want.columns) == as_set(want, want.columns)
    chunks = in_chunks(df, ["store_id", "product_id"], ["date", *ties], lookback=14, max_rows=20)
    sizes = chunks.where(~F.col(HALO)).groupBy(CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 20


@pytest.mark.parametrize("max_rows", [1, 3, 10])
@pytest.mark.parametrize("kind", ["null", "inf", "text", "one value"])
def test_any_tie_gives_the_plain_window(spark, kind, max_rows):
    """Missing, infinite, text and constant leading ties, told apart by the row number."""
    values = {
        "null": [None, 5.0], "inf": [float("-inf"), 1.0, float("inf"), None],
        "text": ["b", None, "a"], "one value": [7.0],
    }[kind]
    rng = random.Random(5)
    rows = [
        ("S", "p", dt.date(2022, 1, 1 + i % 2), rng.choice(values), i, float(i)) for i in range(40)
    ]
    first = "string" if kind == "text" else "double"
    ddl = f"store_id string, product_id string, date date, first {first}, line int, units_sold double"
    df = spark.createDataFrame(rows, ddl)
    w = Window.partitionBy("store_id", "product_id").orderBy(
        "date", F.col("first").asc_nulls_last(), "line"
    )
    want = df
    for k in (1, 7, 14):
        want = want.withColumn(f"units_lag_{k}", F.coalesce(F.lag("units_sold", k).over(w), F.lit(0.0)))
    got = demand_features(df, ties=["first", "line"], max_rows=max_rows)
    assert as_set(got, want.columns) == as_set(want, want.columns)


def test_complete_duplicates_are_cut(spark):
    rows = [("S", "p", dt.date(2022, 1, 1), 1, 4.0)] * 200
    df = spark.createDataFrame(rows, DDL)
    chunks = in_chunks(df, ["store_id", "product_id"], ["date", "line"], lookback=14, max_rows=10)
    sizes = chunks.where(~F.col(HALO)).groupBy(CHUNK).count()
    assert sizes.agg(F.max("count"), F.count("count")).first() == (10, 20)
    got = demand_features(df, ties=["line"], max_rows=10)
    assert got.count() == 200 and got.where("units_lag_14 = 0").count() == 14


def test_lag_of_second_row(spark):
    rows = [("S1", "P1", dt.date(2022, 1, 1), 0, 10.0), ("S1", "P1", dt.date(2022, 1, 2), 0, 12.0)]
    out = demand_features(spark.createDataFrame(rows, DDL)).orderBy("date").collect()
    assert "month" in out[0].asDict()
    assert (out[0].units_lag_1, out[1].units_lag_1) == (0.0, 10.0)


def test_missing_key_has_no_history(spark):
    rows = [("a", "p", 1, 1.0), ("a", "p", 2, 2.0), (None, "p", 3, 3.0), (None, "p", 4, 4.0)]
    df = spark.createDataFrame(rows, "store_id string, product_id string, n int, units_sold double")
    out = history_features(df, order=["n"], lags=[1], trailing=7).orderBy("n").collect()
    assert [r.units_lag_1 for r in out] == [0.0, 1.0, 0.0, 0.0]
    assert [r.units_ma_7 for r in out] == [0.0, 1.0, 0.0, 0.0]


def test_trailing_mean_stays_within_previous_values(spark):
    out = demand_features(panel(spark), ties=["line"])
    top = out.agg(F.max("units_ma_7").alias("m"), F.max("units_sold").alias("u")).first()
    assert top.m <= top.u


def test_weekday_of_a_monday(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "date date")
    row = calendar_features(df).first()
    assert (row.weekday, row.month, row.day_of_month, row.day_of_year) == (0, 1, 1, 1)


def test_events_as_second_panel(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = events.select(
        "event_id", F.col("ts").alias("date"), F.col("event_type").alias("store_id"),
        F.col("user_id").cast("string").alias("product_id"), F.col("event_id").alias("line"),
        F.col("value").alias("units_sold"),
    )
    want = plain(df)
    got = history_features(df, order=["date", "line"], max_rows=20)
    cols = ["event_id", "units_lag_1", "units_lag_14"]
    assert as_set(got, cols) == as_set(want, cols)
