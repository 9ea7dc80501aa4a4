import math

import pytest
from pyspark.sql import functions as F

from demandloom import functions as fn


def one(spark, expr_of, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr_of(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, value",
    [
        ("1e3", 1000.0),
        (" 12 ", 12.0),
        ("inf", math.inf),
        ("-inf", -math.inf),
        ("+.5", 0.5),
        ("1,000", None),
        ("1d", None),
        ("1f", None),
        ("True", None),
        ("0x10", None),
        ("1_000", None),
        ("", None),
        ("nan", None),
        (None, None),
    ],
)
def test_parse_number(spark, text, value):
    assert one(spark, fn.parse_number, text) == value


@pytest.mark.parametrize("text", ["NA", "N/A", "null", "None", "<NA>", "#N/A", "n/a", ""])
def test_missing_tokens(spark, text):
    assert one(spark, fn.without_missing_tokens, text) is None


def test_dash_is_text(spark):
    assert one(spark, fn.without_missing_tokens, "-") == "-"


@pytest.mark.parametrize(
    "text, day",
    [
        ("2022-01-05", "2022-01-05"),
        ("2022-1-5", "2022-01-05"),
        ("2022/01/02", None),
        ("2022-02-30", None),
        ("2022-01-01 10:00:00", "2022-01-01"),
        (" 2022-01-06", "2022-01-06"),
        ("x", None),
    ],
)
def test_parse_day(spark, text, day):
    found = one(spark, fn.parse_day, text)
    assert (found and found.isoformat()) == day


@pytest.mark.parametrize("a, b", [(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (None, 1.0)])
def test_ratio_without_denominator(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(fn.ratio(F.col("a"), F.col("b")).alias("r")).first().r is None


@pytest.mark.parametrize("x, y", [(None, None), (-1.0, 0.0), (2.0, 2.0)])
def test_at_least_zero(spark, x, y):
    assert one(spark, fn.at_least_zero, x, "double") == y


def test_comparisons_with_missing(spark):
    df = spark.createDataFrame([(None, 0.0), (1.0, None), (2.0, 1.0)], "a double, b double")
    rows = df.select(
        fn.above(F.col("a"), F.col("b")).alias("up"), fn.below(F.col("a"), F.col("b")).alias("down")
    ).collect()
    assert [(r.up, r.down) for r in rows] == [(False, False), (False, False), (True, False)]


@pytest.mark.parametrize(
    "x, y", [(2.675, 2.68), (0.125, 0.12), (0.135, 0.14), (1.005, 1.0), (0.015, 0.02)]
)
def test_round2(spark, x, y):
    assert one(spark, fn.round2, x, "double") == y


def test_totals_of_missing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    row = df.agg(fn.total(F.col("x")).alias("s"), F.avg("x").alias("m")).first()
    assert (row.s, row.m) == (0.0, None)


def test_is_finite(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, None, math.nan, math.inf, -math.inf)], "x double")
    assert df.where(fn.is_finite(F.col("x"))).count() == 1
