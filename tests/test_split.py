import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandloom.operators import split as split_module
from demandloom.operators.split import positional_split


def table(spark, n, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["a", "b", "c", None]),
            rng.choice(["x", "y", None]),
            rng.choice([1, 2, 3]),
            i,
        )
        for i in range(n)
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "store_id string, product_id string, date int, line int")


@pytest.mark.parametrize("n, max_rows", [(1, 10), (7, 10), (200, 10**6), (200, 2), (333, 5)])
@pytest.mark.parametrize("test_size", [0.2, 0.5])
def test_equals_numbering_all_rows(spark, n, max_rows, test_size):
    df = table(spark, n, n)
    order = ["store_id", "product_id", "date", "line"]
    w = Window.orderBy(*(F.col(c).asc_nulls_last() for c in order))
    kept = n - math.ceil(test_size * n)
    want = df.withColumn("is_test", F.row_number().over(w) > kept)
    got = positional_split(df, ties=["line"], test_size=test_size, max_rows=max_rows)
    assert got.where("is_test").count() == math.ceil(test_size * n)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_date_sliced_along_ties(spark):
    df = spark.range(5000).select(
        F.lit("s").alias("store_id"), F.lit("p").alias("product_id"),
        F.lit(1).alias("date"), F.col("id").alias("line"),
    )
    got = positional_split(df, ties=["line"], max_rows=3)
    assert got.where("is_test").agg(F.min("line"), F.count("line")).first() == (4000, 1000)


def test_hot_date_with_one_leading_tie(spark):
    df = spark.range(2000).select(
        F.lit("s").alias("store_id"), F.lit("p").alias("product_id"), F.lit(1).alias("date"),
        F.lit(5).alias("first"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"),
        F.col("id").alias("line"),
    )
    got = positional_split(df, ties=["first", "text", "line"], max_rows=3)
    assert got.where("is_test").count() == 400


@pytest.mark.parametrize("max_rows", [1, 3, 10, 10**6])
def test_share_is_exact_with_missing_and_infinite_ties(spark, max_rows):
    values = [None, float("inf"), float("-inf"), 2.0]
    rows = [("s", "p", 1, values[i % 4], i) for i in range(83)]
    df = spark.createDataFrame(
        rows, "store_id string, product_id string, date int, first double, line int"
    )
    w = Window.orderBy(F.col("first").asc_nulls_last(), "line")
    want = df.withColumn("is_test", F.row_number().over(w) > 83 - math.ceil(0.2 * 83))
    got = positional_split(df, ties=["first", "line"], max_rows=max_rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_table(spark):
    df = table(spark, 3, 1).limit(0)
    assert positional_split(df, ties=["line"]).count() == 0


def test_counts_are_as_few_as_stores(spark, monkeypatch):
    df = spark.range(900).select(
        (F.col("id") % 2).cast("string").alias("store_id"), (F.col("id") % 3).cast("string").alias("product_id"),
        (F.col("id") % 300).alias("date"), F.col("id").alias("line"),
    )
    sizes, usual = [], split_module.written

    def written(counts, name):
        found = usual(counts, name)
        sizes.append(found.count())
        return found

    monkeypatch.setattr(split_module, "written", written)
    assert positional_split(df, ties=["line"]).where("is_test").count() == 180
    assert sizes == [2]
