"""The daily sales table seen through the star-schema tables.

One row per `lineitem`.  The dimension joins follow foreign keys that are complete (every line has
its part, order and supplier), so a dimension is joined only when one of its columns is asked for;
reading three measures of the fact does not shuffle it against `orders`.  No join is hinted: the
dimensions grow with the data, and Spark broadcasts those whose size allows it.  Dimensions are
joined to the fact one by one, because the size estimate of a join between dimensions is the
product of their sizes and would rule the broadcast out.  The small ones come first and the largest
last, so a condition on store, product or line is applied before the fact meets the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that identify a line; they break ties wherever an order matters.
LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
TIE_BREAK = LINE_KEY + ("units_sold",)

_EXPRESSIONS = {
    "date": "cast(l_shipdate as date)",
    "store_id": "concat('S00', cast(n_regionkey as string))",
    "product_id": "p_brand",
    "category": "p_type",
    "region": "r_name",
    "weather_condition": "o_orderpriority",
    "holiday_promotion": "case when l_discount >= 0.05D then 1 else 0 end",
    "seasonality": (
        "case when month(l_shipdate) in (12, 1, 2) then 'Winter' "
        "when month(l_shipdate) in (3, 4, 5) then 'Spring' "
        "when month(l_shipdate) in (6, 7, 8) then 'Summer' else 'Autumn' end"
    ),
    "units_sold": "l_quantity - 1",
    "inventory_level": "cast((l_orderkey * 7 + l_partkey * 13 + l_linenumber * 31) % 60 as double)",
    "units_ordered": "cast((l_partkey * 17 + l_orderkey) % 200 as double)",
    "demand_forecast": "l_quantity + ((l_orderkey * 3 + l_partkey * 5 + l_linenumber) % 11) - 6",
    "price": "p_retailprice",
    "discount": "l_discount * 100",
    "competitor_pricing": "l_extendedprice / l_quantity",
    "model_forecast": "l_quantity + ((l_orderkey * 11 + l_partkey * 3 + l_suppkey) % 7) - 4",
}
SALES_COLUMNS = tuple(_EXPRESSIONS)

_NEEDS_PART = {"product_id", "category", "price"}
_NEEDS_ORDERS = {"weather_condition"}
_NEEDS_REGION = {"region"}
_NEEDS_SUPPLIER = {"store_id"} | _NEEDS_REGION


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The sales rows with the line key and the asked columns (all of them by default)."""
    wanted = set(columns or SALES_COLUMNS)
    rows = _table(spark, sf_dir, "lineitem")
    if wanted & _NEEDS_SUPPLIER:
        supplier, nation = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation")
        rows = rows.join(supplier, rows.l_suppkey == supplier.s_suppkey)
        rows = rows.join(nation, rows.s_nationkey == nation.n_nationkey)
    if wanted & _NEEDS_PART:
        part = _table(spark, sf_dir, "part")
        rows = rows.join(part, rows.l_partkey == part.p_partkey)
    if wanted & _NEEDS_ORDERS:
        orders = _table(spark, sf_dir, "orders")
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey)
    if wanted & _NEEDS_REGION:
        region = _table(spark, sf_dir, "region")
        rows = rows.join(region, rows.n_regionkey == region.r_regionkey)
    picked = [F.expr(_EXPRESSIONS[c]).alias(c) for c in SALES_COLUMNS if c in wanted]
    return rows.select(*LINE_KEY, *picked)


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales rows as text with unusable cells strewn in, the way a raw file arrives."""
    k = F.col("l_orderkey") + F.col("l_partkey") + F.col("l_linenumber")
    rows = sales(spark, sf_dir, *(c for c in SALES_COLUMNS if c != "model_forecast"))
    dirty = {
        "date": F.when(k % 37 == 0, "not-a-date")
        .when(k % 41 == 0, "2022-02-30")
        .when(k % 53 == 0, F.date_format("date", "yyyy-MM-dd'T'10:20:30"))
        .otherwise(F.date_format("date", "yyyy-MM-dd")),
        "category": F.when(k % 43 == 0, F.concat(F.lit('a "'), "category", F.lit('", b'))).otherwise(
            F.col("category")
        ),
        "region": F.when(k % 47 == 0, F.concat(F.lit(" "), "region", F.lit(" "))).otherwise(
            F.col("region")
        ),
        "holiday_promotion": F.when(k % 59 == 0, "Yes").otherwise(
            F.col("holiday_promotion").cast("string")
        ),
        "units_sold": F.when(k % 23 == 0, "n/a")
        .when(k % 29 == 0, "")
        .otherwise(F.col("units_sold").cast("string")),
        "inventory_level": F.when(k % 19 == 0, "bad").otherwise(
            F.col("inventory_level").cast("string")
        ),
        "price": F.when(k % 31 != 0, F.col("price").cast("string")),
    }
    return rows.select(
        *LINE_KEY,
        *(
            dirty.get(c, F.col(c).cast("string")).alias(c)
            for c in SALES_COLUMNS
            if c != "model_forecast"
        ),
    )
