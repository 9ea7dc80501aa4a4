"""Windows over long series, cut into chunks of bounded size.

A window partitioned by (store, product) sorts a whole series in one task, and one series may hold
a third of all rows.  `in_chunks` gives every row the chunk of its series it is computed in, so
that the window partitions by (series, chunk) instead:

* a series with at most `max_rows` rows is one chunk; such rows meet no shuffle besides the one of
  the window;
* the rows of longer series are numbered, and every `max_rows` of them are a chunk.  Numbering is
  one sort by ranges: the ranges cut series and dates wherever they have to, also where rows are
  equal on all order columns, and a row's number follows from counts per range;
* the `lookback` rows before a chunk are added to it as halo rows.  They take part in the window
  and are dropped by `without_halo`.

The order is the same in every case: ascending, missing values last.  Whether there are long series
at all is looked up first, with one count per series; without any, the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.scratch import written

MAX_ROWS = 4_000_000

CHUNK = "_chunk"
HALO = "_halo"
PLACE = "_place"


def in_order(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def have_keys(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add the place, from 0, of each row in its series; no task holds a whole series.

    Keys must not be missing.  Rows that are equal on all order columns are told apart by where
    they were read, so a range can end between them.
    """
    keys = list(keys)
    by = [*(F.col(k) for k in keys), *in_order(order), F.col("_read")]
    dealt = df.withColumn("_read", F.monotonically_increasing_id())
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(
        dealt.repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_id", F.monotonically_increasing_id())
        .drop("_read"),
        "numbered",
    )
    # At most one row per series and range.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
        .select(*keys, "_part", "_shift")
    )
    return (
        dealt.join(starts, [*keys, "_part"])
        .withColumn(PLACE, F.col("_id") + F.col("_shift"))
        .select(*df.columns, PLACE)
    )


def in_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lookback: int,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add the chunk number, the halo flag and the place, and the halo rows.

    Rows that lack a key belong to no series; each is a chunk of its own.
    """
    keys = list(keys)
    known = have_keys(keys)
    long_series = (
        df.where(known)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > max_rows)
    )
    alone = F.xxhash64(*order)
    zero = F.lit(0).cast("long")
    whole = {CHUNK: F.when(known, zero).otherwise(alone), HALO: F.lit(False), PLACE: zero}
    if long_series.isEmpty():
        return df.withColumns(whole)
    long_series = written(long_series, "long_series")
    short = df.join(long_series, keys, "left_anti").withColumns(whole)
    rows = numbered(df.join(long_series, keys, "left_semi"), keys, order).join(long_series, keys)
    own = F.expr(f"{PLACE} div {max_rows}")
    # The later chunks that look back to this row, none behind the last one of the series.
    last = F.least(F.expr(f"({PLACE} + {lookback}) div {max_rows}"), F.expr(f"(_n - 1) div {max_rows}"))
    cut = (
        rows.select(*df.columns, PLACE, own.alias("_own"), F.explode(F.sequence(own, last)).alias(CHUNK))
        .withColumn(HALO, F.col(CHUNK) > F.col("_own"))
        .select(*df.columns, CHUNK, HALO, PLACE)
    )
    return short.unionByName(cut)


def chunk_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Rows of a cut series that are equal on all order columns stay as they were numbered."""
    return Window.partitionBy(*keys, CHUNK).orderBy(*in_order(order), PLACE)


def without_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(CHUNK, HALO, PLACE)
