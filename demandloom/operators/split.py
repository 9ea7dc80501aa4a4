"""Hold-out split by position in the canonical order, without sorting the table.

The last part of the rows in (store, product, date, tie-break) order is the test set.  Sorting all
rows to number them would be the largest shuffle of the pipeline, and only one position matters:
the first test row.  It is found step by step: the store that holds it, the product of that store,
the date of that series, and only there by ordering rows.  Each step counts the rows of what the
step before has found by one column, so it shuffles a count per value and task, and hands one row to
the driver.  Marking the rows is then a comparison with that row: no join, no shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SERIES
from ..sources.scratch import written
from .series import MAX_ROWS, PLACE, in_order, numbered

TEST_SIZE = 0.2


def _is(column: str, value: Any) -> Column:
    return F.col(column).isNull() if value is None else F.col(column) == F.lit(value)


def _holding(counts: DataFrame, by: str, skip: int) -> Row:
    """The group with position `skip`: its row, with the position counted from its start.

    One row per group: stores, products of a store, dates of a series.  These are few enough to be
    put in order in one task whatever the number of rows behind them.
    """
    w = Window.orderBy(F.col(by).asc_nulls_last())
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        counts.withColumn("_before", before)
        .withColumn("_skip", F.lit(skip) - F.col("_before"))
        .where((F.col("_skip") >= 0) & (F.col("_skip") < F.col("_n")))
        .first()
    )


def first_test_row(
    df: DataFrame,
    *,
    test_size: float = TEST_SIZE,
    keys: Sequence[str] = (*SERIES, "date"),
    ties: Sequence[str] = (),
    max_rows: int = MAX_ROWS,
) -> dict[str, Any] | None:
    """The order columns of the first test row; None if there is no row.

    A date with more than `max_rows` rows is put in order by ranges, others in one task.
    """
    rows = df.select(*dict.fromkeys([*keys, *ties]))
    skip, found = None, None
    for key in keys:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        if found is None:
            counts = written(counts, "row_counts")
            share = F.sum("_n") - F.ceil(F.lit(test_size) * F.sum("_n"))
            skip = counts.agg(share.alias("skip")).first()["skip"]
            if skip is None:
                return None
        found = _holding(counts, key, skip)
        skip, rows = found["_skip"], rows.where(_is(key, found[key]))
    if found["_n"] > max_rows:
        placed = numbered(rows, [], ties)
    else:
        w = Window.orderBy(*(in_order(ties) or [F.lit(1)]))
        placed = rows.withColumn(PLACE, F.row_number().over(w) - 1)
    return placed.where(F.col(PLACE) == skip).drop(PLACE).first().asDict()


def _literal(value: Any, kind: T.DataType) -> Column:
    if isinstance(value, (dt.date, dt.datetime)):
        return F.lit(str(value)).cast(kind)
    return F.lit(value).cast(kind)


def mark_test(df: DataFrame, first: Mapping[str, Any] | None) -> DataFrame:
    """Add `is_test`: True from the first test row on, in the order of its columns.

    Rows that are equal on all of them go to the same side.
    """
    if first is None:
        return df.withColumn("is_test", F.lit(False))
    # Missing values come last, so each column is compared as (is missing, value).
    here, there = [], []
    for c, value in first.items():
        here += [F.col(c).isNull(), F.col(c)]
        there += [F.lit(value is None), _literal(value, df.schema[c].dataType)]
    at_or_after = F.struct(*(c.alias(f"c{i}") for i, c in enumerate(here))) >= F.struct(
        *(c.alias(f"c{i}") for i, c in enumerate(there))
    )
    return df.withColumn("is_test", at_or_after)


def positional_split(
    df: DataFrame,
    *,
    test_size: float = TEST_SIZE,
    keys: Sequence[str] = (*SERIES, "date"),
    ties: Sequence[str] = (),
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add `is_test`: True for the last ceil(test_size * n) rows ordered by keys, then ties."""
    return mark_test(
        df, first_test_row(df, test_size=test_size, keys=keys, ties=ties, max_rows=max_rows)
    )
