"""Built-in-only column expressions for the missing-value rules.

There is one missing marker in this package: NULL.  NaN is turned into NULL where data enters,
so averages, comparisons and sorts never meet it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts a CSV reader of the data treats as "no value".
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: what a plain number is made of (so no thousands marks, type suffixes or hex), or the
# one word that is a number.
NUMBER_TEXT = r"(?i)^\s*([\d.e+-]+|[+-]?inf)\s*$"
# Fixed value: year, month and day, and a time of day that is cut off.
DAY = r"^\s*(\d{4}-\d{1,2}-\d{1,2})(?:[T ].*)?$"


def without_missing_tokens(c: Column) -> Column:
    """NULL where the text is one of the missing tokens, else the text unchanged."""
    return F.when(~c.isin(*MISSING_TOKENS), c)


def without_nan(c: Column) -> Column:
    """NULL where a floating-point value is NaN."""
    return F.when(~F.isnan(c), c)


def parse_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    return F.when(c.rlike(NUMBER_TEXT), F.trim(c).try_cast("double"))


def parse_day(c: Column, date_format: str | None = None) -> Column:
    """Text to date; text that names no real day becomes NULL.

    Without a format, days and timestamps in the form `year-month-day` are read.
    """
    if date_format is not None:
        return F.try_to_timestamp(c, F.lit(date_format)).cast("date")
    return F.regexp_extract(c, DAY, 1).try_cast("date")


def flag_text(c: Column) -> Column:
    """A flag as the category it is: whole numbers in one spelling, any other text unchanged."""
    text = F.trim(c.cast("string"))
    number = parse_number(text)
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    return F.when(whole, number.cast("long").cast("string")).otherwise(text)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero or missing."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def at_least_zero(c: Column) -> Column:
    """Negative values become zero, missing values stay missing."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def above(a: Column, b: Column) -> Column:
    """a > b, False when either side is missing."""
    return F.coalesce(a > b, F.lit(False))


def below(a: Column, b: Column) -> Column:
    """a < b, False when either side is missing."""
    return F.coalesce(a < b, F.lit(False))


def total(c: Column) -> Column:
    """Sum aggregate that is 0.0 when every value is missing."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def round2(c: Column) -> Column:
    """Two decimals, scaled and rounded half to even."""
    return F.rint(c * 100.0) / 100.0
