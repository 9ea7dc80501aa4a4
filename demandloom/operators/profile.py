"""Looks at a dataset: column types, filled cells, missing cells, first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _per_column(df: DataFrame, columns: Sequence[str], measure, name: str) -> DataFrame:
    """One aggregate per column in a single pass, turned into one row per column."""
    one_row = df.agg(*(measure(F.col(c)).alias(c) for c in columns))
    return one_row.unpivot([], list(columns), "column", name)


def profile_columns(df: DataFrame) -> DataFrame:
    """Type and number of filled cells of every column."""
    types = F.create_map(*(F.lit(x) for pair in df.dtypes for x in pair))
    counts = _per_column(df, df.columns, F.count, "non_null")
    return counts.select("column", types[F.col("column")].alias("dtype"), "non_null")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of missing cells of each named column."""

    def missing(c: Column) -> Column:
        return F.count_if(c.isNull())

    return _per_column(df, columns, missing, "missing")


def preview_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*order).limit(n)


class Observed:
    """Row count, profile and missing counts that come along with the write of a table.

    `rows(df)` is `df` with the counts attached; once it has been written, the tables are there
    without a scan of their own.  `only` names the rows that count, as a condition.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], only: Column | None = None):
        self.types = {c: t for c, t in df.dtypes if c in set(columns)}
        self._seen = Observation()
        only = F.lit(True) if only is None else only
        filled = [F.count(F.when(only, F.col(f"`{c}`"))).alias(f"n{k}") for k, c in enumerate(self.types)]
        self.df = df.observe(self._seen, F.count_if(only).alias("counted"), F.count("*").alias("rows"), *filled)

    @property
    def counted(self) -> int:
        return self._seen.get["counted"]

    @property
    def left_out(self) -> int:
        return self._seen.get["rows"] - self.counted

    def _filled(self) -> dict[str, int]:
        return {c: self._seen.get[f"n{k}"] for k, c in enumerate(self.types)}

    def profile(self, spark: SparkSession) -> DataFrame:
        """As `profile_columns`."""
        rows = [(c, self.types[c], n) for c, n in self._filled().items()]
        return spark.createDataFrame(rows, "column string, dtype string, non_null bigint")

    def null_counts(self, spark: SparkSession, columns: Sequence[str]) -> DataFrame:
        """As `null_counts`."""
        filled = self._filled()
        rows = [(c, self.counted - filled[c]) for c in columns]
        return spark.createDataFrame(rows, "column string, missing bigint")
