"""Exact column medians without holding a column in one task.

An approximate quantile with a bounded rank error brackets the middle values in one pass; a second
pass counts what lies below the brackets, a third counts the few values inside.  The middle values
are then read off these counts.  Nothing but the values between the brackets is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The brackets lie this share of the rows, twice, to either side of the middle.
ACCURACY = 10_000


def column_medians(
    df: DataFrame, columns: Sequence[str], *, accuracy: int = ACCURACY
) -> dict[str, float | None]:
    """Median of each column (mean of the two middle values), None for a column without values.

    The result is one number per column, so it is handed back as plain values: filling with
    literals keeps the plan of the filled frame free of joins.
    """
    values = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    names = values.columns
    shares = [max(0.0, 0.5 - 2 / accuracy), min(1.0, 0.5 + 2 / accuracy)]
    rough = values.agg(
        *(F.count(c).alias(f"{c}_n") for c in names),
        *(F.percentile_approx(c, shares, accuracy).alias(f"{c}_around") for c in names),
    ).first()
    brackets = {c: tuple(rough[f"{c}_around"]) for c in names if rough[f"{c}_n"]}
    if not brackets:
        return dict.fromkeys(columns)
    below = values.agg(*(F.count_if(F.col(c) < low).alias(c) for c, (low, _) in brackets.items())).first()

    cells = F.array(
        *(
            F.when(F.col(c).between(low, high), F.struct(F.lit(c).alias("name"), F.col(c).alias("x")))
            for c, (low, high) in brackets.items()
        )
    )
    inside = (
        values.select(F.explode(F.array_compact(cells)).alias("cell"))
        .groupBy("cell.name", "cell.x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("name").orderBy("x"))
    ranks = {c: ((rough[f"{c}_n"] - 1) // 2 - below[c], rough[f"{c}_n"] // 2 - below[c]) for c in brackets}
    wanted = F.when(F.lit(False), F.array(F.lit(0), F.lit(0)))
    for c, (lower, upper) in ranks.items():
        wanted = wanted.when(F.col("name") == c, F.array(F.lit(lower), F.lit(upper)))
    picked = (
        inside.withColumn("upto", upto)
        .select("name", "x", "upto", F.posexplode(wanted).alias("which", "rank"))
        .where(F.col("upto") > F.col("rank"))
        .groupBy("name", "which")
        .agg(F.min("x").alias("x"))
        .collect()
    )
    found = {(r["name"], r["which"]): r["x"] for r in picked}
    medians = {
        c: (found[f"c{i}", 0] + found[f"c{i}", 1]) / 2 if f"c{i}" in brackets else None
        for i, c in enumerate(columns)
    }
    return medians
