"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  Its documents share the target by classes of length:
a class's expected copies grow with the square root of its lengths, as long documents carry more
context per copy, up to the limit of copies.  The whole copies are certain.  For what is left each
document has an inclusion probability p; documents are ranked by their random odds divided by their
inclusion odds, (u / (1 - u)) / (p / (1 - p)), with u drawn from a hash of the document, and taken
from the lowest rank on.  A design of fixed size in words stops where the target is met.

The cut in a source's ranking is found by counting: ranks are mapped to 2^24 steps, words are summed per coarse step, then per fine step within the coarse step where the
target is met, and only the documents of that one fine step are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, quoted, shuffle_partitions, small_side, written

MAX_COPIES = 3
SEED = 11
WEIGHTS = (1, 2, 3)
#: Coarse and fine steps of a ranking, as powers of two.
STEP_BITS = 12
MAX_OCTAVE = 40


def size_of(text: Column) -> Column:
    """Number of words; 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Add n, the 0-based place of each source by code point, missing last, without one big sort.

    Sources are dealt by range; each range counts its own and adds the counts of those before it.
    """
    parts = shuffle_partitions(sources.sparkSession)
    key = F.col("source").isNull(), F.col("source")
    dealt = written(
        sources.repartitionByRange(parts, *key).select("*", F.spark_partition_id().alias("part")), "ranges"
    )
    # At most one row per range.
    before = dealt.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    own = F.row_number().over(Window.partitionBy("part").orderBy(*key))
    return (
        dealt.withColumn("own", own)
        .join(F.broadcast(before.select("part", "before")), "part")
        .withColumn("n", F.col("own") - 1 + F.col("before"))
        .drop("part", "own", "before")
    )


def targets(sources: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Add to sources(source, source_size) the weight and the target.

    All words are shared by weight; what exceeds `cap` times a source's size goes back and is shared
    among the others by weight, until none exceeds.
    """
    steps = F.array(*[F.lit(float(w)) for w in weights])
    weighted = written(
        ranked(sources)
        .withColumn("weight", F.element_at(steps, F.expr(f"int(n % {len(weights)}) + 1")))
        .withColumn("limit", F.col("source_size") * F.lit(float(cap))),
        "sources",
    )
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    share = None
    while True:
        full = F.lit(False) if share is None else F.expr(f"{share!r}D * weight >= limit")
        row = weighted.agg(
            F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)).alias("fixed"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if row["weight"] is None:
            break
        new = (total - row["fixed"]) / row["weight"]
        if new == share:
            break
        share = new
    target = F.least(F.col("limit"), F.expr(f"{share or 0.0!r}D * weight"))
    return weighted.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(0.0)).drop("limit", "n")


def expected_copies(classes: DataFrame, cap: float) -> DataFrame:
    """Add `copies`, the expected copies of a document, to rows of source, octave, words, target.

    Copies are in proportion to 2^(octave / 2), at most `cap`; the longest classes reach it first.
    """
    by_length = Window.partitionBy("source").orderBy(F.desc("octave"))
    above = by_length.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_length.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    pull = F.pow(F.lit(2.0), F.col("octave") / 2)
    solved = (
        classes.withColumn("pull", pull)
        .withColumn("above", F.coalesce(F.sum("words").over(above), F.lit(0)) * F.lit(float(cap)))
        .withColumn("rest", F.sum(F.col("words") * F.col("pull")).over(rest))
        .withColumn("c", F.try_divide(F.col("target") - F.col("above"), F.col("rest")))
        # The classes above are full; this is the first that is not.
        .withColumn("c", F.when(F.expr(f"c >= 0 AND c * pull <= {float(cap)!r}D"), F.col("c")))
        .withColumn("c", F.max("c").over(Window.partitionBy("source")))
    )
    copies = F.least(F.lit(float(cap)), F.coalesce(F.col("c") * F.col("pull"), F.lit(float(cap))))
    return solved.withColumn("copies", copies).select("source", "octave", "copies")


def _passing(frame: DataFrame, step: str) -> DataFrame:
    """Per source, the step in which the running sum of words passes `need`, and what is left to need."""
    order = Window.partitionBy("source").orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        frame.withColumn("upto", F.sum("words").over(order))
        .where("upto > need AND upto - words <= need")
        .select("source", step, (F.col("need") - (F.col("upto") - F.col("words"))).alias("need"))
    )


def _joined(left: DataFrame, right: DataFrame, rows: int, how: str = "inner", on: str = "source") -> DataFrame:
    """Join on a key that may be missing; a small right side is broadcast."""
    keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on.split()]
    more = [F.col(f"r.{c}") for c in right.columns if c not in on.split()]
    return left.alias("l").join(small_side(right, rows).alias("r"), keys, how).select("l.*", *more)


def _placed(docs: DataFrame) -> DataFrame:
    """Add whole, the certain copies, and t in 0 to 1, the rank by odds; t is missing where p is 0."""
    u = (F.col("draw") + 0.5) / F.lit(float(1 << 52))
    p = F.col("copies") - F.col("whole")
    rank = u / (1 - u) / F.when(p > 0, p / (1 - p))
    return docs.withColumn("whole", F.floor("copies")).withColumn("t", rank / (1 + rank))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of `df`: id, size, source_size, target, copies, taken; or `keep` and copies.

    A missing text has no words and is never taken; a missing source is a source of its own, last in
    order.  Repeated rows have the same draw, so they are taken or left together.  A document is
    taken whole, 0 to `max_copies` times.  An empty table gives no rows.  Reruns agree, as draws
    come from hashes of seed, id and text.
    """
    text = quoted(text_col).cast("string")
    identity = F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(quoted(id_col).cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    )
    docs = df.select(
        quoted(source_col).alias("source"),
        quoted(id_col).alias("id"),
        size_of(text).alias("size"),
        F.conv(F.substring(F.md5(identity.cast("binary")), 1, 13), 16, 10).cast("long").alias("draw"),
        *[quoted(c).alias(f"_keep_{k}") for k, c in enumerate(keep)],
    ).withColumn("octave", F.least(F.floor(F.log2(F.greatest("size", F.lit(1)))), F.lit(MAX_OCTAVE)).cast("int"))
    light = written(docs.select("source", "id", "size", "octave", "draw"), "sizes")

    classes = written(light.groupBy("source", "octave").agg(F.sum("size").alias("words")), "classes")
    sources = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    wanted = written(targets(sources, weights, max_copies).select("source", "source_size", "target"), "targets")
    n_sources, n_classes = wanted.count(), classes.count()
    plan = written(expected_copies(_joined(classes, wanted, n_sources), max_copies), "copies")
    whole = _joined(classes, plan, n_classes, on="source octave").groupBy("source").agg(
        F.sum(F.col("words") * F.floor("copies")).alias("certain")
    )
    need = _joined(wanted, whole, n_sources).select("source", (F.col("target") - F.col("certain")).alias("need"))

    # The cut: coarse step, fine step in it, document in that.
    drawn = (
        _placed(_joined(light, plan, n_classes, on="source octave"))
        .where("t IS NOT NULL AND size > 0")
        .select("source", "size", "t")
        .withColumn("coarse", F.floor(F.col("t") * (1 << STEP_BITS)))
        .withColumn("fine", F.floor(F.col("t") * (1 << 2 * STEP_BITS)))
    )
    sums = drawn.groupBy("source", "coarse").agg(F.sum("size").alias("words"))
    first = written(_passing(_joined(sums, need, n_sources), "coarse"), "coarse")
    inside = _joined(drawn, first.withColumnRenamed("coarse", "at"), n_sources).where("coarse = at")
    sums = inside.groupBy("source", "fine", "need").agg(F.sum("size").alias("words"))
    second = written(_passing(sums, "fine"), "fine")
    inside = _joined(drawn, second.withColumnRenamed("fine", "at"), n_sources).where("fine = at")
    order = Window.partitionBy("source").orderBy("t", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken_last = (
        inside.withColumn("upto", F.sum("size").over(order))
        .where("upto - size / 2 <= need")
        .groupBy("source")
        .agg(F.max("t").alias("last"))
    )
    width = float(1 << 2 * STEP_BITS)
    cuts = _joined(second.select("source", "fine"), taken_last, n_sources, "left").select(
        "source", F.coalesce("last", F.col("fine") / F.lit(width)).alias("cut"), F.col("last").isNotNull().alias("closed")
    )
    # A source whose target takes every ranked document has no cut.
    limits = _joined(wanted, cuts, n_sources, "left").withColumns(
        {"cut": F.coalesce("cut", F.lit(2.0)), "closed": F.coalesce("closed", F.lit(True))}
    )
    limits = written(limits, "limits")

    base = _placed(_joined(docs if keep else light, plan, n_classes, on="source octave"))
    base = _joined(base, limits, n_sources)
    extra = F.expr("t IS NOT NULL AND (t < cut OR (closed AND t = cut))").cast("long")
    copies = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(F.lit(0)).cast("long")
    base = base.withColumn("_copies", copies)
    if keep:
        return base.select(*[F.col(f"_keep_{k}").alias(c) for k, c in enumerate(keep)], F.col("_copies").alias("copies"))
    return base.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("size")).alias("taken"),
    )
