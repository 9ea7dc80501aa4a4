import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import odd
from demandloom.llm import mixing


def water(sizes, weights=(1, 2, 3), cap=3):
    """Targets by exact arithmetic: share by weight, cut at the cap, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: Fraction(weights[k % len(weights)]) for k, s in enumerate(order)}
    total, full = Fraction(sum(sizes.values())), set()
    while True:
        open_ = [s for s in order if s not in full]
        rest = total - sum(cap * sizes[s] for s in full)
        share = rest / sum(w[s] for s in open_) if open_ else 0
        over = {s for s in open_ if share * w[s] > cap * sizes[s]}
        if not over:
            return {s: float(cap * sizes[s] if s in full else share * w[s]) for s in order}
        full |= over


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_words_taken(spark, seed):
    rng = random.Random(seed)
    rows = [(f"s{k}" if k else None, i, odd.prose(i, rng.randrange(1, 40))) for k in range(8) for i in range(4 ** (k % 5) + 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(n, t, s) for n, (s, _, t) in enumerate(rows)], "doc_id long, text string, source string")
    sizes = defaultdict(int)
    for s, _, t in rows:
        sizes[s] += len(t.split())
    want = water(sizes)
    got = mixing.mix(df).join(df.select("doc_id", "source"), "doc_id").collect()
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
    for s, target in want.items():
        assert abs(taken[s] - target) <= longest[s]


def test_expected_copies_meet_the_target(spark):
    rows = [("a", 0, 100, 250.0), ("a", 4, 300, 250.0), ("b", 2, 10, 30.0), ("b", 8, 40, 30.0), ("c", 3, 9, 27.0), ("d", 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "source string, octave int, words long, target double")
    copies = {(r.source, r.octave): r.copies for r in mixing.expected_copies(df, 3).collect()}
    for s, target in (("a", 250.0), ("b", 30.0), ("c", 27.0)):
        assert sum(w * copies[x, o] for x, o, w, _ in rows if x == s) == pytest.approx(target)
    assert copies["a", 4] == pytest.approx(4 * copies["a", 0]) and max(copies.values()) <= 3


def test_inclusion_follows_the_odds(spark):
    """Over many draws, documents are included about as often as expected."""
    df = spark.createDataFrame([(i, odd.prose(i, 5 if i % 2 else 40), f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    runs = [mixing.mix(df, seed=s) for s in range(4)]
    for size in (5, 40):
        plan = [r.where(F.col("size") == size).agg(F.avg("copies")).first()[0] for r in runs]
        assert max(plan) - min(plan) < 0.25
    assert runs[0].exceptAll(mixing.mix(df.repartition(5), seed=0)).isEmpty()


def test_odd_tables(spark):
    df = odd.documents(spark)
    got = mixing.mix(df).collect()
    assert len(got) == df.count()
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    sizes = sorted(len((r.text or "").encode().split()) for r in df.collect())
    assert sorted(r["size"] for r in got) == sizes
    kept = mixing.mix(df, keep=df.columns)
    assert kept.columns == [*df.columns[:8], *df.columns[8:], "copies"] and kept.count() == df.count()
    assert mixing.mix(df.limit(0)).count() == 0
    blank = df.where("text IS NULL OR text = ''")
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix(blank).collect())
    assert math.isclose(sum(r.taken for r in got), sum(sizes), rel_tol=0.7)
