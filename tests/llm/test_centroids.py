import random
from hashlib import sha256
from math import floor, inf, isfinite, nan

import pytest

from demandloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, q int, cluster string, near int, `a.b` int"
EXTRA = (1, 2, "c", 3, 4)


def plain(rows, dimensions, scale, clusters, rounds, seed):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and isfinite(x) for x in v):
            bound = centroids.LARGEST
            kept.append((i, [int(floor(min(max(x * scale, -bound), bound))) for x in v]))

    def name(item):
        i, q = item
        return (i is None, sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "", q)

    middle = [q for _, q in sorted(kept, key=name)[:clusters]]
    far = lambda q, c: sum((a - b) ** 2 for a, b in zip(q, c))
    near = lambda q: min((far(q, c), k) for k, c in enumerate(middle))
    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(near(q)[1], []).append(q)
        middle = [
            [sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(middle)
        ]
    out = [(i, *near(q)) for i, q in kept]
    total = sum(d for _, d, _ in out)
    return sorted(
        (str(i), k, d, sum(e for _, e, m in out if m == k), total,
         sha256(",".join(map(str, middle[k])).encode()).hexdigest())
        for i, d, k in out
    )


def vectors(n, dimensions, seed=3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(i % 4, 0.4) for _ in range(dimensions)]) for i in range(n)]


def odd_vectors(dimensions):
    rows = vectors(80, dimensions)
    same = [0.25] * dimensions
    rows += [(100 + k, same) for k in range(60)] + [rows[0], rows[0], (3, same)]
    rows += [(None, same), (None, [1.0] * dimensions), (200, None), (201, []), (202, [1.0] * (dimensions + 1))]
    rows += [(203, [nan] * dimensions), (204, [inf] + [0.0] * (dimensions - 1)), (205, [None] * dimensions)]
    rows += [(206, [1e300] * dimensions), (207, [-1e30] + [0.0] * (dimensions - 1)), (208, [-0.0] * dimensions)]
    return rows


@pytest.mark.parametrize("dimensions, clusters, rounds, seed", [(6, 5, 3, 1), (6, 300, 2, 2), (64, 16, 3, 1), (3, 4, 0, 9)])
def test_equals_plain_loops(spark, dimensions, clusters, rounds, seed):
    rows = odd_vectors(dimensions)
    df = spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], SCHEMA).repartition(5)
    found = centroids.cluster(df, dimensions=dimensions, clusters=clusters, rounds=rounds, seed=seed)
    got = sorted((str(r[0]), *r[1:]) for r in found.collect())
    want = [(i, k, d, *rest) for i, k, d, *rest in plain(rows, dimensions, 64, clusters, rounds, seed)]
    assert got == [tuple(w) for w in want]
    assert [t for _, t in found.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_floats(spark):
    rows = vectors(50, 4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = centroids.cluster(df, dimensions=4, clusters=3).collect()
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(stored, 4, 64, 3, 3, 1)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [1.0])]])
def test_nothing_kept(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert centroids.cluster(df).count() == 0


def test_no_python_on_the_workers(spark):
    df = spark.createDataFrame(vectors(30, 4), "vec_id long, embedding array<double>")
    plan = centroids.cluster(df, dimensions=4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
