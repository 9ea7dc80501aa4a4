import random

import numpy as np
import pytest

import odd
from demandloom.llm import jaccard as J
from demandloom.llm.components import components


def sets(docs):
    out = []
    for _, text in docs:
        w = (text or "").encode().lower().split()
        out.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute(docs):
    """(id, size, smallest id reachable) of every row, by comparing all pairs."""
    found = sets(docs)
    of = list(range(len(docs)))

    def root(k):
        while of[k] != k:
            k = of[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            union = len(found[a] | found[b])
            if found[a] and found[b] and 100 * len(found[a] & found[b]) >= 75 * union:
                of[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(docs):
        known = [docs[j][0] for j in range(len(docs)) if root(j) == root(k) and docs[j][0] is not None]
        own = known if found[k] else [i]
        out.append((str(i), len(found[k]), str(min(known)) if known and own else str(i if not found[k] else None)))
    return sorted(out)


def edited(rng, words, rate):
    return [rng.choice("abcdefgh") + str(rng.randrange(999)) if rng.random() < rate else w for w in words]


def family(seed, n, rates, length=60):
    rng = random.Random(seed)
    base = [f"b{rng.randrange(3000)}" for _ in range(length)]
    shared = " ".join(f"shared{k}" for k in range(25))
    out = []
    for k in range(n):
        words = edited(rng, base, rng.choice(rates))
        cut = rng.randrange(8)
        out.append(" ".join(words[cut:]) + (" " + shared if k % 4 == 0 else ""))
    return out


def got(spark, docs, parts=4):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.join(df).collect())


@pytest.mark.parametrize("long, frequent, block", [(24, 1 << 20, 256), (2, 40, 8), (0, 5, 4)])
def test_equals_comparing_all_pairs(spark, monkeypatch, long, frequent, block):
    monkeypatch.setattr(J, "LONG", long)
    monkeypatch.setattr(J, "FREQUENT", frequent)
    monkeypatch.setattr(J, "BLOCK", block)
    texts = []
    for seed in range(6):
        texts += family(seed, 25, [0.0, 0.01, 0.02, 0.04, 0.08])
    texts += family(77, 40, [0.03], length=30) + [f"shared{k % 25} " * 3 for k in range(5)]
    random.Random(1).shuffle(texts)
    docs = [(3 * k + 1, t) for k, t in enumerate(texts)]
    assert got(spark, docs) == brute(docs)


def test_threshold_is_exact(spark):
    """20 and 19 of 24: 15 of 20 common shingles of 20 in all link, one less does not."""
    words = [f"x{k}" for k in range(30)]
    docs = [(1, " ".join(words[:24])), (2, " ".join(words[:19])), (3, " ".join(words[:18])), (4, "A B C"), (5, "a b\tc"), (6, "a b c d")]
    assert got(spark, docs) == brute(docs)
    assert {r[2] for r in got(spark, docs[:2])} == {"1"}


def test_odd_tables(spark):
    df = odd.documents(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.join(df).collect())
    assert rows == brute(docs)
    assert J.join(df.limit(0)).count() == 0


def test_front_is_enough():
    """Similar sets share an element of their fronts, in any order of the elements."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.unique(np.concatenate([rng.permutation(x)[: int(len(x) * rng.uniform(0.7, 1))], rng.integers(0, 1 << 62, int(n * rng.uniform(0, 0.2))).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if not len(y) or 100 * common < 75 * (len(x) + len(y) - common):
            continue
        keys = np.unique(rng.choice(np.concatenate([x, y]), 10).astype(np.uint32))
        counts = rng.integers(1, 5, len(keys)).astype(np.uint32)
        assert len(np.intersect1d(J.front(x, keys, counts), J.front(y, keys, counts)))


def test_word_hashes(monkeypatch):
    texts = [b"", b" \n", b"a", b" One two\tTHREE\x0bfour\x0cfive\rsix ", "é É ünï\u00a0cöde".encode(), b"x" * 100, odd.prose(1, 500).encode()]
    known = {}
    for text in texts:
        words = text.lower().split()
        for word, h in zip(words, J.word_hashes(text).tolist(), strict=True):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    whole = [J.shingles(t).tolist() for t in texts]
    monkeypatch.setattr(J, "STRETCH", 7)
    assert [J.shingles(t).tolist() for t in texts] == whole


def test_deltas_round_trip():
    for keys in ([], [0], [5, 5 + 2**31, 2**32 - 1]):
        keys = np.array(keys, np.uint32)
        assert J._keys(J._deltas(keys)).tolist() == keys.tolist()


def test_components(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(50)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)] + [(7, 7)]
    label = {v: v for p in links if p[0] != p[1] for v in p}
    for _ in range(300):
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in rows} == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_family_is_not_paired(spark, monkeypatch):
    """Near copies of one text are compared with fewer than 20 others each."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(200)]
    docs = [(k, " ".join(edited(rng, base, rng.choice([0.005, 0.01, 0.02])))) for k in range(2000)]
    compared = []
    overlaps = J.Join.overlaps

    def counted(self, pairs):
        out = overlaps(self, pairs)
        compared.append(out.count())
        return out

    monkeypatch.setattr(J.Join, "overlaps", counted)
    got(spark, docs)
    assert sum(compared) < 20 * len(docs)


def test_elements_of_one_document_are_not_listed(spark):
    """Only elements that two documents hold are listed, at their places behind the others."""
    base = [f"w{k}" for k in range(40)]
    docs = [(1, " ".join(base)), (2, " ".join([*base[:-1], "other"])), (3, " ".join(f"v{k}" for k in range(50)))]
    join = J.Join(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    rows = join.entries().collect()
    one, other = (J.shingles(t.encode()) for _, t in docs[:2])
    common = set(np.intersect1d(one, other).view(np.int64).tolist())
    assert rows and {r.token for r in rows} <= common
    assert min(r["at"] for r in rows) == 1 and max(r["at"] for r in rows) == J.prefix_length(36) - 1


def test_entries_are_compared_with_the_leader_of_their_list(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(J, "BLOCK", 2)
    rows = [(7, 5, k, k % 3, 40, k // 8) for k in range(20)] + [(8, 5, 30, 3, 40, 0), (8, 6, 31, 4, 70, 0)]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["token", "band", "class", "label", "size", "at"])
    want = sorted((0, k) for k in range(20) if k % 3 and k // 8 <= 5)
    for step in (1, 3, 50):
        found = J._led(whole.slice(k, step) for k in range(0, len(rows), step))
        assert sorted(p for b in found for p in zip(*(c.to_pylist() for c in b.columns))) == want
