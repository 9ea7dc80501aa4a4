import random
from collections import defaultdict
from hashlib import md5, sha256
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import prefix_trie
from demandloom.operators import series

TURNS = "conv_id long, turn long, role string, text string, n_convs int, id string, size int, `a.b` int"
EXTRA = (1, "x", 5, 2)


def tables():
    rng = random.Random(5)
    rows = []
    for c in [*range(60), -7, -5, -3, 105, 203]:
        for t in range(rng.randrange(1, 13)):
            shared = rng.random() < 0.6
            rows.append((c, t, rng.choice(["user", None]), f"t{t % 3}" if shared else f"é{c}.{t}"))
    rows += [(61, None, "user", "first"), (61, 0, None, None), (61, None, "a", "early"), (62, None, None, None)]
    rows += [(63, 1, "user", "same")] * 3 + [(None, 0, "user", "no conversation"), (None, None, None, None)]
    rows += [(c, t, "user", f"long {t}") for c in (200, 201, 400) for t in range(45)]
    rows += [(c, t, "user", "copy" * (t + 1)) for c in range(300, 340) for t in range(3)]
    rows += [(500, 0, "user", "long text " * 50_000)]
    rng.shuffle(rows)
    return rows


def turns(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], TURNS)


def in_order(rows):
    held = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            held[c].append(((t is not None, t or 0, tie), (role, text)))
    return {c: tuple(turn for _, turn in sorted(v)) for c, v in held.items()}


def forked(held):
    out = {}
    for c, own in held.items():
        h = crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = held.get(base, ())[:h] + own[h:]
    return out


def plain(held):
    """Rows of the trie, every node by its whole prefix."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in held.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
         sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def collected(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted(tuple(r) for r in df.select(names).collect())


@pytest.mark.parametrize("piece", [4096, 10, 9])
def test_equals_whole_prefixes(spark, monkeypatch, piece):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rows = tables()
    found = prefix_trie.sequences(turns(spark, rows))
    assert collected(prefix_trie.trie(found)) == plain(in_order(rows))
    assert collected(prefix_trie.trie(prefix_trie.rebuilt(found))) == plain(forked(in_order(rows)))


def test_small_memory_gives_the_same_rows(monkeypatch):
    """Tries that are expanded early, in the process of the test."""
    import pyarrow as pa

    rng = random.Random(1)
    rows = []
    for c in range(200):
        path = [rng.randrange(3) for _ in range(rng.randrange(0, 9))]
        ids = [f"{path[: d + 1]}".encode() for d in range(len(path))]
        sizes = [n + 1 for n in path]
        rows.append({"conv_id": c, "start": 0, "start_id": prefix_trie.ROOT, "tail": 0, "ids": ids, "sizes": sizes})
    batch = pa.RecordBatch.from_pylist(rows)

    def summed(limit):
        monkeypatch.setattr(prefix_trie, "HELD_TURNS", limit)
        out = defaultdict(lambda: [10**9, 0, 0])
        for part in prefix_trie._tries(iter([batch.slice(0, 90), batch.slice(90)])):
            for r in part.to_pylist():
                v = out[r["id"], r["parent_id"], r["depth"], r["size"]]
                v[0], v[1], v[2] = min(v[0], r["conv_id"]), v[1] + r["n_convs"], v[2] + r["gross"]
        return out

    assert summed(10**9) == summed(1) == summed(100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=12), min_size=1, max_size=25), st.integers(1, 9))
def test_z_fast_trie(words, size):
    """Fat binary search finds the same node as a walk, and every prefix is expanded once."""
    trie = prefix_trie.ZFastTrie(b"")
    paths = [[b"", *("".join(w[: d + 1]).encode() for d in range(len(w)))] for w in words]
    for start in range(0, len(paths), size):
        trie.insert_batch(
            [(start + k, p, [0, *[1] * (len(p) - 1)], 0) for k, p in enumerate(paths[start : start + size])]
        )
        for p in paths:
            walked = max(
                (n for n in trie.nodes if n.high < len(p) and n.ids[n.high] == p[n.high]), key=lambda n: n.high
            )
            assert trie.locate(p) is walked
        for n in trie.nodes[1:]:
            assert trie.handles[n.ids[prefix_trie.two_fattest(n.low, n.high)]] is n
            assert n.parent.high == n.low
    rows = [*trie.expanded()]
    want = {p[d] for p in paths for d in range(len(p))}
    assert len(rows) == len(want) and {r[0] for r in rows} == want
    for id_, above, depth, _, first, n, behind in rows:
        members = [k for k, p in enumerate(paths) if len(p) > depth and p[depth] == id_]
        assert (first, n) == (min(members), len(members))
        assert behind == sum(len(paths[k]) - max(depth, 1) for k in members)


def test_members_in_many_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(prefix_trie, "TEXT_IDS", 2)
    rows = [(b"a", 1), (b"a", 2), (b"a", 10), (b"a", 11), (b"a", 12), (b"b", -1), (b"c", 3), (b"c", 4)]
    batch = pa.RecordBatch.from_pylist([{"id": i, "conv_id": c} for i, c in rows])
    texts = [*prefix_trie._ends(iter([batch.slice(0, 4), batch.slice(4)]))]
    assert max(t.count(",") for b in texts for t in b.column("members").to_pylist()) == 1
    got = {r["id"]: r["ends_sha256"] for b in prefix_trie._hashed(iter(texts)) for r in b.to_pylist()}
    assert got == {i: sha256(t).hexdigest() for i, t in [(b"a", b"1,2,10,11,12"), (b"b", b"-1"), (b"c", b"3,4")]}


def test_two_fattest():
    for high in range(1, 70):
        for low in range(high):
            want = max(range(low + 1, high + 1), key=lambda n: n & -n)
            assert prefix_trie.two_fattest(low, high) == want


def test_empty_and_without_ids(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        found = prefix_trie.sequences(turns(spark, rows))
        assert prefix_trie.trie(prefix_trie.rebuilt(found)).count() == 0


def test_long_conversations_are_cut(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 10)
    found = prefix_trie.sequences(turns(spark, tables()))
    assert found.selectExpr("max(size(turns))").first()[0] <= 10
    assert series.MAX_ROWS > 10
