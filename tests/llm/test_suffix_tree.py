import math
import random
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

import odd
from demandloom.llm import suffix_tree as S
from plain_tree import tree_of, vocabulary_of

SCHEMA = "doc_id long, text string"


def token_hash(word):
    return S.hashed(pa.array([word]))[0]


def words(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def corpus(n=200):
    """Where 'b' follows 'a' nearly always, and 'd' follows 'c' only after 'a'."""
    rng = random.Random(8)
    out = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(5, 40)):
            text += rng.choice([["a", "b"], ["a", "b"], ["a", "c", "d"], ["e", "c", "f"], [f"rare{rng.randrange(300)}"], ["E"]])
        out.append((i, " ".join(text)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return S.Model(spark.createDataFrame(corpus(), SCHEMA).repartition(5))


@pytest.fixture(scope="module")
def small_held(spark):
    """The same model when workers hold only some of the counts."""
    before = S.HELD_SHARE
    S.HELD_SHARE = 0.002
    made = S.Model(spark.createDataFrame(corpus(), SCHEMA).repartition(3))
    yield made
    S.HELD_SHARE = before


def test_counts_and_base_score(spark, model, small_held):
    docs = [*corpus()[:40], (900, "a b unknown a"), (901, None), (902, "")]
    counts = Counter(w for _, t in corpus() for w in words(t))
    n, v = sum(counts.values()), len(counts)
    assert (model.total, model.distinct) == (n, v)
    text = dict(docs)
    both = []
    for m in (model, small_held):
        rows = {r.doc_id: r for r in m.score(spark.createDataFrame(docs, SCHEMA)).collect()}
        assert len(rows) == len(docs)
        for i, r in rows.items():
            own = words(text[i])
            assert r.n_tokens == len(own) and r.n_known == sum(counts[w] > 0 for w in own)
            assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        both.append({i: round(r.score, 9) for i, r in rows.items()})
    assert len(vocabulary_of(small_held).tokens) < len(vocabulary_of(model).tokens)
    known = set(vocabulary_of(small_held).tokens.tolist())
    assert known < set(vocabulary_of(model).tokens.tolist())
    assert all(s < 0 for scores in both for s in scores.values())


def brute_score(tree, text):
    """Longest retained context of every token, by looking for it in turn."""
    v = tree.vocabulary
    ids = v.of(np.array([token_hash(w) if w != b"\n" else S.END for w in words(text)])).tolist()
    end = int(v.of(np.array([S.END]))[0])
    base = v.contexts + 1
    state_of = dict(zip(tree.keys.tolist(), tree.states.tolist()))
    entry = dict(zip(tree.entries.tolist(), tree.log.tolist()))
    total = 0.0
    for k, i in enumerate(ids):
        state = 0
        for d in range(S.DEPTH, 0, -1):
            past = ([end, *ids[:k]])[-d:]
            if len(past) == d and all(0 <= p < v.contexts for p in past):
                key = sum((p + 1) * base**e for e, p in enumerate(reversed(past)))
                if key in state_of:
                    state = state_of[key]
                    break
        while state and not (0 <= i < v.symbols and state * v.symbols + i in entry):
            total += tree.spread[state]
            state = int(tree.parent[state])
        if state:
            total += entry[state * v.symbols + i]
        elif i >= 0:
            total += tree.root[i]
        else:
            total += math.log10(1 / tree.norm)
    return total


def test_longest_suffix_states(spark, model):
    docs = [*corpus()[:30], (900, "a b unknown a c d e c f f"), (901, None)]
    tree = tree_of(model)
    rows = {r.doc_id: r.score for r in model.score(spark.createDataFrame(docs, SCHEMA)).collect()}
    for i, text in docs:
        assert rows[i] == pytest.approx(brute_score(tree, text)), text


def test_contexts_are_retained_where_they_tell_something(model):
    v = vocabulary_of(model)
    base = v.contexts + 1
    a, b, c, e, d = (int(v.of(np.array([token_hash(w)]))[0]) for w in (b"a", b"b", b"c", b"e", b"d"))
    keys = set(tree_of(model).keys.tolist())
    assert {a + 1, c + 1, (c + 1) + (a + 1) * base, (c + 1) + (e + 1) * base} <= keys
    assert not any(k % base == d + 1 and k >= base for k in keys)  # after 'd' nothing earlier matters
    assert b < v.symbols


def test_distributions_add_up_to_one(model):
    tree = tree_of(model)
    v = tree.vocabulary
    p = np.concatenate([10**tree.root, [1 / tree.norm]])
    assert p.sum() == pytest.approx(1)
    below = [p]
    for state in range(1, len(tree.parent)):
        q = below[tree.parent[state]] * 10 ** tree.spread[state]
        own = (tree.entries >= state * v.symbols) & (tree.entries < (state + 1) * v.symbols)
        q[tree.entries[own] - state * v.symbols] = 10 ** tree.log[own]
        assert q.sum() == pytest.approx(1)
        below.append(q)


def test_beats_single_tokens_on_new_texts(spark, model):
    rows = model.score(spark.createDataFrame([(1, "a b a c d a b e c f e c f a b")], SCHEMA)).first()
    assert rows.score > rows.base_score + 3


def test_odd_tables(spark, model):
    df = odd.documents(spark)
    rows = model.score(df).collect()
    assert len(rows) == df.count()
    assert sorted(r.n_tokens for r in rows) == sorted(len(words(r.text)) for r in df.collect())
    assert model.score(df.limit(0)).count() == 0
    nothing = S.Model(df.limit(0))
    row = nothing.score(df.where("doc_id = 7")).first()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (2, 0, 0.0, 0.0)


def rare_contexts():
    """'zig' and 'zag' are less than one in 2,000 tokens each; 'zag' always follows 'zig'."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(100)) for _ in range(300)]
    return [(k, t + (" zig zag" if k < 8 else "")) for k, t in enumerate(texts)]


@pytest.mark.parametrize("held_share, held_weights", [(1e-6, 4_000_000), (0.01, 4)])
def test_rare_tokens_are_contexts_and_symbols(spark, monkeypatch, held_share, held_weights):
    monkeypatch.setattr(S, "HELD_SHARE", held_share)
    monkeypatch.setattr(S, "HELD_WEIGHTS", held_weights, raising=False)
    model = S.Model(spark.createDataFrame(rare_contexts(), SCHEMA).repartition(3))
    row = model.score(spark.createDataFrame([(1, "zig zag")], SCHEMA)).first()
    # 'zag' nearly certain after 'zig', the end nearly certain after 'zag'.
    p = {w: math.log10((n + 1) / model.norm) for w, n in (("zig", 8), ("zag", 8), ("end", 300))}
    assert row.base_score == pytest.approx(sum(p.values()))
    assert row.score > row.base_score + 3.5


def test_joined_weights_give_the_same_scores(spark, model, monkeypatch):
    monkeypatch.setattr(S, "HELD_SHARE", 0.01)
    monkeypatch.setattr(S, "HELD_WEIGHTS", 5, raising=False)
    joined = S.Model(spark.createDataFrame(corpus(), SCHEMA).repartition(3))
    assert joined.weights.count() > 0
    docs = spark.createDataFrame([*corpus()[:30], (900, "a b unknown a c d e c f f"), (901, None)], SCHEMA)
    want = {r.doc_id: r.score for r in model.score(docs).collect()}
    assert {r.doc_id: r.score for r in joined.score(docs).collect()} == pytest.approx(want)


def test_words_are_hashed_wherever_they_stand():
    made = [b"", b"a", b"a\0", b"\0a", b"abcdefgh", b"abcdefghi", b"x" * 64, b"x" * 65, b"x" * 3000, b"\xff\xfe", "é".encode()]
    whole = S.hashed(pa.array(made))
    assert len(set(whole.tolist())) == len(made) and (whole >= 0).all()
    assert [token_hash(w) for w in made] == whole.tolist()
    assert S.hashed(pa.array(made).slice(3, 5)).tolist() == whole[3:8].tolist()
    assert len(S.hashed(pa.array([], pa.binary()))) == 0


def test_chunks_cut_like_bytes(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 16)
    texts = [b"A b\tB\x0b\x0cc\r\n", None, b"", b"  ", "É a\u00a0b \x1c".encode(), b"\xff \xfe", b"long " * 50, b"z"]
    got = [c for c in S.chunks(pa.array(texts, pa.binary()))]
    assert len(got) > 2 and sum(len(c.starts) for c in got) == len(texts)
    want = [h for t in texts for h in [*(token_hash(w) for w in (t or b"").lower().split()), S.END]]
    assert np.concatenate([c.tokens for c in got]).tolist() == want


def test_counts_travel_as_arrays_by_bucket():
    """A bucket has one row for each time that counts are sent, and sums do not depend on how they were cut."""
    texts = [t.encode() for _, t in corpus(60)]
    want = Counter()
    for t in texts:
        w = words(t.decode())
        want.update((a, b) for a, b in zip([b"\n", *w], w))
        want.update((None, b) for b in w)
    tokens = {w: int(token_hash(w.decode())) if w != b"\n" else S.END for p in want for w in p if w is not None}
    want = {(S.SINGLE if a is None else tokens[a], tokens[b]): n for (a, b), n in want.items() if a is None or n >= S.LEAST}
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    for buckets, step in ((1, 60), (7, 4)):
        rows = [r for k in range(0, 60, step) for r in S._counted((1, 2), buckets)([batch.slice(k, step)])]
        assert all(r.num_rows <= buckets for r in rows)
        sums = [S._frequent(t) for b in range(buckets) if (t := pa.Table.from_batches(rows).filter(pa.compute.field("bucket") == b)).num_rows]
        got = {(r["context"], r["symbol"]): r["n"] for t in sums for r in t.to_pylist()}
        assert got == want


def test_only_what_scores_need_stays_on_disk(spark, monkeypatch):
    """Counts of runs go once the model is built, entries where only scores are asked for."""
    made = []
    monkeypatch.setattr(S, "new_folder", lambda spark, name, real=S.new_folder: made.append(real(spark, name)) or made[-1])
    df = spark.createDataFrame(corpus(), SCHEMA)
    model = S.Model(df).without_levels()
    assert model.score(df).count() == 200
    assert len(made) > 2 * S.DEPTH and not [path for path in made if Path(path.removeprefix("file:")).exists()]


def test_memory_of_counting_is_bounded():
    rng = np.random.default_rng(3)
    texts = pa.array([b" ".join(b"%d" % w for w in rng.integers(0, 5000, 500)) for _ in range(600)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    tracemalloc.start()
    found = S._counted((3, 4), 8)(batch for _ in range(10))
    runs = sum(len(x.as_buffer()) // 8 for b in found for x in b.column("context"))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Three million tokens, some of which are flushed before the others are read.
    assert runs > 500_000
    assert most < 160 << 20


def test_keys_meet_their_weights_as_arrays(spark, monkeypatch):
    """Occurrences of what workers do not hold are no rows: one for each bucket that they are sent to, and each group of texts."""
    rng = np.random.default_rng(5)
    weight = dict(zip(range(-500, 500, 3), rng.random(334).tolist()))
    keys = [np.unique(rng.integers(-500, 500, 200)) for _ in range(300)]
    often = [rng.integers(1, 4, len(k)).astype(np.int32) for k in keys]
    rows = (np.arange(300) // 100 << 40) + np.arange(300) % 100
    texts = pa.RecordBatch.from_arrays([pa.array(rows), pa.array(keys), pa.array(often)], names=["row", "keys", "often"])
    weights = pa.RecordBatch.from_arrays([pa.array([*weight]), pa.array([*weight.values()])], names=["key", "weight"])
    want = {}
    for row, k, n in zip(rows.tolist(), keys, often):
        found = [(x, m, weight[x]) for x, m in zip(k.tolist(), n.tolist()) if x in weight]
        want[row] = (sum(m for x, m, _ in found if x >= 0), sum(m * w for x, m, w in found if x >= 0), sum(m * w for _, m, w in found))
    for sums in (50, 1_000_000):
        monkeypatch.setattr(S, "SUMS", sums)
        sent = [*S._keys_dealt(7, False)([weights]), *S._keys_dealt(7, True)([texts.slice(k, 150) for k in (0, 150)])]
        assert sum(b.num_rows for b in sent) <= 2 * 7
        table = pa.Table.from_batches(sent)
        table = table.append_column("late", pa.compute.is_valid(table["row"])).sort_by([("bucket", "ascending"), ("late", "ascending")])
        found = pa.Table.from_batches(S._weighed(table.drop_columns("late").to_batches(max_chunksize=3)))
        assert sums == 50 or found.num_rows <= 3
        got = {}
        for g in set(found["group"].to_pylist()):
            for r in S._totals(found.filter(pa.compute.field("group") == g)).to_pylist():
                assert r["row"] >> S.GROUP == g and r["row"] not in got
                got[r["row"]] = (r["more_known"], r["more_base"], r["more_score"])
        assert got.keys() == want.keys()
        assert all(got[r] == pytest.approx(want[r]) for r in want)


def test_scores_do_not_list_occurrences(spark, model):
    plan = model.score(spark.createDataFrame([(1, "a b")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join [key" not in plan
