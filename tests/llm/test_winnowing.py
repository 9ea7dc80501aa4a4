import hashlib
import random

import numpy as np
import pytest

import odd
from demandloom.llm import winnowing as W


def brute(text):
    grams = W.gram_hashes(W.code_points(text)).tolist()
    out = []
    for start in range(max(1, len(grams) - W.WINDOW + 1)):
        window = grams[start : start + W.WINDOW]
        at = start + max(k for k, v in enumerate(window) if v == min(window))
        if not out or out[-1] != at:
            out.append(at)
    return sorted(set(out))


@pytest.mark.parametrize("text", ["a", "ab" * 7, "ab" * 200, "x" * 300, odd.prose(1, 150), "日本語" * 40, "a" * 15, "a" * 16, "b" * 47])
@pytest.mark.parametrize("segment", [1 << 22, 37])
def test_rightmost_minimum_of_every_window(monkeypatch, text, segment):
    monkeypatch.setattr(W, "SEGMENT", segment)
    assert W.winnow(text)[1].tolist() == brute(text)


def test_rolling_hash_is_that_of_the_gram():
    text = odd.prose(3, 40)
    grams = W.gram_hashes(W.code_points(text))
    for k in (0, 17, len(grams) - 1):
        assert W.gram_hashes(W.code_points(text[k : k + W.K]))[0] == grams[k]


def test_shared_passage_is_found():
    passage = odd.prose(5, 30)[: W.WINDOW + W.K - 1]
    for seed in range(20):
        a, b = (odd.prose(s, 50, 10**6) + " " + passage + " " + odd.prose(s + 7, 50, 10**6) for s in (seed, seed + 100))
        assert len(np.intersect1d(W.winnow(a)[0], W.winnow(b)[0]))


def test_next_and_edited_texts(spark):
    rng = random.Random(2)
    extra = [(1000 + 7 * i, odd.prose(i, rng.randrange(1, 60)), None, None, None, *odd.EXTRA) for i in range(60)]
    df = odd.documents(spark, extra)
    docs = sorted(df.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.text is not None, r.text or ""))
    got = W.compare_with_next(df).collect()
    want = []
    for k, r in enumerate(docs):
        text, following = r.text or "", docs[(k + 1) % len(docs)].text or ""
        edited = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        own, other = (np.unique(W.winnow(t)[0]) for t in (text, edited))
        want.append((str(r.doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), W.shown(*W.winnow(text)),
                     W.likeness(own, other), W.likeness(own, np.unique(W.winnow(following)[0]))))
    rows = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in got]
    assert sorted(rows) == sorted(want)


def test_lone_and_no_documents(spark):
    df = odd.documents(spark)
    row = W.compare_with_next(df.where("doc_id = 1").limit(1)).first()
    assert row.near_next == 1.0 and 0 < row.near_edited < 1
    assert W.compare_with_next(df.limit(0)).count() == 0
