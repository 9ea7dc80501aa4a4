from hashlib import sha256

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import odd
from demandloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.encoder(PATH)


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN(text) == want
    assert OWN.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \n\t\x0b\x1c\x85  ​'’stmdlrveaébcΣσςİıß²½٣Ⅷ1299!?.—_-éͅͅ<|>日あ😀"), max_size=80))
def test_texts_of_awkward_characters(text):
    same(text)


@pytest.mark.parametrize(
    "text",
    ["", " \n", "a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|>", "It's we'll 'S", "ÀÉ ΣΑΣ İ",
     "x" * 70, "ab" * 4000, "!?" * 3000, "ﬁ ǆ K Å", "﻿BOM �", "é" * 50, "ünïcode 日本語 " * 20],
)
def test_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdeghinorst"), min_size=1, max_size=150))
def test_both_ways_to_merge(word):
    symbols = tuple(OWN.symbols(word, True))
    assert OWN.merged(symbols) == OWN._merged_by_queue(symbols)
    assert [*OWN.merged(symbols)] == LIBRARY.encode(word, add_special_tokens=False).ids


def test_cuts_are_certain():
    """Fragments put together give the word, and no token holds a pair that is cut."""
    for word in ["zxqjk", "ffxqzz", "hello", "qqqq", "xjxjxj"]:
        fragments = OWN.cuts(word)
        assert "".join(s for f in fragments for s in f) == word + "</w>"
        for a, b in zip(fragments, fragments[1:]):
            assert not any(a[-1] + b[0] in t and (a[-1], b[0]) in OWN.inside for t in OWN.vocab)
    assert any(len(OWN.cuts(w)) > 1 for w in ["zxqjk", "xjxjxj"])
    together = [t for t in list(OWN.vocab)[512:20_000:37] if t not in OWN.added and t.endswith("</w>")]
    assert all(len(OWN.cuts(t.removesuffix("</w>"))) == 1 for t in together)


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Encoder(PATH)
    for k in range(50):
        text = f"word{k}, zxq{k}"
        assert own(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert len(own.words) <= 3 and len(own.fragments) <= 3


def test_another_vocabulary_through_the_librarys_words():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = bpe.Encoder(path), Tokenizer.from_file(path)
    for text in ["Hello  world, it's\n 12", " ünïcode 日本", "a<|endoftext|>b"]:
        want = library.encode(text, add_special_tokens=False).ids
        assert own(text) == want and own.decode(want) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("flush", [8_000_000, 10])
def test_rows(spark, monkeypatch, flush):
    df = odd.documents(spark)
    rows = bpe.code(df, PATH).collect()
    want = sorted(
        (str(r.doc_id), ids, LIBRARY.decode(ids, skip_special_tokens=False))
        for r in df.collect()
        for ids in [LIBRARY.encode(r.text or "", add_special_tokens=False).ids]
    )
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in rows) == want
    assert bpe.code(df.limit(0), PATH).count() == 0


def test_output_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "FLUSH", 10)
    texts = ["one two", None, "", "three", "four five six seven", "eight"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["doc", "text"])
    out = [r for b in bpe._coded(PATH)(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    assert [r["doc"] for r in out] == [*range(6)]
    assert [r["ids"] for r in out] == [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_query_derives_hashes(spark):
    from demandloom.llm.queries import op12_bpe

    rows = op12_bpe(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(decoded.encode()).hexdigest()
