import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import odd
from demandloom.llm import common, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x0b\x1c\u00a0\u2003abcZ09'.!é日<|>"), max_size=40))
def test_ids_are_the_tokenizers(text):
    assert np.frombuffer(packing.encoder(PATH)(text), "<u4").tolist() == ids(text)


@pytest.mark.parametrize("text", ["a<|endoftext|>b c", "  two  spaces ", "x's 12 a1", "tabs\t \tx", "\ud7ff\U0001f600 ok"])
def test_ids_of_odd_texts(text):
    assert np.frombuffer(packing.encoder(PATH)(text), "<u4").tolist() == ids(text)


@given(st.integers(1, 30_000))
@settings(max_examples=300, deadline=None)
def test_cuts(length):
    pieces = packing.cut(length)
    assert sum(pieces) == length and all(0 < p <= packing.CAPACITY for p in pieces)
    for p in pieces:
        j = packing.class_of(p)
        assert p * j <= packing.CAPACITY
        assert j == packing.FINEST or p * j >= (1 - packing.WASTE) * packing.CAPACITY - j


def check(rows, docs, capacity):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, texts in docs.items():
        want = sorted(
            (len(i), i) for i in (ids(t) + [1] for t in texts)
        )
        got = defaultdict(int)
        for r in pieces[doc]:
            got[r.doc_tokens] += r.length
        assert dict(got) == {n: n * sum(m == n for m, _ in want) for n, _ in want}
        for n, i in want:
            for r in pieces[doc]:
                if sum(m == n for m, _ in want) == 1 and r.doc_tokens == n:
                    part = np.asarray(i[r.start : r.start + r.length], "<u4").tobytes()
                    assert r.ids_crc32 == zlib.crc32(part)
    return len(sequences)


@pytest.mark.parametrize("parts, bits", [(1, 7), (6, 1), (40, 2)])
def test_pieces_round_trip(spark, monkeypatch, parts, bits):
    monkeypatch.setattr(packing, "BLOCK_BITS", bits)
    df = odd.documents(spark)
    docs = defaultdict(list)
    for r in df.collect():
        docs[r.doc_id].append(r.text)
    rows = packing.pack(df.repartition(parts), PATH).collect()
    n = check(rows, docs, packing.CAPACITY)
    total = sum(r.length for r in rows)
    assert n <= -(-total // packing.CAPACITY) + 3


def test_little_padding(spark):
    df = spark.createDataFrame([(i, odd.prose(i, 40 + 37 * i % 900)) for i in range(600)], "doc_id long, text string")
    rows = packing.pack(df.repartition(5), PATH).collect()
    n = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) >= 0.97 * n * packing.CAPACITY


def test_empty_table(spark):
    assert packing.pack(odd.documents(spark).limit(0), PATH).count() == 0


@pytest.mark.parametrize("words", [0, 3, 9])
def test_little_padding_of_tiny_documents(spark, words):
    df = spark.createDataFrame([(i, odd.prose(i, words)) for i in range(9000)], "doc_id long, text string")
    rows = packing.pack(df.repartition(7), PATH).collect()
    assert len(rows) >= 9000
    n = len({r.sequence_id for r in rows})
    total = sum(r.length for r in rows)
    assert total >= 0.95 * (n - 1) * packing.CAPACITY
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.CAPACITY
    assert sum(r.offset == 0 for r in rows) == n


def test_batches_that_go_to_python_are_bounded_by_bytes(spark):
    common.prepare(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])

    texts = spark.range(300, numPartitions=1).selectExpr("repeat('word ', 20000 + id) AS text")
    found = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
    assert sum(found) >= 300 * 100_000
    assert max(found) <= 2 * common.SENT_BYTES


def test_remembered_words_are_bounded():
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for start in range(0, 150_000, 1000):
        encode(" " + " ".join(f"w{n}" for n in range(start, start + 1000)))
    assert len(encode.known) <= 100_000
