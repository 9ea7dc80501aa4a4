import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
import odd
from demandloom.llm import secrets


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean, toxic, copied and secret documents of three sources, and their labels."""
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(240):
        text = odd.prose(i, rng.randrange(30, 120), 4000)
        toxic = i % 8 == 0
        if toxic:
            text = text.replace(" ", " grumph ", 2) + " snarf"
        if i % 7 == 3:
            text += " password=9c82e4685ca7e26784"
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(300 + k, docs[9][1] + (" tail" if k % 2 else ""), "en", "s0", 1) for k in range(6)]
    docs += [(400, None, None, None, None), (401, "", "en", "s1", 0), docs[1]]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, steps = zip(*C.STAGES)
    assert names == ("toxicity", "ngram_jaccard", "secrets", "mixing", "packing")
    seen = [docs]
    for step in steps[:-1]:
        out = step(spark, seen[-1], folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen.append(C.written(out, "stage"))
    _, clean, single, redacted, mixed = ([tuple(r) for r in df.collect()] for df in seen)

    ids = {r[0] for r in clean}
    assert ids == {r.doc_id for r in docs.collect()} - {i for i in range(240) if i % 8 == 0}
    assert len(clean) == docs.count() - 30
    kept = sorted(r[0] for r in single)
    assert kept == sorted(ids - set(range(300, 306)))
    before = {r[0]: r for r in single}
    assert sorted(r[0] for r in redacted) == kept
    for r in redacted:
        old = before[r[0]][1]
        assert r[2:4] == before[r[0]][2:4] and r[4] == (None if r[1] is None else len(r[1]))
        assert r[1] == (old.replace("password=9c82e4685ca7e26784", "[SECRET]") if old else old)
    rows = {r[0]: r for r in redacted}
    assert all(tuple(m) == rows[m[0]] for m in mixed)
    assert max(sum(m[0] == i for m in mixed) for i in rows) <= 3
    words = {s: sum(len(r[1].split()) for r in redacted if r[3] == s) for s in ("s0", "s1", "s2")}
    total = sum(words.values())
    for k, s in enumerate(words):
        taken = sum(len(m[1].split()) for m in mixed if m[3] == s)
        assert abs(taken - total * (k + 1) / 6) <= 130

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = steps[-1](spark, seen[-1], folder).collect()
    for r in pieces:
        ids = tokenizer.encode(rows[r.doc_id][1], add_special_tokens=False).ids + [1]
        part = np.asarray(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.doc_tokens == len(ids) and zlib.crc32(part) == r.ids_crc32
    for i in rows:
        copies = sum(m[0] == i for m in mixed)
        assert sum(r.length for r in pieces if r.doc_id == i) == copies * next((r.doc_tokens for r in pieces if r.doc_id == i), 0)


def test_run(spark, folder):
    pieces = C.run(spark, folder)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert pieces.count() > 100
    assert secrets.KINDS[0] == "assign"


def test_one_of_each_decides_by_row(spark):
    """Of an id with several texts only the copies go; rows without an id are reduced, too."""
    a, b, c = (odd.prose(k, 60, 4000) for k in (1001, 1002, 1003))
    rows = [
        (5, a, "x"), (3, b, "x"), (3, a, "x"), (7, b, "x"), (7, c, "x"), (None, c, "x"), (None, c, "x"), (None, a + " t", "x"),
        (None, odd.prose(1004, 50, 4000), "n"), (None, None, "n"), (None, None, "n"), (None, "", "n"), (9, None, "e"), (10, None, "e"),
        (11, odd.prose(1005, 40), "later"), (11, odd.prose(1005, 40), "first"),
    ]
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame(rows, schema)
    outs = [sorted(map(str, C.jaccard.one_of_each(df.repartition(n)).collect())) for n in (1, 4)]
    want = [
        (3, b, "x"), (3, a, "x"), (7, c, "x"), (None, odd.prose(1004, 50, 4000), "n"), (None, None, "n"), (None, None, "n"),
        (None, "", "n"), (9, None, "e"), (10, None, "e"), (11, odd.prose(1005, 40), "first"),
    ]
    assert outs[0] == outs[1] == sorted(map(str, spark.createDataFrame(want, schema).collect()))


def test_both_ways_agree_where_ids_are_unique(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").dropDuplicates(["doc_id"])
    more = docs.unionByName(docs.where("doc_id = 9").selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "lang", "source", "n_chars"))
    assert sorted(map(str, C.jaccard.one_of_each(docs).collect())) == sorted(map(str, C.jaccard.one_of_each(more).collect()))


def test_stages_of_odd_tables(spark, folder):
    """Missing cells, equal rows, clashing columns and empty tables pass through every stage."""
    docs = odd.documents(spark)
    for name, step in C.STAGES:
        out = step(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
            docs = C.written(out, "stage")
        assert step(spark, odd.documents(spark).limit(0), folder).count() == 0
    assert out.count() > 0
