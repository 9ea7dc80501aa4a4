"""Harmonic packing of token sequences.

Lengths fall into classes by reciprocals of the capacity: class j holds lengths from
capacity / (j + 1), exclusive, to capacity / j.  A sequence of class j takes exactly j pieces, so a
worker fills its sequences without knowing what other workers hold.  As documents may be cut
freely, a length that would waste much of its share gives off a piece of exactly capacity / (j + 1)
first; what is then left of the document is short.

Sequences that a worker could not complete are completed among blocks of workers, then among blocks
of blocks, each step by class.  Fewer than j pieces of class j are left at the end, a number that
does not depend on the data; they share the last sequences, largest first.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import prepare, quoted, written

CAPACITY = 2048
END_ID = 1
#: The finest class: sequences of single tokens.
FINEST = CAPACITY
#: A length is left whole if its class wastes at most this share of its part of a sequence.
WASTE = 0.03
#: Workers of which one task completes the open sequences, as a power of two.
BLOCK_BITS = 7
#: Words of at most this many characters are remembered, and how many of them a worker holds.
REMEMBERED_CHARS, REMEMBERED = 48, 100_000
#: The pre-tokenizer's pattern of the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_character() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids of the tokenizer in a JSON file, as little-endian unsigned 32-bit bytes.

    A pre-token never crosses a space in front of a character that is no white space: the space
    belongs to what follows it.  So texts are encoded word by word, each word once, by a faster
    encoder over the same vocabulary.  Texts with a space before more white space go through that
    encoder whole, and texts that spell an added token through the tokenizer itself.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.added = [t["content"] for t in model.get("added_tokens", [])]
        byte = _byte_of_character()
        ranks = {
            bytes(byte[c] for c in token): n
            for token, n in model["model"]["vocab"].items()
            if token not in self.added
        }
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.fast.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.asarray(ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        known, out = self.known, [self._whole(first)] if first else []
        for word in rest:
            ids = known.get(word)
            if ids is None:
                if not word or word[0].isspace():
                    return self._whole(text)
                ids = self._whole(" " + word)
                if len(word) <= REMEMBERED_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = ids
            out.append(ids)
        return b"".join(out)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def class_of(length: int, capacity: int = CAPACITY, finest: int = FINEST) -> int:
    return min(capacity // length, finest)


def cut(length: int, capacity: int = CAPACITY, finest: int = FINEST, waste: float = WASTE) -> list[int]:
    """Lengths of a document's pieces, in its order."""
    pieces = [capacity] * (length // capacity)
    left = length % capacity
    while left:
        j = capacity // left
        share = capacity // (j + 1)
        if j >= finest or left * j >= (1 - waste) * capacity:
            pieces.append(left)
            break
        pieces.append(share)
        left -= share
    return pieces


PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


def _fill(path: str, capacity: int, end_id: int):
    """Cut the documents of a task and fill its sequences; open ones are left without a number."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        worker = TaskContext.get().partitionId()
        made, open_ = 0, {}
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(encode(text or "") + end)
                total, start = len(ids) // 4, 0
                for length in cut(total, capacity):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    j = class_of(length, capacity)
                    held = open_.setdefault(j, [])
                    held.append((doc, start, length, crc, total))
                    start += length
                    if len(held) == j:
                        number, offset = (worker << 32) + made, 0
                        for piece in held:
                            rows.append((*piece, worker, j, number, offset))
                            offset += piece[2]
                        made += 1
                        held.clear()
            yield _batch(rows, id_type)
        rest = [(*piece, worker, j, None, None) for j, held in open_.items() for piece in held]
        if rest:
            yield _batch(rest, id_type)

    return run


def _batch(rows: list[tuple], id_type) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 9
    types = [id_type, *[pa.int64()] * 8]
    names = ["doc", "start", "length", "ids_crc32", "doc_tokens", "worker", "class", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _last(capacity: int):
    """Place a bounded number of pieces, largest first, each in the first sequence with room."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        df = pd.concat(got).sort_values(
            ["length", "doc", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        used: list[int] = []
        sequence, offset = [], []
        for length in df["length"]:
            k = next((k for k, u in enumerate(used) if u + length <= capacity), len(used))
            if k == len(used):
                used.append(0)
            sequence.append((1 << 61) + k)
            offset.append(used[k])
            used[k] += length
        yield df.assign(sequence_id=sequence, offset=offset)

    return run


def pack(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text, a missing text counting as empty, and `end_id`; so no
    document is without a piece.  Repeated rows are packed once each.  An id may be missing or
    repeated: it is only carried along.  An empty table gives no rows.  Other columns are not read.
    Sequences are as long as their pieces; the padding behind them is not stored.
    """
    prepare(df.sparkSession)
    docs = df.select(quoted(id_col).alias("doc"), quoted(text_col).cast("string").alias("text"))
    kind = docs.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, {PIECE}, worker long, class long, sequence_id long, offset long"
    pieces = written(docs.mapInArrow(_fill(tokenizer, capacity, end_id), schema), "pieces")

    columns = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    done = [pieces.where("sequence_id IS NOT NULL").select(columns)]
    left = pieces.where("sequence_id IS NULL").drop("sequence_id", "offset")
    workers = left.agg(F.max("worker")).first()[0]
    order = Window.partitionBy("class", "worker").orderBy("doc", "start", "ids_crc32", "length")
    level = 0
    while workers is not None:
        level += 1
        workers >>= BLOCK_BITS
        numbered = (
            left.withColumn("worker", F.expr(f"shiftright(worker, {BLOCK_BITS})"))
            .withColumn("n", F.row_number().over(order) - 1)
            .withColumn("all", F.count("*").over(Window.partitionBy("class", "worker")))
        )
        numbered = written(
            numbered.withColumn("whole", F.expr("n < all - all % class"))
            .withColumn("bin", F.expr("n div class")),
            "open_pieces",
        )
        before = (
            Window.partitionBy("class", "worker", "bin")
            .orderBy("n")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        done.append(
            numbered.where("whole")
            .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
            .withColumn(
                "sequence_id",
                F.expr(
                    f"shiftleft({level}L, 58) + shiftleft(worker, 40) + shiftleft(class, 28) + bin"
                ),
            )
            .select(columns)
        )
        left = numbered.where("not whole").drop("n", "all", "whole", "bin")
        if workers == 0:
            break
    if level:
        tail = left.select("doc", *[c.split()[0] for c in PIECE.split(", ")]).coalesce(1)
        done.append(
            tail.mapInPandas(_last(capacity), f"doc {kind}, {PIECE}, sequence_id long, offset long")
        )
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("doc", id_col)
