"""Document fingerprints by winnowing.

A text's k-grams of code points are hashed by a polynomial rolling hash.  Of every window of w
neighbouring hashes the smallest is kept, the rightmost if several are, with its position.  Two
texts that share a passage of w + k - 1 code points share a fingerprint; passages shorter than k
cannot match.  A text with fewer than w k-grams is one window; one with fewer than k code points
is one gram of its own length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, quoted, shuffle_partitions

#: Grams and windows are powers of two, so that both are built by doubling.
GRAM_BITS, WINDOW_BITS = 4, 5
K, WINDOW = 1 << GRAM_BITS, 1 << WINDOW_BITS
BASE = 0x9E3779B97F4A7C15
HASH_BITS, POSITION_BITS = 40, 24
#: Grams handled at once; a window's positions must fit into POSITION_BITS.
SEGMENT = 1 << 22
#: Stretches of documents by id for each shuffle partition.
STRETCHES = 8
MASK = (1 << 64) - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(32))) >> np.uint64(64 - HASH_BITS)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """Hash of the gram at every position; of the whole text if it is shorter than a gram."""
    if 0 < len(points) < K:
        value = len(points)
        for p in points.tolist():
            value = (value * BASE + p + 1) & MASK
        return _mixed(np.array([value], np.uint64))
    h, factor, reach = points + np.uint64(1), BASE, 1
    for _ in range(GRAM_BITS):
        h = h[:-reach] * np.uint64(factor) + h[reach:]
        factor, reach = factor * factor & MASK, 2 * reach
    return _mixed(h)


def winnow(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the fingerprints, by position."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams = gram_hashes(code_points(text))
    hashes, positions = [], []
    last = (1 << POSITION_BITS) - 1
    for start in range(0, max(1, len(grams) - WINDOW + 1), SEGMENT):
        part = grams[start : start + SEGMENT + WINDOW - 1]
        # The smallest hash first, then the largest position.
        key = (part << np.uint64(POSITION_BITS)) | (np.uint64(last) - np.arange(len(part), dtype=np.uint64))
        if len(key) < WINDOW:
            key = key.min(keepdims=True)
        else:
            reach = 1
            for _ in range(WINDOW_BITS):
                key = np.minimum(key[:-reach], key[reach:])
                reach *= 2
            key = key[np.flatnonzero(np.r_[True, key[1:] != key[:-1]])]
        hashes.append(key >> np.uint64(POSITION_BITS))
        positions.append(start + last - (key & np.uint64(last)).astype(np.int64))
    if len(hashes) == 1:
        return hashes[0], positions[0]
    position, first = np.unique(np.concatenate(positions), return_index=True)
    return np.concatenate(hashes)[first], position


def shown(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Fingerprints as text: hash:position in hexadecimal and decimal, joined by commas."""
    return ",".join([f"{h:010x}:{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprint(text: Column) -> Column:
    """Fingerprints of each text as text; a missing text counts as empty."""

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: shown(*winnow(t or "")))

    return run(text.cast("string"))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by stretch, each ended by a copy of the next stretch's first document."""
    held = None
    kind = None
    for batch in batches:
        kind = batch.schema.field(1).type
        rows = []
        tails, ids, texts = (batch.column(k).to_pylist() for k in range(3))
        for tail, doc, text in zip(tails, ids, texts):
            if tail and held is None:
                continue  # ties behind the copy that has been used
            text = text or ""
            hashes, positions = winnow(text)
            own = np.unique(hashes)
            if held is not None:
                doc0, text0, shown0, own0 = held
                changed = edited(text0, text)
                hashes1, positions1 = winnow(changed)
                rows.append(
                    (
                        doc0,
                        len(text0),
                        hashlib.sha256(changed.encode()).hexdigest(),
                        shown0,
                        shown(hashes1, positions1),
                        likeness(own0, np.unique(hashes1)),
                        likeness(own0, own),
                    )
                )
            held = None if tail else (doc, text, shown(hashes, positions), own)
        columns = list(zip(*rows)) or [()] * 7
        types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["id", *[c.split()[0] for c in COLUMNS.split(", ")]],
        )


def _stretch(key: Column, bounds: list[int]) -> Column:
    """A number that grows with each bound at or above the key, looked up in two steps; a missing
    key comes last."""
    width = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[k : k + width] for k in range(0, len(bounds), width)]  # both descending
    if not blocks:
        return F.when(key.isNull(), 1).otherwise(0)
    lows = F.array(*[F.lit(b[-1]) for b in blocks])
    table = F.array(*[F.array(*[F.lit(v) for v in b]) for b in blocks])
    block = F.size(F.filter(lows, lambda low: low >= key))
    inside = F.size(F.filter(F.coalesce(F.get(table, block), F.array().cast("array<long>")), lambda v: v >= key))
    return F.when(key.isNull(), (len(blocks) + 1) * width).otherwise(block * width + inside)


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next document is the one with the next lower id, a whole number; after the last comes the
    first.  Rows with the same id follow each other by their texts, rows without an id come last.  A
    missing text counts as empty; two empty texts are alike.  A lone document is its own next one.
    An empty table gives no rows; other columns are not read.

    Ids are cut into stretches at approximate quantiles, so the texts are shuffled once; the first
    document of each stretch also goes to the end of the stretch before.
    """
    spark = df.sparkSession
    prepare(spark)
    parts = shuffle_partitions(spark)
    n = STRETCHES * parts
    docs = df.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    key = F.col("id").cast("long")
    bounds = docs.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 100 * n)).first()[0] or []
    stretched = docs.withColumn("key", key).withColumn("stretch", _stretch(F.col("key"), sorted(set(bounds), reverse=True)))
    # At most one row per stretch.
    heads = sorted(
        stretched.groupBy("stretch").agg(F.max("key").alias("head")).collect(), key=lambda r: r["stretch"]
    )
    if not heads:
        return df.sparkSession.createDataFrame([], f"`{id_col}` {docs.schema['id'].dataType.simpleString()}, {COLUMNS}")
    known = spark.createDataFrame(
        [(h["stretch"], h["head"], heads[k - 1]["stretch"]) for k, h in enumerate(heads)],
        "stretch int, head long, previous int",
    )
    own = F.struct(F.col("stretch"), F.lit(False).alias("tail"))
    copy = F.struct(F.col("previous").alias("stretch"), F.lit(True).alias("tail"))
    places = F.when(F.col("key").eqNullSafe(F.col("head")), F.array(own, copy)).otherwise(F.array(own))
    placed = (
        stretched.join(F.broadcast(known), "stretch")
        .select(F.explode(places).alias("place"), "key", "id", "text")
        .select("place.stretch", "place.tail", "key", "id", "text")
    )
    streamed = (
        placed.repartition(parts, "stretch")
        .sortWithinPartitions("stretch", "tail", F.desc_nulls_last("key"), F.asc_nulls_first("text"))
        .select("tail", "id", "text")
    )
    schema = f"id {docs.schema['id'].dataType.simpleString()}, {COLUMNS}"
    return streamed.mapInArrow(_compared, schema).withColumnRenamed("id", id_col)
