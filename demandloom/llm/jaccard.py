"""Exact Jaccard join of word shingle sets that uses relations between the sets.

Two sets of sizes m and n with 100 |x & y| >= 75 |x | y| share at least 3/7 (m + n) elements, so
under one common order of all elements they share one among the first m - ceil(3/4 m) + 1 of x and
as many of y.  The index lists the sets by these elements.

*Answers from similar sets.*  Equal sets are one class.  A class that is verified to be similar to
another one, found through equal min-hashes, joins that hub's group and the group is listed once
per element.  What is computed for two hubs serves their groups: |x & y| <= |r & s| + |x - r| +
|y - s| for x in r's group and y in s's.  Only members for which this bound can reach the threshold,
and which share an element of their own fronts, are compared themselves.  So neither copies nor near copies are ever paired with each other, and
their links follow from the hubs.

*Known components.*  The result is components, so links between sets that are connected already
add nothing.  The components of the links to the hubs are found first.  Then every entry of a list is
compared with the list's leader of about its size, the set with the fewest rare elements of its own,
which is the likeliest to be similar; that is one pair an entry at most.  The components so far travel
with the groups in the lists; two groups of one component are never paired.  What hubs add is merged
in the same way before members are compared.

*Skipping by position.*  An element at position i of a set of size m leaves at most m - i common
elements.  Long lists are cut into blocks by size and position, and blocks that cannot reach the
threshold with each other are skipped whole; in short lists pairs are skipped one by one.

*Order.*  Elements are ordered by how many documents hold them, counted over all, then by hash.  Any
order gives the same result; the counts of the most frequent elements, a bounded number, are enough
to keep passages that many texts share out of the lists.  What one document alone holds comes first
and is not listed, as no other set has it; it still counts as a position.  A bit filter of bounded
size tells these elements; one that it cannot tell is listed like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.series import PLACE, numbered
from .common import prepare, quoted, shuffle_partitions, small_side, written
from .components import components

WORDS = 5
PERCENT = 75
#: Min-hashes by which classes find a hub.
MIN_HASHES = 6
#: An element in more documents is frequent; the most such elements that are sent to all workers,
#: the most frequent first (4 bytes of key and of count each).
LONG, FREQUENT = 24, 1 << 20
#: The filter of elements that more than one document holds has two to this power of bits at most.
FILTER_BITS = 27
#: Entries of a block of a long list.
BLOCK = 256
#: Bytes of a text that are hashed at once.
STRETCH = 1 << 20
SPACE = re.compile(rb"[ \t-\r]")
#: Elements counted together before they are sent on.
FLUSH = 2_000_000
#: Bytes of text whose elements are summed in one group, on average.
BUCKET = 1 << 25
_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_BASE = 0x2545F4914F6CDD1D
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n at least."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words in ASCII lower case, in order.

    The hash of a word is a polynomial in its bytes; running sums of the whole text give all words at
    once.  Long texts are taken in stretches that end between words.
    """
    if len(text) <= STRETCH:
        return _stretch_hashes(text)
    out, at = [], 0
    while at < len(text):
        space = SPACE.search(text, at + STRETCH)
        end = space.start() if space else len(text)
        out.append(_stretch_hashes(text[at:end]))
        at = end
    return np.concatenate(out)


def _stretch_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text.lower(), np.uint8)
    outside = np.ones(len(data) + 2, np.int8)
    outside[1:-1] = _SPACE[data]
    edges = np.flatnonzero(np.diff(outside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * power[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return _mixed(value + (ends - starts).astype(np.uint64) * np.uint64(_FACTORS[4]))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words, of the whole sequence."""
    w = word_hashes(text or b"")
    if not len(w):
        return w
    width = min(WORDS, len(w))
    n = len(w) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += w[k : k + n] * np.uint64(_FACTORS[k])
    total = np.sort(_mixed(total))
    return total[np.r_[True, total[1:] != total[:-1]]]


def class_of(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) >> 1


def prefix_length(size: int) -> int:
    return size - (PERCENT * size + 99) // 100 + 1


def min_hashes(elements: np.ndarray) -> list[int]:
    return [
        int(((elements ^ np.uint64(_FACTORS[k % 5] + k)) * np.uint64(_FACTORS[(k + 1) % 5] | 1)).min() >> np.uint64(1))
        for k in range(MIN_HASHES)
    ]


DESCRIBED = {"n": pa.int64(), "class": pa.int64(), "mins": pa.list_(pa.int64())}
COUNTED = {"bucket": pa.int32(), "once": pa.binary(), "keys": pa.binary(), "counts": pa.binary()}


def _deltas(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, by byte planes: the high planes are nearly empty and compress."""
    return np.diff(keys, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _keys(deltas: bytes) -> np.ndarray:
    planes = np.frombuffer(deltas, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _described(buckets: int):
    """One row per set, and rows with counts of elements; what occurs once goes without a count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        edges = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets)
        kind, size = None, 0

        def rows(columns: dict, ids) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            arrays = [pa.nulls(n, kind) if ids is None else ids]
            for name, of in (DESCRIBED | COUNTED).items():
                arrays.append(pa.array(columns[name], of) if name in columns else pa.nulls(n, of))
            return pa.RecordBatch.from_arrays(arrays, names=["id", *DESCRIBED, *COUNTED])

        def counted() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            out = {name: [] for name in COUNTED}
            for b in range(buckets):
                k, c = keys[cuts[b] : cuts[b + 1]], counts[cuts[b] : cuts[b + 1]].astype("<u4")
                if len(k):
                    out["bucket"].append(b)
                    out["once"].append(_deltas(k[c == 1]))
                    out["keys"].append(_deltas(k[c > 1]))
                    out["counts"].append(c[c > 1].tobytes())
            return rows(out, None)

        for batch in batches:
            kind = batch.schema.field(0).type
            sizes, classes, mins = [], [], []
            for text in batch.column(1).to_pylist():
                elements = shingles(text)
                sizes.append(len(elements))
                classes.append(class_of(elements) if len(elements) else None)
                mins.append(min_hashes(elements) if len(elements) else [])
                held.append(elements.astype(np.uint32))
                size += len(elements)
                if size >= FLUSH:
                    yield counted()
                    held.clear()
                    size = 0
            yield rows({"n": sizes, "class": classes, "mins": mins}, batch.column(0))
        if size:
            yield counted()

    return run


def _of_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is of the class looked for."""
    for batch in batches:
        wanted, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield batch.filter(pa.array([class_of(shingles(t)) == c for c, t in zip(wanted, texts)], pa.bool_()))


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}

    def elements(key: int, text: bytes) -> np.ndarray:
        if key not in known:
            if len(known) >= 64:
                known.clear()
            known[key] = shingles(text)
        return known[key]

    for batch in batches:
        found = []
        for i, j, s, t in zip(*(batch.column(k).to_pylist() for k in range(4))):
            one, other = elements(i, s), elements(j, t)
            found.append((len(np.intersect1d(one, other, assume_unique=True)), len(one), len(other)))
        counts = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *counts], names=["a", "b", "common", "m", "n"]
        )


def similar(common: str, m: str, n: str) -> str:
    return f"100 * {common} >= {PERCENT} * ({m} + {n} - {common})"


def close_sizes(m: str, n: str) -> str:
    return f"100 * least({m}, {n}) >= {PERCENT} * greatest({m}, {n})"


class Join:
    """One run of the join; keeps what the steps share."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str):
        self.spark = df.sparkSession
        prepare(self.spark)
        self.docs = df.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").cast("binary").alias("text"))
        self.id_type = self.docs.schema["id"].dataType
        schema = T.StructType(
            [
                T.StructField("id", self.id_type),
                T.StructField("n", T.LongType()),
                T.StructField("class", T.LongType()),
                T.StructField("mins", T.ArrayType(T.LongType())),
                T.StructField("bucket", T.IntegerType()),
                *(T.StructField(c, T.BinaryType()) for c in ("once", "keys", "counts")),
            ]
        )
        self.size = self.docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(2 * shuffle_partitions(self.spark), self.size // BUCKET)
        found = written(self.docs.mapInArrow(_described(buckets), schema), "sets")
        #: Every document with its size, class and min-hashes.
        self.described = found.where("bucket IS NULL").select("id", "n", "class", "mins")
        self.counted = found.where("bucket IS NOT NULL").select("bucket", "once", "keys", "counts")
        #: Every class with its smallest id.
        self.classes = written(
            self.described.where("class IS NOT NULL")
            .groupBy("class").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("mins").alias("mins")),
            "classes",
        )

    def texts(self, classes: DataFrame) -> DataFrame:
        """class, text of the given classes."""
        wanted = written(self.classes.join(classes, "class", "left_semi").select("class", "rep"), "wanted")
        same = F.col("d.id").eqNullSafe(F.col("w.rep"))
        found = self.docs.alias("d").join(small_side(wanted, wanted.count()).alias("w"), same).select("w.class", "d.text")
        found = found.mapInArrow(_of_class, "class long, text binary")
        return written(found.groupBy("class").agg(F.first("text").alias("text")), "texts")

    def overlaps(self, pairs: DataFrame) -> DataFrame:
        """a, b, common and the sizes m, n of pairs(a, b), compared element by element."""
        pairs = written(pairs, "pairs")
        texts = self.texts(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct())
        one = texts.select(F.col("class").alias("a"), F.col("text").alias("x"))
        other = texts.select(F.col("class").alias("b"), F.col("text").alias("y"))
        rows = pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y")
        return written(rows.mapInArrow(_overlaps, "a long, b long, common long, m long, n long"), "overlaps")

    def hubs(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Overlaps of classes with the leaders of their min-hash groups; member, hub, extra, n;
        class, n, label with the component of each class by these links."""
        keyed = self.classes.select("class", "n", F.posexplode("mins").alias("k", "value"))
        leaders = (
            keyed.groupBy("k", "value")
            .agg(F.count("*").alias("of"), F.min(F.struct("class", "n")).alias("leader"))
            .where("of > 1")
            .select("k", "value", "of", "leader")
        )
        pairs = (
            keyed.join(leaders, ["k", "value"])
            .where(f"class != leader.class AND {close_sizes('n', 'leader.n')}")
            .select(F.col("class").alias("a"), F.col("leader.class").alias("b"))
            .distinct()
        )
        star = self.overlaps(pairs)
        # The most similar leader; of equally similar ones the first.
        rank = F.struct((F.col("common") / (F.expr("m + n") - F.col("common"))).alias("j"), (-F.col("b")).alias("o"))
        best = (
            star.where(similar("common", "m", "n"))
            .groupBy("a")
            .agg(F.max_by(F.struct("b", "common", "m"), rank).alias("best"))
            .select(F.col("a").alias("member"), F.col("best.b").alias("hub"), F.expr("best.m - best.common").alias("extra"), F.col("best.m").alias("n"))
        )
        best = written(best, "best")
        chosen = best.select(F.col("hub").alias("member")).distinct()
        members = written(best.join(chosen, "member", "left_anti"), "members")
        alone = self.classes.select("class", "n", F.col("class").alias("label"))
        labels = self.merged(alone, star.where(similar("common", "m", "n")).select("a", "b"))
        return star, members, labels

    def merged(self, labels: DataFrame, links: DataFrame) -> DataFrame:
        """class, n, label once links(a, b) between classes have joined components."""
        label = lambda end: labels.select(F.col("class").alias(end), F.col("label").alias(f"{end}_label"))
        ends = written(
            links.join(label("a"), "a").join(label("b"), "b").where("a_label != b_label")
            .select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct(),
            "label_links",
        )
        if ends.isEmpty():
            return labels
        reached = components(ends).toDF("label", "further")
        return written(
            labels.join(reached, "label", "left").select("class", "n", F.coalesce("further", "label").alias("label")),
            "labels",
        )

    def entries(self) -> DataFrame:
        """token, class, size, at: the front of every class, as far as other documents hold its elements.

        Read is one document per class; those without an id, and ids that stand for several classes, all are.
        """
        ids = self.described.where("class IS NOT NULL").groupBy("id").agg(
            F.min("class").alias("class"), F.max("class").alias("other")
        )
        single = ids.where("class = other").select("id", "class")
        copies = single.join(self.classes.select("class", "rep"), "class").where(~F.col("id").eqNullSafe(F.col("rep")))
        copies = written(copies.select("id"), "copies")
        texts = self.docs.join(small_side(copies, copies.count()), "id", "left_anti").select("text")
        often = self.spark.sparkContext.broadcast(self.frequent())
        return written(texts.mapInArrow(_fronts(often), "token long, class long, size int, at int"), "entries")

    def labelled(self, entries: DataFrame, labels: DataFrame) -> DataFrame:
        """Entries with the component of their class; one that is connected with no other is its own."""
        others = written(labels.where("label != class").select("class", "label"), "other_labels")
        return entries.join(small_side(others, others.count()), "class", "left").withColumn(
            "label", F.coalesce("label", "class")
        )

    def led(self, entries: DataFrame, labels: DataFrame) -> DataFrame:
        """Labels once the entries of each list are compared with its leaders."""
        band = F.log2(F.col("size")).cast("int").alias("band")
        columns = ["token", band, "class", "label", "size", "at"]
        dealt = self.labelled(entries, labels).select(*columns).repartition(shuffle_partitions(self.spark), "token")
        pairs = dealt.sortWithinPartitions("token", "band", "at", "class").mapInArrow(_led, "a long, b long").distinct()
        found = self.overlaps(pairs)
        return self.merged(labels, found.where(similar("common", "m", "n")).select("a", "b"))

    def frequent(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys and counts of the elements that more than LONG documents hold, and a filter of those in more than one."""
        bits = min(FILTER_BITS, max(16, self.size.bit_length()))
        found = written(self.counted.groupBy("bucket").applyInPandas(_summed(bits), "key long, n long, bits binary"), "frequent")
        repeated = np.zeros(1 << bits >> 3, np.uint8)
        # Buckets are ranges of keys, so each has its own part of the filter but for a byte at its ends.
        for part in found.where("n = 0").select("key", "bits").collect():
            repeated[part["key"] : part["key"] + len(part["bits"])] |= np.frombuffer(part["bits"], np.uint8)
        found = found.where("n > 0").select("key", "n")
        if found.count() > FREQUENT:
            found = found.orderBy(F.desc("n"), "key").limit(FREQUENT)
        rows = found.toPandas()
        order = np.argsort(rows["key"].to_numpy(np.int64), kind="stable")
        return rows["key"].to_numpy(np.uint32)[order], rows["n"].to_numpy(np.uint32)[order], repeated

    def candidates(self, entries: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of hubs a < b of different components whose groups may hold similar sets."""
        hubs = members.select(F.col("member").alias("class"), "hub")
        lists = self.labelled(entries, labels).join(small_side(hubs, hubs.count()), "class", "left")
        columns = ["token", "hub", "label", _packed("low", "high", "at").alias("size")]
        own = lists.where("hub IS NULL").select(
            "token", F.col("class").alias("hub"), "label", F.col("size").alias("low"), F.col("size").alias("high"), "at"
        )
        grouped = (
            lists.where("hub IS NOT NULL")
            .groupBy("token", "hub")
            .agg(F.min("label").alias("label"), F.min("size").alias("low"), F.max("size").alias("high"), F.min("at").alias("at"))
        )
        return self.paired(own.unionByName(grouped).select(*columns))

    def paired(self, entries: DataFrame) -> DataFrame:
        """Pairs a < b of different labels that may be similar by the lists of their elements."""
        parts = shuffle_partitions(self.spark)
        dealt = entries.repartition(parts, "token").sortWithinPartitions("token", "size")
        return dealt.mapInArrow(_paired, "a long, b long").distinct()

    def run(self) -> DataFrame:
        """id, n, component of every document."""
        star, members, labels = self.hubs()
        entries = self.entries()
        labels = self.led(entries, labels)
        pairs = written(self.candidates(entries, members, labels), "candidates")
        turned = star.select("a", "b", "common", "m", "n").union(
            star.select(F.col("b").alias("a"), F.col("a").alias("b"), "common", F.col("n").alias("m"), F.col("m").alias("n"))
        )
        turned = turned.dropDuplicates(["a", "b"])
        known = pairs.join(turned, ["a", "b"])
        fresh = self.overlaps(pairs.join(turned.select("a", "b"), ["a", "b"], "left_anti"))
        hubs = written(known.select("a", "b", "common", "m", "n").union(fresh), "hub_pairs")

        # Pairs of hubs that are not similar but whose groups may be, unless other hubs connect them.
        labels = self.merged(labels, hubs.where(similar("common", "m", "n")).select("a", "b"))
        label = lambda end: labels.select(F.col("class").alias(end), F.col("label").alias(f"{end}_label"))
        group = members.select("hub", "member", "extra", "n").union(
            members.select("hub").distinct().join(self.classes, F.col("hub") == F.col("class")).select(
                "hub", F.col("class"), F.lit(0).cast("long"), "n"
            )
        )
        reach = group.groupBy("hub").agg(F.max("extra").alias("extra"), F.min("n").alias("low"))
        near = (
            hubs.where(f"NOT ({similar('common', 'm', 'n')})")
            .join(label("a"), "a").join(label("b"), "b").where("a_label != b_label").drop("a_label", "b_label")
            .join(reach.select(F.col("hub").alias("a"), F.col("extra").alias("extra_a"), F.col("low").alias("low_a")), "a", "left")
            .join(reach.select(F.col("hub").alias("b"), F.col("extra").alias("extra_b"), F.col("low").alias("low_b")), "b", "left")
            .where("extra_a IS NOT NULL OR extra_b IS NOT NULL")
            .withColumns(
                {
                    "extra_a": F.coalesce("extra_a", F.lit(0)), "extra_b": F.coalesce("extra_b", F.lit(0)),
                    "low_a": F.coalesce("low_a", "m"), "low_b": F.coalesce("low_b", "n"),
                }
            )
            .where(_can("common + extra_a + extra_b", "low_a", "low_b"))
        )
        near = written(near, "near_groups")
        if not near.isEmpty():
            # Members by their own fronts, of those the pairs whose hubs let them be similar.
            ends = near.select(F.col("a").alias("hub")).union(near.select("b")).distinct()
            within = written(
                ends.join(group, "hub", "left").select("hub", F.coalesce("member", "hub").alias("class"), F.coalesce("extra", F.lit(0)).alias("extra"))
                .join(labels, "class"),
                "near_members",
            )
            fronts = entries.join(small_side(within.select("class", "label"), within.count()), "class")
            fronts = fronts.select("token", F.col("class").alias("hub"), "label", _packed("size", "size", "at").alias("size"))
            pairs = written(self.paired(fronts), "member_pairs")

            def end(name: str) -> DataFrame:
                return within.select(
                    F.col("class").alias(name), F.col("hub").alias(f"{name}_hub"), F.col("extra").alias(f"{name}_extra"), F.col("n").alias(f"{name}_n")
                )

            bounds = near.select(F.least("a", "b").alias("low_hub"), F.greatest("a", "b").alias("high_hub"), "common")
            both = (
                pairs.join(end("a"), "a").join(end("b"), "b")
                .where("a != a_hub OR b != b_hub")
                .withColumns({"low_hub": F.least("a_hub", "b_hub"), "high_hub": F.greatest("a_hub", "b_hub")})
                .join(bounds, ["low_hub", "high_hub"])
                .where(f"{_can('common + a_extra + b_extra', 'a_n', 'b_n')} AND {close_sizes('a_n', 'b_n')}")
            )
            again = self.overlaps(both.select("a", "b").distinct())
            labels = self.merged(labels, again.where(similar("common", "m", "n")).select("a", "b"))
        labelled = self.classes.select("class", "rep").join(labels.select("class", "label"), "class")
        smallest = labelled.groupBy("label").agg(F.min("rep").alias("component"))
        result = labelled.join(smallest, "label").select("class", "component")
        return self.described.select("id", "n", "class").join(result, "class", "left").select(
            "id", "n", F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component")).alias("component")
        )


def _can(common: str, m: str, n: str) -> str:
    """Whether sets of at least these sizes with at most so much in common may be similar."""
    return f"{100 + PERCENT} * ({common}) >= {PERCENT} * ({m} + {n})"


#: Sizes up to this are told apart in a list; larger ones count as unbounded.
TOP = (1 << 21) - 1


def _packed(*columns: str):
    """Smallest size, largest size and position in one number that sorts by them."""
    low, high, at = (F.least(F.col(c), F.lit(TOP)).cast("long") for c in columns)
    return F.shiftleft(low, 42) + F.shiftleft(high, 21) + at


def _summed(bits: int):
    """Elements of a bucket that more than LONG sets hold, and as a row with n = 0 its part of the filter."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        once = [_keys(k) for k in rows["once"]]
        keys = np.concatenate([*once, *(_keys(k) for k in rows["keys"])])
        counts = np.ones(len(keys), np.int64)
        counts[sum(map(len, once)) :] = np.frombuffer(b"".join(rows["counts"]), "<u4")
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
        sums = np.add.reduceat(counts, starts) if len(starts) else np.empty(0, np.int64)
        keys = keys[starts].astype(np.int64)
        often, at = sums > LONG, keys[sums > 1] >> (32 - bits)
        first = int(at[0]) >> 3 if len(at) else 0
        there = np.zeros((int(at[-1]) >> 3) + 1 - first << 3 if len(at) else 0, bool)
        there[at - (first << 3)] = True
        return pd.DataFrame(
            {
                "key": np.r_[keys[often], first],
                "n": np.r_[sums[often], 0],
                "bits": [None] * int(often.sum()) + [np.packbits(there).tobytes()],
            }
        )

    return run


def is_repeated(repeated: np.ndarray, own: np.ndarray) -> np.ndarray:
    """False only for elements that a single document holds."""
    at = own.astype(np.int64) >> (32 - (len(repeated).bit_length() + 2))
    return (repeated[at >> 3] >> (7 - (at & 7))) & 1 > 0


def front(
    elements: np.ndarray, keys: np.ndarray, counts: np.ndarray, repeated: np.ndarray | None = None
) -> np.ndarray:
    """The first elements of a set in the common order."""
    size = prefix_length(len(elements))
    if not len(keys) and repeated is None:
        return elements[:size]
    own = elements.astype(np.uint32)
    often = np.zeros(len(own), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        often = np.where(keys[at] == own, counts[at], 0).astype(np.int64)
    if repeated is not None:
        often = np.where(is_repeated(repeated, own), often + 1, 0)
    return elements[np.argsort(often, kind="stable")[:size]]


def _fronts(frequent):
    """One row per element at the front of a set that another document may hold, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, repeated = frequent.value
        names = ["token", "class", "size", "at"]
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in names]

            def rows() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], names=names)
                for part in parts:
                    part.clear()
                return out

            held = 0
            for text in batch.column(0).to_pylist():
                elements = shingles(text)
                size, alone = prefix_length(len(elements)), ~is_repeated(repeated, elements.astype(np.uint32))
                alone = int(alone.sum())
                if not len(elements) or alone >= size:
                    continue
                listed = front(elements, keys, counts, repeated)[alone:]
                n = len(listed)
                parts[0].append(listed.view(np.int64))
                parts[1].append(np.full(n, class_of(elements), np.int64))
                parts[2].append(np.full(n, len(elements), np.int32))
                parts[3].append(np.arange(alone, size, dtype=np.int32))
                held += n
                if held >= 200_000:
                    yield rows()
                    held = 0
            if held:
                yield rows()

    return run


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each entry with the first one of its list and band, if they are of different components and may be similar."""
    last = None
    for batch in batches:
        columns = [column.to_numpy().astype(np.int64) for column in batch.columns]
        if not len(columns[0]):
            continue
        # The leader of a list that goes on stands before the entries of this batch.
        if last is not None:
            columns = [np.r_[before, c] for before, c in zip(last, columns)]
        token, band, class_, label, size, at = columns
        new = np.r_[True, (token[1:] != token[:-1]) | (band[1:] != band[:-1])]
        of = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        fits = _may(size[of], size[of], at[of], size, size, at) & (label[of] != label)
        a, b = class_[of[fits]], class_[fits]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        last = [c[of[-1]] for c in columns]


def _may(low_a, high_a, at_a, low_b, high_b, at_b):
    """Whether sets with this element at these positions can be similar, given that it is their first in common."""
    left = np.minimum(high_a - at_a, high_b - at_b)
    close = 100 * np.minimum(high_a, high_b) >= PERCENT * np.maximum(low_a, low_b)
    return close & ((100 + PERCENT) * left >= PERCENT * (low_a + low_b))


def _short(token, hub, label, low, high, at):
    """Pairs within the lists of a run of entries, neighbours first, as (a, b)."""
    a, b = [], []
    active = np.arange(len(token))
    step = 1
    while True:
        active = active[active + step < len(token)]
        active = active[token[active + step] == token[active]]
        # Lists are sorted by size: where the next one is too large, all later ones are.
        active = active[100 * high[active] >= PERCENT * low[active + step]]
        if not len(active):
            break
        other = active + step
        fits = _may(low[active], high[active], at[active], low[other], high[other], at[other])
        fits &= label[active] != label[other]
        a.append(hub[active[fits]])
        b.append(hub[other[fits]])
        step += 1
    return a, b


def _long(hub, label, low, high, at):
    """Pairs within one long list, by blocks; yields (a, b)."""
    # Entries of the component with most of them stand last and are not paired with each other.
    labels, of, counts = np.unique(label, return_inverse=True, return_counts=True)
    most = of == counts.argmax()
    order = np.lexsort((at, low // max(1, BLOCK), most))
    hub, label, low, high, at = hub[order], label[order], low[order], high[order], at[order]
    cuts = range(0, len(hub), BLOCK)
    parts = [slice(k, k + BLOCK) for k in cuts]
    least = [(low[p].min(), high[p].max(), at[p].min()) for p in parts]
    for i, p in enumerate(parts[: -(-int((~most).sum()) // BLOCK)]):
        for j in range(i, len(parts)):
            q = parts[j]
            if not _may(*least[i], *least[j]):
                continue
            fits = _may(
                low[p][:, None], high[p][:, None], at[p][:, None], low[q][None, :], high[q][None, :], at[q][None, :]
            )
            fits &= label[p][:, None] != label[q][None, :]
            if i == j:
                fits &= hub[p][:, None] < hub[q][None, :]
            x, y = np.nonzero(fits)
            if len(x):
                yield [hub[p][x]], [hub[q][y]]


def _pair_batch(a: list[np.ndarray], b: list[np.ndarray], seen: set) -> pa.RecordBatch:
    x, y = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
    pairs = pairs[[(p, q) not in seen for p, q in pairs.tolist()]] if len(pairs) else pairs
    if len(seen) < 1_000_000:
        seen.update(map(tuple, pairs.tolist()))
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of the lists, which arrive one after the other."""
    held: list[list[np.ndarray]] = []
    seen: set[tuple[int, int]] = set()

    def pairs(token, hub, label, size):
        low, high, at = size >> 42, (size >> 21) & TOP, size & TOP
        high = np.where(high == TOP, 1 << 40, high)
        edges = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
        lengths = np.diff(edges)
        short = np.repeat((lengths > 1) & (lengths <= BLOCK), lengths)
        if short.any():
            a, b = _short(token[short], hub[short], label[short], low[short], high[short], at[short])
            if sum(map(len, a)):
                yield _pair_batch(a, b, seen)
        for k in np.flatnonzero(lengths > BLOCK):
            p = slice(edges[k], edges[k + 1])
            if (label[p] == label[edges[k]]).all():
                continue
            for a, b in _long(hub[p], label[p], low[p], high[p], at[p]):
                yield _pair_batch(a, b, seen)

    def waiting():
        return [np.concatenate(parts) for parts in zip(*held)]

    for batch in batches:
        rows = [column.to_numpy() for column in batch.columns]
        if not len(rows[0]):
            continue
        # The last list may go on in the next batch, and the waiting one may end in this.
        ends = np.flatnonzero(rows[0] != rows[0][-1])
        cut = ends[-1] + 1 if len(ends) else 0
        if cut or held and held[-1][0][-1] != rows[0][0]:
            held.append([r[:cut] for r in rows])
            yield from pairs(*waiting())
            held.clear()
        held.append([r[cut:] for r in rows])
    if held:
        yield from pairs(*waiting())


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: id, n_shingles, component_id.

    component_id is the smallest id that links reach from the document, itself included.  A missing
    or empty text, or one without words, has an empty set and is its own component.  Rows with the
    same id and different texts are documents of their own that share an id; rows without an id
    count, but give a component no id unless it has no other.  An empty table gives no rows; other
    columns are not read.  Elements and sets are told apart by 64-bit hashes.
    """
    out = Join(df, id_col, text_col).run()
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of similar shingle sets, with the columns of `df`.

    Kept is the document with the smallest id, of texts that share an id the one with the smallest
    hash; documents with an id come before those without.  Rows of one id and text are one document,
    of which the smallest row by the other columns stays, so reruns agree.  Documents without a word
    are linked with nothing and stay; such rows without an id all do.  An empty table stays empty.
    """
    key, text = quoted(id_col), quoted(text_col)
    ids = df.select(key.alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 OR id IS NULL").isEmpty():
        joined = written(join(df, id_col, text_col), "components")
        dropped = joined.where(F.col("component_id") != key).select(key.alias("_dropped"))
        return df.join(small_side(dropped, dropped.count()), key == F.col("_dropped"), "left_anti")

    # Documents are numbered in the order in which they are preferred.
    digest = F.md5(text.cast("string").cast("binary"))
    known = df.select(F.lit(0).alias("all"), key.alias("id"), digest.alias("digest")).distinct()
    numbers = written(numbered(known, ["all"], ["id", "digest"]).select("id", "digest", PLACE), "numbers")
    rows = df.select(F.struct(*map(quoted, df.columns)).alias("row"), key.alias("_own"), text.alias("_text"))
    own = F.md5(F.col("_text").cast("string").cast("binary"))
    same = F.col("_own").eqNullSafe(F.col("_id")) & own.eqNullSafe(F.col("_digest"))
    keyed = written(
        rows.join(numbers.toDF("_id", "_digest", "_number"), same).select(
            F.col("_number").alias("number"), F.col("_text").alias("text"), F.col("_own").isNull().alias("nameless"), "row"
        ),
        "keyed",
    )
    documents = keyed.groupBy("number").agg(F.first("text").alias("text"))
    joined = written(join(documents, "number", "text"), "components")
    kept = joined.where("component_id = number").select("number", (F.col("n_shingles") == 0).alias("wordless"))
    chosen = keyed.join(kept, "number")
    several = F.col("nameless") & F.col("wordless")
    one = chosen.where(~several).groupBy("number").agg(F.min("row").alias("row"))
    return one.select("row.*").unionByName(chosen.where(several).select("row.*"))
