"""Language-model scores by a probabilistic suffix tree over words.

Words are lowered in A-Z only; each text ends with an end token, which is also what stands before
its first word.  The root of the tree is the distribution of single tokens with one added to every
count and one unseen token.  A context is a run of up to DEPTH tokens, an entry a context with a next
symbol that follows it at least LEAST times; any token can stand in either.  An entry is kept if it is
likelier than after the parent, the context without its oldest token, and a context is retained if the
log-likelihood that it gains over its parent by its kept entries exceeds half a log of its count for
each of them (a divergence test with the price of a minimum description).
Next-symbol distributions are smoothed by absolute discounting: what is discounted, and what falls on
symbols without a kept entry, is spread like the distribution of the longest retained suffix.  A token
is scored in the longest retained context that it stands in.

Entries, contexts and their probabilities are tables that grow with the corpus, built level by level.
A token's score is a sum: that of the root, the log of the spread of every retained context before it,
and for every entry of these what its log probability is above that.  So the tree is one table of
weights of token runs, joined to the runs of the texts.  Workers hold the weights and token counts of
the most frequent ones, and a bit filter of bounded size that only spares runs without a weight.  What
they cannot score is written beside a text's sums; it meets the other weights as arrays, by ranges of
hashes, and only its sums by text come back.  Tokens and runs are told apart by 63-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import new_folder, removed
from .common import prepare, quoted, shuffle_partitions, shuffles_deleted, written

DEPTH = 3
#: Least share of all tokens of a token whose count every worker holds, and how many of them at most.
HELD_SHARE, HELD_TOKENS = 1e-7, 500_000
#: Weights that every worker holds at most, and 64-bit words of a filter.
HELD_WEIGHTS, FILTER_WORDS = 3_000_000, 1 << 21
#: Least count of an entry, and what is taken off it.
LEAST, DISCOUNT = 3, 0.75
#: Tokens whose runs are counted together, bytes of text cut into words together.
FLUSH, CHUNK = 1_500_000, 2 << 20
#: Bytes of text whose runs are summed in one group, on average, and counts that are sent together.
BUCKET, SENT = 4 << 20, 250_000
#: Sums by text that are held before they are sent, and bits of a text's number within a group of texts.
SUMS, GROUP = 1_000_000, 14
#: Words of more bytes are hashed one by one.
LONG = 64
END = xxhash.xxh64_intdigest(b"\n") >> 1
#: In place of the context of a single token.
SINGLE = -1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashed(words: pa.Array) -> np.ndarray:
    """63-bit hashes of words (string or binary, none missing), eight bytes of all of them at a time."""
    if not len(words):
        return np.empty(0, np.int64)
    _, ends, data = words.buffers()
    bounds = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    at, lengths = bounds[:-1], np.diff(bounds)
    data = np.frombuffer(data or b"", np.uint8)[: bounds[-1]]
    padded = np.r_[data, np.zeros(16, np.uint8)]
    eight = np.ndarray(len(padded) - 7, "<u8", padded, 0, (1,))
    out = _mixed(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for start in range(0, min(LONG, int(lengths.max())), 8):
        on = np.flatnonzero(lengths > start)
        spare = np.maximum(8 - (lengths[on] - start), 0).astype(np.uint64) << np.uint64(3)
        lane = eight[at[on] + start] << spare
        out[on] = _mixed((out[on] + lane) * np.uint64(0x9E3779B97F4A7C15))
    for k in np.flatnonzero(lengths > LONG).tolist():
        out[k] = xxhash.xxh64_intdigest(data[at[k] : at[k] + lengths[k]].tobytes())
    return (out >> np.uint64(1)).astype(np.int64)


@dataclass
class Chunk:
    """Tokens of some texts one after the other, an end token closing each."""

    words: np.ndarray  # hashes of the distinct tokens
    codes: np.ndarray  # which of them each token is
    starts: np.ndarray  # where each text starts

    @property
    def tokens(self) -> np.ndarray:
        return self.words[self.codes]


def _chunk(texts: pa.Array) -> Chunk:
    # Only A-Z and white space of ASCII matter, so bytes that are no text pass as they are.
    text = pc.fill_null(texts, b"").cast(pa.string(), safe=False)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words, of = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    some = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(some).dictionary_encode()
    known = hashed(coded.dictionary)
    of = of[some.to_numpy(zero_copy_only=False)]
    codes = np.full(len(of) + len(texts), len(known), np.int64)
    codes[np.arange(len(of)) + of] = coded.indices.to_numpy()
    lengths = np.bincount(of, minlength=len(texts)) + 1
    return Chunk(np.r_[known, END], codes, np.cumsum(lengths) - lengths)


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """Texts (binary, missing for empty) in order, about CHUNK bytes at a time."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + CHUNK, side="right")))
        yield _chunk(texts.slice(start, end - start))
        start = end


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def followed(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hash of the run of a context and the token behind it."""
    mixed = _mixed(context.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + symbol.view(np.uint64))
    return (mixed >> np.uint64(1)).astype(np.int64)


def runs(
    tokens: np.ndarray, pairs: np.ndarray | None = None, longest: int = DEPTH + 1
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length from 2, of the runs within a text: context, symbol, run, and place of the symbol.

    The end token before a text belongs to its runs, as their first token only.  With a filter of the
    frequent pairs, of length 3 and more only those all of whose pairs are in it: others are not frequent.
    """
    context, at = np.r_[END, tokens[:-1]], np.arange(len(tokens))
    frequent = None
    for length in range(2, longest + 1):
        symbol = tokens[at]
        run = followed(context, symbol)
        yield context, symbol, run, at
        # A run goes on where its last token does not end the text.
        on = symbol != END
        if pairs is not None and length < longest:
            if frequent is None:
                frequent = np.r_[is_in(pairs, run), False]
                on &= frequent[:-1]
            on &= frequent[at + 1]
        context, at = run[on], at[on] + 1


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key stands once, and how often it does."""
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return order[new], np.diff(np.r_[new, len(key)])


def is_in(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that are not in the filter."""
    word = filter_[(keys >> 18) & (len(filter_) - 1)]
    bits, one, last = keys.view(np.uint64), np.uint64(1), np.uint64(63)
    three = one << (bits & last)
    three |= one << ((bits >> np.uint64(6)) & last)
    three |= one << ((bits >> np.uint64(12)) & last)
    return word & three == three


def bit_filter(df: DataFrame, rows: int) -> np.ndarray:
    """Three bits of one word for each hash in the only column; 16 bits a row up to FILTER_WORDS."""
    words = 1 << min(FILTER_WORDS.bit_length() - 1, max(0, math.ceil(math.log2(max(rows, 1) / 4))))
    out = np.zeros(words, np.uint64)
    key = df.columns[0]
    three = " | ".join(f"shiftleft(1L, cast(shiftright({key}, {shift}) & 63 AS int))" for shift in (0, 6, 12))
    bits = (
        df.select(F.expr(f"shiftright({key}, 18) & {words - 1}L AS word"), F.expr(f"{three} AS bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    out[bits["word"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return out


def _dealt(key: np.ndarray, buckets: int, columns: dict[str, np.ndarray | None]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted 63-bit hashes as arrays by bucket, a range of hashes; columns may be missing."""
    cuts = np.searchsorted(key.view(np.uint64), np.array([(k << 63) // buckets for k in range(buckets + 1)], np.uint64))
    start = 0
    while start < buckets:
        end = max(start + 1, int(np.searchsorted(cuts, cuts[start] + SENT, side="right")) - 1)
        full = [b for b in range(start, end) if cuts[b] < cuts[b + 1]]
        parts = [
            pa.array([None if c is None else c[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary())
            for c in columns.values()
        ]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *parts], names=["bucket", *columns])
        start = end


def _counted(lengths: tuple[int, ...], buckets: int, pairs=None):
    """Counts of runs, with length 1 of tokens, as arrays by bucket; with a filter, of runs of frequent pairs.

    A bucket is a range of run hashes.
    """

    def sent(key: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        return _dealt(key, buckets, {"context": context, "symbol": symbol, "n": n.astype("<u4")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, size = [], [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            if words:
                token, n = (np.concatenate(c) for c in zip(*words))
                words.clear()
                context = np.full(len(token), SINGLE)
                yield from sent(*_added(followed(context, token), context, token, n))
            # Only tokens are held; their runs are made here, a length at a time.
            tokens = np.concatenate(held)
            held.clear()
            for length, (context, symbol, key, _) in enumerate(runs(tokens, pairs and pairs.value, max(lengths)), 2):
                if length in lengths:
                    first, n = _groups(key)
                    yield from sent(key[first], context[first], symbol[first], n)

        for batch in batches:
            for chunk in chunks(batch.column(0)):
                held.append(chunk.tokens)
                if 1 in lengths:
                    words.append((chunk.words, np.bincount(chunk.codes, minlength=len(chunk.words))))
                size += len(held[-1])
                if size >= FLUSH:
                    yield from flushed()
                    size = 0
        if size:
            yield from flushed()

    return run


def _added(key: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sum of their counts."""
    order = np.argsort(key)
    key, n = key[order], n[order].astype(np.int64)
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    first = order[new]
    return key[new], context[first], symbol[first], np.add.reduceat(n, new) if len(new) else n


def _frequent(rows: pa.Table) -> pa.Table:
    """Sums of the counts of a bucket: tokens, and runs that are frequent enough for an entry."""

    def whole(name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)])

    context, symbol, n = whole("context", "<i8"), whole("symbol", "<i8"), whole("n", "<u4")
    _, context, symbol, n = _added(followed(context, symbol), context, symbol, n)
    kept = (context == SINGLE) | (n >= LEAST)
    return pa.table({"context": context[kept], "symbol": symbol[kept], "n": n[kept]})


def _with_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the run of an entry, and that run without its oldest token."""
    for batch in batches:
        symbol = batch.column("symbol").to_numpy()
        context, parent = (batch.column(c).to_numpy() for c in ("context", "parent"))
        shorter = np.where(parent == SINGLE, symbol, followed(parent, symbol))
        more = [pa.array(followed(context, symbol)), pa.array(shorter)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "run", "shorter"])


@dataclass
class Held:
    """What every worker holds to score texts."""

    tokens: np.ndarray  # the most frequent tokens, sorted
    root: np.ndarray  # log10 probability of each of them
    unseen: float  # that of a token that training has not seen
    runs: np.ndarray  # the most frequent runs that have a weight, sorted
    weights: np.ndarray
    filter: np.ndarray  # of all runs that have a weight
    pairs: np.ndarray  # filter of the frequent pairs

    def single(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Whether each token is held, and its log10 probability; others count as unseen."""
        there, root = _found(self.tokens, self.root, chunk.words)
        return there[chunk.codes], np.where(there, root, self.unseen)[chunk.codes]

    def above(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What held runs add to the log10 probability of each token, and the runs to be joined with their places."""
        keys, places = [np.r_[END, tokens[:-1]]], [np.arange(len(tokens))]
        for _, _, run, at in runs(tokens, self.pairs):
            keys.append(run)
            # As a context the run counts for the token behind it, which is in the same text.
            places.append(at)
        maybe = [is_in(self.filter, k) for k in keys]
        key = np.concatenate([k[m] for k, m in zip(keys, maybe)])
        place = np.concatenate([p[m] for p, m in zip(places, maybe)])
        order = np.argsort(key)
        key, place = key[order], place[order]
        there, weight = _found(self.runs, self.weights, key)
        return np.bincount(place[there], weight[there], len(tokens)), key[~there], place[~there]


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether wanted keys are among the sorted ones, and their values, else 0."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return there, np.where(there, values[at], 0.0)


def _scored(model):
    """Sums for what is held, and the other tokens and runs of a text, each once with how often it stands there.

    Rows get numbers of their own, which hold once they are written.  Runs stand as -1 - run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Held = model.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            done = 0
            for chunk in chunks(batch.column(1)):
                tokens, starts = chunk.tokens, chunk.starts
                documents = len(starts)
                there, single = held.single(chunk)
                above, joined, places = held.above(tokens)
                of = np.repeat(np.arange(documents), np.diff(np.r_[starts, len(tokens)]))
                rest = np.flatnonzero(~there)
                doc, key = np.r_[of[rest], of[places]], np.r_[tokens[rest], -1 - joined]
                order = np.lexsort((key, doc))
                doc, key = doc[order], key[order]
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])][: len(doc)])
                offsets = pa.array(np.searchsorted(doc[new], np.arange(documents + 1)).astype(np.int32))
                often = np.diff(np.r_[new, len(doc)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + documents)),
                        batch.column(0).slice(done, documents),
                        pa.array(np.bincount(of, minlength=documents)),
                        pa.array(np.bincount(of, there, documents).astype(np.int64)),
                        pa.array(np.add.reduceat(single, starts)),
                        pa.array(np.add.reduceat(single + above, starts)),
                        pa.ListArray.from_arrays(offsets, pa.array(key[new])),
                        pa.ListArray.from_arrays(offsets, pa.array(often)),
                    ],
                    names=["row", "id", "tokens", "known", "base", "score", "keys", "often"],
                )
                done, row = done + documents, row + documents

    return run


#: Keys of a bucket with their weights, or with the numbers of their texts and how often they stand there.
KEYS = "bucket int, row binary, key binary, value binary"


def _keys_dealt(buckets: int, in_texts: bool):
    """Keys with weights, or lists of keys in texts, to KEYS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            key, value, *row = (np.concatenate(c) for c in zip(*held))
            held.clear()
            hashes = key ^ (key >> 63)
            order = np.argsort(hashes)
            row = row[0][order] if in_texts else None
            yield from _dealt(hashes[order], buckets, {"row": row, "key": key[order], "value": value[order]})

        for batch in batches:
            if in_texts:
                row, keys, often = batch.columns
                rows = np.repeat(row.to_numpy(), pc.list_value_length(keys).to_numpy())
                held.append((keys.flatten().to_numpy(), often.flatten().to_numpy(), rows))
            else:
                held.append(tuple(c.to_numpy() for c in batch.columns))
            size += len(held[-1][0])
            if size >= 2 * SENT:
                yield from flushed()
                size = 0
        if size:
            yield from flushed()

    return run


def _by_row(row: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct rows in order, and the sums of their values."""
    order = np.argsort(row)
    row = row[order]
    new = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    return [row[new], *(np.add.reduceat(v[order], new) for v in values)]


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """KEYS, in each bucket those with weights first, to sums by text as arrays by group of texts."""
    held, size = [], 0

    def flushed() -> Iterator[pa.RecordBatch]:
        columns = _by_row(*(np.concatenate(c) for c in zip(*held)))
        held.clear()
        group = columns[0] >> GROUP
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        cuts = [*zip(start, [*start[1:], len(group)])]
        parts = [pa.array([c[a:b].tobytes() for a, b in cuts], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(group[start]), *parts], names=["group", "row", "known", "base", "score"])

    at, weights, table = None, [], None
    for batch in batches:
        for bucket, row, key, value in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
            if bucket != at:
                at, weights, table = bucket, [], None
            key = np.frombuffer(key.as_buffer(), "<i8")
            if not row.is_valid:
                weights.append((key, np.frombuffer(value.as_buffer(), "<f8")))
                continue
            if table is None:
                table = [np.concatenate(c) for c in zip(*weights)] or [np.empty(0, np.int64), np.empty(0)]
                order = np.argsort(table[0])
                table, weights = [c[order] for c in table], []
            there, weight = _found(*table, key)
            often = np.frombuffer(value.as_buffer(), "<i4")[there].astype(np.int64)
            weight, token = weight[there] * often, key[there] >= 0
            row = np.frombuffer(row.as_buffer(), "<i8")[there]
            held.append((row, np.where(token, often, 0), np.where(token, weight, 0.0), weight))
            size += len(row)
            if size >= SUMS:
                yield from flushed()
                size = 0
    if size:
        yield from flushed()


def _totals(rows: pa.Table) -> pa.Table:
    """Sums by text of one group of texts."""
    kinds = {"row": "<i8", "known": "<i8", "base": "<f8", "score": "<f8"}
    row, *sums = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows.column(c)]) for c, kind in kinds.items())
    return pa.table(dict(zip(("row", "more_known", "more_base", "more_score"), _by_row(row, *sums))))


def _text(df: DataFrame, text_col: str) -> Column:
    return quoted(text_col).cast("string").cast("binary")


class Model:
    """Counts of all training tokens, and the tree over all of them as tables."""

    def __init__(self, df: DataFrame, text_col: str = "text"):
        spark = df.sparkSession
        prepare(spark)
        texts = df.select(_text(df, text_col).alias("text"))
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.buckets = max(2 * shuffle_partitions(spark), size // BUCKET)
        self.spark, self.sums, self.entries = spark, [], []
        pairs = self._summed(texts, "pair_counts", (1, 2))
        singles = pairs.where(F.col("context") == SINGLE).select(F.col("symbol").alias("token"), "n")
        self.counts = written(singles, "token_counts")
        row = self.counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
        self.total, self.distinct = row["total"] or 0, row["distinct"]
        self.norm = float(self.total + self.distinct + 1)
        self.least = max(1, math.ceil(HELD_SHARE * self.total), _above(self.counts, self.distinct, HELD_TOKENS) + 1)
        self.held_counts = self.counts.where(F.col("n") >= self.least).toPandas().sort_values("token")
        self._build(texts, pairs.where(F.col("context") != SINGLE))
        for path in self.sums:
            removed(spark, path)

    def _summed(self, texts: DataFrame, name: str, lengths: tuple[int, ...], pairs=None) -> DataFrame:
        # A row holds the counts of a bucket in one FLUSH; single counts as rows would cost much more.
        found = texts.mapInArrow(_counted(lengths, self.buckets, pairs), "bucket int, context binary, symbol binary, n binary")
        sums = found.groupBy("bucket").applyInArrow(_frequent, "context long, symbol long, n long")
        return self._kept(sums, name, self.sums)

    def _kept(self, df: DataFrame, name: str, paths: list[str]) -> DataFrame:
        """A written table whose path is noted, to remove it."""
        paths.append(new_folder(self.spark, name))
        with shuffles_deleted(self.spark):
            return written(df, name, paths[-1])

    def without_levels(self) -> Model:
        """The model for scores alone: the entries, of which the weights are made, are deleted."""
        self.levels = []
        while self.entries:
            removed(self.spark, self.entries.pop())
        return self

    def _build(self, texts: DataFrame, entries: DataFrame) -> None:
        singles = self.counts.select(F.col("token").alias("symbol"), F.col("n").alias("parent_n"))
        above = entries.join(singles, "symbol").join(
            self.counts.select(F.col("token").alias("context"), F.col("n").alias("total")), "context"
        )
        joined = above.select(
            "context", "symbol", "n", "total", F.lit(SINGLE).cast("long").alias("parent"), "parent_n",
            F.lit(self.total).cast("long").alias("parent_total"), ((F.col("parent_n") + 1) / F.lit(self.norm)).alias("below"),
        )
        self.levels = [self._level(joined, 1)]
        pairs = self.levels[0].select("run")
        self.pairs = bit_filter(pairs, pairs.count())
        model = self.spark.sparkContext.broadcast(self.pairs)
        longer = tuple(range(3, DEPTH + 2))
        counted = self._summed(texts, "run_counts", longer, model)
        for depth in range(2, DEPTH + 1):
            last = self.levels[-1]
            contexts = last.select(F.col("run").alias("context"), F.col("n").alias("total"), F.col("shorter").alias("parent"))
            # An entry without its oldest token is an entry of the level below.
            parents = last.select(
                F.col("context").alias("parent"), "symbol", F.col("n").alias("parent_n"),
                F.col("total").alias("parent_total"), F.col("probability").alias("below"),
            )
            # Runs of all lengths are counted together; the join with their contexts tells them apart.
            joined = counted.join(contexts, "context").join(parents, ["parent", "symbol"])
            self.levels.append(self._level(joined, depth))
        self._weigh()

    def _level(self, joined: DataFrame, depth: int) -> DataFrame:
        """Entries of a level; rest is the share of a retained context's parent, missing for other contexts."""
        columns = ["context", "symbol", "n", "total", "parent", "below"]
        path = new_folder(self.spark, f"level_{depth}")
        joined = joined.select(*columns, "parent_n", "parent_total")
        with shuffles_deleted(self.spark):
            joined.write.parquet(path)
        p, q = F.col("n") / F.col("total"), F.col("parent_n") / F.col("parent_total")
        price = 0.5 * F.log("total")
        rows = self.spark.read.schema(joined.schema).parquet(path).withColumns({"p": p, "q": q, "kept": p > q})
        other = (1 - F.col("p")) * F.log((1 - F.col("p")) / (1 - F.col("q")))
        tests = (
            rows.where("kept")
            .groupBy("context", "total")
            .agg(
                F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("gain"),
                F.sum("p").alias("p"), F.sum("q").alias("q"), F.count("*").alias("k"),
                (1 - F.sum(F.col("n") - DISCOUNT) / F.col("total")).alias("rest"),
            )
            .withColumn("other", F.when((F.col("p") < 1) & (F.col("q") < 1), other).otherwise(0.0))
            .where(F.col("total") * (F.col("gain") + F.col("other")) > F.col("k") * price)
            .select("context", "rest")
        )
        spread = F.coalesce(F.col("rest") * F.col("below"), "below")
        own = F.when(F.col("kept") & F.col("rest").isNotNull(), (F.col("n") - DISCOUNT) / F.col("total")).otherwise(0.0)
        scored = rows.join(tests, "context", "left").select(*columns, "kept", "rest", (own + spread).alias("probability"))
        schema = (
            "context long, symbol long, n long, total long, parent long, below double, kept boolean,"
            " rest double, probability double, run long, shorter long"
        )
        entries = self._kept(scored.mapInArrow(_with_runs, schema), f"entries_{depth}", self.entries)
        removed(self.spark, path)
        return entries

    def _weigh(self) -> None:
        parts = []
        for rows in self.levels:
            retained = rows.where("kept AND rest IS NOT NULL")
            parts.append(retained.selectExpr("run", "log10(probability) - log10(below) - log10(rest) AS weight", "n"))
            parts.append(retained.groupBy(F.col("context").alias("run")).agg(
                F.log10(F.first("rest")).alias("weight"), F.first("total").alias("n")
            ))
        both = parts[0]
        for part in parts[1:]:
            both = both.unionByName(part)
        summed = both.groupBy("run").agg(F.sum("weight").alias("weight"), F.max("n").alias("n"))
        with shuffles_deleted(self.spark):
            weights = written(summed, "weights")
        rows = weights.count()
        above = _above(weights, rows, HELD_WEIGHTS)
        held = weights.where(F.col("n") > above).select("run", "weight").toArrow()
        keys = held["run"].to_numpy()
        order = np.argsort(keys)
        self.held = Held(
            self.held_counts["token"].to_numpy(np.int64),
            np.log10((self.held_counts["n"].to_numpy(np.int64) + 1) / self.norm),
            -math.log10(self.norm),
            keys[order],
            held["weight"].to_numpy()[order],
            bit_filter(weights.select("run"), rows),
            self.pairs,
        )
        self.weights = weights.where(F.col("n") <= above)

    def score(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per row of `df`: id, n_tokens, n_known, base_score, score.

        base_score takes every token by itself; both are log10 probabilities.  A missing text counts
        as empty: the end token alone.  Ids are only carried along; repeated rows stay; an empty
        table gives no rows; other columns are not read.
        """
        docs = df.select(quoted(id_col).alias("id"), _text(df, text_col).alias("text"))
        schema = T.StructType([T.StructField("row", T.LongType()), docs.schema["id"]])
        for name, kind in (("tokens", "long"), ("known", "long"), ("base", "double"), ("score", "double")):
            schema = schema.add(name, kind)
        schema = schema.add("keys", T.ArrayType(T.LongType())).add("often", T.ArrayType(T.IntegerType()))
        sums = written(docs.mapInArrow(_scored(self.spark.sparkContext.broadcast(self.held)), schema), "scored")
        # A token that is not held counts as unseen so far.  Keys stay arrays: as rows they would cost much more.
        tokens = self.counts.where(F.col("n") < self.least).select(
            F.col("token").alias("key"), F.log10(F.col("n") + 1.0).alias("weight")
        )
        weights = tokens.unionByName(self.weights.select((-1 - F.col("run")).alias("key"), "weight"))
        keys = sums.select("row", "keys", "often").mapInArrow(_keys_dealt(self.buckets, True), KEYS)
        more = (
            keys.unionByName(weights.mapInArrow(_keys_dealt(self.buckets, False), KEYS))
            .repartition("bucket").sortWithinPartitions("bucket", F.col("row").isNotNull())
            .mapInArrow(_weighed, "group long, row binary, known binary, base binary, score binary")
            .groupBy("group").applyInArrow(_totals, "row long, more_known long, more_base double, more_score double")
        )

        def both(name: str) -> Column:
            return F.col(name) + F.coalesce(f"more_{name}", F.lit(0))

        return sums.drop("keys", "often").join(more, "row", "left").select(
            F.col("id").alias(id_col),
            F.col("tokens").alias("n_tokens"),
            both("known").alias("n_known"),
            both("base").alias("base_score"),
            both("score").alias("score"),
        )


def _above(counts: DataFrame, rows: int, most: int) -> int:
    """A count n that at most about `most` of the rows exceed; 0 if there are no more rows."""
    if rows <= most:
        return 0
    return counts.agg(F.percentile_approx("n", 1 - most / rows, 10_000)).first()[0]
