"""Prefix trie of conversations, built from z-fast tries.

A conversation is its sequence of turns.  Every prefix has an identity: a polynomial over the digests
of its turns modulo a Mersenne prime of 127 bits, so the identity of a sequence that is continued
follows from the two parts, and equal prefixes have equal identities in every task.

Each task holds a z-fast trie of the conversations it reads.  Its nodes are compacted: one covers all
depths from below its parent to where its members part or one of them ends.  A node is found by its
handle, the prefix whose depth is the two-fattest number of that range (the one that the highest
power of two divides).  Fat binary search needs about log2(depth) look-ups of a conversation's own
prefixes to find the node at which it leaves the trie; the edge there is split or a leaf added.
Conversations come in batches: all of a batch are located in the trie as it stands, and those that
leave it at one node are inserted one after another from there.  A task keeps a bounded number of
turns; then it expands the edges of its trie to a row per depth and starts a new one.  Rows of equal
identity are then summed, so a prefix that most conversations share is a row per task and not per
conversation.

Sums over subtrees need no walk through the tree.  Every node belongs to its smallest member, and
the nodes of one conversation are the end of its path, from some depth on.  Therefore a sum over the
nodes below a prefix is a sum over the conversations that start with it, each giving what it owns
below; that is one more aggregation by identity.

Long conversations are cut into pieces of `PIECE` turns, each a string of the trie below the prefix
at which it starts, so no row, sort or task holds a whole one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import series
from .common import prepare, quoted, shuffle_partitions, written

#: Turns of a piece; longer conversations are several.
PIECE = 4096
#: Turns that a task's trie refers to before it is expanded and a new one begun.
HELD_TURNS = 400_000
#: Ids hashed as one text; the members that end at a node may be many such texts.
TEXT_IDS = 50_000

PRIME = 2**127 - 1
BASE = int.from_bytes(hashlib.md5(b"base of prefix identities").digest(), "big") % PRIME
ROOT = bytes(16)

PATH = "conv_id long, start long, start_id binary, tail long, last boolean, ids array<binary>, sizes array<long>, lefts array<long>"
NODE = "id binary, parent_id binary, depth long, size long, conv_id long, n_convs long, gross long"


# ---- conversations as pieces


def turn_order(turn: Column) -> list[Column]:
    """A missing turn number comes first."""
    return [turn.isNotNull().alias("numbered"), turn.alias("turn")]


def sequences(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, piece, turns: the turns of each conversation in order, `PIECE` of them in a row.

    A turn is (digest, size): the MD5 of role and text and the UTF-8 bytes of the text; a missing
    role or text is empty.  Turns of equal number are ordered by digest, and repeated rows are
    turns of their own.  Rows without a conversation id belong to none and are left out.
    """
    role = F.coalesce(quoted(role_col).cast("string"), F.lit(""))
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = df.where(quoted(conv_col).isNotNull()).select(
        quoted(conv_col).cast("long").alias("conv_id"),
        *turn_order(quoted(turn_col)),
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    order = ["numbered", "turn", "digest"]
    cut = series.in_chunks(turns, ["conv_id"], order, lookback=0, max_rows=PIECE)
    return (
        cut.groupBy("conv_id", F.col(series.CHUNK).alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct(*order, "size"))).alias("turns"))
        .select("conv_id", "piece", F.expr("transform(turns, t -> struct(t.digest, t.size))").alias("turns"))
    )


def rebuilt(found: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Sequences whose first turns are those of the family's first conversation.

    Conversation c takes the first h turns of conversation c - c % family, h being the crc32 of c's
    decimal digits modulo `most`: all if there are fewer, none if there is no such conversation.
    Its own turns follow after its first h.
    """
    found = written(found, "sequences")
    base = F.expr(f"conv_id - conv_id % {family}")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = found.where((F.col("piece") == 0) & (F.col("conv_id") == base)).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head")
    )
    # A conversation that takes turns has at most `most - 1` of them replaced, all in its first piece.
    first = (
        found.where("piece = 0").withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
        .withColumn("own", F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
        .withColumn("head", F.slice("head", F.lit(1), F.col("h")))
        .select("conv_id", "piece", F.concat(F.coalesce("head", F.expr("slice(turns, 1, 0)")), "own").alias("turns"))
    )
    return first.unionByName(found.where("piece > 0"))


# ---- identities of prefixes


def _extended(state: int, digests: list[bytes]) -> list[int]:
    out = []
    for d in digests:
        state = (state * BASE + int.from_bytes(d, "big") % (PRIME - 1) + 1) % PRIME
        out.append(state)
    return out


def _as_id(state: int) -> bytes:
    return state.to_bytes(16, "big")


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, piece, turns) to what each piece adds to the state, how many turns and bytes."""
    for rows in batches:
        turns = rows.column("turns")
        digests = turns.flatten().field("digest").to_pylist()
        sizes = turns.flatten().field("size").to_pylist()
        added, counts, bytes_, at = [], [], [], 0
        for n in turns.value_lengths().to_pylist():
            part = digests[at : at + n]
            added.append(_as_id(_extended(0, part)[-1] if part else 0))
            counts.append(n)
            bytes_.append(sum(sizes[at : at + n]))
            at += n
        yield pa.RecordBatch.from_arrays(
            [rows.column("conv_id"), rows.column("piece"), pa.array(added, pa.binary()),
             pa.array(counts, pa.int64()), pa.array(bytes_, pa.int64())],
            names=["conv_id", "piece", "added", "n", "bytes"],
        )


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals sorted by (conv_id, piece) to the state before each piece; holds one state."""
    conv, state, depth = None, 0, 0
    for rows in batches:
        ids, depths = [], []
        for c, added, n in zip(*(rows.column(k).to_pylist() for k in ("conv_id", "added", "n"))):
            if c != conv:
                conv, state, depth = c, 0, 0
            ids.append(_as_id(state))
            depths.append(depth)
            state = (state * pow(BASE, n, PRIME) + int.from_bytes(added, "big")) % PRIME
            depth += n
        yield pa.RecordBatch.from_arrays(
            [rows.column("conv_id"), rows.column("piece"), pa.array(ids, pa.binary()), pa.array(depths, pa.int64())],
            names=["conv_id", "piece", "start_id", "start"],
        )


def _identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, start, start_id, tail, last, turns) to the identity of every prefix of the piece, and
    the bytes of the conversation's turns from there on."""
    for rows in batches:
        turns = rows.column("turns")
        digests = turns.flatten().field("digest").to_pylist()
        lengths = turns.value_lengths().to_pylist()
        sizes = turns.flatten().field("size").to_pylist()
        ids, lefts, ends = [], [], [0]
        starts, tails = rows.column("start_id").to_pylist(), rows.column("tail").to_pylist()
        for start, tail, n in zip(starts, tails, lengths):
            at = ends[-1]
            ends.append(at + n)
            ids.extend(map(_as_id, _extended(int.from_bytes(start, "big"), digests[at : at + n])))
            lefts.extend([*accumulate(reversed(sizes[at : at + n]), initial=tail)][:0:-1])
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(k) for k in ("conv_id", "start", "start_id", "tail", "last")),
             pa.ListArray.from_arrays(ends, pa.array(ids, pa.binary())),
             pa.ListArray.from_arrays(ends, pa.array(sizes, pa.int64())),
             pa.ListArray.from_arrays(ends, pa.array(lefts, pa.int64()))],
            names=[c.split()[0] for c in PATH.split(", ")],
        )


def paths(found: DataFrame) -> DataFrame:
    """Every piece with the identities of its prefixes, written.

    `start` and `start_id` are depth and identity of the prefix before it, `tail` the bytes of the
    conversation behind it, `last` whether the conversation ends with it.
    """
    spark = found.sparkSession
    prepare(spark)
    found = written(found, "pieces")
    long = found.where("piece > 0").select("conv_id").distinct()
    states = found.select("conv_id", "piece").where("false").selectExpr(
        "*", "CAST(NULL AS BINARY) AS start_id", "0L AS start", "0L AS tail", "true AS last"
    )
    if not long.isEmpty():
        # A row per PIECE turns of the long conversations from here on.
        totals = written(
            found.join(long, "conv_id", "left_semi").mapInArrow(
                _totals, "conv_id long, piece long, added binary, n long, bytes long"
            ),
            "totals",
        )
        later = Window.partitionBy("conv_id").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
        before = (
            totals.repartition(shuffle_partitions(spark), "conv_id")
            .sortWithinPartitions("conv_id", "piece")
            .mapInArrow(_states, "conv_id long, piece long, start_id binary, start long")
        )
        behind = totals.select(
            "conv_id",
            "piece",
            F.coalesce(F.sum("bytes").over(later), F.lit(0)).alias("tail"),
            F.max("piece").over(later).isNull().alias("last"),
        )
        states = written(before.join(behind, ["conv_id", "piece"]), "states")
    placed = found.join(states, ["conv_id", "piece"], "left").select(
        "conv_id",
        F.coalesce("start", F.lit(0)).cast("long").alias("start"),
        F.coalesce("start_id", F.lit(ROOT)).alias("start_id"),
        F.coalesce("tail", F.lit(0)).cast("long").alias("tail"),
        F.coalesce("last", F.lit(True)).alias("last"),
        "turns",
    )
    return written(placed.mapInArrow(_identified, PATH), "paths")


# ---- z-fast tries


def two_fattest(low: int, high: int) -> int:
    """Of the numbers from low, exclusive, to high the one that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """A compacted node: depths from `low`, exclusive, to `high` of its members' common path."""

    __slots__ = ("low", "high", "ids", "sizes", "parent", "n", "first", "after")

    def __init__(self, low, high, ids, sizes, parent):
        self.low, self.high, self.ids, self.sizes, self.parent = low, high, ids, sizes, parent
        #: Members that end here while the trie grows, all members once it is summed; the smallest
        #: one; bytes of the members' turns behind `high`.
        self.n, self.first, self.after = 0, None, 0


class ZFastTrie:
    """Paths below one prefix; a path is the list of identities by depth, at 0 that of the prefix."""

    def __init__(self, start_id: bytes):
        self.root = Node(0, 0, [start_id], [0], None)
        self.handles: dict[bytes, Node] = {}
        #: Nodes by the first identity of their edge.
        self.edges: dict[bytes, Node] = {}
        self.nodes = [self.root]

    def locate(self, ids: list[bytes], at: Node | None = None) -> Node:
        """The deepest node whose path is a prefix of `ids`, searched below `at`."""
        at = at or self.root
        low, high = at.high, len(ids) - 1
        while low < high:
            f = two_fattest(low, high)
            node = self.handles.get(ids[f])
            if node is None:
                high = f - 1
            elif node.high <= len(ids) - 1 and node.ids[node.high] == ids[node.high]:
                at, low = node, node.high
            else:
                return node.parent  # the path leaves the trie on this node's edge
        return at

    def _add(self, node: Node) -> Node:
        self.nodes.append(node)
        self.edges[node.ids[node.low + 1]] = node
        self.handles[node.ids[two_fattest(node.low, node.high)]] = node
        return node

    def insert(self, ids: list[bytes], sizes: list[int], near: Node) -> Node:
        """The node at which the path ends, made if it is not there; `near` is above it."""
        at = self.locate(ids, near)
        deep = len(ids) - 1
        if at.high == deep:
            return at
        edge = self.edges.get(ids[at.high + 1])
        if edge is None:
            return self._add(Node(at.high, deep, ids, sizes, at))
        same, differs = at.high + 1, min(edge.high, deep) + 1
        while differs - same > 1:
            middle = (same + differs) // 2
            if edge.ids[middle] == ids[middle]:
                same = middle
            else:
                differs = middle
        del self.handles[edge.ids[two_fattest(edge.low, edge.high)]]
        upper = self._add(Node(at.high, same, edge.ids, edge.sizes, at))
        edge.low, edge.parent = same, upper
        self.edges[edge.ids[same + 1]] = edge
        self.handles[edge.ids[two_fattest(same, edge.high)]] = edge
        if same == deep:
            return upper
        return self._add(Node(same, deep, ids, sizes, upper))

    def insert_batch(self, batch: list[tuple[int, list[bytes], list[int], int]]) -> None:
        """Paths as (member, identities, sizes, bytes behind the path)."""
        located = [self.locate(ids) for _, ids, _, _ in batch]
        for (member, ids, sizes, tail), near in zip(batch, located):
            end = self.insert(ids, sizes, near)
            end.n += 1
            end.first = member if end.first is None else min(end.first, member)
            end.after += tail

    def expanded(self) -> Iterator[tuple]:
        """A row per depth of every edge: identity, the one above, depth, size, smallest member,
        members, and the bytes of all members' turns from this depth on."""
        # A node is deeper than its parent.
        for node in sorted(self.nodes, key=lambda n: -n.high):
            above = node.parent
            behind = node.after
            for d in range(node.high, node.low, -1):
                behind += node.n * node.sizes[d]
                yield node.ids[d], node.ids[d - 1], d, node.sizes[d], node.first, node.n, behind
            if above is not None:
                above.n += node.n
                above.first = node.first if above.first is None else min(above.first, node.first)
                above.after += behind
        yield self.root.ids[0], None, 0, 0, self.root.first, self.root.n, self.root.after


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tries: dict[tuple[int, bytes], ZFastTrie] = {}
    held = 0
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 5]
    names = [c.split()[0] for c in NODE.split(", ")]

    def rows() -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (start, _), trie in tries.items():
            for id_, parent, depth, *rest in trie.expanded():
                if depth or not start:  # the prefix before a piece is a node of the piece before it
                    out.append((id_, parent, start + depth, *rest))
                if len(out) >= 50_000:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for part in batches:
        for start in range(0, part.num_rows, 256):
            found = part.slice(start, 256).to_pylist()
            found.sort(key=lambda r: (r["start"], r["start_id"]))
            for key, group in groupby(found, lambda r: (r["start"], r["start_id"])):
                trie = tries.get(key) or tries.setdefault(key, ZFastTrie(key[1]))
                members = []
                for r in group:
                    members.append((r["conv_id"], [key[1], *r["ids"]], [0, *r["sizes"]], r["tail"]))
                    held += len(r["ids"]) + 1
                trie.insert_batch(members)
            if held >= HELD_TURNS:
                yield from rows()
                tries.clear()
                held = 0
    yield from rows()


# ---- results


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, conv_id) in order to texts of at most TEXT_IDS ids, joined by commas."""
    node, held = None, []

    def batch(rows):
        columns = zip(*rows)
        types = [pa.binary(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["id", "first", "members"]
        )

    for part in batches:
        out = []
        for id_, conv in zip(part.column("id").to_pylist(), part.column("conv_id").to_pylist()):
            if held and (id_ != node or len(held) >= TEXT_IDS):
                out.append((node, held[0], ",".join(map(str, held))))
                held = []
            node = id_
            held.append(conv)
        if out:
            yield batch(out)
    if held:
        yield batch([(node, held[0], ",".join(map(str, held)))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, members) in order to the SHA-256 of each id's texts; holds one state."""
    node, state = None, None
    for part in batches:
        ids, digests = [], []
        for id_, members in zip(part.column("id").to_pylist(), part.column("members").to_pylist()):
            if id_ == node:
                state.update(b"," + members.encode())
                continue
            if state is not None:
                ids.append(node)
                digests.append(state.hexdigest())
            node, state = id_, hashlib.sha256(members.encode())
        yield _digests(ids, digests)
    if state is not None:
        yield _digests([node], [state.hexdigest()])


def _digests(ids: list[bytes], digests: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.binary()), pa.array(digests, pa.string())], names=["id", "ends_sha256"]
    )


def ends(found: DataFrame) -> DataFrame:
    """id, ends_sha256: the hash of the sorted members that end at a node.

    Members are sorted by ranges of (node, member), which cut a node with many members into several
    texts; a hash is a single chain, so one task then reads a node's texts, `TEXT_IDS` ids in each.
    """
    parts = shuffle_partitions(found.sparkSession)
    at = F.when(F.size("ids") > 0, F.element_at("ids", F.greatest(F.size("ids"), F.lit(1)))).otherwise(F.col("start_id"))
    members = found.where("last").select(at.alias("id"), "conv_id")
    texts = (
        members.repartitionByRange(parts, "id", "conv_id")
        .sortWithinPartitions("id", "conv_id")
        .mapInArrow(_ends, "id binary, first long, members string")
    )
    return (
        texts.repartition(parts, "id")
        .sortWithinPartitions("id", "first")
        .mapInArrow(_hashed, "id binary, ends_sha256 string")
    )


def trie(found: DataFrame) -> DataFrame:
    """A row per distinct prefix of the sequences (conv_id, piece, turns).

    Columns: id and parent_id (16 bytes each; the root's parent is null), depth, size (bytes of the
    last turn's text), conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  A sequence without turns is a member of the root and ends there.  An
    empty table gives no rows, not even a root.  `sequences` defines ties, repeated rows and missing
    cells.
    """
    held = paths(found)
    nodes = written(
        held.mapInArrow(_tries, NODE)
        .groupBy("id", "parent_id", "depth", "size")
        .agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("gross").alias("gross")),
        "nodes",
    )
    children = nodes.where("depth > 0").groupBy(F.col("parent_id").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = written(
        nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes"
    )
    owned = nodes.groupBy("conv_id").agg(
        F.sum("size").alias("owned"), F.max(F.expr("CAST(n_children = 0 AS LONG)")).alias("leaf")
    )
    # A path has `left` bytes from a depth on; those at its end are its own.
    steps = F.expr(
        "concat(if(start = 0, array(struct(start_id AS id, coalesce(get(lefts, 0), 0L) AS left)), array()), "
        "transform(ids, (id, k) -> struct(id, get(lefts, k) AS left)))"
    )
    below = (
        held.join(owned, "conv_id")
        .select("owned", "leaf", F.explode(steps).alias("step"))
        .groupBy("step.id")
        .agg(F.sum(F.least("step.left", "owned")).alias("distinct_bytes"), F.sum("leaf").alias("n_leaves"))
    )
    tops = nodes.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(below, "id")
        .join(ends(held), "id", "left")
        .join(tops, "parent_id", "left")
        .select(
            "id",
            "parent_id",
            "depth",
            "size",
            "conv_id",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("gross") - F.col("distinct_bytes")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
