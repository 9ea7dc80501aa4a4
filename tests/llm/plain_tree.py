"""A suffix tree in the driver's memory, to look into small models."""

import math
from dataclasses import dataclass

import numpy as np

from demandloom.llm import suffix_tree as S


@dataclass
class Vocabulary:
    """Tokens that workers hold, by hash; ids go by falling count."""

    tokens: np.ndarray  # sorted
    ids: np.ndarray
    counts: np.ndarray  # by id
    total: int
    distinct: int

    @property
    def contexts(self) -> int:
        return len(self.counts)

    @property
    def symbols(self) -> int:
        return len(self.counts)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """Ids of tokens; -1 for those not held."""
        if not len(self.tokens):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.ids[at], -1)


@dataclass
class Tree:
    """Retained contexts as states 1, 2, ..., the root being state 0, and their distributions."""

    vocabulary: Vocabulary
    keys: np.ndarray  # of the states, sorted; ids as digits to the base contexts + 1, the newest last
    states: np.ndarray
    parent: np.ndarray  # by state: longest retained proper suffix
    spread: np.ndarray  # by state: log10 of the share that goes by the parent
    entries: np.ndarray  # state * symbols + symbol, sorted
    log: np.ndarray  # log10 probability of each entry
    root: np.ndarray  # log10 probability of each held token
    norm: float


def grow(vocabulary: Vocabulary, rows: list[tuple[int, int, int, int, int]]) -> Tree:
    """The tree from retained rows of context, depth, total, symbol, n."""
    norm = vocabulary.total + vocabulary.distinct + 1
    root = np.log10((vocabulary.counts + 1) / norm)
    base = vocabulary.contexts + 1
    of: dict[int, tuple[int, int, list[tuple[int, int]]]] = {}
    for context, depth, total, symbol, n in rows:
        of.setdefault(context, (depth, total, []))[2].append((symbol, n))
    order = sorted(of, key=lambda c: (of[c][0], c))
    number = {c: k + 1 for k, c in enumerate(order)}
    parent, spread = np.zeros(len(order) + 1, int), np.zeros(len(order) + 1)
    probability: list[dict[int, float]] = [{}]
    share = [1.0]
    entries, log = [], []
    for c in order:
        depth, total, symbols = of[c]
        state = number[c]
        for d in range(depth - 1, 0, -1):
            if c % base**d in number:
                parent[state] = number[c % base**d]
                break
        rest = 1 - sum(n - S.DISCOUNT for _, n in symbols) / total
        spread[state] = math.log10(rest)
        share.append(rest)
        own: dict[int, float] = {}
        for symbol, n in sorted(symbols):
            below, factor = int(parent[state]), 1.0
            while below and symbol not in probability[below]:
                factor *= share[below]
                below = int(parent[below])
            at_parent = factor * (probability[below][symbol] if below else 10.0 ** root[symbol])
            own[symbol] = (n - S.DISCOUNT) / total + rest * at_parent
            entries.append(state * vocabulary.symbols + symbol)
            log.append(math.log10(own[symbol]))
        probability.append(own)
    keys = np.array(sorted(number), np.int64)
    return Tree(
        vocabulary, keys, np.array([number[c] for c in keys.tolist()], int), parent, spread,
        np.array(entries, np.int64), np.array(log), root, float(norm),
    )


def vocabulary_of(model) -> Vocabulary:
    held = model.held_counts.sort_values(["n", "token"], ascending=[False, True])
    tokens = held["token"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return Vocabulary(tokens[order], order.astype(np.int64), held["n"].to_numpy(np.int64), model.total, model.distinct)


def tree_of(model) -> Tree:
    """The retained contexts and kept entries of held tokens; scoring uses the tables."""
    v = vocabulary_of(model)
    base = v.contexts + 1
    key = {int(t): int(k) + 1 for t, k in zip(v.tokens, v.ids)}
    id_of = {t: k - 1 for t, k in key.items()}
    oldest = {t: t for t in key}
    out = []
    for depth, rows in enumerate(model.levels, 1):
        for r in rows.toPandas().itertuples(index=False):
            if r.context not in key or r.symbol not in id_of:
                continue
            if r.kept and r.rest == r.rest:
                out.append((key[r.context], depth, r.total, id_of[r.symbol], r.n))
            if r.shorter in key:
                oldest[r.run] = oldest[r.context]
                key[r.run] = key[r.shorter] + (id_of[oldest[r.run]] + 1) * base**depth
    return grow(v, out)
