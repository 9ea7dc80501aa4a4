"""Secrets in texts: fixed patterns, and a linear-chain conditional random field for the rest.

The field tags tokens as begin, inside or outside of a secret.  A token's features are its shape
with its length, the shapes of its neighbours, whether a credential word or an assignment stands
shortly before it, and how much of the file looks like code.  It is trained by maximum likelihood
on windows of sampled documents in which the patterns mark the secrets, and on variants of these
windows with other credential words and other alphabets, which the patterns do not know.

Decoding is exact but skips: the weights of ordinary tokens (words, punctuation) are bounded so
that outside is their best tag whatever their neighbours are.  Viterbi then runs only over windows
around the other tokens, as an ordinary token in between separates the chain.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, quoted

#: Documents that give training windows (about), and the most windows used.
FIT_DOCUMENTS, FIT_WINDOWS = 3_000, 6_000
ROUNDS, PENALTY, RATE = 120, 0.02, 0.3
#: Characters of context around a token that is not ordinary, and the shortest span added.
CONTEXT, SHORTEST = 60, 8
OUTSIDE, BEGIN, INSIDE = range(3)

# The patterns, by kind in their order; a match must have this many characters.
KINDS = ("assign", "access", "hex", "tagged")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
SHORTEST_VALUE, SHORTEST_ACCESS = 12, 18

TOKEN = re.compile(r"[\w+/\-]+|[^\w\s+/\-]")
CREDENTIAL = r"passw|passwd|pwd|secret|token|api[_-]?key|bearer|credential|private_?key|client_?secret|auth_"
#: Finds every token that is not ordinary.
UNUSUAL = re.compile(rf"\d|[A-Z]{{4}}|[A-Za-z+/_]{{20}}|(?i:{CREDENTIAL})", re.ASCII)
CREDENTIAL_WORD = re.compile(CREDENTIAL, re.IGNORECASE | re.ASCII)
ORDINARY = ("word", "punct", "assign", "quote")
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = (UPPER + DIGITS, DIGITS + "abcdefABCDEF", UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "_-+/")
OTHER_WORDS = ("pwd", "auth_token", "client_secret", "private_key", "Bearer", "credential", "API-Key")


CAPITALS = re.compile(r"[A-Z]{4}")


def names_credential(low: str) -> bool:
    return any(w in low for w in ("pass", "pwd", "secret", "token", "api", "bearer", "credential", "private", "auth_"))


def maybe_unusual(text: str) -> bool:
    """Cheap and never wrong when it says no: most texts hold nothing that UNUSUAL finds."""
    return (
        any(d in text for d in DIGITS)
        or names_credential(text.lower())
        or CAPITALS.search(text) is not None
        or max(map(len, text.split()), default=0) >= 20
    )


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the pattern matches, by start and kind."""
    out = []
    if names_credential(text.lower()):
        out += [
            (m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= SHORTEST_VALUE
        ]
    out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= SHORTEST_ACCESS]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def shape(token: str) -> str:
    if len(token) == 1 and not token.isalnum():
        return "assign" if token in "=:" else "quote" if token in "\"'`" else "punct"
    if CREDENTIAL_WORD.search(token):
        return "credential"
    letters = token.replace("-", "").replace("_", "").replace("/", "").replace("+", "")
    if not UNUSUAL.search(token):
        return "word"
    size = bisect.bisect((8, 12, 16, 24, 40), len(token))
    if letters.isdigit():
        kind = "digits"
    elif re.fullmatch(r"[0-9a-f]+", token):
        kind = "hex"
    elif re.fullmatch(r"[0-9A-Z]+", token):
        kind = "capitals" if letters.isalpha() else "capitals_digits"
    elif letters.isalpha():
        kind = "letters"
    elif letters != token:
        kind = "mixed_signs"
    else:
        kind = "mixed"
    return f"{kind}{size}"


class Shapes(dict):
    """Shape of a token, remembered."""

    def __missing__(self, token: str) -> str:
        found = shape(token)
        if len(self) < 200_000:
            self[token] = found
        return found


def file_feature(text: str) -> str:
    """How much of the file is made of signs that code and settings use."""
    signs = sum(map(text.count, "={}[]();\"<>"))
    return f"file{bisect.bisect((0.001, 0.01, 0.05), signs / max(1, len(text)))}"


def features(shapes: list[str], of_file: str) -> list[tuple[str, ...]]:
    out = []
    since_word, since_sign = 9, 9
    for k, s in enumerate(shapes):
        before = shapes[k - 1] if k else "edge"
        after = shapes[k + 1] if k + 1 < len(shapes) else "edge"
        named, given = since_word <= 4, since_sign <= 2
        own = [f"0{s}", f"-{before}", f"+{after}", of_file]
        if named:
            own += [f"named {s}"]
        if named and given:
            own += [f"given {s}", "given"]
        out.append(tuple(own))
        since_word = 1 if s == "credential" else since_word + 1
        since_sign = 1 if s == "assign" else since_sign + (s != "quote")
    return out


@dataclass
class Field:
    """Weights of each feature and of each move for the three tags."""

    weights: dict[str, tuple[float, float, float]]
    moves: tuple[tuple[float, float, float], ...]

    def emission(self, own: tuple[str, ...]) -> tuple[float, float, float]:
        o = b = i = 0.0
        for f in own:
            w = self.weights.get(f)
            if w:
                o, b, i = o + w[0], b + w[1], i + w[2]
        return o, b, i

    def decode(self, rows: list[tuple[str, ...]]) -> list[int]:
        """The best tags, by Viterbi."""
        if not rows:
            return []
        moves, back = self.moves, []
        best = list(self.emission(rows[0]))
        for own in rows[1:]:
            e = self.emission(own)
            step, now = [], []
            for tag in range(3):
                came = max(range(3), key=lambda p: best[p] + moves[p][tag])
                step.append(came)
                now.append(best[came] + moves[came][tag] + e[tag])
            back.append(step)
            best = now
        tags = [max(range(3), key=best.__getitem__)]
        for step in reversed(back):
            tags.append(step[tags[-1]])
        return tags[::-1]

    def bounded(self) -> Field:
        """The same field in which outside is the best tag of an ordinary token.

        That holds if outside leads by more than any neighbours, file and moves can take back.
        Tokens that follow a credential word are not ordinary.
        """
        flat = [w for row in self.moves for w in row]
        slack = 2 * (max(flat) - min(flat))
        for prefix in "-+":
            slack += max([0.0, *(max(w[1], w[2]) - w[0] for f, w in self.weights.items() if f.startswith(prefix))])
        slack += max([0.0, *(max(w[1], w[2]) - w[0] for f, w in self.weights.items() if f.startswith("file"))])
        weights = dict(self.weights)
        for s in ORDINARY:
            o, b, i = weights.get(f"0{s}", (0.0, 0.0, 0.0))
            lead = max(o, max(b, i) + slack + 0.1)
            weights[f"0{s}"] = (lead, b, i)
            # What was added for ordinary tokens does not count behind a credential word.
            n = weights.get(f"named {s}", (0.0, 0.0, 0.0))
            weights[f"named {s}"] = (n[0] - (lead - o), n[1], n[2])
        return Field(weights, self.moves)


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches between white space that hold every token that is not ordinary, with context."""
    out: list[tuple[int, int]] = []
    if not maybe_unusual(text):
        return out
    reached = -1
    for m in UNUSUAL.finditer(text):
        at = m.start()
        if at < reached:
            continue
        low, high = max(0, at - CONTEXT), min(len(text), m.end() + CONTEXT)
        while low > 0 and not text[low - 1].isspace():
            low -= 1
        while high < len(text) and not text[high].isspace():
            high += 1
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
        # Tokens up to here have their context; a later one extends the stretch.
        reached = high - CONTEXT
    return out


def tagged_spans(text: str, model: Field, shapes: Shapes) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    stretches = windows(text)
    if not stretches:
        return spans
    of_file = file_feature(text)
    for low, high in stretches:
        tokens = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(text, low, high)]
        tags = model.decode(features([shapes[t[2]] for t in tokens], of_file))
        open_ = None
        for (start, end, _), tag in zip(tokens, tags):
            if tag == OUTSIDE or tag == BEGIN and open_:
                if open_:
                    spans.append(open_)
                open_ = None
            if tag != OUTSIDE:
                open_ = (open_[0] if open_ else start, end)
        if open_:
            spans.append(open_)
    return spans


def all_spans(text: str, model: Field, shapes: Shapes) -> tuple[list, list[tuple[int, int, int]]]:
    """The base spans, and (start, kind, end) of all.

    A span of the field is added whole if letters or digits of it stand outside the base spans, so
    of a secret that a pattern knows only in part nothing stays; base spans are as they were.
    """
    base = base_spans(text)
    taken: list[list[int]] = []
    for start, end in sorted((s, e) for s, _, e, _ in base):
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    ends = [e for _, e in taken]
    out = [(s, k, e) for s, k, e, _ in base]
    for start, end in tagged_spans(text, model, shapes):
        if end - start < SHORTEST:
            continue
        at, rest = start, ""
        for s, e in taken[bisect.bisect_right(ends, start) :]:
            if s >= end:
                break
            rest += text[at : max(at, s)]
            at = max(at, e)
        if any(map(str.isalnum, rest + text[at:end])):
            out.append((start, KINDS.index("tagged"), end))
    return base, sorted(out)


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# Training


def _variant(text: str, low: int, high: int, values: list[tuple[int, int]], rng: random.Random):
    """The stretch with other credential words and values of another alphabet."""
    alphabet = rng.choice(ALPHABETS)
    out, spans, at = "", [], low
    for start, end in [*values, (high, high)]:
        between = text[at:start]
        if start != high or values:
            between = CREDENTIAL_WORD.sub(lambda m: rng.choice(OTHER_WORDS) if rng.random() < 0.5 else m.group(), between)
        out += between
        if start < high:
            value = "".join(rng.choice(alphabet) for _ in range(rng.randint(16, 40)))
            spans.append((len(out), len(out) + len(value)))
            out += value
        at = end
    return out, spans


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature rows and tags of the windows of sampled documents, as text."""
    shapes = Shapes()

    def coded(text: str, low: int, high: int, values: list[tuple[int, int]], of_file: str) -> str:
        tokens = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(text, low, high)]
        rows = features([shapes[t[2]] for t in tokens], of_file)
        tags, before = [], None
        for start, end, _ in tokens:
            inside = next((v for v in values if v[0] <= start and end <= v[1]), None)
            tags.append("O" if inside is None else "I" if inside == before else "B")
            before = inside
        return "\n".join("\t".join([t, *r]) for t, r in zip(tags, rows))

    for batch in batches:
        order, secret, example = [], [], []
        for text in batch.column(0).to_pylist():
            text = text or ""
            base = base_spans(text)
            of_file = file_feature(text)
            for low, high in windows(text):
                values = sorted((v, e) for _, _, e, v in base if low <= v and e <= high)
                # A value within another one is the same secret.
                values = [v for k, v in enumerate(values) if not any(o[0] <= v[0] and v[1] <= o[1] for o in values[:k])]
                mark = xxhash.xxh64_intdigest(text[low:high])
                made = [coded(text, low, high, values, of_file)]
                if values:
                    rng = random.Random(mark)
                    other, spans = _variant(text, low, high, values, rng)
                    made.append(coded(other, 0, len(other), spans, of_file))
                for one in made:
                    order.append(mark >> 1)
                    secret.append(bool(values))
                    example.append(one)
        arrays = [pa.array(order, pa.int64()), pa.array(secret, pa.bool_()), pa.array(example, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["mark", "secret", "example"])


def train(examples: list[str]) -> Field:
    """Maximum likelihood with a ridge penalty, by full-batch adaptive gradient steps.

    Equal examples are counted instead of repeated; long ones are cut into runs of 60 tokens.
    """
    counted: dict[tuple, int] = {}
    for example in examples:
        rows = [tuple(line.split("\t")) for line in example.split("\n") if line]
        for k in range(0, len(rows), 60):
            key = tuple(rows[k : k + 60])
            counted[key] = counted.get(key, 0) + 1
    names = sorted({f for rows in counted for r in rows for f in r[1:]})
    if not names:
        return Field({}, ((0.0,) * 3,) * 3)
    index = {f: k for k, f in enumerate(names)}
    chains = sorted(counted, key=lambda rows: (len(rows), rows))
    n, length, slots = len(chains), max(map(len, chains)), max(len(r) - 1 for rows in chains for r in rows)
    slot = np.full((n, length, slots), len(names))
    tag = np.zeros((n, length), int)
    mask = np.zeros((n, length), bool)
    for a, rows in enumerate(chains):
        for b, (t, *own) in enumerate(rows):
            slot[a, b, : len(own)] = [index[f] for f in own]
            tag[a, b] = "OBI".index(t)
            mask[a, b] = True
    weight = np.array([counted[rows] for rows in chains], float)
    weight /= weight.sum()
    gold = np.zeros((n, length, 3))
    gold[np.arange(n)[:, None], np.arange(length)[None, :], tag] = 1
    gold *= mask[..., None]
    pair_mask = mask[:, 1:]
    gold_moves = np.einsum("n,nti,ntj->ij", weight, gold[:, :-1], gold[:, 1:])
    w, moves = np.zeros((len(names) + 1, 3)), np.zeros((3, 3))
    seen_w, seen_m = np.full_like(w, 1e-8), np.full_like(moves, 1e-8)
    flat = slot.ravel()

    def logsum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(ROUNDS):
        e = w[slot].sum(axis=2) * mask[..., None]
        forward = np.zeros((n, length, 3))
        backward = np.zeros((n, length, 3))
        forward[:, 0] = e[:, 0]
        for t in range(1, length):
            go = logsum(forward[:, t - 1, :, None] + moves, 1) + e[:, t]
            forward[:, t] = np.where(mask[:, t, None], go, forward[:, t - 1])
        for t in range(length - 2, -1, -1):
            go = logsum(moves + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(pair_mask[:, t, None], go, backward[:, t + 1])
        total = logsum(forward[:, -1], 1)
        one = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        two = np.exp(
            forward[:, :-1, :, None] + moves + (e[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        two *= pair_mask[..., None, None]
        gap = (gold - one) * weight[:, None, None]
        gradient = np.empty_like(w)
        for k in range(3):
            gradient[:, k] = np.bincount(flat, np.repeat(gap[..., k].ravel(), slots), len(names) + 1)
        gradient -= PENALTY * w / n
        move_gradient = gold_moves - np.einsum("n,ntij->ij", weight, two) - PENALTY * moves / n
        gradient[-1] = 0
        seen_w += gradient**2
        seen_m += move_gradient**2
        w += RATE * gradient / np.sqrt(seen_w)
        moves += RATE * move_gradient / np.sqrt(seen_m)
    rounded = np.round(w, 9)
    return Field(
        {f: tuple(rounded[k].tolist()) for f, k in index.items()}, tuple(map(tuple, np.round(moves, 9).tolist()))
    ).bounded()


def fit(df: DataFrame, text_col: str = "text", documents: int = FIT_DOCUMENTS, most: int = FIT_WINDOWS) -> Field:
    """Train the field on windows of about `documents` documents, chosen by a hash of the text.

    At most `most` windows are used, those with a secret first.  Without any the field adds nothing.
    """
    prepare(df.sparkSession)
    texts = df.select(quoted(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    share = min(1.0, documents / max(1, df.count()))
    if share < 1:
        texts = texts.where(F.expr(f"pmod(xxhash64(text), 1000000) < {max(1, round(share * 1e6))}"))
    found = (
        texts.distinct()
        .mapInArrow(_examples, "mark long, secret boolean, example string")
        .orderBy(F.desc("secret"), "mark", "example")
        .limit(most)
        .collect()
    )
    return train([r["example"] for r in found])


def _found(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for text in batch.column(1).to_pylist():
                base, every = all_spans(text or "", model, shapes)
                for kind in range(3):
                    counts[kind].append(sum(k == kind for _, k, _, _ in base))
                digests.append(hashlib.sha256(listed((s, k, e) for s, k, e, _ in base).encode()).hexdigest())
                spans.append(listed(every))
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def find(df: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: id, n_assign, n_access, n_hex, base_sha256, spans.

    Positions are code points, ends exclusive.  A missing text counts as empty.  Ids are only
    carried along; repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    prepare(df.sparkSession)
    docs = df.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.mapInArrow(_found(model), schema).withColumnRenamed("id", id_col)


def redacted(text: Column, model: Field, instead: str = "[SECRET]") -> Column:
    """Each text with every span replaced; overlapping spans are replaced once.  Missing stays missing."""

    def replaced(value: str, shapes: Shapes) -> str:
        out, at = [], 0
        for start, _, end in all_spans(value, model, shapes)[1]:
            if end > at:
                if start >= at:
                    out += [value[at:start], instead]
                at = end
        return "".join(out) + value[at:]

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shapes = Shapes()
        for texts in batches:
            yield texts.map(lambda t: replaced(t, shapes) if isinstance(t, str) else None)

    return run(text.cast("string"))
