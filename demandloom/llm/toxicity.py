"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer rewrites words as tags: insult, threat, target, negation, report, break, or
nothing.  Its entries are words and word beginnings; the weights of insults and threats are log-odds
learned from labelled texts, with a few entries given for when there are none.  Three small
transducers read the tags: one remembers a negation for some words, one a verb of reported speech
or an open quotation until the clause ends, one a target until the clause ends.  Their composition
is one machine whose state says how much a match counts and of which kind it is.  A text is scored
by its matched clauses: the sums per kind, the strongest clause, and the share of words matched go
into a logistic function fitted on the same labelled texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, quoted, written

#: Different labelled texts the grammar is fitted on, at most (about; chosen by a hash of the text).
FIT_ROWS = 12_000
#: An entry must hold in this share of the toxic texts, and the log-odds of finding it there must be
#: this high even one standard error lower.  A beginning has one of these numbers of characters, and
#: stands for several words: it holds in this many times the texts of any one of them.
SUPPORT, LOG_ODDS, BEGINNINGS, PRODUCTIVE = 0.005, 2.5, (4, 5, 6), 1.3
#: Weight of a given entry that the labels do not speak of.
GIVEN_WEIGHT = 2.0
REMEMBERED = 300_000

# Words of the four languages by tag.
GIVEN = {
    "insult": "idiot moron stupid imbecile scum loser idiote imbécile crétin trottel dummkopf abschaum estúpido imbécil",
    "threat": "kill murder strangle stab tuer étrangler umbringen erwürgen matar estrangular",
    "target": "you your yours yourself tu toi vous votre du dich dir euch tú usted ustedes vosotros",
    "negation": "not no never neither nor isn't aren't don't ne pas jamais nicht kein keine nie nunca jamás",
    "report": "said says wrote called quoted claimed reported dit écrit appelé sagte schrieb nannte dijo escribió llamó",
}
NOTHING, BREAK = ("", 0.0), "break"
LEET = str.maketrans("013457@$", "oieastas")


def bare(word: str) -> str:
    """The word in lower case without what surrounds its letters."""
    return word.strip("\"'`“”„«»().,;:!?¡¿[]{}<>#*$%&|_-~=+/\\…").lower()


def entries_of(word: str) -> Iterator[str]:
    """What the lexicon may hold of a word: itself, and its beginnings, marked by a star."""
    yield word
    for n in BEGINNINGS:
        if len(word) >= n:
            yield word[:n] + "*"


class Lexicon(dict):
    """Word as written -> (tag, weight, whether it ends a clause, whether it holds a quotation mark)."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.given = {w: tag for tag, words in GIVEN.items() for w in words.split()}
        self.learned = learned

    def __missing__(self, written_: str):
        word = bare(written_)
        found = self._tag(word)
        if not found[0] and any(c in "013457@$" for c in word):
            found = self._tag(word.translate(LEET))
        out = (*found, written_[-1:] in ".!?;" or written_.endswith((".\"", ".”", ":")), written_[:1] in "\"“„«")
        if len(self) >= REMEMBERED:
            self.clear()
        self[written_] = out
        return out

    def _tag(self, word: str) -> tuple[str, float]:
        tag = self.given.get(word, "")
        weight = max((self.learned[e] for e in entries_of(word) if e in self.learned), default=0.0)
        if tag in ("insult", "threat"):
            return tag, weight or self.learned.get("?" + word, GIVEN_WEIGHT)
        if tag:
            return tag, 0.0
        return ("insult", weight) if weight else NOTHING


@dataclass(frozen=True)
class Machine:
    """A transducer over tags: what each state becomes by a tag, and how it scales a match."""

    start: str
    step: dict[tuple[str, str], str]
    scale: dict[str, float]

    def after(self, state: str, tag: str) -> str:
        return self.step.get((state, tag), self.step.get((state, "*"), state))


NEGATION = Machine(
    "plain",
    {("plain", "negation"): "3", ("3", "*"): "2", ("2", "*"): "1", ("1", "*"): "plain"}
    | {(s, "negation"): "3" for s in "123"}
    | {(s, BREAK): "plain" for s in "123"},
    {"plain": 1.0, "1": 0.4, "2": 0.4, "3": 0.4},
)
REPORT = Machine(
    "own", {("own", "report"): "other", ("own", "quote"): "other", ("other", BREAK): "own"}, {"own": 1.0, "other": 0.6}
)
TARGET = Machine(
    "none", {("none", "target"): "aimed", ("aimed", BREAK): "none"}, {"none": 1.0, "aimed": 1.5}
)
TAGS = ("", "insult", "threat", "target", "negation", "report", "quote", BREAK)


def compose(*machines: Machine) -> tuple[int, list[dict[str, int]], list[float], list[tuple[str, ...]]]:
    """The product machine: its start, its moves, the scale and the component states of each state."""
    start = tuple(m.start for m in machines)
    states, moves = {start: 0}, []
    todo = [start]
    while todo:
        state = todo.pop(0)
        move = {}
        for tag in TAGS:
            to = tuple(m.after(s, tag) for m, s in zip(machines, state))
            if to not in states:
                states[to] = len(states)
                todo.append(to)
            move[tag] = states[to]
        moves.append(move)
    scales = [math.prod(m.scale[s] for m, s in zip(machines, state)) for state in states]
    return 0, moves, scales, list(states)


START, MOVES, SCALES, STATES = compose(NEGATION, REPORT, TARGET)
#: Which sum a match in each state belongs to.
KIND = [0 if n == "plain" and r == "own" and t == "none" else 1 if n == "plain" and r == "own" else 2 for n, r, t in STATES]
FEATURES = ("direct", "aimed", "softened", "threats", "strongest", "share")


def features(words: list[str], lexicon: Lexicon) -> list[float]:
    """Scores of the matched clauses of one text."""
    coded = list(map(lexicon.__getitem__, words))
    if not any(c[1] for c in coded):
        return [0.0] * len(FEATURES)
    sums, threats, strongest, matches = [0.0, 0.0, 0.0], 0.0, 0.0, 0
    # A target may follow its insult: matches wait for the end of their clause.
    state, waiting = START, []
    last = len(coded) - 1
    for place, (tag, weight, ends, opens) in enumerate(coded):
        if opens:
            state = MOVES[state]["quote"]
        state = MOVES[state][tag]
        if weight:
            matches += 1
            waiting.append((state, tag, weight))
        if ends or place == last:
            aimed, clause = STATES[state][2] == "aimed", 0.0
            for at, kind, w in waiting:
                scale = SCALES[at] * (TARGET.scale["aimed"] if aimed and STATES[at][2] == "none" else 1)
                sums[1 if KIND[at] == 0 and aimed else KIND[at]] += scale * w
                threats += scale * w if kind == "threat" else 0.0
                clause += scale * w
            strongest, waiting = max(strongest, clause), []
            state = MOVES[state][BREAK]
    return [*map(math.log1p, sums), math.log1p(threats), math.log1p(strongest), math.log1p(100 * matches / len(words))]


@dataclass
class Grammar:
    """Learned entries and the logistic weights: intercept first, then one per feature."""

    learned: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (-3.0, 1.0, 1.0, 0.5, 0.5, 1.0, 0.5)

    def scores(self, texts: list[str | None], lexicon: Lexicon) -> list[float]:
        out = []
        for text in texts:
            z = self.weights[0]
            if text:
                z += sum(w * f for w, f in zip(self.weights[1:], features(text.split(), lexicon)))
            out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
        return out


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text a key that its near copies mostly share, and its entries if it is toxic."""
    for batch in batches:
        family, entries = [], []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = (text or "").split()
            pairs = {a + " " + b for a, b in zip(words, words[1:])} or {text or ""}
            family.append(min(xxhash.xxh64_intdigest(p) for p in pairs) >> 1)
            own = set(filter(None, map(bare, words))) if toxic else ()
            entries.append(sorted({e for w in own for e in entries_of(w)}))
        arrays = [pa.array(family, pa.int64()), batch.column(1), batch.column(0), pa.array(entries, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["family", "toxic", "text", "entries"])


def _held(candidates: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted({e for w in {bare(w) for w in (t or "").split()} for e in entries_of(w)} & candidates)
                for t in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.string())), batch.column(1)], names=["entries", "weight"]
            )

    return run


def _features(learned: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(learned)
        for batch in batches:
            rows = [features(t.split(), lexicon) if t else [0.0] * len(FEATURES) for t in batch.column(0).to_pylist()]
            arrays = [pa.array(rows, pa.list_(pa.float64())), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, names=["features", "toxic", "weight"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the intercept is not penalised."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(x.shape[1]), np.r_[0.0, np.full(x.shape[1] - 1, penalty)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(
    labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", most: int = FIT_ROWS
) -> Grammar:
    """Learn a grammar from texts labelled 0 or 1; rows without a label or a text are left out.

    At most about `most` texts are used.  Near copies share one vote.  With no labelled text of
    either class the given entries and weights are returned.
    """
    spark = labelled.sparkSession
    prepare(spark)
    known = labelled.select(
        quoted(text_col).cast("string").alias("text"), quoted(label_col).cast("int").alias("toxic")
    ).where("text IS NOT NULL AND toxic IS NOT NULL")
    share = min(1.0, most / max(1, labelled.where(quoted(label_col).isNotNull()).count()))
    if share < 1:
        known = known.where(F.expr(f"pmod(xxhash64(text), 1000000) < {round(share * 1e6)}"))
    # A text that many rows share is one text.
    known = known.distinct()
    sample = written(
        known.mapInArrow(_families, "family long, toxic int, text string, entries array<string>"), "labelled"
    )
    sizes = sample.groupBy("family", "toxic").agg(F.count("*").alias("copies"))
    weighted = sample.join(sizes, ["family", "toxic"]).withColumn("weight", 1 / F.col("copies"))
    mass = {r["toxic"]: r["mass"] for r in weighted.groupBy("toxic").agg(F.sum("weight").alias("mass")).collect()}
    if not mass.get(0) or not mass.get(1):
        return Grammar()

    # Entries that enough toxic texts hold: at most a text's entries over SUPPORT.
    often = (
        weighted.where("toxic = 1").select(F.explode("entries").alias("entry"), "weight")
        .groupBy("entry").agg(F.sum("weight").alias("mass"))
        .where(F.col("mass") >= max(2.0, SUPPORT * mass[1])).collect()
    )
    toxic_mass = {r["entry"]: r["mass"] for r in often}
    clean = (
        weighted.where("toxic = 0").select("text", "weight")
        .mapInArrow(_held(frozenset(toxic_mass)), "entries array<string>, weight double")
        .select(F.explode("entries").alias("entry"), "weight")
        .groupBy("entry").agg(F.sum("weight").alias("mass")).collect()
    )
    clean_mass = {r["entry"]: r["mass"] for r in clean}

    def odds(entry: str) -> float:
        a, b = toxic_mass[entry] + 0.5, clean_mass.get(entry, 0.0) + 0.5
        return math.log(a / (mass[1] + 1)) - math.log(b / (mass[0] + 1))

    def error(entry: str) -> float:
        return math.sqrt(1 / (toxic_mass[entry] + 0.5) + 1 / (clean_mass.get(entry, 0.0) + 0.5))

    single: dict[str, float] = {}
    for entry, share_ in toxic_mass.items():
        if not entry.endswith("*"):
            for beginning in entries_of(entry):
                single[beginning] = max(single.get(beginning, 0.0), share_)
    weights = {e: round(odds(e), 6) for e in sorted(toxic_mass)}
    learned = {
        e: w
        for e, w in weights.items()
        if w - error(e) >= LOG_ODDS
        and (not e.endswith("*") or toxic_mass[e] >= PRODUCTIVE * single.get(e, 0.0))
    }
    learned |= {"?" + w: max(0.05, weights[w]) for tag in ("insult", "threat") for w in GIVEN[tag].split() if w in weights and w not in learned}

    seen = weighted.select("text", "toxic", "weight").mapInArrow(
        _features(learned), "features array<double>, toxic int, weight double"
    )
    # The rows in one order, so that sums do not depend on how they arrived.
    rows = np.array([[r["toxic"], r["weight"], *r["features"]] for r in seen.collect()])
    rows = rows[np.lexsort(rows.T)]
    beta = logistic(rows[:, 2:], rows[:, 0], rows[:, 1])
    return Grammar(learned, tuple(float(b) for b in beta))


def score(text: Column, grammar: Grammar) -> Column:
    """Score of each text, 0 to 1; a missing or empty text has the score of no match."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(grammar.learned)
        for texts in batches:
            yield pd.Series(grammar.scores(texts.tolist(), lexicon), dtype="float64")

    return scored(text.cast("string"))


def rate(df: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: id, score, predicted (1 from a score of one half).

    Ids are only carried along; repeated rows stay; an empty table gives no rows; other columns are
    neither read nor returned.
    """
    prepare(df.sparkSession)
    scored = df.select(quoted(id_col).alias("id"), score(quoted(text_col), grammar).alias("score"))
    return scored.select(
        F.col("id").alias(id_col), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
