"""Quality rules as a short-circuit cascade.

Every text is counted once.  The rules run one after the other and stop at the first that rejects.
Their order is estimated: on a sample all rules run on all texts, which gives each one's cost and
the share it rejects, and the rules with the most rejections per second go first.  A text is kept
if no rule rejects it, so the order changes what the job costs and never what it returns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from time import perf_counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, quoted

#: Documents on which cost and selectivity are estimated (about; they only decide the order).
SAMPLE = 2_000
SYMBOLS, SPACE = "#*$%&|<>", " \t\n\v\f\r"


class Text:
    """A text and what rules ask of it, each computed when first asked for."""

    def __init__(self, text: str):
        self.text = text
        self.words = text.encode().split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """Lines that hold a word."""
        return [line for line in self.text.split("\n") if line.strip(SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in a window of three that occurs twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        often = Counter(windows)
        total = end = 0
        for at, window in enumerate(windows):
            if often[window] > 1:
                total += at + 3 - max(at, end)
                end = at + 3
        return total

    @cached_property
    def letter_words(self) -> int:
        """Words with at least one letter; nearly all words have one in front."""
        return sum(w[:1].isalpha() or any(c.isalpha() for c in w.decode()) for w in self.words)

    @cached_property
    def top_pair_chars(self) -> int:
        """Characters in the occurrences of the pair of words that covers most."""
        pairs = Counter(zip(self.words, self.words[1:]))
        return max(((len(a.decode()) + len(b.decode())) * n for (a, b), n in pairs.items() if n > 1), default=0)

    @cached_property
    def capitals(self) -> tuple[int, int]:
        """Upper-case letters and all letters that have a case."""
        upper = sum(map(str.isupper, self.text))
        return upper, upper + sum(map(str.islower, self.text))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def base_failed(t: Text) -> bool:
    return t.n_words < 50 or 100 * t.n_repeat_words > 50 * t.n_words


RULES = (
    Rule("word_length", lambda t: not 2.5 * t.n_words <= t.word_chars <= 12 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated_lines", lambda t: 10 * t.n_dup_lines > 4 * len(t.lines)),
    Rule("words_without_letters", lambda t: 10 * t.letter_words < 7 * t.n_words),
    Rule("frequent_pair", lambda t: 10 * t.top_pair_chars > 3 * t.word_chars),
    Rule("capitals", lambda t: 10 * t.capitals[0] > 6 * t.capitals[1] > 0),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(rules: Sequence[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for k, rule in enumerate(rules):
                    t = Text(text or "")  # each rule pays for its own features
                    start = perf_counter()
                    rejected[k] += bool(rule.rejects(t))
                    seconds[k] += perf_counter() - start
        yield pa.RecordBatch.from_pydict({"k": list(range(len(rules))), "seconds": seconds, "rejected": rejected})

    return run


def ordered(df: DataFrame, text_col: str, rules: Sequence[Rule], sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per second on the sample, dearest last where none rejects."""
    total = df.count()
    texts = df.select(quoted(text_col).cast("string").alias("text"))
    if total > sample:
        texts = texts.sample(sample / total, seed=7)
    seen = (
        texts.mapInArrow(_measured(rules), "k long, seconds double, rejected long")
        .groupBy("k")
        .agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
        .collect()
    )
    cost = {r["k"]: (-r["rejected"] / (r["seconds"] + 1e-9), r["seconds"]) for r in seen}
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: (cost.get(k, (0, 0)), k))]


def _judged(rules: Sequence[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in (*COUNTS, "base_failed", "kept")}
            for text in batch.column(1).to_pylist():
                t = Text(text or "")
                for c in COUNTS:
                    out[c].append(getattr(t, c))
                failed = base_failed(t)
                out["base_failed"].append(failed)
                out["kept"].append(not failed and not any(r.rejects(t) for r in rules))
            columns = [batch.column(0), *(pa.array(out[c], pa.int64()) for c in COUNTS)]
            columns += [pa.array(out[c], pa.bool_()) for c in ("base_failed", "kept")]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *out])

    return run


def judge(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per row of `df`: id, the counts, base_failed, kept.

    A missing text counts as empty: no words, so base_failed.  Ids are only carried along; repeated
    rows stay; an empty table gives no rows; other columns are not read.
    """
    prepare(df.sparkSession)
    cascade = ordered(df, text_col, rules)
    docs = df.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"
    return docs.mapInArrow(_judged(cascade), schema).withColumnRenamed("id", id_col)
