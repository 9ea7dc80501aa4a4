"""BPE encoding and decoding by forced-boundary splitting.

A merge only ever makes tokens of the vocabulary.  So where two neighbouring symbols of a word stand
side by side inside no token, no merge can reach across: there the word can be cut for certain.  The
fragments between such cuts are encoded independently of each other, each once as long as a worker
remembers it, and their ids are concatenated.  Within a fragment the pair with the lowest rank is
merged first, the leftmost among equals.

A symbol is a byte, and the last byte of a word together with the vocabulary's end-of-word mark, if
it has one; the cuts tell these apart.

Texts are split into words as the tokenizer's file says.  Characters for which Python and the
tokenizers library could follow different versions of Unicode go through the library's own
normalizer and pre-tokenizer, with the whole text around them.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import prepare, quoted

#: Words and fragments of at most this many characters are remembered, and how many of each.
REMEMBERED_CHARS, REMEMBERED = 48, 400_000
#: Fragments up to this many symbols are merged by plain search for the lowest rank.
SHORT = 64
#: Separators that Python splits at and the tokenizer does not.
NOT_SPACE = re.compile("[\x1c-\x1f]")
#: Characters from here on (but for general punctuation) are left to the library.
NEWER = re.compile("[^\x00-ӿ‐-‧‰-⁞]")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Encoder:
    """Ids of texts, and tokens of ids, by the vocabulary in a JSON file of the tokenizers library."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path}: not a byte-level BPE vocabulary without dropout and prefixes")
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): n for n, (a, b) in enumerate(merges)}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added = added
        self.at_added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.token_of = {n: t for t, n in self.vocab.items()} | {n: t for t, n in added.items()}
        #: Symbols that stand side by side inside a token; every other pair is a cut.
        self.inside = {
            pair
            for token in self.vocab
            if token not in added
            for symbols in [self.symbols(*self._bare(token))]
            for pair in zip(symbols, symbols[1:])
        }
        self.byte_character = dict(enumerate(byte_characters()))
        self.pattern = self._pattern(spec)
        self.lowers = "Lowercase" in json.dumps(spec.get("normalizer"))
        self.agreed: dict[str, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.fragments: dict[tuple[str, ...], tuple[int, ...]] = {}

    def _bare(self, token: str) -> tuple[str, bool]:
        ends = bool(self.end) and token.endswith(self.end)
        return (token[: -len(self.end)] if ends else token), ends

    def symbols(self, characters: str, ends: bool) -> list[str]:
        """Byte characters, the last one with the end-of-word mark if the word ends there."""
        out = list(characters)
        if ends and out:
            out[-1] += self.end
        return out

    @staticmethod
    def _pattern(spec: dict) -> regex.Pattern | None:
        """The pattern of words, where a word is all that counts and white space is dropped."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or kinds != ["NFC", "Replace", "Lowercase"]:
            return None
        split, level = steps
        plain = split["invert"] and split["behavior"] == "Removed"
        plain = plain and not level["add_prefix_space"] and not level["use_regex"]
        return regex.compile(split["pattern"]["Regex"]) if plain else None

    def _agree(self, character: str) -> bool:
        """Whether this module and the library take a character for the same."""
        known = self.agreed.get(character)
        if known is None:
            pairs = [character, character * 2, f"a{character}a", f"1{character}", f"!{character}!"]
            known = all(
                self._own_words(p) == [w for w, _ in self._library_words(p)] for p in pairs
            )
            self.agreed[character] = known
        return known

    def _own_words(self, text: str) -> list[str]:
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [self._as_bytes(w) for w in self.pattern.findall(lowered)]

    def _library_words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        normalizer, pre = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return pre.pre_tokenize_str(text) if pre else [(text, (0, len(text)))]

    def _as_bytes(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.byte_character)

    def cuts(self, word: str) -> list[tuple[str, ...]]:
        """Fragments of a word of byte characters, cut wherever no token can reach across."""
        symbols = tuple(self.symbols(word, True))
        pairs = [*zip(symbols, symbols[1:])]
        if self.inside.issuperset(pairs):
            return [symbols]
        ends = [k for k, pair in enumerate(pairs, 1) if pair not in self.inside]
        return [symbols[a:b] for a, b in zip([0, *ends], [*ends, len(symbols)])]

    def merged(self, symbols: tuple[str, ...]) -> tuple[int, ...]:
        """Ids of one fragment: the pair of lowest rank first, the leftmost among equals."""
        if len(symbols) > SHORT:
            return self._merged_by_queue(symbols)
        parts = list(symbols)
        rank_of, none = self.ranks.get, len(self.ranks)
        ranks = [rank_of(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            k = ranks.index(least)
            parts[k] += parts.pop(k + 1)
            del ranks[k]
            if k:
                ranks[k - 1] = rank_of((parts[k - 1], parts[k]), none)
            if k < len(ranks):
                ranks[k] = rank_of((parts[k], parts[k + 1]), none)
        return tuple([self.vocab[p] for p in parts])

    def _merged_by_queue(self, symbols: tuple[str, ...]) -> tuple[int, ...]:
        """The same for long fragments, in n log n steps."""
        parts: list[str | None] = list(symbols)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [
            (rank, k, pair)
            for k, pair in enumerate(zip(symbols, symbols[1:]))
            if (rank := self.ranks.get(pair)) is not None
        ]
        heapq.heapify(queue)
        while queue:
            _, k, pair = heapq.heappop(queue)
            right = after[k]
            if parts[k] != pair[0] or right >= n or parts[right] != pair[1]:
                continue
            parts[k], parts[right] = pair[0] + pair[1], None
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
            for left, other in ((before[k], k), (k, after[k])):
                if left >= 0 and other < n:
                    new = (parts[left], parts[other])
                    rank = self.ranks.get(new)
                    if rank is not None:
                        heapq.heappush(queue, (rank, left, new))
        return tuple(self.vocab[p] for p in parts if p is not None)

    def word(self, word: str) -> list[int]:
        """Ids of a word of byte characters: those of its fragments, one after the other."""
        out: list[int] = []
        for fragment in self.cuts(word) if word else []:
            ids = self.fragments.get(fragment)
            if ids is None:
                ids = self.merged(fragment)
                if len(fragment) <= REMEMBERED_CHARS:
                    if len(self.fragments) >= REMEMBERED:
                        self.fragments.clear()
                    self.fragments[fragment] = ids
            out += ids
        return out

    def _run(self, run: str) -> list[int]:
        """Ids of a run without white space, in lower case; its words are remembered like runs."""
        known, words = self.words, self.pattern.findall(run)
        if len(words) == 1:
            out = self.word(self._as_bytes(words[0]))
        else:
            out = []
            for w in words:
                ids = known.get(w)
                if ids is None:
                    ids = self.word(self._as_bytes(w))
                    self._remember(w, ids)
                out += ids
        self._remember(run, out)
        return out

    def _remember(self, run: str, ids: list[int]) -> None:
        if len(run) <= REMEMBERED_CHARS:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[run] = ids

    def _plain(self, text: str) -> list[int]:
        """Ids of a text without added tokens."""
        own = self.pattern is not None and not NEWER.search(text) and not NOT_SPACE.search(text)
        if not own or not (text.isascii() or all(map(self._agree, set(text)))):
            return [n for w, _ in self._library_words(text) for n in self.word(w)]
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        out: list[int] = []
        known = self.words
        for run in lowered.split():
            ids = known.get(run)
            out += self._run(run) if ids is None else ids
        return out

    def __call__(self, text: str) -> list[int]:
        if self.at_added is None or not self.at_added.search(text):
            return self._plain(text)
        out: list[int] = []
        for part in self.at_added.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out.extend(self._plain(part))
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens of the ids, special ones too, as the library's decode; unknown ids give nothing."""
        tokens = [t for t in map(self.token_of.get, ids) if t is not None]
        decoder = self.tokenizer.decoder
        return decoder.decode(tokens) if decoder else " ".join(tokens)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


#: Characters that go to one output batch.
FLUSH = 8_000_000


def _coded(path: str):
    """(other columns, text) to (other columns, ids, decoded)."""

    def batch(kept: list[pa.Array], lists: list[list[int]], texts: list[str], names: list[str]) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, lists)])
        values = np.fromiter((n for ids in lists for n in ids), np.int32, ends[-1])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
        return pa.RecordBatch.from_arrays([*kept, ids, pa.array(texts, pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for rows in batches:
            names = [*rows.schema.names[:-1], "ids", "decoded"]
            lists: list[list[int]] = []
            texts: list[str] = []
            held, start = 0, 0
            for k, text in enumerate(rows.column(rows.num_columns - 1)):
                ids = encode(text.as_py() or "")
                lists.append(ids)
                texts.append(encode.decode(ids))
                held += len(texts[-1])
                if held >= FLUSH:
                    yield batch([c.slice(start, k + 1 - start) for c in rows.columns[:-1]], lists, texts, names)
                    lists, texts, held, start = [], [], 0, k + 1
            if lists:
                yield batch([c.slice(start) for c in rows.columns[:-1]], lists, texts, names)

    return run


def code(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, `ids` of the whole text, and `decoded`, what these ids are decoded to: a row per row.

    A missing text is empty; an empty or blank one has no ids and decodes to an empty text.  Ids of
    documents may be missing or repeated: they are only carried along, and repeated rows are encoded
    once each.  An empty table gives no rows.  Other columns are not read, whatever their names.
    Memory holds one batch of texts and a bounded number of words and fragments; a fragment of n
    symbols takes n log n steps.
    """
    prepare(df.sparkSession)
    rows = df.select(quoted(id_col).alias("doc"), quoted(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    coded = rows.mapInArrow(_coded(tokenizer), f"doc {kind}, ids array<int>, decoded string")
    return coded.withColumnRenamed("doc", id_col)
