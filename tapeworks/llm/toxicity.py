"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text and normalised by length.

Folding undoes what hides a word: look-alike letters of other scripts, accents, wide forms, digits and signs in
place of letters, invisible characters. Phrases in which a word of the lexicon means no harm are matched as well, and
what they cover does not count. The lexicon is a fixed list and what labelled documents add to it: words and
beginnings of words (written with a star) that stand in toxic documents and next to never in clean ones.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.columns import Compute, add_columns, stage
from tapeworks.llm.labelled import TRAINING_ROWS, first_rows, held_out, training_rows

# Lengths of the beginnings of words that may be learned, and how many terms at most.
PREFIXES = (4, 5)
LEARNED_TERMS = 5_000
# Insults and harmless phrases that hold them.
LEXICON = (
    "idiot", "idiots", "idiotic", "moron", "morons", "moronic", "stupid", "stupidity", "dumb", "dumbass", "imbecile",
    "scum", "scumbag", "trash", "garbage", "filth", "vermin", "loser", "losers", "clown", "clowns", "worthless",
    "pathetic", "disgusting", "disgrace", "degenerate", "creep", "pig", "pigs", "rat", "jerk", "bastard", "bitch",
    "asshole", "crap", "shit", "fuck", "fucking", "retard", "retarded", "slut", "whore", "cretin", "dimwit", "halfwit",
)
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bag", "trash bags", "trash collection", "garbage can", "garbage bag",
    "garbage collection", "garbage collector", "garbage truck", "clown fish", "circus clown", "clown car", "pond scum",
    "sore loser", "guinea pig", "guinea pigs", "pig iron", "rat race", "lab rat", "jerk chicken", "jerk seasoning",
    "not stupid", "no loser",
)
# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ɡ": "g", "ɑ": "a",
}
# Digits and signs in place of letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "£": "l"}
# A sign stands for a letter only before one; the letters i and l, which 1 may be, count as the same.
_SIGN = re.compile(r"[@$!|€£](?=[^\W_])")


class _Folding(dict):
    """What str.translate makes of each character: a folded letter, nothing, or a space."""

    def __missing__(self, code: int) -> str:
        found = self[code] = self._fold(chr(code))
        return found

    @staticmethod
    def _fold(c: str) -> str:
        if unicodedata.category(c) in ("Cf", "Mn", "Me"):
            return ""
        letters = []
        for x in unicodedata.normalize("NFKD", c).lower():
            x = HOMOGLYPHS.get(x, STAND_INS.get(x, x))
            x = unicodedata.normalize("NFKD", x)[:1]
            if x.isalnum():
                letters.append("i" if x == "l" else x)
            elif unicodedata.category(x) != "Mn":
                letters.append(" ")
        return "".join(letters)


_FOLDING = _Folding()


def folded(text: str) -> str:
    """The text in folded letters, with a space for all else."""
    if _SIGN.search(text):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text.translate(_FOLDING)


@dataclass(frozen=True)
class Model:
    """Weights of the lexicon's terms, phrases that excuse them, and what makes a probability of the two numbers."""

    weights: Mapping[str, float] = field(default_factory=lambda: dict.fromkeys(LEXICON, 1.0))
    exceptions: Sequence[str] = EXCEPTIONS
    bias: float = -3.0
    per_weight: float = 3.0
    per_density: float = 0.5

    def probability(self, numbers: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + numbers @ np.array([self.per_weight, self.per_density]))))


class Matcher:
    """Finds the terms of a text, but for those that an exception covers; one for each word, the longest."""

    def __init__(self, terms: Sequence[str], exceptions: Sequence[str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term in terms:
            self._add(term, term)
        for phrase in exceptions:  # a term that is an exception too is one
            self._add(phrase, None)
        self.automaton.make_automaton()

    def _add(self, phrase: str, term: str | None) -> None:
        key = " ".join(folded(phrase.rstrip("*")).split())
        pattern = f" {key}" if phrase.endswith("*") else f" {key} "
        self.automaton.add_word(pattern, (term, len(pattern)))

    def found(self, text: str) -> tuple[list[str], int]:
        """The terms that count, one for each place, and the number of words."""
        words = folded(text).split()
        hits, excused = {}, []
        for end, (term, length) in self.automaton.iter(f" {' '.join(words)} "):
            if term is None:
                excused.append((end - length, end))
            else:
                hits[end - length] = (end, term)
        if excused:
            # Of the exceptions that begin no later than a hit, the one that ends last decides.
            excused.sort()
            begins, reach = [x for x, _ in excused], list(accumulate((y for _, y in excused), max))
            hits = {a: h for a, h in hits.items() if not (k := bisect_right(begins, a)) or reach[k - 1] < h[0]}
        return [term for _, term in hits.values()], len(words)


def numbers(found: Sequence[str], words: int, weights: Mapping[str, float]) -> tuple[float, float]:
    """Logarithms of the summed weight and of the weight in a thousand words."""
    weight = sum(map(weights.__getitem__, found))
    return float(np.log1p(weight)), float(np.log1p(1000 * weight / max(1, words)))


@lru_cache(maxsize=4)
def _matcher(terms: tuple[str, ...], exceptions: tuple[str, ...]) -> Matcher:
    return Matcher(terms, exceptions)


def with_terms(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """docs with ``terms``, the lexicon's words found in each text, and ``words``, its length."""
    terms, exceptions = tuple(model.weights), tuple(model.exceptions)

    def make() -> Compute:
        matcher = _matcher(terms, exceptions)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [matcher.found(t or "") for t in batch.column(text).to_pylist()]
            return [pa.array([f for f, _ in found], pa.list_(pa.string())), pa.array([n for _, n in found], pa.int64())]
        return compute

    fields = T.StructType([T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("words", T.LongType())])
    return add_columns(docs, text, fields, make, keep)


def fit(found: Sequence[Sequence[str]], words: Sequence[int], y: np.ndarray, prior: Model = Model()) -> Model:
    """Weights from how much oftener a term stands in toxic documents, then a logistic regression on the numbers.

    A term that was never seen keeps the prior's weight. With one label only the prior is returned.
    """
    if not 0 < y.sum() < len(y):
        return prior
    toxic, clean = ({}, {})
    for terms, label in zip(found, y):
        for term in set(terms):
            side = toxic if label else clean
            side[term] = side.get(term, 0) + 1
    weights = {}
    for term, weight in prior.weights.items():
        a, b = toxic.get(term, 0), clean.get(term, 0)
        odds = np.log((a + 0.5) / (y.sum() + 1)) - np.log((b + 0.5) / (len(y) - y.sum() + 1))
        weights[term] = float(np.clip(odds / 4, 0, 2)) if a + b else weight
    x = np.array([numbers(f, n, weights) for f, n in zip(found, words)])
    design, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    ridge = np.diag([1e-3, 1.0, 1.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-design @ beta))
        beta -= np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge, design.T @ (p - y) + ridge @ beta)
    return Model(weights, prior.exceptions, *map(float, beta))


def with_words(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """docs with ``folded_words``, the different folded words of each text, and ``signature``, the least of their
    hashes, which near copies mostly share."""
    def make() -> Compute:
        import xxhash

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            words = [sorted(set(folded(t or "").split())) for t in batch.column(text).to_pylist()]
            least = [min((xxhash.xxh64_intdigest(w) >> 1 for w in ws), default=0) for ws in words]
            return [pa.array(words, pa.list_(pa.string())), pa.array(least, pa.int64())]
        return compute

    fields = T.StructType([T.StructField("folded_words", T.ArrayType(T.StringType())),
                           T.StructField("signature", T.LongType())])
    return add_columns(docs, text, fields, make, keep)


def _beginnings(words: Column, n: int) -> Column:
    long = F.filter(words, lambda w: F.length(w) >= n)
    return F.transform(long, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def learned_terms(sample: DataFrame, text: str = "text", support: int = 4, odds: float = 4.5,
                  terms: int = LEARNED_TERMS) -> list[str]:
    """Words and beginnings of words that mark toxic documents of the sample (columns text and target).

    They stand in at least ``support`` toxic texts with different signatures, and the logarithm of how much oftener
    they stand in toxic than in clean texts is at least ``odds``. A beginning is left out for a longer term with
    nearly its support, and so is what begins with a term that is kept. Returns ``terms`` at most, the commonest.
    """
    words = stage(with_words(sample, text, ["target"]), "toxicity-words")
    toxic, clean = (words.filter(F.col("target") == t) for t in (1, 0))
    toxic_texts, clean_texts = toxic.select("signature").distinct().count(), clean.count()

    def exploded(rows: DataFrame) -> DataFrame:
        long = F.filter("folded_words", lambda w: F.length(w) >= PREFIXES[0])
        starts = [_beginnings(long, n) for n in PREFIXES]
        return rows.select("signature", F.explode(F.array_distinct(F.concat(long, *starts))).alias("term"))

    marked = exploded(toxic).distinct().groupBy("term").agg(F.count("*").alias("toxic")).filter(F.col("toxic") >= support)
    marked = stage(marked, "toxicity-terms")
    counted = exploded(clean).join(marked.select("term"), "term").groupBy("term").agg(F.count("*").alias("clean"))
    rate = F.log((F.col("toxic") + 0.5) / (toxic_texts + 1)) - F.log((F.coalesce("clean", F.lit(0)) + 0.5) / (clean_texts + 1))
    strong = marked.join(counted, "term", "left").filter(rate >= odds)
    found = {r[0]: r[1] for r in strong.orderBy(F.desc("toxic"), "term").select("term", "toxic").limit(terms).collect()}
    # Of a word and the beginning spelt like it the one with more support counts, the word if they are equal.
    by_stem = {t.rstrip("*"): t for t in sorted(found, key=lambda t: (found[t], not t.endswith("*")))}
    kept: list[str] = []
    for stem in sorted(by_stem, key=lambda s: (len(s), s)):
        term = by_stem[stem]
        longer = any(len(o) > len(stem) and o.startswith(stem) and found[by_stem[o]] >= 0.95 * found[term] for o in by_stem)
        covered = any(k.endswith("*") and stem.startswith(k.rstrip("*")) for k in kept)
        if not covered and not (term.endswith("*") and longer):
            kept.append(term)
    return kept


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAINING_ROWS,
          id_col: str = "doc_id", text: str = "text", prior: Model = Model()) -> Model:
    """A model fitted on at most ``rows`` labelled documents that are not held out; only terms are collected."""
    sample = stage(training_rows(docs.select(id_col, text), labels, label, rows, id_col), "toxicity-sample")
    known = {folded(term) for term in prior.weights}
    new = [term for term in learned_terms(sample, text) if term not in known]
    wider = replace(prior, weights=dict.fromkeys(new, 1.0) | dict(prior.weights))
    found = first_rows(with_terms(sample, wider, text, [id_col, "target"]), rows, id_col)
    numbered = found.select("terms", "words", "target").collect()
    return fit([r[0] for r in numbered], [r[1] for r in numbered], np.array([r[2] for r in numbered], dtype=float), wider)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score",
          keep: Sequence[str] | None = None) -> DataFrame:
    """docs with the probability that each whole text is toxic.

    Only the text counts. A null or empty text has no terms and no words, and scores like any text without terms;
    equal texts score the same; repeated rows stay. A column that has the name of the score is replaced.
    """
    terms, exceptions = tuple(model.weights), tuple(model.exceptions)

    def make() -> Compute:
        matcher = _matcher(terms, exceptions)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            x = [numbers(*matcher.found(t or ""), model.weights) for t in batch.column(text).to_pylist()]
            return [pa.array(model.probability(np.array(x, dtype=float).reshape(-1, 2)))]
        return compute

    return add_columns(docs, text, T.StructType([T.StructField(name, T.DoubleType())]), make, keep)


def judged(docs: DataFrame, model: Model, at_least: float = 0.5, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """id, held_out, score and predicted (1 from ``at_least`` on) of each document."""
    return score(docs, model, text, keep=[id_col]).select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= at_least).cast("int").alias("predicted"))
