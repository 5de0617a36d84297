"""Operator 10: toxicity by a counterfactual-regularised linear classifier.

A text's features are its distinct lower-case words and their first letters (4
and 5). Training minimises the logistic loss on labelled texts plus a penalty
on score changes when an identity term in a labelled text is swapped for
another of its family; texts that name none get a pair in which each member is
added. The identity terms therefore carry (nearly) equal weights, and naming a
group neutrally does not raise a score.

Training takes a bounded sample (``PER_CLASS`` rows a class, see ``training``),
of whose features the ``VOCABULARY`` best separating ones and the identity terms
are kept; scoring is one pass over all rows, every text whole, with that small
table and no shuffle. Null and empty texts get the bias's score; copies and ties
get equal scores; without labels of both classes every score is 0.5; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only, strings, text_or_empty
from tessera.llm.training import held_out, labelled_sample

PER_CLASS = 2500
VOCABULARY = 2048
PENALTY = 1.0
PAIRS_PER_TEXT = 2
CACHE = 300_000

# fixed values: identity terms, by family
IDENTITY_FAMILIES = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"), ("mother", "father"), ("wife", "husband"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "african", "european", "hispanic", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "protestant", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "protestants", "atheists"),
    ("american", "mexican", "chinese", "indian", "german", "french", "russian", "turkish", "polish"),
    ("immigrant", "native", "foreigner", "refugee"), ("old", "young"), ("deaf", "blind", "disabled"),
    ("frau", "mann"), ("frauen", "männer"), ("femme", "homme"), ("femmes", "hommes"), ("mujer", "hombre"),
    ("mujeres", "hombres"),
)
_FAMILY = {t: family for family in IDENTITY_FAMILIES for t in family}
_TRIM = ".,;:!?\"'()[]{}<>*$%&#|-–—«»¡¿"


def words_in(text: str) -> set[str]:
    """Distinct lower-case words without outer punctuation."""
    found = {w.strip(_TRIM) for w in set(text.lower().split())}
    found.discard("")
    return found


def word_features(word: str) -> list[str]:
    """The word and, unless it is an identity term, its beginnings."""
    if word in _FAMILY:
        return [word]
    return [word, *[f"{word[:n]}~" for n in (4, 5) if len(word) > n - 1]]


def features_of(words) -> set[str]:
    return {f for w in words for f in word_features(w)}


def counterfactuals(words: set[str], rng: np.random.Generator) -> list[tuple[set[str], set[str]]]:
    """Pairs of word sets that differ in one identity term of a family."""
    named = sorted(w for w in words if w in _FAMILY)
    out = []
    for k in range(PAIRS_PER_TEXT):
        if named:
            a = named[k % len(named)]
            others = [t for t in _FAMILY[a] if t != a]
            out.append((words, (words - {a}) | {others[int(rng.integers(len(others)))]}))
        else:
            family = IDENTITY_FAMILIES[int(rng.integers(len(IDENTITY_FAMILIES)))]
            a, b = rng.choice(len(family), 2, replace=False)
            out.append((words | {family[a]}, words | {family[b]}))
    return out


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]

    def scorer(self, cache: int = CACHE):
        known: dict[str, tuple[str, ...]] = {}
        weights = self.weights

        def score(text: str) -> float:
            hits = set()
            for w in words_in(text):
                f = known.get(w)
                if f is None:
                    f = tuple(x for x in word_features(w) if x in weights)
                    if len(known) >= cache:
                        known.clear()
                    known[w] = f
                hits.update(f)
            z = self.bias + sum(weights[f] for f in sorted(hits))
            return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))
        return score


def train(rows: list[tuple[str, int]], penalty: float = PENALTY, vocabulary: int = VOCABULARY, l2: float = 0.02,
          steps: int = 400) -> Model | None:
    """Fit on (text, label) rows; None without both labels."""
    y = np.array([v for _, v in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return None
    sets = [words_in(t) for t, _ in rows]
    seen = {0: Counter(), 1: Counter()}
    for s, v in zip(sets, y):
        seen[int(v)].update(features_of(s))
    total = {v: float((y == v).sum()) for v in (0, 1)}

    def z(f: str) -> float:
        a, c = seen[1][f] + 0.5, seen[0][f] + 0.5
        return (math.log(a / total[1]) - math.log(c / total[0])) / math.sqrt(1 / a + 1 / c)

    common = [f for f in seen[1].keys() | seen[0].keys() if seen[1][f] + seen[0][f] >= 4]
    ranked = sorted(((-abs(z(f)), f) for f in common if f not in _FAMILY))
    names = [f for s, f in ranked[:vocabulary] if s < -2.5] + sorted(_FAMILY)
    del seen
    column = {f: i for i, f in enumerate(names)}

    def matrix(word_sets) -> np.ndarray:
        x = np.zeros((len(word_sets), len(names)), np.float32)
        for i, s in enumerate(word_sets):
            x[i, [column[f] for f in features_of(s) if f in column]] = 1
        return x

    x = matrix(sets)
    rng = np.random.default_rng(10)
    pairs = [p for s in sets for p in counterfactuals(s, rng)]
    swap = np.zeros((len(names), len(names)))  # sum of the outer products of the feature differences
    for a, b in pairs:
        plus = [column[f] for f in features_of(a - b) if f in column]
        minus = [column[f] for f in features_of(b - a) if f in column]
        at, sign = np.array(plus + minus, int), np.array([1.0] * len(plus) + [-1.0] * len(minus))
        swap[np.ix_(at, at)] += np.outer(sign, sign)
    swap = (swap / max(1, len(pairs))).astype(np.float32)
    w, bias = np.zeros(len(names), np.float32), float(np.log(total[1] / total[0]))
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -35, 35)))
        err = (p - y) / len(y)
        g = np.append(err @ x + l2 / len(y) * 10 * w + penalty * (swap @ w), err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, bias = (w - move[:-1]).astype(np.float32), bias - float(move[-1])
    return Model(bias, {f: float(w[i]) for f, i in column.items() if abs(w[i]) > 1e-4})


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = PER_CLASS,
        id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    return train(labelled_sample(docs, labels, label_col, per_class, id_col, text_col))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of every row."""
    import pyarrow as pa

    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`"), text_or_empty(text_col).alias("_text"))
    if model is None:
        return rows.select(id_col, F.lit(0.5).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for b in batches:
            s = pa.array([one(t) for t in strings(b.column(1))], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), s], names=[id_col, "score"])

    return bounded_batches(rows).mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, score double")


def report(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.5,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` of every document."""
    s = score(docs, fit(docs, labels, label_col, id_col=id_col, text_col=text_col), id_col, text_col)
    return s.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))
