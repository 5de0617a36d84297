"""Operator 13: language identification, multinomial naive Bayes over hashed character n-grams.

A text is casefolded; runs of characters that are no letters become one space,
so that a word's edges are part of its n-grams. Every n-gram of the orders
``ORDERS`` is hashed into one of ``BUCKETS`` buckets. Training counts buckets
per language over *all* training rows: tasks add up dense counts and return
them once, in chunks that Spark sums. The log-probability matrix (at most
``MAX_LANGUAGES`` x ``BUCKETS`` doubles, 64 MiB) is broadcast, and scoring is
one pass without a shuffle: the buckets of a batch of texts form one sparse
row list, whose log probabilities numpy looks up and sums per text.

Documented bound: if the training rows name more than ``MAX_LANGUAGES``
languages, the most frequent ones are learned (ties by name).

Rows: a text that is null or has no letter gets ``und`` and score 0.0, as does
every text when nothing could be learned. Texts of any length are read whole,
in slices whose n-grams join up. Equal probabilities go to the language first
by name; rows with a null id are scored but not learned from and not held out;
copies and repeated ids are scored one by one; an empty table gives no rows.
The score is the posterior probability of the language given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
MAX_LANGUAGES = 256
ALPHA = 0.5
#: characters hashed at a time
SLICE = 1 << 17
_CHUNK = 4096
_NO_LETTER = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def pieces(text: str, size: int = SLICE) -> Iterator[tuple[np.ndarray, int]]:
    """The normal form of ``text`` as code points, in slices: (codes, how many lead codes were counted before)."""
    back = max(ORDERS) - 1
    tail = " "
    old = 0
    for lo in range(0, max(1, len(text)), size):
        new = _NO_LETTER.sub(" ", text[lo:lo + size].casefold())
        if tail.endswith(" "):
            new = new.lstrip(" ")
        if lo + size >= len(text) and not (tail + new).endswith(" "):
            new += " "
        yield np.frombuffer((tail + new).encode("utf-32-le", "surrogatepass"), np.uint32), old
        tail = (tail + new)[-back:]
        old = len(tail)


def bucket_lists(parts: list[tuple[np.ndarray, int]]) -> Iterator[np.ndarray]:
    """Per order, a bucket for each code of the joined parts: that of the n-gram ending there. Codes where none ends (the
    n-gram would begin before its part, or was counted with the slice before) get the bucket ``BUCKETS``."""
    codes = np.concatenate([c for c, _ in parts])
    sizes = np.array([len(c) for c, _ in parts])
    old = np.array([o for _, o in parts])
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    old = np.repeat(old, sizes)
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        # the hash of the last n codes: that of the n - 1 before, moved by one, and the code itself
        h = np.concatenate([np.zeros(1, np.uint32), h[:-1]]) * np.uint32(0x9E3779B1) + codes + np.uint32(n) if n > 1 \
            else codes * np.uint32(0x85EBCA6B)
        if n in ORDERS:
            x = h ^ (h >> np.uint32(15))
            x = x * np.uint32(0xC2B2AE35)
            x = (x ^ (x >> np.uint32(13))) & np.uint32(BUCKETS - 1)
            yield np.where(place >= np.maximum(n - 1, old), x, np.uint32(BUCKETS))


def batches_of(texts: list[str], rows: list[int], size: int = SLICE) -> Iterator[tuple[list[int], list]]:
    """Slices of the texts, about ``size`` codes at a time: (row of each part, parts)."""
    at, parts, n = [], [], 0
    for i in rows:
        for part in pieces(texts[i], size):
            if n and n + len(part[0]) > size:
                yield at, parts
                at, parts, n = [], [], 0
            at.append(i)
            parts.append(part)
            n += len(part[0])
    if parts:
        yield at, parts


# ---------------------------------------------------------------- model

@dataclass(frozen=True)
class Model:
    """Languages by name, log priors, and log probabilities (languages, buckets + 1; the last bucket counts nothing)."""
    languages: tuple[str, ...]
    prior: np.ndarray
    matrix: np.ndarray

    def log_likelihood(self, texts: list[str], rows: list[int]) -> np.ndarray:
        """Sums of the n-grams' log probabilities, (texts, languages); only the given rows are filled."""
        out = np.zeros((len(texts), len(self.languages)))
        for at, parts in batches_of(texts, rows):
            first = np.cumsum([0, *[len(c) for c, _ in parts[:-1]]])
            for buckets in bucket_lists(parts):
                for j, row in enumerate(self.matrix):
                    np.add.at(out[:, j], at, np.add.reduceat(row[buckets], first))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        rows = [i for i, t in enumerate(texts) if has_letter(t)]
        name, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if rows and self.languages:
            z = self.log_likelihood(texts, rows) + self.prior
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            for i in rows:
                j = int(z[i].argmax())
                name[i], score[i] = self.languages[j], float(p[i, j])
        return name, score


def make_model(counts: dict[str, tuple[int, np.ndarray]], alpha: float = ALPHA) -> Model:
    """From documents and bucket counts by language; smoothed by ``alpha``."""
    names = tuple(sorted(counts))
    prior = np.log(np.array([counts[x][0] for x in names], float)) if names else np.zeros(0)
    matrix = np.zeros((len(names), BUCKETS + 1))
    for j, x in enumerate(names):
        c = counts[x][1] + alpha
        matrix[j, :BUCKETS] = np.log(c / c.sum())
    return Model(names, prior, matrix)


def count_buckets(texts: list[str]) -> np.ndarray:
    """Bucket counts over all n-grams of the texts."""
    out = np.zeros(BUCKETS + 1, np.int64)
    for _, parts in batches_of(texts, [i for i, t in enumerate(texts) if has_letter(t)]):
        for buckets in bucket_lists(parts):
            out += np.bincount(buckets, minlength=BUCKETS + 1)
    return out[:BUCKETS]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_languages: int = MAX_LANGUAGES) -> Model:
    """Counts over every row with a text, a language and an id that is not held out."""
    import pyarrow as pa
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    known = only(docs, *dict.fromkeys((id_col, text_col, lang_col))) \
        .filter(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull() & ~held_out(id_col)) \
        .select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    top = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(max_languages).collect()]
    if not top:
        return make_model({})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for b in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                if lang not in seen:
                    seen[lang] = [0, np.zeros(BUCKETS, np.int64)]
                seen[lang][0] += len(texts)
                seen[lang][1] += count_buckets(texts)
        for lang, (n, counts) in seen.items():
            chunks = [np.array([n]), *np.split(counts, range(_CHUNK, BUCKETS, _CHUNK))]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(chunks)), pa.array(np.arange(-1, len(chunks) - 1), pa.int32()),
                pa.array([c.astype(np.float64) for c in chunks], pa.list_(pa.float64()))], names=["lang", "chunk", "counts"])

    rows = bounded_batches(known.filter(F.col("lang").isin(top))).mapInArrow(run, "lang string, chunk int, counts array<double>")
    # chunks of one length per (language, chunk): at most max_languages x buckets numbers reach the driver
    summed = rows.groupBy("lang", "chunk").agg(Summarizer.sum(array_to_vector("counts")).alias("s")) \
        .select("lang", "chunk", vector_to_array("s").alias("s")).collect()
    found: dict[str, dict] = {}
    for r in summed:
        found.setdefault(r["lang"], {})[r["chunk"]] = r["s"]
    return make_model({lang: (int(c[-1][0]), np.concatenate([c[i] for i in range(BUCKETS // _CHUNK)])) for lang, c in found.items()})


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` of every row."""
    import pyarrow as pa

    rows = only(docs, *dict.fromkeys((id_col, text_col))) \
        .select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            names, scores = m.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[id_col, "lang_pred", "score"])

    kind = rows.schema[0].dataType.simpleString()
    return bounded_batches(rows).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    p = predict(docs, fit(docs, id_col, text_col, lang_col), id_col, text_col)
    return p.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "lang_pred", "score")
