"""Operator 9: quality by compression with zstandard dictionaries.

One dictionary is built from good and one from bad labelled texts. A text is
cut into blocks and compressed with either; the difference of the compressed
sizes per byte, with the size per byte itself, goes through a logistic
calibration that was fitted on labelled texts the dictionaries have not seen.

Training takes a bounded sample (``PER_CLASS`` rows a class, see ``training``);
scoring is one pass over all rows, every text whole, with two dictionaries of
bounded size and no shuffle. Null and empty texts get the calibration's value
for zero features; copies and ties get equal scores; without labels of both
classes every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only, strings, text_or_empty
from tessera.llm.training import fit_logistic, held_out, labelled_sample

PER_CLASS = 2500
DICTIONARY_BYTES = 112_640
BLOCK = 2048
LEVEL = 3


def _blocks(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


def build_dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the texts; their plain bytes where there are too few to train one."""
    import zstandard

    samples = [b for t in texts for b in _blocks(t)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b" " * 8


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def scorer(self):
        """A function from text to score; holds the two compressors."""
        import zstandard

        made = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                 write_checksum=False, write_dict_id=False))

        def score(text: str) -> float:
            z = self.weights[0] + float(np.dot(self.weights[1:], features(text, *made)))
            return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))
        return score


def features(text: str, good, bad) -> list[float]:
    """Normalised size difference, its value for short texts, and the size itself (all per byte)."""
    blocks = _blocks(text)
    if not blocks:
        return [0.0, 0.0, 0.0]
    n = sum(map(len, blocks))
    g = sum(len(good.compress(b)) for b in blocks)
    b = sum(len(bad.compress(b)) for b in blocks)
    diff = (b - g) / n
    return [diff, diff * min(1.0, 200 / n), min(g, b) / n]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = PER_CLASS,
        id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Dictionaries from three of five sampled texts, calibration from the rest; None without both labels."""
    rows = labelled_sample(docs, labels, label_col, per_class, id_col, text_col)
    order = np.random.default_rng(9).permutation(len(rows))
    rows = [rows[i] for i in order]
    if len({y for _, y in rows}) < 2:
        return None
    part = {1: [], 0: []}
    for t, y in rows:
        part[y].append(t)
    cut = {y: max(1, len(ts) * 3 // 5) for y, ts in part.items()}
    good, bad = (build_dictionary(part[y][:cut[y]]) for y in (1, 0))
    model = Model(good, bad, (0.0, 0.0, 0.0, 0.0))
    import zstandard

    tools = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                      write_checksum=False, write_dict_id=False) for d in (good, bad)]
    seen = [(t, y) for y, ts in part.items() for t in (ts[cut[y]:] or ts)]
    x = np.array([features(t, *tools) for t, _ in seen])
    scale = np.maximum(x.std(axis=0), 1e-6)
    w = fit_logistic(x / scale, np.array([y for _, y in seen], float))
    return Model(model.good, model.bad, (float(w[0]), *map(float, w[1:] / scale)))


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


def report(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` of every document."""
    s = score(docs, fit(docs, labels, label_col, id_col=id_col, text_col=text_col), id_col, text_col)
    return s.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))
