"""Bounded, reproducible training samples, and a small logistic fit on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: longest text used for training (scoring has no such limit)
MAX_CHARS = 20_000


def held_out(id_col: str = "doc_id"):
    """Rows that no label is learned from: crc32 of the id as text divides by 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id",
                    text_col: str = "text", max_chars: int = MAX_CHARS) -> list[tuple[str, int]]:
    """At most ``per_class`` (text, label) rows of each label 0 and 1, in the order of a hash of the id.

    Held-out rows, null ids, labels other than 0 and 1 and texts above
    ``max_chars`` are not used; equal texts count once. The ids picked, at most
    ``2 * per_class`` numbers, are what is broadcast.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")) \
        .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id"))
    picked = None
    for y in (0, 1):
        part = known.filter(F.col("_y") == y).dropDuplicates(["_id"]) \
            .orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")) \
        .filter(F.char_length("_text") <= max_chars)
    rows = texts.join(F.broadcast(picked), "_id").select("_id", "_text", "_y").collect()
    return sorted({(r["_text"], int(r["_y"])): None for r in sorted(rows, key=lambda r: (r["_id"], r["_text"]))})


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights (bias first) of a logistic regression on few columns, by Newton steps."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-6, *[l2] * x.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        grad = z.T @ (p - y) / len(y) + ridge @ w
        hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z / len(y) + ridge
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w
