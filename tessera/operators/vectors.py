"""Vector table operators: S14 scan, V1 similarity, V2 top-k nearest, V3/V4 lookup.

V2 never materialises query x vector pairs as rows, and has one plan at every
size: both sides are cut into hash blocks of a bounded number of bytes, and a
co-grouped task scores one query block against one vector block with matrix
products (slices of at most 2^21 scores). A task keeps the k best per query in
the final order (score desc, key asc), so ties never add rows; at most
k x vector blocks candidates per query are ranked by a window that Spark
limits to k rows before its shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import as_double_array, cosine, l2_norm


def scan_vectors(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Iterate every vector (a projection; the scan reads one column)."""
    return vectors.select(vec_col)


def lookup_vectors(vectors: DataFrame, keys: DataFrame, key_col: str, vec_col: str = "embedding",
                   keys_key: str | None = None) -> DataFrame:
    """V3: the vector of each requested key (NULL for an unknown key)."""
    from tessera.operators.joins import left_join_nonnull
    keys_key = keys_key or key_col
    right = vectors.select(F.col(key_col).alias("_k"), as_double_array(vec_col).alias("vector"))
    return left_join_nonnull(keys, right, keys_key, "_k").drop("_k")


def vector_matrix(vec: Column | str) -> Column:
    """V4: a vector as a 1 x d matrix struct(shape, values)."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.when(v.isNotNull(), F.struct(F.array(F.lit(1), F.size(v)).alias("shape"),
                                          as_double_array(v).alias("values")))


def similarity(vectors: DataFrame, pairs: DataFrame, key_col: str, vec_col: str = "embedding",
               left: str = "key1", right: str = "key2", out_col: str = "similarity") -> DataFrame:
    """V1: cosine similarity of two keys per row of ``pairs``; an unknown key
    (or a zero vector) gives NULL. Two equi-joins on the key."""
    from tessera.operators.joins import left_join_nonnull
    a = vectors.select(F.col(key_col).alias("_ka"), F.col(vec_col).alias("_va"))
    b = vectors.select(F.col(key_col).alias("_kb"), F.col(vec_col).alias("_vb"))
    out = left_join_nonnull(left_join_nonnull(pairs, a, left, "_ka"), b, right, "_kb")
    return out.withColumn(out_col, cosine("_va", "_vb")).drop("_ka", "_va", "_kb", "_vb")


# ---------------------------------------------------------------- V2 top-k

def _unit_rows(mat: np.ndarray) -> np.ndarray:
    out = np.empty(mat.shape)
    step = max(1, (1 << 18) // max(1, mat.shape[1]))
    for lo in range(0, len(mat), step):  # by slices: what a step needs besides the result stays small
        part = mat[lo:lo + step]
        with np.errstate(invalid="ignore", divide="ignore"):
            unit = part / np.linalg.norm(part, axis=1, keepdims=True)
        unit[~np.isfinite(unit).all(axis=1)] = np.nan  # zero vector: no similarity
        out[lo:lo + step] = unit
    return out


def _topk_candidates(q_keys: np.ndarray, q_unit: np.ndarray, v_keys: np.ndarray, v_mat: np.ndarray,
                     k: int, exclude_self: bool, max_cells: int = 1 << 21
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query: its ``k`` best vectors here by (score desc, key asc), as
    (query position, vector position, score).

    The score matrix is built for slices of the queries so that one slice
    holds at most ``max_cells`` scores (16 MiB by default; ranking takes as
    much again), whatever the number of queries or the batch size. Keys may be
    of any type."""
    if len(v_keys) == 0 or len(q_keys) == 0:
        e = np.empty(0, dtype=np.int64)
        return e, e, np.empty(0)
    by_key = np.argsort(np.asarray(v_keys), kind="stable")  # ties go to the smaller key
    v_keys, v_unit = np.asarray(v_keys)[by_key], _unit_rows(v_mat[by_key]).T  # (d, n)
    n = v_unit.shape[1]
    kk = min(k, n)
    step = max(1, max_cells // n)
    out_q, out_v, out_s = [], [], []
    for lo in range(0, len(q_keys), step):
        sims = q_unit[lo:lo + step] @ v_unit  # (slice, n)
        sims[np.isnan(sims)] = -np.inf
        if exclude_self:
            sims[np.asarray(q_keys[lo:lo + step])[:, None] == v_keys[None, :]] = -np.inf
        kth = np.partition(sims, n - kk, axis=1)[:, n - kk].copy()  # not a view that keeps the slice
        for i, (row, low) in enumerate(zip(sims, kth)):
            at = np.flatnonzero((row >= low) & np.isfinite(row))
            at = at[np.argsort(-row[at], kind="stable")[:k]]
            out_q.append(np.full(len(at), lo + i))
            out_v.append(by_key[at])
            out_s.append(row[at])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _stack(series: pd.Series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series.to_numpy()])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 3, key_col: str = "vec_id",
            vec_col: str = "embedding", query_key: str | None = None, query_vec: str | None = None,
            exclude_self: bool = True, block_bytes: int = 32 << 20) -> DataFrame:
    """V2: for each query row, the ``k`` nearest vectors by cosine similarity.

    Returns ``(query_key, key, score, rank)``; ``rank`` 1..k by score desc,
    key asc. Keys keep their type (ids or words). A vector with the query's
    own key is skipped when ``exclude_self``. Rows with a NULL or empty vector
    take no part on either side, and only vectors of the query's length are
    compared. ``block_bytes`` bounds the vectors of one block.
    """
    query_key = query_key or key_col
    query_vec = query_vec or vec_col

    def side(df: DataFrame, key: str, vec: str, k_name: str, v_name: str) -> DataFrame:
        return df.select(F.col(key).alias(k_name), as_double_array(vec).alias(v_name)).where(F.size(v_name) > 0) \
                 .withColumn("d", F.size(v_name))

    def blocks(df: DataFrame, name: str) -> int:
        total = df.agg(F.sum(F.col("d").cast("long") * 8)).first()[0] or 0
        return max(1, int(-(-total // block_bytes)))

    q, v = side(queries, query_key, query_vec, "qk", "qv"), side(vectors, key_col, vec_col, "vk", "vv")
    nq, nv = blocks(q, "qv"), blocks(v, "vv")
    schema = T.StructType([T.StructField("query_key", q.schema["qk"].dataType),
                           T.StructField("key", v.schema["vk"].dataType),
                           T.StructField("score", T.DoubleType())])
    # a block pair is one task: its query block and its vector block, both bounded in bytes
    qb = (q.withColumn("qb", F.pmod(F.xxhash64("qk"), F.lit(nq)))
           .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1)).cast("array<bigint>"))))
    vb = (v.withColumn("vb", F.pmod(F.xxhash64("vk"), F.lit(nv)))
           .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<bigint>"))))

    def score_block(qpdf: pd.DataFrame, vpdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(vpdf) == 0:
            return pd.DataFrame({"query_key": [], "key": [], "score": []})
        qkeys, vkeys = qpdf["qk"].to_numpy(), vpdf["vk"].to_numpy()
        qi, vi, sc = _topk_candidates(qkeys, _unit_rows(_stack(qpdf["qv"])), vkeys, _stack(vpdf["vv"]),
                                      k, exclude_self)
        return pd.DataFrame({"query_key": qkeys[qi], "key": vkeys[vi], "score": sc})

    keys = ["d", "qb", "vb"]
    cands = qb.groupBy(*keys).cogroup(vb.groupBy(*keys)).applyInPandas(score_block, schema)
    w = Window.partitionBy("query_key").orderBy(F.col("score").desc(), F.col("key").asc())
    return (cands.withColumn("rank", F.row_number().over(w))
                 .where(F.col("rank") <= k))


def vector_norms(vectors: DataFrame, key_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    return vectors.select(key_col, F.size(vec_col).alias("dim"), l2_norm(vec_col).alias("norm"))
