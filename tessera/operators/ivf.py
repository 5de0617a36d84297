"""V2 at scale: an inverted-file index over a vector table, searched by cosine similarity.

``build`` fits cells (spherical k-means) on a bounded sample and writes *every*
row to the vector table, partitioned by the cell of its direction. ``search``
looks each query up in the cells nearest to it only. Cells no query probes are
pruned at the scan; a cell of many rows is cut into blocks of bounded bytes, as
are its queries, and a block pair is one task. How many cells to probe is
measured at build time: the fewest that find ``target`` of the true neighbours of
sample vectors. Probing all cells is exact (``probes=None``), and
``vectors.nearest`` needs no index at all.

Documented bound: at most ``SAMPLE`` vectors, those of smallest key hash, reach
the driver for the fit, and at most ``MAX_CELLS`` centroids are broadcast.

Rows: a null or empty vector is not indexed (it has no similarity to any); zero
vectors and vectors of another length than the cells' are indexed in cell -1, which a
query of such a length probes; only vectors of the query's length are compared. A
query without a vector gives no rows. Repeated keys are rows of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import as_double_array
from tessera.operators.sampling import hash_uniform
from tessera.operators.vectors import _stack, _topk_candidates, _unit_rows

SAMPLE = 20_000
MAX_CELLS = 1024
#: sample vectors a cell is fitted on, at least
PER_CELL = 16
BLOCK_BYTES = 32 << 20
#: scores of rows and cells that a task holds at a time
SCORES = 1 << 20
NO_CELL = -1


@dataclass(frozen=True)
class Index:
    """Where the vectors lie, the cells' unit centroids, and how many cells to probe."""
    path: str
    centroids: np.ndarray
    probes: int
    key_type: str

    @property
    def n_cells(self) -> int:
        return len(self.centroids)

    def table(self, spark: SparkSession) -> DataFrame:
        """``key, vector, n_blocks, block, cell``."""
        schema = f"key {self.key_type}, vector array<double>, n_blocks int, block int, cell int"
        return spark.read.schema(schema).parquet(f"{self.path}/vectors")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Index":
        r = spark.read.parquet(f"{path}/cells").first()
        d = json.loads(r["text"])
        return Index(path, np.array(d["centroids"]).reshape(d["shape"]), d["probes"], d["key_type"])


def _units(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1.0)


def fit_cells(sample: np.ndarray, n_cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids by spherical k-means, started from evenly spaced sample rows; an empty cell keeps its centroid."""
    x = _units(sample)
    centroids = x[np.linspace(0, len(x) - 1, n_cells).astype(int)].copy()
    for _ in range(rounds):
        cell = (x @ centroids.T).argmax(axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, cell, x)
        held = np.bincount(cell, minlength=n_cells) > 0
        centroids[held] = _units(total[held])
    return centroids


def choose_probes(sample: np.ndarray, centroids: np.ndarray, k: int, target: float, n_queries: int = 500) -> int:
    """The fewest probed cells with which ``target`` of the k nearest sample vectors of sample queries are found."""
    x = _units(sample)
    q = x[:n_queries]
    k = min(k, len(x) - 1)
    if k < 1:
        return len(centroids)
    sims = q @ x.T
    sims[np.arange(len(q)), np.arange(len(q))] = -np.inf
    true = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    cell = (x @ centroids.T).argmax(axis=1)
    order = np.argsort(-(q @ centroids.T), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centroids))[None, :], axis=1)
    needed = np.sort(np.take_along_axis(rank, cell[true], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) + 1


def _vectors(df: DataFrame, key_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(key_col).alias("key"), as_double_array(vec_col).alias("vector")).where(F.size("vector") > 0)


def _with_cells(batches: Iterator[pa.RecordBatch], at: int, c: np.ndarray, probes: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to at most ``SCORES`` scores each, with ``cells`` of the vectors in column ``at``."""
    dim, probes = c.shape[1], min(probes, len(c))
    step = max(1, SCORES // len(c))
    for b in (whole.slice(lo, step) for whole in batches for lo in range(0, whole.num_rows, step)):
        col = b.column(at)
        fits = np.flatnonzero(np.diff(col.offsets.to_numpy()) == dim)
        x = col.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(len(fits), dim)
        good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        top = np.argsort(-(x[good] @ c.T), axis=1, kind="stable")[:, :probes]
        counts = np.ones(b.num_rows, dtype=np.int64)
        counts[fits[good]] = probes
        ends = np.cumsum(counts)
        flat = np.full(ends[-1], NO_CELL, dtype=np.int32)
        flat[(ends[fits[good]] - probes)[:, None] + np.arange(probes)] = top
        cells = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([*b.columns, cells], names=[*b.schema.names, "cells"])


def nearest_cells(rows: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """``rows`` (with ``vector``) with ``cells``: the ``probes`` cells nearest to each, nearest first; ``[-1]`` for vectors that
    have none."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)
    at = rows.columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_cells(batches, at, shared.value, probes)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))


def build(vectors: DataFrame, path: str, key_col: str = "vec_id", vec_col: str = "embedding", n_cells: int | None = None,
          k: int = 10, target: float = 0.95, sample: int = SAMPLE, seed: int = 13, block_bytes: int = BLOCK_BYTES) -> Index:
    """Fit cells and write the index below ``path``: ``vectors`` partitioned by cell, and ``cells``."""
    spark = vectors.sparkSession
    rows = _vectors(vectors, key_col, vec_col)
    # the most frequent length (ties: the shorter) is the index's
    dims = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").limit(1).collect()
    if not dims:
        dim, total, drawn = 1, 0, np.ones((1, 1))
    else:
        dim, total = dims[0]["d"], dims[0]["count"]
        # keys are picked by hash first, vectors of the picked hashes read after
        of = F.xxhash64(hash_uniform(seed, F.col("key")), "vector")
        picked = [r[0] for r in rows.where(F.size("vector") == dim).select(of.alias("h")).orderBy("h").limit(sample).collect()]
        head = rows.where((F.size("vector") == dim) & (of <= picked[-1])).withColumn("h", of).orderBy("h", "vector").limit(sample)
        drawn = np.stack([np.asarray(v) for v in head.select("vector").toArrow()["vector"].to_numpy()]).reshape(-1, dim)
        drawn = drawn[np.isfinite(drawn).all(axis=1) & (drawn != 0).any(axis=1)]
        if not len(drawn):
            drawn = np.ones((1, dim))
    if n_cells is None:
        n_cells = int(np.sqrt(total))
    n_cells = max(1, min(n_cells, MAX_CELLS, -(-len(drawn) // PER_CELL)))
    centroids = fit_cells(drawn, n_cells)
    probes = choose_probes(drawn, centroids, k, target)

    assigned = nearest_cells(rows, centroids, 1).select("key", "vector", F.get("cells", F.lit(0)).alias("cell"))
    assigned.write.mode("overwrite").parquet(f"{path}/assigned")  # the cells' sizes are needed before the blocks
    assigned = spark.read.parquet(f"{path}/assigned")
    sizes = assigned.groupBy("cell").agg(F.sum(F.size("vector").cast("long") * 8).alias("bytes"))
    blocks = sizes.select("cell", F.ceil(F.col("bytes") / block_bytes).cast("int").alias("n_blocks"))  # a row per cell
    out = assigned.join(F.broadcast(blocks), "cell") \
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int"))
    out.select("key", "vector", "n_blocks", "block", "cell").repartition("cell", "block").sortWithinPartitions("cell", "block") \
        .write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    from tessera.sources.sinks import delete_path
    delete_path(spark, f"{path}/assigned")
    key_type = rows.schema["key"].dataType.simpleString()
    meta = json.dumps({"centroids": centroids.ravel().tolist(), "shape": list(centroids.shape), "probes": probes, "key_type": key_type})
    spark.createDataFrame([(meta,)], "text string").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return Index(path, centroids, probes, key_type)


def search(index: Index, queries: DataFrame, k: int = 3, query_key: str = "vec_id", query_vec: str = "embedding",
           exclude_self: bool = True, probes: int | None = 0, block_queries: int = 4096) -> DataFrame:
    """``query_key, key, score, rank`` as of ``vectors.nearest``, among the vectors of the probed cells.

    ``probes``: cells per query; 0 takes what ``build`` chose, None probes all, which is exact.
    """
    spark = queries.sparkSession
    table = index.table(spark)
    probes = index.n_cells if probes is None else min(index.n_cells, probes or index.probes)
    q = _vectors(queries, query_key, query_vec)
    kind = q.schema["key"].dataType
    probed = nearest_cells(q, index.centroids, probes).select("key", "vector", F.explode("cells").alias("cell"))
    cells = [r["cell"] for r in probed.select("cell").distinct().collect()]  # at most the number of cells
    # per cell: blocks of vectors (from the index) and blocks of queries
    sizes = table.where(F.col("cell").isin(cells)).select("cell", "n_blocks").distinct()  # a row per cell
    asked = probed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("q_blocks"))
    grid = F.broadcast(sizes.join(F.broadcast(asked), "cell"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = probed.join(grid, "cell").withColumn("qb", F.pmod(F.xxhash64("key"), F.col("q_blocks")).cast("int")) \
        .withColumn("block", spread("n_blocks")).select("cell", "block", "qb", "key", "vector")
    right = table.where(F.col("cell").isin(cells)).select("key", "vector", "cell", "block") \
        .join(grid.select("cell", "q_blocks"), "cell").withColumn("qb", spread("q_blocks")) \
        .select("cell", "block", "qb", "key", "vector")
    schema = T.StructType([T.StructField("query_key", kind), T.StructField("key", table.schema["key"].dataType),
                           T.StructField("score", T.DoubleType())])

    def score(qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for d in set(qs["vector"].map(len)) & set(vs["vector"].map(len)):
            a, b = qs[qs["vector"].map(len) == d], vs[vs["vector"].map(len) == d]
            qk, vk = a["key"].to_numpy(), b["key"].to_numpy()
            qi, vi, s = _topk_candidates(qk, _unit_rows(_stack(a["vector"])), vk, _stack(b["vector"]), k, exclude_self)
            parts.append(pd.DataFrame({"query_key": qk[qi], "key": vk[vi], "score": s}))
        return pd.concat(parts) if parts else pd.DataFrame({"query_key": [], "key": [], "score": []})

    on = ["cell", "block", "qb"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(score, schema)
    best = Window.partitionBy("query_key").orderBy(F.col("score").desc(), F.col("key").asc())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``n_exact, n_found, recall``: the share of the exact neighbours that were found (one row)."""
    hit = found.select("query_key", "key", F.lit(1).alias("hit")).distinct()
    return exact.select("query_key", "key").join(hit, ["query_key", "key"], "left") \
        .agg(F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found"),
             (F.count("hit") / F.count(F.lit(1))).alias("recall"))
