"""Inverted-file index: every row indexed, exact with all cells, recall with the chosen ones."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ivf
from tessera.operators import vectors as V

from conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(20, 12))
    rows = [(i, [float(x) for x in centers[i % 20 if i % 3 else 0] + 0.3 * rng.normal(size=12)]) for i in range(2400)]
    rows += [(9000, [0.0] * 12), (9001, None), (9002, []), (9003, [1.0, 2.0]), (9004, [2.0, 4.1]), (9005, [float("nan")] * 12)]
    return spark.createDataFrame(rows, SCHEMA)


def _pairs(df):
    return sorted((r["query_key"], r["key"], r["rank"], round(r["score"], 9)) for r in df.collect())


def test_every_row_is_indexed_and_all_cells_are_exact(spark, clustered, tmpdir_fresh):
    index = ivf.build(clustered, f"{tmpdir_fresh}/i", n_cells=16, block_bytes=5_000)
    table = index.table(spark)
    assert sorted(r["key"] for r in table.select("key").collect()) == sorted(
        r["vec_id"] for r in clustered.where(F.size("embedding") > 0).select("vec_id").collect())
    assert table.where("cell = -1").count() == 4 and table.agg(F.max("block")).first()[0] > 2  # the large cell is cut
    q = clustered.where("vec_id % 7 = 0 OR vec_id >= 9000")
    want = _pairs(V.nearest(clustered, q, k=3))
    assert _pairs(ivf.search(index, q, k=3, probes=None)) == want
    assert _pairs(ivf.search(index, q, k=3, probes=None, block_queries=10)) == want
    again = ivf.Index.load(spark, f"{tmpdir_fresh}/i")
    assert np.array_equal(again.centroids, index.centroids) and again.probes == index.probes


def test_chosen_cells_reach_the_recall(spark, clustered, tmpdir_fresh):
    index = ivf.build(clustered, f"{tmpdir_fresh}/i")
    q = clustered.where("vec_id % 20 = 0")
    r = ivf.recall(ivf.search(index, q, k=3), V.nearest(clustered, q, k=3)).first()
    assert r["recall"] >= 0.9 and index.probes < index.n_cells / 2
    one = ivf.recall(ivf.search(index, q, k=3, probes=1), V.nearest(clustered, q, k=3)).first()
    assert 0 < one["recall"] <= r["recall"]


def test_recall_on_the_embeddings_table(spark, tmpdir_fresh):
    emb = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    index = ivf.build(emb, f"{tmpdir_fresh}/i")
    q = emb.where("vec_id % 20 = 0")
    assert index.table(spark).count() == emb.count()
    assert ivf.recall(ivf.search(index, q, k=3), V.nearest(emb, q, k=3)).first()["recall"] >= 0.9


def test_same_cells_whatever_the_partitions(spark, clustered, tmpdir_fresh):
    a, b = (ivf.build(clustered.repartition(n), f"{tmpdir_fresh}/p{n}", sample=500) for n in (1, 7))
    assert np.allclose(a.centroids, b.centroids) and a.probes == b.probes


def test_unprobed_cells_are_pruned(spark, clustered, tmpdir_fresh):
    index = ivf.build(clustered, f"{tmpdir_fresh}/i", n_cells=16)
    plan = ivf.search(index, clustered.where("vec_id = 5"), probes=1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell#\d+ (IN|=)", plan)


def test_empty_and_small_tables(spark, clustered, tmpdir_fresh):
    empty = ivf.build(clustered.limit(0), f"{tmpdir_fresh}/e")
    assert ivf.search(empty, clustered.limit(5)).count() == 0
    few = ivf.build(clustered.where("vec_id < 2"), f"{tmpdir_fresh}/f")
    assert ivf.search(few, clustered.where("vec_id < 2"), k=3).count() == 2
    assert ivf.search(few, clustered.limit(0)).count() == 0


def test_cells_of_a_large_batch_are_made_in_slices():
    import tracemalloc

    import pyarrow as pa
    rng = np.random.default_rng(6)
    c = ivf._units(rng.normal(size=(1024, 4)))
    x = rng.normal(size=(6000, 4))
    x[17] = 0.0
    vectors = [r.tolist() for r in x]
    vectors[18] = [1.0, 2.0]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6000)), pa.array(vectors, pa.list_(pa.float64()))], names=["key", "vector"])
    seen, want = 0, np.argsort(-(x @ c.T), axis=1, kind="stable")
    tracemalloc.start()
    for b in ivf._with_cells(iter([batch]), 1, c, 5000):
        for key, cells in zip(b.column("key").to_pylist()[:20], b.column("cells").slice(0, 20).to_pylist()):
            assert cells == ([-1] if key in (17, 18) else want[key].tolist())
        assert b.column("key").to_pylist() == list(range(seen, seen + b.num_rows))
        seen += b.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 6000 and peak < 64 << 20  # 6000 x 1024 cells as Python lists are over 200 MB
