"""Vector search against a NumPy brute force, both execution paths."""

import numpy as np
import pytest

from tessera.operators import vectors as V


@pytest.fixture(scope="module")
def vecs(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(300, 8))
    m[10] = m[11]  # exact duplicate vectors: ties must break by key
    m[20] = 0.0   # zero vector: no similarity
    rows = [(i, [float(x) for x in m[i]]) for i in range(300)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>"), m.astype(np.float32)


def _brute(m, k):
    x = m.astype(np.float64)
    n = np.linalg.norm(x, axis=1)
    out = {}
    for q in range(len(x)):
        if n[q] == 0:
            continue
        cands = [(-(x[q] @ x[j]) / (n[q] * n[j]), j) for j in range(len(x)) if j != q and n[j] > 0]
        out[q] = [j for _, j in sorted(cands)[:k]]
    return out


@pytest.mark.parametrize("bbytes", [256 << 20, 2000])  # one block / many blocks on either side
def test_nearest_matches_brute_force(vecs, bbytes):
    df, m = vecs
    res = V.nearest(df, df, k=3, block_bytes=bbytes).collect()
    got = {}
    for r in sorted(res, key=lambda r: (r["query_key"], r["rank"])):
        got.setdefault(r["query_key"], []).append(r["key"])
    assert got == _brute(m, 3)


def test_similarity_unknown_key_is_null(vecs, spark):
    df, m = vecs
    pairs = spark.createDataFrame([(1, 2), (1, 999), (10, 11)], "key1 long, key2 long")
    got = {(r["key1"], r["key2"]): r["similarity"] for r in V.similarity(df, pairs, "vec_id").collect()}
    assert got[(1, 999)] is None and abs(got[(10, 11)] - 1.0) < 1e-9
    x = m.astype(np.float64)
    assert abs(got[(1, 2)] - x[1] @ x[2] / np.linalg.norm(x[1]) / np.linalg.norm(x[2])) < 1e-9


def test_lookup_and_matrix(vecs, spark):
    df, m = vecs
    keys = spark.createDataFrame([(5,), (1000,)], "vec_id long")
    got = {r["vec_id"]: r["vector"] for r in V.lookup_vectors(df, keys, "vec_id").collect()}
    assert got[1000] is None and np.allclose(got[5], m[5])
    mat = df.where("vec_id = 5").select(V.vector_matrix("embedding").alias("m")).first()["m"]
    assert mat["shape"] == [1, 8] and np.allclose(mat["values"], m[5])


def test_query_slicing_same_result(vecs):
    df, m = vecs
    x = m.astype(np.float64)
    keys = np.arange(len(x), dtype=np.int64)
    unit = V._unit_rows(x)
    a = V._topk_candidates(keys, unit, keys, x, 3, True)
    b = V._topk_candidates(keys, unit, keys, x, 3, True, max_cells=1000)  # 3 queries per slice
    pa = sorted(zip(a[0].tolist(), a[1].tolist(), a[2].tolist()))
    pb = sorted(zip(b[0].tolist(), b[1].tolist(), b[2].tolist()))
    assert [(q, v) for q, v, _ in pa] == [(q, v) for q, v, _ in pb]
    assert np.allclose([s for _, _, s in pa], [s for _, _, s in pb], atol=1e-12)


@pytest.mark.parametrize("bbytes", [64 << 20, 100])
def test_nearest_with_word_keys(spark, bbytes):
    words = {"home": [1.0, 0.1, 0.0], "house": [0.9, 0.2, 0.0], "flat": [0.8, 0.3, 0.1],
             "car": [0.0, 1.0, 0.0], "truck": [0.1, 0.9, 0.0], "tree": [0.0, 0.0, 1.0]}
    df = spark.createDataFrame([(w, v) for w, v in words.items()], "word string, vector array<float>")
    queries = df.where("word in ('home', 'car')")
    got = {}
    for r in V.nearest(df, queries, k=2, key_col="word", vec_col="vector", block_bytes=bbytes).collect():
        got.setdefault(r["query_key"], []).append((r["rank"], r["key"]))
    assert sorted(got["home"]) == [(1, "house"), (2, "flat")]
    assert sorted(got["car"])[0] == (1, "truck")
    pairs = spark.createDataFrame([("home", "house"), ("home", "unknown")], "key1 string, key2 string")
    sims = {r["key2"]: r["similarity"] for r in V.similarity(df, pairs, "word", "vector").collect()}
    assert sims["unknown"] is None and sims["house"] > 0.9


def test_nearest_including_self(vecs):
    df, _ = vecs
    res = V.nearest(df, df.where("vec_id < 5"), k=1, exclude_self=False).collect()
    assert sorted((r["query_key"], r["key"]) for r in res) == [(i, i) for i in range(5)]
    assert all(abs(r["score"] - 1.0) < 1e-9 for r in res)


def test_nearest_skips_null_and_short_vectors_and_cuts_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(50, None), (51, []), (52, [1.0]), (53, [0.9, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for size in (1 << 20, 64):
        got = V.nearest(df, df.where("vec_id in (0, 50, 51, 52)"), k=3, block_bytes=size).collect()
        assert sorted((r["query_key"], r["rank"], r["key"]) for r in got) == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    x = np.ones((1000, 2))
    keys = np.arange(1000)
    assert len(V._topk_candidates(keys[:2], V._unit_rows(x[:2]), keys, x, 3, True)[0]) == 6


def test_scoring_holds_bounded_slices():
    import tracemalloc
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1 << 16, 4))
    keys = np.arange(len(x))
    unit = V._unit_rows(x[:512])
    tracemalloc.start()
    q, v, s = V._topk_candidates(keys[:512], unit, keys, x, 3, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # 512 x 65536 scores are 256 MB
    sims = unit[:5] @ V._unit_rows(x).T
    sims[np.arange(5), np.arange(5)] = -np.inf
    assert v.reshape(512, 3)[:5].tolist() == np.argsort(-sims, axis=1)[:, :3].tolist() and q.tolist() == np.repeat(keys[:512], 3).tolist()
