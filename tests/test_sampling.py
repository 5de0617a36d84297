"""Ordering, balancing, splitting and batching against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import sampling as SM


def _u(seed, key):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)


@pytest.fixture(scope="module")
def skewed(spark):
    # one class holds a third+ of the rows (hot group), the rest is spread out
    rows = [(i, 0 if i % 3 == 0 else (i % 7) + 1) for i in range(3000)]
    return spark.createDataFrame(rows, "key long, label int")


def test_hash_uniform_matches_md5(spark):
    df = spark.range(50).select(F.col("id").alias("k"), SM.hash_uniform(13, F.col("id")).alias("u"))
    assert all(r["u"] == _u(13, r["k"]) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_global_index_any_partitioning(spark, parts):
    df = spark.range(1000).select(F.col("id").alias("k"), SM.hash_uniform(5, F.col("id")).alias("u"))
    got = {r["k"]: r["idx"] for r in SM.global_index(df, ["u", "k"], num_partitions=parts).collect()}
    expect = sorted(range(1000), key=lambda k: (_u(5, k), k))
    assert [got[k] for k in expect] == list(range(1000))


def test_rank_within_groups_hot_group(skewed):
    u = skewed.withColumn("u", SM.hash_uniform(1, F.col("key")))
    got = {r["key"]: (r["rank"], r["n"]) for r in
           SM.rank_within_groups(u, ["label"], "u", "key", size_col="n", bucket_bits=6).collect()}
    by = {}
    for r in skewed.collect():
        by.setdefault(r["label"], []).append(r["key"])
    for lab, keys in by.items():
        for i, k in enumerate(sorted(keys, key=lambda k: (_u(1, k), k))):
            assert got[k] == (i + 1, len(keys))


def test_balanced_sample_sizes(skewed):
    out = SM.balanced_sample(skewed, "label", "key", seed=13)
    counts = dict(out.groupBy("label").count().collect())
    smallest = min(dict(skewed.groupBy("label").count().collect()).values())
    assert set(counts.values()) == {smallest} and len(counts) == 8


def test_split_exact_and_stable(spark, skewed):
    a = {r["key"]: r["split"] for r in SM.split_train_test(skewed, "label", "key", 80, seed=13).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = {r["key"]: r["split"] for r in SM.split_train_test(skewed, "label", "key", 80, seed=13).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b
    for lab, n in skewed.groupBy("label").count().collect():
        n_train = sum(1 for r in skewed.where(F.col("label") == lab).collect() if a[r["key"]] == "train")
        assert n_train == (n * 80) // 100


def test_split_guard(skewed):
    with pytest.raises(ValueError):
        SM.split_train_test(skewed, "label", "key", 100)


def test_approximate_split(skewed):
    out = SM.split_train_test(skewed, "label", "key", 80, exact=False).groupBy("split").count().collect()
    share = dict(out)["train"] / 3000
    assert 0.75 < share < 0.85


def test_minibatches_last_short(spark):
    df = spark.range(45).select(F.col("id").alias("k"))
    b = SM.minibatches(df, "k", 20, seed=123).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in b] == [20, 20, 5]


def test_assemble_batches_rank(spark):
    df = spark.createDataFrame([(0, i, [float(i)] * 4, i % 2) for i in range(3)],
                               "b long, r int, f array<double>, l int")
    out = SM.assemble_batches(df, "b", "r", "f", "l", extra_shape=[1, 2, 2]).first()
    assert out["shape"] == [3, 1, 2, 2] and out["values"][:5] == [0.0, 0.0, 0.0, 0.0, 1.0]
    assert out["labels"] == [0, 1, 0]
    with pytest.raises(ValueError, match="rank"):
        SM.assemble_batches(df, "b", "r", "f", extra_shape=[1, 1, 2, 2])


def test_running_totals(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(200)], "b long, v long")
    got = {r["b"]: r["cum_v"] for r in SM.running_totals(df, "b", ["v"], num_partitions=5).collect()}
    assert [got[i] for i in range(200)] == list(np.cumsum([i % 4 for i in range(200)]))


def test_split_without_classes(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    out = dict(SM.split_train_test(df, None, "k", 70, seed=3).groupBy("split").count().collect())
    assert out == {"train": 700, "test": 300}


def test_null_labels_are_a_group_of_their_own(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(200)], "k long, lab int")
    out = SM.split_train_test(df, "lab", "k", 80).collect()
    assert len(out) == 200
    n = {lab: sum(r["split"] == "train" for r in out if r["lab"] == lab) for lab in (None, 0, 1)}
    assert n == {None: 40, 0: 40, 1: 80}
    assert SM.seeded_order(df.withColumn("k", F.when(F.col("k") < 190, F.col("k"))), "k").count() == 200


def test_bucket_count_follows_the_table():
    assert SM.bucket_bits_for(1000) < SM.bucket_bits_for(10**7) < SM.bucket_bits_for(10**11) <= 30
    assert 10**11 / 2 ** SM.bucket_bits_for(10**11) <= SM.ROWS_PER_BUCKET
