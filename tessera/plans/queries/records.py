"""Driver queries: text records, normalisation and sampling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import sampling as SM
from tessera.plans.queries._registry import _SQL_UE, ORACLE, _emb, _long_form, register
from tessera.session import table


# ------------------------------------------------------------------ text records

@register("text_to_features", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3,
       CAST(l_linenumber - 1 AS INTEGER) AS label,
       array_to_string(list_transform(range(7), lambda i: CASE WHEN i = l_linenumber - 1 THEN 1 ELSE 0 END), ',')
         AS one_hot,
       CAST(NULL AS VARCHAR) AS error
FROM lineitem
""")
def q_text_to_features(spark, sf):
    """Numeric columns written as delimited text (with blank and empty
    cells), parsed back into features + label + one-hot."""
    from tessera.sources.text import parse_lines
    li = table(spark, sf, "lineitem")
    text = li.select("l_orderkey", "l_linenumber",
                     F.concat_ws(",", F.col("l_quantity").cast("string"), F.lit(""),
                                 F.col("l_extendedprice").cast("string"), F.lit("  "),
                                 F.col("l_discount").cast("string"), F.col("l_tax").cast("string"),
                                 (F.col("l_linenumber") - 1).cast("string")).alias("value"))
    parsed = parse_lines(text, ",", n_classes=7, expected_width=5, keep=("l_orderkey", "l_linenumber"))
    return parsed.select("l_orderkey", "l_linenumber",
                         *[F.col("features")[i].alias(f"f{i}") for i in range(4)],
                         "label", F.array_join("label_onehot", ",").alias("one_hot"), "error")


# ------------------------------------------------------------------ normalisation

@register("scale_minmax", """
WITH r AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS mn, CAST(max(list_max(embedding)) AS DOUBLE) AS mx
           FROM embeddings),
x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings)
SELECT vec_id, CAST(pos AS BIGINT) AS pos, round((v - mn) / (mx - mn), 6) AS value FROM x, r
""")
def q_scale_minmax(spark, sf):
    """Scale every value into [0, 1] using the table's own range."""
    e = _emb(spark, sf)
    r = e.agg(F.min(F.array_min("embedding")).cast("double").alias("mn"),
              F.max(F.array_max("embedding")).cast("double").alias("mx")).first()
    scaled = e.select("vec_id", A.scale_minmax("embedding", r["mn"], r["mx"]).alias("v"))
    return _long_form(scaled, "vec_id", "v")


@register("mean_subtract", """
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
           FROM embeddings),
m AS (SELECT pos // 16 AS ch, avg(v) AS mean FROM x GROUP BY pos // 16)
SELECT vec_id, CAST(pos AS BIGINT) AS pos, round(v - mean, 6) AS value FROM x JOIN m ON x.pos // 16 = m.ch
""")
def q_mean_subtract(spark, sf):
    """Subtract per-channel means (4 channels x 16, channel-first) taken
    from the table itself."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    e = _emb(spark, sf)
    # per-position means in one partial aggregate (no row explosion); every row
    # has all positions, so a channel's mean is the mean of its positions' means
    pos_means = e.agg(vector_to_array(Summarizer.mean(array_to_vector(
        F.col("embedding").cast("array<double>")))).alias("m")).first()["m"]
    vals = [float(np.mean(pos_means[c * 16:(c + 1) * 16])) for c in range(len(pos_means) // 16)]
    sub = e.select("vec_id", A.subtract_channel_means("embedding", vals, channel_last=False,
                                                      plane_size=16).alias("v"))
    return _long_form(sub, "vec_id", "v")


# ------------------------------------------------------------------ sampling


@register("balanced_sample", f"""
WITH u AS (SELECT vec_id, label, {_SQL_UE.format(seed=13)} AS u FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, vec_id) AS rn FROM u),
m AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM embeddings GROUP BY label))
SELECT vec_id, label FROM r, m WHERE rn <= m.m
""")
def q_balanced_sample(spark, sf):
    """equal rows per class (the smallest class size), seeded choice."""
    return SM.balanced_sample(_emb(spark, sf).select("vec_id", "label"), "label", "vec_id", seed=13)


@register("split_train_test", f"""
WITH u AS (SELECT vec_id, label, {_SQL_UE.format(seed=13)} AS u FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, vec_id) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM u)
SELECT vec_id, label, CASE WHEN rn * 100 <= n * 80 THEN 'train' ELSE 'test' END AS split FROM r
""")
def q_split_train_test(spark, sf):
    """Exact per-class 80/20 split in seeded order."""
    return SM.split_train_test(_emb(spark, sf).select("vec_id", "label"), "label", "vec_id",
                               train_percent=80, seed=13)


@register("seeded_order", f"""
SELECT vec_id, row_number() OVER (ORDER BY {_SQL_UE.format(seed=123)}, vec_id) - 1 AS pos FROM embeddings
""")
def q_seeded_order(spark, sf):
    """Seeded shuffle order (0-based position)."""
    return SM.seeded_order(_emb(spark, sf).select("vec_id"), "vec_id", seed=123)


@register("minibatches", f"""
WITH o AS (SELECT vec_id, row_number() OVER (ORDER BY {_SQL_UE.format(seed=123)}, vec_id) - 1 AS pos
           FROM embeddings)
SELECT vec_id, CAST(pos // 20 AS BIGINT) AS batch_id, CAST(pos % 20 AS INTEGER) AS row_in_batch FROM o
""")
def q_minibatches(spark, sf):
    """Batches of 20 in seeded order; the last one may be short."""
    return SM.minibatches(_emb(spark, sf).select("vec_id"), "vec_id", 20, seed=123)


@register("batch_assemble", f"""
WITH o AS (SELECT vec_id, label, embedding,
                  row_number() OVER (ORDER BY {_SQL_UE.format(seed=123)}, vec_id) - 1 AS pos FROM embeddings),
b AS (SELECT pos // 20 AS batch_id, pos % 20 AS r, label, embedding FROM o),
x AS (SELECT batch_id, r, label, generate_subscripts(embedding, 1) - 1 AS p, CAST(unnest(embedding) AS DOUBLE) AS v,
             len(embedding) AS d FROM b)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(DISTINCT r) AS INTEGER) AS n_rows,
       '[' || CAST(count(DISTINCT r) AS VARCHAR) || ',' || CAST(max(d) AS VARCHAR) || ']' AS shape,
       round(sum(v * (r * d + p + 1)), 4) AS checksum,
       (SELECT string_agg(CAST(label AS VARCHAR), ',' ORDER BY r) FROM b b2 WHERE b2.batch_id = x.batch_id) AS labels
FROM x GROUP BY batch_id
""")
def q_batch_assemble(spark, sf):
    """Assemble each batch into one [rows, d] tensor (row-major) with
    its labels in row order."""
    e = _emb(spark, sf)
    mb = SM.minibatches(e, "vec_id", 20, seed=123)
    mb = mb.withColumn("features", A.as_double_array("embedding"))
    bt = SM.assemble_batches(mb, "batch_id", "row_in_batch", "features", label_col="label")
    return bt.select(
        "batch_id", F.col("n_rows").cast("int").alias("n_rows"),
        F.concat(F.lit("["), F.array_join("shape", ","), F.lit("]")).alias("shape"),
        F.round(F.aggregate(F.transform("values", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x),
                4).alias("checksum"),
        F.array_join(F.transform("labels", lambda x: x.cast("string")), ",").alias("labels"))


@register("saved_batches", f"""
WITH u AS (SELECT vec_id, label, embedding, {_SQL_UE.format(seed=13)} AS u FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, vec_id) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM u),
sp AS (SELECT vec_id, label, embedding, CASE WHEN rn * 100 <= n * 80 THEN 'train' ELSE 'test' END AS split FROM r),
b AS (SELECT vec_id, label, embedding, split,
             (row_number() OVER (PARTITION BY split ORDER BY {_SQL_UE.format(seed=123)}, vec_id) - 1) // 20
               AS batch_id FROM sp)
SELECT vec_id, label, CAST(batch_id AS BIGINT) AS batch_id, CAST(len(embedding) AS INTEGER) AS n_features,
       round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda v, i: v * i)), 6) AS checksum
FROM b WHERE split = 'test'
""")
def q_saved_batches(spark, sf):
    """T1 + T3 + K2 + K7 + S10/S11: each split, with its features, cut into
    batches of 20 in seeded order, saved once as a table partitioned by split
    (compute-if-absent), then the test split read back in batch order."""
    from tessera.session import scratch_path
    from tessera.sources.sinks import materialize, read_batches_in_order

    e = _emb(spark, sf).select("vec_id", "label", A.as_double_array("embedding").alias("features"))
    sp = SM.split_train_test(e, "label", "vec_id", 80, seed=13)
    path = scratch_path(spark, "batches")
    materialize(spark, path, lambda: SM.minibatches(sp, "vec_id", 20, seed=123, within=["split"]), partition_by=["split"])
    weighted = F.transform("features", lambda v, i: v * (i + 1))
    return read_batches_in_order(spark, path, "test").select(
        "vec_id", "label", "batch_id", F.size("features").alias("n_features"),
        F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 6).alias("checksum"))


@register("numbered_batches", ORACLE["saved_batches"])
def q_numbered_batches(spark, sf):
    """K2 + S10/S11: the test split as files numbered from 0, one per batch, read back in the order of the numbers by planned
    partitions."""
    from tessera.session import scratch_path
    from tessera.sources.listing import read_numbered, save_numbered

    e = _emb(spark, sf).select("vec_id", "label", A.as_double_array("embedding").alias("features"))
    test = SM.split_train_test(e, "label", "vec_id", 80, seed=13).where(F.col("split") == "test")
    folder = scratch_path(spark, "numbered")
    save_numbered(SM.minibatches(test, "vec_id", 20, seed=123).select("vec_id", "label", "features", "batch_id"), folder, "object-test-")
    back = read_numbered(spark, folder, "object-test-", "vec_id bigint, label int, features array<double>, batch_id bigint")
    weighted = F.transform("features", lambda v, i: v * (i + 1))
    return back.select("vec_id", "label", "batch_id", F.size("features").alias("n_features"),
                       F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 6).alias("checksum"))


@register("predict_text_lines", """
WITH x AS (SELECT CAST(l_linenumber - 1 AS INTEGER) AS label, CAST(l_quantity AS DOUBLE) * 0.07
                  + CAST(l_extendedprice AS DOUBLE) * 0.00002 + CAST(l_discount AS DOUBLE) * 3 + CAST(l_tax AS DOUBLE) * 5 AS q FROM lineitem),
z AS (SELECT label, q, k, k * q - 0.35172931234 * k * k AS z FROM x, (SELECT unnest(range(7)) AS k)),
p AS (SELECT label, arg_max(k, z) AS prediction, q, count(*) // 7 AS n FROM z GROUP BY label, q)
SELECT label, CAST(prediction AS INTEGER) AS prediction, CAST(prediction AS VARCHAR) AS predicted_name,
       CAST(sum(n) AS BIGINT) AS n
FROM p GROUP BY ALL
""")
def q_predict_text_lines(spark, sf):
    """S5 + S4 + I1 + P5: lineitem written as text lines, read back, parsed into
    features and label, scored by a fixed linear head and named; counted per
    (label, prediction)."""
    import numpy as np

    from tessera.operators.models import Model
    from tessera.plans.jobs import predict_text_lines
    from tessera.session import scratch_path
    path = scratch_path(spark, "lines")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    table(spark, sf, "lineitem").select(F.concat_ws(
        ",", *[F.col(c).cast("string") for c in cols], (F.col("l_linenumber") - 1).cast("string"))).write.text(path)
    head = Model.build([{"kind": "output", "activation": "softmax", "n_out": 7, "name": "output"}], (4,))
    w = np.arange(7.0)[:, None] * np.array([0.07, 0.00002, 3.0, 5.0])[None, :]  # every feature counts
    head.params = [{"W": w, "b": -0.35172931234 * np.arange(7.0) ** 2}]
    pred = predict_text_lines(spark, path, head, n_classes=7, expected_width=5)
    return pred.where(F.col("error").isNull()).groupBy("label", "prediction", "predicted_name") \
               .agg(F.count(F.lit(1)).alias("n"))
