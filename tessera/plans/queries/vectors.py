"""Driver queries: vector table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import vectors as V
from tessera.plans.queries._registry import _SQL_COS, ORACLE, _emb, register
from tessera.session import scratch_path, table


# ------------------------------------------------------------------ vectors

@register("nearest_topk", f"""
WITH s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id,
         {_SQL_COS.format(a='a.embedding', b='b.embedding')} AS sim
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, neighbor_id) AS rnk
      FROM s WHERE sim IS NOT NULL)
SELECT query_id, neighbor_id, CAST(rnk AS BIGINT) AS rank, round(sim, 6) AS similarity
FROM r WHERE rnk <= 3
""")
def q_nearest_topk(spark, sf):
    """V2: the 3 nearest other vectors (cosine) of every vector whose id divides by 20, among all vectors."""
    emb = _emb(spark, sf)
    res = V.nearest(emb, emb.where(F.col("vec_id") % 20 == 0), k=3, key_col="vec_id", vec_col="embedding", exclude_self=True)
    return res.select(F.col("query_key").alias("query_id"), F.col("key").alias("neighbor_id"),
                      F.col("rank").cast("bigint").alias("rank"),
                      F.round("score", 6).alias("similarity"))


@register("nearest_indexed", ORACLE["nearest_topk"])
def q_nearest_indexed(spark, sf):
    """V2: the same neighbours from an inverted-file index with every cell probed (its exact path)."""
    from tessera.operators import ivf
    emb = _emb(spark, sf)
    index = ivf.build(emb, scratch_path(spark, "ivf"))
    res = ivf.search(index, emb.where(F.col("vec_id") % 20 == 0), k=3, probes=None)
    return res.select(F.col("query_key").alias("query_id"), F.col("key").alias("neighbor_id"),
                      F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("similarity"))


@register("nearest_indexed_recall", f"""
WITH q AS (SELECT count(*) AS n FROM embeddings WHERE vec_id % 20 = 0)
SELECT (SELECT count(*) FROM embeddings) AS n_indexed, 3 * n AS n_exact, true AS recall_at_least_0_9 FROM q
""")
def q_nearest_indexed_recall(spark, sf):
    """V2: rows in the index, and whether the cells it chose to probe find nine of ten exact neighbours."""
    from tessera.operators import ivf
    emb = _emb(spark, sf)
    queries = emb.where(F.col("vec_id") % 20 == 0)
    index = ivf.build(emb, scratch_path(spark, "ivf"))
    found = ivf.recall(ivf.search(index, queries, k=3), V.nearest(emb, queries, k=3))
    return found.select(F.lit(index.table(spark).count()).alias("n_indexed"), "n_exact",
                        (F.col("recall") >= 0.9).alias("recall_at_least_0_9"))


@register("vector_similarity", f"""
SELECT a.vec_id AS key1, a.vec_id + 1 AS key2,
       round({_SQL_COS.format(a='a.embedding', b='b.embedding')}, 6) AS similarity
FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def q_vector_similarity(spark, sf):
    """V1: similarity of each key with the next key (unknown key -> NULL)."""
    emb = _emb(spark, sf)
    pairs = emb.select(F.col("vec_id").alias("key1"), (F.col("vec_id") + 1).alias("key2"))
    out = V.similarity(emb, pairs, "vec_id", "embedding", "key1", "key2")
    return out.select("key1", "key2", F.round("similarity", 6).alias("similarity"))


@register("vector_lookup", """
SELECT l.doc_id, CAST(p.pos AS BIGINT) AS pos, p.value
FROM labels l LEFT JOIN (
  SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS value
  FROM embeddings) p ON p.vec_id = l.doc_id
""")
def q_vector_lookup(spark, sf):
    """V3: the vectors of the keys named by another table (labels.doc_id)."""
    keys = table(spark, sf, "labels").select("doc_id")
    found = V.lookup_vectors(_emb(spark, sf), keys, key_col="vec_id", keys_key="doc_id")
    return found.select("doc_id", F.posexplode_outer("vector").alias("pos", "value")) \
                .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "value")


@register("vector_matrix", """
SELECT vec_id, '[1,' || CAST(len(embedding) AS VARCHAR) || ']' AS shape,
       CAST(len(embedding) AS BIGINT) AS n_values,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS value_sum
FROM embeddings
""")
def q_vector_matrix(spark, sf):
    """V4: each vector as a 1 x d matrix."""
    m = _emb(spark, sf).select("vec_id", V.vector_matrix("embedding").alias("m"))
    return m.select("vec_id",
                    F.concat(F.lit("["), F.array_join(F.col("m.shape"), ","), F.lit("]")).alias("shape"),
                    F.size("m.values").cast("bigint").alias("n_values"),
                    F.round(F.aggregate("m.values", F.lit(0.0), lambda a, x: a + x), 6).alias("value_sum"))


@register("vector_scan", f"""
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim,
       round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm
FROM embeddings
""")
def q_vector_scan(spark, sf):
    """Scan every vector (dimension and norm)."""
    return V.vector_norms(_emb(spark, sf)).select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("norm", 6).alias("norm"))
