"""Driver queries: label expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import labels as L
from tessera.plans.queries._registry import _emb, register
from tessera.session import table


# ------------------------------------------------------------------ labels

@register("one_hot_label", """
SELECT vec_id, label,
       array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), ',') AS one_hot
FROM embeddings
""")
def q_one_hot_label(spark, sf):
    """One-hot encoding of the class label (10 classes)."""
    e = _emb(spark, sf)
    return e.select("vec_id", "label", F.array_join(L.one_hot("label", 10), ",").alias("one_hot"))


@register("argmax_onehot", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax_pos,
       CAST(list_position(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), 1) - 1
            AS INTEGER) AS label_back
FROM embeddings
""")
def q_argmax_onehot(spark, sf):
    """Arg-max over a score vector (first maximum wins); one-hot -> label."""
    e = _emb(spark, sf)
    return e.select("vec_id", A.argmax("embedding").alias("argmax_pos"),
                    A.argmax(L.one_hot("label", 10)).alias("label_back"))


@register("label_names", """
SELECT CAST(label AS INTEGER) AS label, CAST(label AS VARCHAR) AS label_name, count(*) AS n_rows
FROM embeddings GROUP BY label
""")
def q_label_names(spark, sf):
    """P5: label dimension "0".."N-1" joined to the class counts."""
    e = _emb(spark, sf)
    n_classes = e.agg(F.max("label")).first()[0] + 1
    counts = e.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    names = L.label_names(spark, n_classes)
    return counts.join(F.broadcast(names), "label").select("label", "label_name", "n_rows")


@register("label_index", """
SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_index,
       source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS source_index
FROM documents
""")
def q_label_index(spark, sf):
    """String label -> class index, alphabetical order."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    d = L.index_labels(d, "lang")
    d = L.index_labels(d, "source")
    return d.select("doc_id", "lang", "lang_index", "source", "source_index")


_SQL_PARTS = "string_split_regex(regexp_replace(url, '[/\\\\]+$', ''), '[/\\\\]')"


@register("path_labels", f"""
SELECT page_id,
       CASE WHEN len({_SQL_PARTS}) >= 2 THEN {_SQL_PARTS}[-2] END AS parent_label,
       TRY_CAST(split_part({_SQL_PARTS}[-1], '.', 1) AS INTEGER) AS base_label
FROM pages
""")
def q_path_labels(spark, sf):
    """P1 + P2: parent-directory label and numeric base-name label of a path."""
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", L.parent_dir_label("url").alias("parent_label"),
                    L.base_name_label("url").alias("base_label"))


@register("path_parent_label", f"""
SELECT page_id, CASE WHEN len({_SQL_PARTS}) >= 2 THEN {_SQL_PARTS}[-2] END AS parent_label FROM pages
""")
def q_path_parent_label(spark, sf):
    """label = name of the directory holding the file."""
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", L.parent_dir_label("url").alias("parent_label"))


@register("path_base_label", f"""
SELECT page_id, TRY_CAST(split_part({_SQL_PARTS}[-1], '.', 1) AS INTEGER) AS base_label FROM pages
""")
def q_path_base_label(spark, sf):
    """label = number before the first dot of the file's base name."""
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", L.base_name_label("url").alias("base_label"))
