"""Label expressions: P1 parent-directory label, P2 base-name label, P4 one-hot,
P5 label names, plus the label-index join (P3) built on a scalable ordered index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax  # re-export (P8)

__all__ = ["strip_trailing_slashes", "path_parts", "parent_dir_label", "base_name_label",
           "one_hot", "label_names", "index_labels", "argmax"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_trailing_slashes(path) -> Column:
    """Paths are normalised like a file object would: trailing separators dropped."""
    return F.regexp_replace(_col(path), r"[/\\]+$", "")


def path_parts(path) -> Column:
    return F.split(strip_trailing_slashes(path), r"[/\\]")


def parent_dir_label(path) -> Column:
    """The name of the directory that holds the file."""
    parts = path_parts(path)
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2))


def base_name(path) -> Column:
    return F.element_at(path_parts(path), -1)


def base_name_label(path) -> Column:
    """The file's base name up to its first dot, as int (NULL if not numeric)."""
    stem = F.split(base_name(path), r"\.", 2).getItem(0)
    return stem.try_cast("int")


def one_hot(label, n_classes: int) -> Column:
    """Array of n_classes ints, 1 at the label's position.

    A label outside [0, n_classes) is an error, not a silent zero row."""
    lab = _col(label).cast("int")
    checked = F.when((lab >= 0) & (lab < n_classes), lab).otherwise(
        F.raise_error(F.concat(F.lit("label out of range: "), lab.cast("string"))))
    if n_classes <= 4096:
        # explicit positions: no lambda, stays inside whole-stage codegen
        return F.array(*[(checked == F.lit(i)).cast("int") for i in range(n_classes)])
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda i: (i == checked).cast("int"))


def label_names(spark: SparkSession, n_classes: int) -> DataFrame:
    """P5: the default label dimension ``(label, label_name)`` = ("0".."N-1")."""
    return spark.range(n_classes).select(F.col("id").cast("int").alias("label"),
                                         F.col("id").cast("string").alias("label_name"))


def index_labels(df: DataFrame, label_col: str, index_col: str | None = None) -> DataFrame:
    """String label -> 0-based class index in alphabetical order.

    The dictionary is built from the distinct labels only (a partial
    aggregate, so a hot label costs nothing extra), ordered with the
    scalable global index, and joined back; Spark picks the join by the
    dictionary's measured size. Rows without a label bypass the join.
    """
    from tessera.operators.joins import left_join_nonnull
    from tessera.operators.sampling import global_index

    index_col = index_col or f"{label_col}_index"
    distinct = df.select(label_col).where(F.col(label_col).isNotNull()).distinct()
    dictionary = global_index(distinct, [F.col(label_col)], index_col=index_col)
    dictionary = dictionary.select(F.col(label_col).alias("_lab"), F.col(index_col).cast("int").alias(index_col))
    return left_join_nonnull(df, dictionary, label_col, "_lab").drop("_lab")
