"""Delimited text sources: S3 (CSV records), S4 (text lines -> features/label),
S5 (non-empty lines), P14 (cell coercion), P16 (features = all cells but label).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.labels import one_hot


def read_lines(spark: SparkSession, path: str | Sequence[str], keep_empty: bool = False,
               line_sep: str | None = None) -> DataFrame:
    """Text lines of a file or folder with their source file; empty
    lines dropped unless asked. ``line_sep`` fixes the separator (by default
    \\n, \\r and \\r\\n all end a line)."""
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    df = reader.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file_path"))
    if not keep_empty:
        df = df.where(F.col("value") != "")
    return df


def coerce(cell: Column, to: str, strict: bool = False) -> Column:
    """Text cell -> int / double. ``strict`` raises on a bad cell (ANSI
    cast), otherwise the value is NULL."""
    return cell.cast(to) if strict else cell.try_cast(to)


def split_cells(line: Column, delimiter: str) -> Column:
    """Split on a literal ``delimiter``, trim every cell, drop empty cells;
    a line without any cell gives an empty array.

    (Measured: a plain split + two small lambdas beats regex rewrites that
    would keep the step inside codegen, since Java regex costs more per row.)"""
    cells = F.split(line, re.escape(delimiter))
    return F.filter(F.transform(cells, lambda c: F.trim(c)), lambda c: c != "")


def parse_lines(lines: DataFrame, delimiter: str = ",", n_classes: int | None = None,
                line_col: str = "value", expected_width: int | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """Text lines -> (features ARRAY<DOUBLE>, label INT[, label_onehot]).

    Cells are split on ``delimiter``, trimmed, and empty cells omitted. The
    label is the last cell (as int), the features the others (as double).
    A row whose cell count differs from ``expected_width`` (when given), or
    whose cells do not parse, gets an ``error`` text and NULL features.
    """
    cells = split_cells(F.col(line_col), delimiter)
    df = lines.select(*keep, cells.alias("_cells"))
    n = F.coalesce(F.size("_cells"), F.lit(0))
    label = F.element_at("_cells", -1).try_cast("int")
    if expected_width:
        # fixed width: positional casts stay inside whole-stage codegen
        parts = [F.element_at("_cells", i + 1).try_cast("double") for i in range(expected_width - 1)]
        feats = F.array(*parts)
        bad_cell = label.isNull()
        for c in parts:
            bad_cell = bad_cell | c.isNull()
        bad_width = n != F.lit(expected_width)
    else:
        feats = F.transform(F.slice("_cells", 1, n - 1), lambda c: c.try_cast("double"))
        bad_cell = F.exists(feats, lambda x: x.isNull()) | label.isNull()
        bad_width = n < 2
    error = (F.when(n < 2, F.lit("too few cells"))
              .when(bad_width, F.concat(F.lit("expected "), F.lit(str(expected_width)), F.lit(" cells, got "),
                                        n.cast("string")))
              .when(bad_cell, F.lit("non-numeric cell")))
    if n_classes is not None:
        error = F.coalesce(error, F.when((label < 0) | (label >= n_classes), F.lit("label out of range")))
    out = df.select(*keep, error.alias("error"), feats.alias("_f"), label.alias("_l"))
    out = out.select(*keep, "error",
                     F.when(F.col("error").isNull(), F.col("_f")).alias("features"),
                     F.when(F.col("error").isNull(), F.col("_l")).alias("label"))
    if n_classes is not None:
        out = out.withColumn("label_onehot",
                             F.when(F.col("label").isNotNull(), one_hot(F.col("label"), n_classes)))
    return out


def read_delimited(spark: SparkSession, path: str | Sequence[str], n_features: int, delimiter: str = ",",
                   skip_lines: int = 0, label_index: int | None = None, n_classes: int | None = None,
                   strict: bool = False) -> DataFrame:
    """S3: delimited records with an explicit schema (no inference).

    ``label_index`` defaults to the last column. ``skip_lines`` drops the
    first lines of each file (like a header). Output: features ARRAY<DOUBLE>,
    label INT (+ label_onehot when ``n_classes``) and ``error``: a row with too
    few cells (or an empty last one), with cells too many, with a cell that is no
    number or a label outside the classes is kept, with the reason and without
    features or label, as in ``parse_lines``. ``strict`` makes such a cell an error of the job."""
    width = n_features + 1
    label_index = width - 1 if label_index is None else label_index
    # one column more than a record has: what lands there is a cell too many
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width + 1)])
    reader = spark.read.schema(schema).option("sep", delimiter).option("mode", "PERMISSIVE")
    if skip_lines == 1:
        df = reader.option("header", "true").option("enforceSchema", "true").csv(path)
    else:
        df = reader.csv(path)
    if skip_lines > 1:
        # Skipped lines can only sit in a file's first block, whose rows one task reads in order: they are the ones
        # with the smallest row ids there. The ids to skip are an aggregate of skip_lines rows per file, no sort.
        df = (df.withColumn("_file", F.col("_metadata.file_path"))
                .withColumn("_first", F.col("_metadata.file_block_start") == 0)
                .withColumn("_row", F.monotonically_increasing_id()))
        start = df.where("_first").groupBy("_file").agg(F.min("_row").alias("_row0"))
        df = df.join(start, "_file", "left") \
               .where(~F.col("_first") | (F.col("_row") >= F.col("_row0") + skip_lines)) \
               .drop("_file", "_first", "_row", "_row0")
    feat_cols = [f"c{i}" for i in range(width) if i != label_index]
    many, few = F.col(f"c{width}").isNotNull(), F.col(f"c{width - 1}").isNull()
    feats = [coerce(F.trim(F.col(c)), "double", strict) for c in feat_cols]
    label = coerce(F.trim(F.col(f"c{label_index}")), "int", strict)
    error = F.when(many, F.lit(f"more than {width} cells")).when(few, F.lit(f"fewer than {width} cells"))
    if not strict:
        bad_cell = label.isNull()
        for c in feats:
            bad_cell = bad_cell | c.isNull()
        error = error.when(bad_cell, F.lit("non-numeric cell"))
        if n_classes is not None:
            error = error.when((label < 0) | (label >= n_classes), F.lit("label out of range"))
    out = df.select("*", error.alias("error"))
    ok = F.col("error").isNull()
    out = out.select(F.when(ok, F.array(*feats)).alias("features"), F.when(ok, label).alias("label"), "error")
    if n_classes is not None:
        out = out.withColumn("label_onehot", F.when(ok, one_hot("label", n_classes)))
    return out
