"""URL manifests — every file of a folder is one class; each line is
space-separated and its second token is an image URL. Builds the download
plan (class directory, local name, target path) as column expressions.
The HTTP download itself is not part of this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import strings as S
from tessera.functions.labels import index_labels


def manifest_tokens(line) -> F.Column:
    """Split on single spaces, trim every piece, drop empty pieces."""
    line = F.col(line) if isinstance(line, str) else line
    return F.filter(F.transform(F.split(line, " "), lambda t: F.trim(t)), lambda t: t != "")


def parse_manifest(lines: DataFrame, root: str, file_col: str = "file_name", line_col: str = "value",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Manifest lines -> (file_name, class_index, class_dir, url, local_name, target_path).

    Class index = position of the file name in alphabetical order (0-based);
    class directory = 4-digit zero-padded index, a dot, the file name minus
    its last 4 characters. A line without a second token, or a URL that
    yields no name, gets NULL in ``target_path`` (later lines are kept).
    """
    tok = manifest_tokens(line_col)
    df = lines.select(*keep, F.col(file_col).alias("file_name"),
                      F.when(F.size(tok) >= 2, F.element_at(tok, 2)).alias("url"))
    df = index_labels(df, "file_name", "class_index")
    df = df.withColumn("class_dir", S.class_dir_name(F.col("class_index"), F.col("file_name")))
    df = df.withColumn("local_name", S.url_local_name(F.col("url")))
    df = df.withColumn("target_path", S.target_path(root, F.col("class_dir"), F.col("local_name")))
    return df


def write_manifest(lines: DataFrame, folder: str, file_col: str = "file_name", line_col: str = "value",
                   rows_per_part: int = 1_000_000) -> None:
    """Write manifest lines as one sub-folder per manifest file, of part files with at most about ``rows_per_part`` lines.

    A manifest holding a third of all lines is many part files of as many tasks; small ones are a single part. Lines keep no order
    within a manifest (a class is a set of URLs)."""
    parts = lines.groupBy(file_col).agg(F.ceil(F.count(F.lit(1)) / rows_per_part).cast("int").alias("_parts"))
    dealt = lines.select(file_col, line_col).join(parts, file_col) \
        .withColumn("_part", F.pmod(F.xxhash64(line_col), F.col("_parts")))
    dealt.repartition(file_col, "_part").select(F.col(line_col).alias("value"), F.col(file_col).alias("file_name")) \
        .write.partitionBy("file_name").option("maxRecordsPerFile", rows_per_part).text(folder)


def read_manifest(spark: SparkSession, folder: str, root: str, in_parts: bool = False) -> DataFrame:
    """Read every manifest of ``folder``: one file = one class, or with ``in_parts`` one sub-folder of part files as
    ``write_manifest`` leaves them."""
    if in_parts:
        lines = spark.read.schema("value string, file_name string").text(folder)
    else:
        lines = spark.read.text(folder).select(F.col("_metadata.file_name").alias("file_name"), "value")
    return parse_manifest(lines, root)
