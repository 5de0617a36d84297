"""File listings: S1 (list files), S2 (labelled, seeded file split), F1
(extension whitelist), F2 (small-file flag), F3 (skip items already present).

Listing uses the ``binaryFile`` source without reading ``content`` (column
pruning keeps the bytes out of the scan), so a listing of millions of files
is a distributed scan, not a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import SMALL_FILE_BYTES
from tessera.functions import labels as L
from tessera.functions import strings as S
from tessera.operators.sampling import hash_uniform


def list_files(spark: SparkSession, folder: str, suffixes: Sequence[str] | None = None,
               recursive: bool = True, path_glob: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of the files under ``folder``.

    ``suffixes=None`` keeps everything; otherwise a case-sensitive plain
    suffix match (no dot added). ``path_glob`` is pushed into the listing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.load(folder).select("path", "length", "modificationTime")
    if suffixes:
        df = df.where(S.suffix_match(F.col("path"), suffixes))
    return df


def labelled_files(spark: SparkSession, folder: str, suffixes: Sequence[str] | None = None,
                   seed: int = 123, label: str = "parent") -> DataFrame:
    """Listing + label from the path (P1 parent dir or P2 base name) +
    a seeded order column ``order_key`` (T2).

    The order hashes ``rel_path`` (class folder / file name), not the full
    path, so a dataset keeps its order wherever it is stored."""
    df = list_files(spark, folder, suffixes, recursive=True)
    lab = L.parent_dir_label("path") if label == "parent" else L.base_name_label("path")
    rel = F.concat_ws("/", L.parent_dir_label("path"), L.base_name("path"))
    return (df.withColumn("label_name", lab).withColumn("rel_path", rel)
              .withColumn("order_key", hash_uniform(seed, F.col("rel_path"))))


def flag_small(df: DataFrame, size_col: str = "length", limit: int = SMALL_FILE_BYTES,
               out_col: str = "is_small") -> DataFrame:
    """flag items shorter than ``limit`` bytes (flag only; nothing deleted)."""
    return df.withColumn(out_col, F.col(size_col) < F.lit(limit))


def skip_existing(plan: DataFrame, existing: DataFrame, on: str = "target_path",
                  existing_col: str | None = None) -> DataFrame:
    """drop the planned items whose target already exists (left anti join).

    Rows without a target (NULL key) can never match; they bypass the join
    instead of all landing in one shuffle partition. The existing side is
    de-duplicated first (a partial aggregate)."""
    existing_col = existing_col or on
    ex = existing.select(F.col(existing_col).alias(on)).where(F.col(on).isNotNull()).distinct()
    keyed = plan.where(F.col(on).isNotNull()).join(ex, on=on, how="left_anti")
    return keyed.unionByName(plan.where(F.col(on).isNull()))


def skip_existing_stored(plan: DataFrame, existing: DataFrame, on: str = "target_path") -> DataFrame:
    """F3 against a table stored by ``sinks.save_bucketed`` on ``on``: the stored side is neither shuffled nor
    de-duplicated (an anti join needs no distinct keys), only the plan's rows move to its buckets."""
    keyed = plan.where(F.col(on).isNotNull()).join(existing.select(on), on=on, how="left_anti")
    return keyed.unionByName(plan.where(F.col(on).isNull()))
