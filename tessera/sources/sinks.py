"""Sinks and read-backs: K1 (records), K2 (numbered batches per split), K3
(bundle of listings per split), K7 (materialise if absent), S9/S10/S11
(read back records, one split, batches in order), plus ``write_files`` for
binary file outputs (one file per row, written by the tasks themselves).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K1: labelled records as parquet."""
    df.write.mode(mode).parquet(path)


def save_batches(df: DataFrame, path: str, split: str, layer: str | None = None, mode: str = "append") -> None:
    """K2: batches of one split, keeping ``batch_id`` (and the featurized
    ``layer``) as columns; partitioned by ``split`` so a reader prunes."""
    out = df.withColumn("split", F.lit(split))
    if layer is not None:
        out = out.withColumn("layer", F.lit(layer))
    out.write.mode(mode).partitionBy("split").parquet(path)


def bundle(listings: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """K3: several listings (e.g. ``train`` / ``test`` file lists) shipped as
    one table with a ``split`` column, partitioned by split."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in listings.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out.write.mode(mode).partitionBy("split").parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Read back saved records."""
    return spark.read.parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a batch table (partition pruning on ``split``)."""
    return spark.read.parquet(path).where(F.col("split") == split)


def read_batches_in_order(spark: SparkSession, path: str, split: str) -> DataFrame:
    """The batches of one split in batch-number order."""
    return read_split(spark, path, split).orderBy("batch_id")


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library created in the scratch space (Hadoop FS,
    so it works on any cluster filesystem)."""
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.delete(p, True))


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                partition_by: list[str] | None = None) -> DataFrame:
    """K7: compute-if-absent. A table counts as present only when its
    ``_SUCCESS`` marker exists (a half-written folder is rebuilt)."""
    if not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return spark.read.parquet(path)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A catalog table bucketed and sorted by ``key``: joins and anti joins on it read its side without a shuffle.

    One shuffle at the write (a file per bucket); every later join shuffles its other side only, into ``buckets`` partitions,
    so ``buckets`` is chosen for the stored side (128-256 MB each). Rows without a key are kept; they match nothing. The data lie at
    ``path``, or in the warehouse."""
    writer = df.repartition(buckets, F.col(key)).write.mode("errorifexists").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


_WRITE_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType())])


def write_files(df: DataFrame, root: str, rel_path_col: str = "rel_path", content_col: str = "content"
                ) -> DataFrame:
    """Write one binary file per row under ``root`` (any filesystem pyarrow
    can open: local, HDFS, S3, GCS). Lazy: returns ``(path, bytes)`` rows;
    an action performs the writes. Re-running a task rewrites the same
    files, so retries are safe."""
    root = root.rstrip("/")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        from urllib.parse import urlparse

        import pyarrow.fs as pafs
        local = root.startswith("/") or root.startswith("file:")
        # one filesystem handle per task; paths below the root are joined to its base
        fs, base = (None, None) if local else pafs.FileSystem.from_uri(root)
        made: set[str] = set()
        for pdf in batches:
            out = []
            for rel, data in zip(pdf[rel_path_col], pdf[content_col]):
                full = f"{root}/{rel}"
                if local:
                    p = urlparse(full).path if full.startswith("file:") else full
                    folder = os.path.dirname(p)
                    if folder not in made:
                        os.makedirs(folder, exist_ok=True)
                        made.add(folder)
                    with open(p, "wb") as fh:
                        fh.write(bytes(data))
                else:
                    inner = f"{base.rstrip('/')}/{rel}"
                    folder = inner.rsplit("/", 1)[0]
                    if folder not in made:
                        fs.create_dir(folder, recursive=True)
                        made.add(folder)
                    with fs.open_output_stream(inner) as fh:
                        fh.write(bytes(data))
                out.append((full, len(data)))
            yield pd.DataFrame(out, columns=["path", "bytes"])

    return df.select(rel_path_col, content_col).mapInPandas(write, _WRITE_SCHEMA)


def write_chunked_files(df: DataFrame, root: str) -> DataFrame:
    """Write files given as rows ``rel_path, chunk_no, content``: the chunks of
    a file are sorted into one task and appended in order, one in memory at a
    time. Lazy: returns ``(path, bytes)``, one row per file; a retried task
    starts its files anew."""
    root = root.rstrip("/")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        from urllib.parse import urlparse

        import pyarrow.fs as pafs
        local = root.startswith("/") or root.startswith("file:")
        fs, base = (None, None) if local else pafs.FileSystem.from_uri(root)
        name, out, size = None, None, 0
        for pdf in batches:
            done = []
            for rel, data in zip(pdf["rel_path"], pdf["content"]):
                if rel != name:
                    if out is not None:
                        out.close()
                        done.append((f"{root}/{name}", size))
                    name, size = rel, 0
                    if local:
                        full = f"{root}/{rel}"
                        p = urlparse(full).path if full.startswith("file:") else full
                        os.makedirs(os.path.dirname(p), exist_ok=True)
                        out = open(p, "wb")
                    else:
                        inner = f"{base.rstrip('/')}/{rel}"
                        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                        out = fs.open_output_stream(inner)
                out.write(bytes(data))
                size += len(data)
            yield pd.DataFrame(done, columns=["path", "bytes"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(f"{root}/{name}", size)], columns=["path", "bytes"])

    ordered = df.repartition("rel_path").sortWithinPartitions("rel_path", "chunk_no")
    return ordered.select("rel_path", "content").mapInPandas(write, _WRITE_SCHEMA)
