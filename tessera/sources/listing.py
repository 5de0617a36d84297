"""File sources with planned partitions (S1, S2, S11), on Spark's Python data source API.

``folder_listing`` lists a tree without a file index on the driver: planning
looks at the folder's own level only and makes partitions of its sub-folders;
each is listed, recursively, by the task that owns it. The schema given to the
reader is what the scan returns, so a listing of paths carries nothing else.

``numbered_batches`` reads files numbered from 0 (``<prefix><n><suffix>``, Parquet)
in order. How many there are is found by doubling and halving, so planning asks
for a handful of files whatever their number; partitions are ranges of numbers
in order, and a range is read file by file.

Files are opened through ``pyarrow.fs``; a folder that only the JVM can open is
listed by ``files.list_files``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LISTING_SCHEMA = "path string, length long, modificationTime timestamp"
#: partitions a listing is planned into, at most; more sub-folders share them
MAX_PARTITIONS = 10_000
#: numbered files of one partition
FILES_PER_PARTITION = 64
_ROWS = 8192


def open_filesystem(uri: str) -> tuple[pafs.FileSystem, str, str]:
    """(filesystem, path on it, the same folder as Spark names it)."""
    fs, path = pafs.FileSystem.from_uri(uri) if ":" in uri.split("/", 1)[0] else (pafs.LocalFileSystem(), uri)
    path = path.rstrip("/") or "/"
    named = f"file:{path}" if isinstance(fs, pafs.LocalFileSystem) else uri.rstrip("/")
    return fs, path, named


def _hidden(relative: str) -> bool:
    """Spark's file sources skip these, at any depth."""
    return any(part[:1] in ("_", ".") for part in relative.split("/") if part)


class _Folders(InputPartition):
    """Sub-folders (listed with all below them), or the top folder itself (its own files only)."""

    def __init__(self, folders: list[str], recursive: bool):
        super().__init__((folders, recursive))
        self.folders, self.recursive = folders, recursive


class _ListingReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.uri = options["path"]
        self.recursive = str(options.get("recursive", "true")).lower() == "true"
        self.suffixes = tuple(json.loads(options.get("suffixes", "[]")))
        self.most = int(options.get("maxpartitions", options.get("maxPartitions", MAX_PARTITIONS)))
        self.columns = [f.name for f in schema.fields]

    def partitions(self) -> Sequence[InputPartition]:
        fs, path, _ = open_filesystem(self.uri)
        parts: list[InputPartition] = [_Folders([path], False)]
        if self.recursive:
            level = fs.get_file_info(pafs.FileSelector(path, recursive=False))
            folders = sorted(i.path for i in level if i.type == pafs.FileType.Directory and not _hidden(i.base_name))
            step = max(1, -(-len(folders) // max(1, self.most - 1)))
            parts += [_Folders(folders[i:i + step], True) for i in range(0, len(folders), step)]
        return parts

    def read(self, partition: _Folders) -> Iterator[pa.RecordBatch]:
        fs, top, named = open_filesystem(self.uri)
        kinds = {"path": pa.string(), "length": pa.int64(), "modificationTime": pa.timestamp("us", "UTC")}
        for folder in partition.folders:
            found = [i for i in fs.get_file_info(pafs.FileSelector(folder, recursive=partition.recursive, allow_not_found=True))
                     if i.type == pafs.FileType.File and not _hidden(i.path[len(top):])
                     and (not self.suffixes or i.path.endswith(self.suffixes))]
            for at in range(0, len(found), _ROWS):
                part = found[at:at + _ROWS]
                values = {"path": lambda: [named + i.path[len(top):] for i in part], "length": lambda: [i.size for i in part],
                          "modificationTime": lambda: [i.mtime for i in part]}
                yield pa.RecordBatch.from_arrays([pa.array(values[c](), kinds[c]) for c in self.columns], names=self.columns)


class FolderListing(DataSource):
    """``spark.read.format("folder_listing").option("recursive", …).option("suffixes", '["png"]').load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ListingReader(dict(self.options), schema)


def list_folder(spark: SparkSession, folder: str, suffixes: Sequence[str] | None = None, recursive: bool = True,
                columns: Sequence[str] = ("path", "length", "modificationTime")) -> DataFrame:
    """S1 by planned partitions: the asked ``columns`` of the files under ``folder``, suffixes matched case-sensitively."""
    spark.dataSource.register(FolderListing)
    kinds = dict(c.split() for c in LISTING_SCHEMA.split(", "))
    return spark.read.format("folder_listing").schema(", ".join(f"{c} {kinds[c]}" for c in columns)) \
        .option("recursive", str(recursive).lower()).option("suffixes", json.dumps(list(suffixes or []))).load(folder)


# ---------------------------------------------------------------- numbered batch files

class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


def count_numbered(exists) -> int:
    """How many of the files 0, 1, 2, … exist, by doubling and halving (the numbers have no gap)."""
    if not exists(0):
        return 0
    hi = 1
    while exists(hi):
        hi *= 2
    lo = hi // 2  # exists; hi does not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if exists(mid) else (lo, mid)
    return hi


class _NumberedReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.uri, self.prefix = options["path"], options.get("prefix", "")
        self.suffix = options.get("suffix", ".parquet")
        self.step = int(options.get("filesperpartition", options.get("filesPerPartition", FILES_PER_PARTITION)))
        self.columns = [f.name for f in schema.fields]

    def _file(self, path: str, n: int) -> str:
        return f"{path}/{self.prefix}{n}{self.suffix}"

    def partitions(self) -> Sequence[InputPartition]:
        fs, path, _ = open_filesystem(self.uri)
        n = count_numbered(lambda i: fs.get_file_info(self._file(path, i)).type == pafs.FileType.File)
        return [_Range(lo, min(n, lo + self.step)) for lo in range(0, n, self.step)] or [_Range(0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        fs, path, _ = open_filesystem(self.uri)
        stored = [c for c in self.columns if c != "batch_id"]
        for n in range(partition.lo, partition.hi):
            with fs.open_input_file(self._file(path, n)) as f:
                for b in pq.ParquetFile(f).iter_batches(_ROWS, columns=stored):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n] * b.num_rows, pa.int64()) if c == "batch_id" else b.column(c) for c in self.columns],
                        names=self.columns)


class NumberedBatches(DataSource):
    """``spark.read.format("numbered_batches").schema(…).option("prefix", "fc2-train-").load(folder)``; ``batch_id`` is the
    number in the name."""

    @classmethod
    def name(cls) -> str:
        return "numbered_batches"

    def schema(self) -> T.StructType:
        raise ValueError("numbered_batches needs a schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _NumberedReader(dict(self.options), schema)


def save_numbered(batches: DataFrame, folder: str, prefix: str, batch_col: str = "batch_id") -> None:
    """K2 as numbered files: each batch becomes ``<folder>/<prefix><n>.parquet``, written by the task that holds it (under
    another name first, so a file is whole or absent, and a second try of a task writes the same file)."""
    rest = [f.name for f in batches.schema.fields if f.name != batch_col]

    def write(key, table):
        import uuid

        fs, path, _ = open_filesystem(folder)
        n = key[0].as_py()
        fs.create_dir(path, recursive=True)
        part = f"{path}/_{prefix}{n}-{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            pq.write_table(table.select(rest), f)
        fs.move(part, f"{path}/{prefix}{n}.parquet")
        return pa.table({"batch_id": pa.array([n], pa.int64())})

    batches.groupBy(batch_col).applyInArrow(write, "batch_id long").write.format("noop").mode("overwrite").save()


def read_numbered(spark: SparkSession, folder: str, prefix: str, schema: str, files_per_partition: int = FILES_PER_PARTITION
                  ) -> DataFrame:
    """The rows of the numbered files, partitions and rows in the order of the numbers."""
    spark.dataSource.register(NumberedBatches)
    return spark.read.format("numbered_batches").schema(schema).option("prefix", prefix) \
        .option("filesPerPartition", str(files_per_partition)).load(folder)


def labelled_listing(spark: SparkSession, folder: str, suffixes: Sequence[str] | None = None, seed: int = 123,
                     label: str = "parent") -> DataFrame:
    """S2 over the planned listing: ``path, label_name, rel_path, order_key`` as of ``files.labelled_files``."""
    from tessera.functions import labels as L
    from tessera.operators.sampling import hash_uniform

    lab = L.parent_dir_label("path") if label == "parent" else L.base_name_label("path")
    rel = F.concat_ws("/", L.parent_dir_label("path"), L.base_name("path"))
    return list_folder(spark, folder, suffixes, columns=("path",)).withColumn("label_name", lab).withColumn("rel_path", rel) \
        .withColumn("order_key", hash_uniform(seed, F.col("rel_path")))
