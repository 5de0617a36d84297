"""Archive entries (zip / jar / tar / tar.gz / tgz) as rows.

Archives are listed with ``binaryFile`` (no bytes read on the driver) and
opened by executors through ``pyarrow.fs`` (local, HDFS, S3, GCS paths).
An index pass reads only directories / headers; entry bytes are then read
in offset order by tasks that each own a range of one archive, so one huge
zip or tar is many tasks and each opens it once. A gzip-compressed tar of several
gzip members (as written by appending or by block-wise compressors) is entered at
its members: the index pass notes where each begins, and tasks own ranges of
members. One of a single member cannot be entered and is streamed by one task. An entry of any size is read whole, in rows of
at most ``CHUNK_BYTES`` each (``chunk_no`` 0, 1, ...), so no task holds more
than a few chunks. The format is detected from the content, not the name (a
``.tar.gz`` named ``.tar`` still works). Absolute entry names or names holding
``..`` are flagged ``unsafe``.
"""

from __future__ import annotations

import re
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

ENTRY_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("entry", T.StringType()),
    T.StructField("is_dir", T.BooleanType()),
    T.StructField("size", T.LongType()),
    T.StructField("unsafe", T.BooleanType()),
    T.StructField("entry_no", T.LongType()),
    T.StructField("chunk_no", T.LongType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("error", T.StringType()),
])

CHUNK_BYTES = 16 << 20  # content bytes per row
RANGE_BYTES = 128 << 20  # archive bytes that one task reads
ARCHIVE_SUFFIXES = (".zip", ".jar", ".tar", ".tar.gz", ".tgz")


def _open(path: str):
    import pyarrow.fs as pafs
    from urllib.parse import urlparse
    if path.startswith("file:"):
        return open(urlparse(path).path, "rb")
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def _unsafe(name: str) -> bool:
    return name.startswith("/") or name.startswith("\\") or ".." in name.replace("\\", "/").split("/")


def _kind(fh) -> str:
    head = fh.read(262)
    fh.seek(0)
    if head[:2] == b"PK":
        return "zip"
    if head[:2] == b"\x1f\x8b":
        return "tgz"
    if head[257:262] == b"ustar":
        return "tar"
    return "tgz"  # let tarfile try its other compressions on the streaming path


# a gzip member's header: magic, deflate, flags, time, extra flags, system; chance alone makes one in about 100 GB
_MEMBER = re.compile(rb"\x1f\x8b\x08[\x00-\x1f].{4}[\x00\x02\x04][\x00-\x0d\xff]", re.S)
_READ = 1 << 20
_KEPT_MEMBERS = 1 << 16


def may_have_members(fh) -> bool:
    """Whether a member header stands anywhere after the first one (a search of the compressed bytes, nothing unpacked)."""
    fh.seek(1)
    tail = b""
    while data := fh.read(_READ):
        if _MEMBER.search(tail + data):
            fh.seek(0)
            return True
        tail = (tail + data)[-9:]
    fh.seek(0)
    return False


class MemberReader:
    """The unpacked bytes of a gzip file from the member that begins at ``start``; notes each member it enters as
    (compressed start, unpacked start)."""

    def __init__(self, fh, start: int = 0, position: int = 0):
        fh.seek(start)
        self._fh, self._in, self._out, self._at = fh, b"", b"", start
        self._z = None
        self.position = position  # unpacked bytes before what ``read`` gives next
        self.members: list[tuple[int, int]] = []

    def _more(self) -> bool:
        if not self._in:
            self._in = self._fh.read(_READ)
            if not self._in:
                if self._z is not None:
                    raise EOFError("gzip member breaks off")
                return False
        if self._z is None:
            self._in = self._in.lstrip(b"\0") if self.members else self._in  # padding between members
            if not self._in:
                return self._more()
            self._z = zlib.decompressobj(31)
            self.members.append((self._fh.tell() - len(self._in), self.position + len(self._out)))
        self._out += self._z.decompress(self._in, _READ)
        self._in = self._z.unconsumed_tail
        if self._z.eof:
            self._in, self._z = self._z.unused_data, None
        return True

    def read(self, size: int = -1) -> bytes:
        while (size < 0 or len(self._out) < size) and self._more():
            pass
        out = self._out if size < 0 else self._out[:size]
        self._out = self._out[len(out):]
        self.position += len(out)
        return out

    def skip_to(self, position: int) -> None:
        while self.position < position and self.read(min(_READ, position - self.position)):
            pass

    def member_of(self, position: int) -> tuple[int, int]:
        """(compressed start, unpacked start) of the member that holds an unpacked position, or of the last one entered."""
        return next((m for m in reversed(self.members) if m[1] <= position), self.members[-1])


def iter_index(path: str) -> Iterator[tuple]:
    """Entries of one archive without their bytes: (archive, entry, is_dir,
    size, unsafe, entry_no, kind, offset, at, member_at). Zip: central directory; plain tar:
    headers, skipping content by seeking; gzip of several members: headers while
    unpacking (kind 'members': offset of the member where the content begins, the
    content's unpacked position, and the member's); other compressed tars: streamed (kind 'tgz',
    offset -1: content cannot be reached without reading what comes before)."""
    with _open(path) as fh:
        kind = _kind(fh)
        if kind == "zip":
            for i, info in enumerate(zipfile.ZipFile(fh).infolist()):
                yield (path, info.filename, info.is_dir(), int(info.file_size), _unsafe(info.filename), i, kind,
                       int(info.header_offset), 0, 0)
        elif kind == "tar":
            with tarfile.open(fileobj=fh, mode="r:") as tf:
                for i, m in enumerate(tf):
                    yield (path, m.name, m.isdir(), int(m.size), _unsafe(m.name), i, kind, int(m.offset_data), 0, 0)
        elif fh.read(2) == b"\x1f\x8b" and may_have_members(fh):
            source = MemberReader(fh)
            with tarfile.open(fileobj=source, mode="r|") as tf:
                for i, m in enumerate(tf):
                    source.members = source.members[-_KEPT_MEMBERS:]  # a position is at most a block behind
                    offset, member_at = source.member_of(int(m.offset_data))
                    yield (path, m.name, m.isdir(), int(m.size), _unsafe(m.name), i, "members", offset, int(m.offset_data), member_at)
        else:
            yield (path, None, None, None, None, 0, kind, -1, 0, 0)


def _chunks(fh, size: int | None = None) -> Iterator[bytes]:
    """The bytes of an open file (at most ``size``) in chunks; one empty chunk for an empty file."""
    left, first = size, True
    while True:
        data = fh.read(CHUNK_BYTES if left is None else min(CHUNK_BYTES, left))
        if data or first:
            yield data
        if not data:
            if left:
                raise EOFError(f"archive ends {left} bytes before the entry does")
            return
        first = False
        if left is not None:
            left -= len(data)
            if not left:
                return


def _entry_rows(head: tuple, open_content) -> Iterator[tuple]:
    """Rows of one entry: its chunks, then a row with ``error`` where reading breaks off."""
    done = 0
    try:
        source = open_content()
        if source is None:  # a directory, a link, or no content asked for
            yield (*head, 0, None, None)
            return
        for data in source:
            yield (*head, done, data, None)
            done += 1
    except Exception as e:  # noqa: BLE001 - a broken entry is a row
        yield (*head, done, None, f"{type(e).__name__}: {e}")


def iter_entries(path: str, with_content: bool) -> Iterator[tuple]:
    """All entries of a tar with their bytes, streamed in archive order."""
    with _open(path) as fh, tarfile.open(fileobj=fh, mode="r|*") as tf:  # streaming: gzip or plain detected
        for i, m in enumerate(tf):
            head = (path, m.name, m.isdir(), int(m.size), _unsafe(m.name), i)
            yield from _entry_rows(head, lambda: _chunks(tf.extractfile(m)) if with_content and m.isfile() else None)


def _range_entries(path: str, kind: str, part: pd.DataFrame, with_content: bool) -> Iterator[tuple]:
    """Entries of one range of a zip or plain tar, in offset order, by seeking; the archive is opened once."""
    fh = _open(path)
    try:
        zf = zipfile.ZipFile(fh) if kind == "zip" else None
        by_offset = {i.header_offset: i for i in zf.infolist()} if zf is not None else {}
        reader: MemberReader | None = None

        def content(r):
            if not with_content or r.is_dir:
                return None
            if zf is not None:  # by its own header, so entries of one name stay apart
                return _chunks(zf.open(by_offset[int(r.offset)]))
            if kind == "members":
                nonlocal reader
                if reader is None or reader.position > r.at:
                    # the member's own first position is not known here, nor needed: only the way on from it
                    reader = MemberReader(fh, int(r.offset), int(r.member_at))
                reader.skip_to(int(r.at))
                return _chunks(reader, int(r.size))
            fh.seek(int(r.offset))
            return _chunks(fh, int(r.size))

        for r in part.sort_values(["offset", "at"]).itertuples(index=False):
            head = (path, r.entry, bool(r.is_dir), int(r.size), bool(r.unsafe), int(r.entry_no))
            yield from _entry_rows(head, lambda: content(r))
    finally:
        fh.close()


def _batches(rows_iter, columns, rows_per_batch: int = 1024, bytes_per_batch: int = 64 << 20):
    rows, held = [], 0
    for row in rows_iter:
        rows.append(row)
        held += sum(len(v) for v in row if isinstance(v, bytes))
        if len(rows) >= rows_per_batch or held >= bytes_per_batch:
            yield pd.DataFrame(rows, columns=columns)
            rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=columns)


_INDEX_SCHEMA = T.StructType([f for f in ENTRY_SCHEMA.fields if f.name not in ("chunk_no", "content", "error")]
                             + [T.StructField("kind", T.StringType()), T.StructField("offset", T.LongType()),
                                T.StructField("at", T.LongType()), T.StructField("member_at", T.LongType()),
                                T.StructField("error", T.StringType())])
_NO_ENTRY = (None, None, None, None)


def archive_entries(spark: SparkSession, folder: str, with_content: bool = True) -> DataFrame:
    """``(archive, entry, is_dir, size, unsafe, entry_no, chunk_no, content, error)``:
    one row per entry and content chunk (``whole_entries`` puts small ones
    together). A broken archive or entry yields a row with ``error``.

    (1) Index every archive without reading entry bytes (zip central directory,
    tar headers); (2) give each task ranges of ``RANGE_BYTES`` of an archive and
    read the entries in them by seeking. Gzip-compressed tars of one member cannot
    be entered at an offset; they are streamed by one task each.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
                    .select("path", "length"))
    cond = F.lit(False)
    for suffix in ARCHIVE_SUFFIXES:
        cond = cond | F.lower(F.col("path")).endswith(suffix)
    listing = listing.where(cond)
    # archives are few rows but heavy work: one task each, up to the shuffle width
    n_archives, total = listing.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_archives))
    listing = listing.repartition(n, F.xxhash64("path"))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(path):
            try:
                for r in iter_index(path):
                    yield (*r, None)
            except Exception as e:  # noqa: BLE001 - a broken archive is a row
                yield (path, *_NO_ENTRY, 0, None, -1, 0, 0, f"{type(e).__name__}: {e}")
        for pdf in batches:
            for path in pdf["path"]:
                yield from _batches(rows(path), _INDEX_SCHEMA.names)

    # the index (no entry bytes) is used three times below: cut it once to the shared checkpoint folder
    idx = cut_lineage(listing.mapInPandas(index, _INDEX_SCHEMA))
    seekable = idx.where(F.col("kind").isin("zip", "tar", "members") & F.col("entry").isNotNull())
    streamed = idx.where(F.col("kind") == "tgz").select("archive").distinct()
    broken = idx.where(F.col("error").isNotNull()).select(
        "archive", "entry", "is_dir", "size", "unsafe", "entry_no", F.lit(0).cast("long").alias("chunk_no"),
        F.lit(None).cast("binary").alias("content"), "error")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (path, kind, _), part in pdf.groupby(["archive", "kind", "range"], sort=False):
                yield from _batches(_range_entries(path, kind, part, with_content), ENTRY_SCHEMA.names)

    seekable = seekable.withColumn("range", F.floor(F.col("offset") / RANGE_BYTES))
    # as many tasks as the archives have ranges, known from the listing
    seek_rows = (seekable.repartition(max(n, -(-int(total) // RANGE_BYTES)), F.xxhash64("archive", "range"))
                         .sortWithinPartitions("archive", "range", "offset").mapInPandas(fetch, ENTRY_SCHEMA))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(path):
            try:
                yield from iter_entries(path, with_content)
            except Exception as e:  # noqa: BLE001 - a broken archive is a row
                yield (path, *_NO_ENTRY, 0, 0, None, f"{type(e).__name__}: {e}")
        for pdf in batches:
            for path in pdf["archive"]:
                yield from _batches(rows(path), ENTRY_SCHEMA.names)

    stream_rows = streamed.repartition(n, F.xxhash64("archive")).mapInPandas(stream, ENTRY_SCHEMA)
    # (gzip tars of one member: one streaming task per archive, spread like the listing)
    return seek_rows.unionByName(stream_rows).unionByName(broken)


def whole_entries(entries: DataFrame) -> DataFrame:
    """One row per entry with its chunks joined in order, for decoders that need whole files. An entry that broke
    off keeps its ``error`` and has no content."""
    keys = ["archive", "entry", "is_dir", "size", "unsafe", "entry_no"]
    joined = entries.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("content").isNotNull(), F.struct("chunk_no", "content")))).alias("_c"),
        F.max("error").alias("error"))
    content = F.aggregate("_c", F.lit(b"").cast("binary"), lambda acc, c: F.concat(acc, c["content"]))
    return joined.withColumn("content", F.when(F.col("error").isNull() & (F.size("_c") > 0), content)) \
                 .select(*keys, "content", "error")


def entry_counts(entries: DataFrame) -> DataFrame:
    """Files and directories per archive (entries, not chunks)."""
    if "chunk_no" in entries.columns:
        entries = entries.where(F.col("chunk_no") == 0)
    return entries.groupBy("archive").agg(F.count_if(~F.col("is_dir")).alias("n_files"),
                                          F.count_if(F.col("is_dir")).alias("n_dirs"))


def extraction_targets(entries: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Where an extraction would put each entry: ``out_dir`` or, when empty,
    the archive's parent folder; unsafe names get no target."""
    base = (F.lit(out_dir.rstrip("/")) if out_dir else F.regexp_replace(F.col("archive"), r"/[^/]*$", ""))
    return entries.withColumn("target", F.when(~F.col("unsafe"), F.concat(base, F.lit("/"), F.col("entry"))))


def extract_entries(entries: DataFrame, out_dir: str) -> DataFrame:
    """Write the file entries (safe names only) under ``out_dir``; returns
    ``(path, bytes)`` after the writes ran. The folder can then be read by any
    file source, e.g. the image source for formats only the JVM decoders
    handle. An entry with an ``error`` is not written; it stays in ``entries``.

    The chunks of one file meet in one task in order and are appended, so a
    file of any size is written with a chunk in memory. Of several entries with
    one name in an archive the last counts, as when it is unpacked. A name that
    several archives hold is written for each of them: below ``out_dir`` for the
    last archive, and for the others below ``clashes/<hash>-<archive>`` in it."""
    from tessera.sources.sinks import write_chunked_files
    files = entries.where(F.col("entry").isNotNull() & ~F.col("is_dir") & ~F.col("unsafe"))
    each = files.groupBy("archive", "entry", "entry_no").agg(F.max("error").alias("_error"))
    last = each.groupBy("archive", "entry").agg(F.max(F.struct("entry_no", "_error")).alias("_last")) \
        .where(F.col("_last._error").isNull()).select("archive", "entry", F.col("_last.entry_no").alias("entry_no"))
    plain = last.groupBy("entry").agg(F.max("archive").alias("_plain"))
    files = files.join(last, ["archive", "entry", "entry_no"]).join(plain, "entry").where(F.col("content").isNotNull())
    folder = F.concat(F.lit("clashes/"), F.hex(F.xxhash64("archive")), F.lit("-"),
                      F.element_at(F.split("archive", "/"), -1), F.lit("/"))
    path = F.concat(F.when(F.col("archive") == F.col("_plain"), F.lit("")).otherwise(folder), F.col("entry"))
    return cut_lineage(write_chunked_files(
        files.select(path.alias("rel_path"), "chunk_no", "content"), out_dir))
