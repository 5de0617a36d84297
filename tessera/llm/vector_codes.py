"""Operator 12: vector code compression (product quantisation) in exact integers.

Components become integers floor(scale * x); a vector is cut into equal
consecutive parts, and each part position gets a codebook by rounds of
nearest-entry assignment and componentwise floored means. Distances are exact:
integers are broken into limbs so narrow that every sum of a float64 matrix
product of two limbs stays below 2^53, the products are put together in int64,
and the first nearest entry wins. Results thus do not depend on partitions,
BLAS or machine.

Plan: the integer vectors are written once; a round is one job that reads them
and returns, per (part, entry), a count and the component sums of each task
(partial sums, a few kilobytes), summed by Spark. The codebooks (parts x
entries x part length numbers, whatever the table holds) are all that the
driver sees.

Rows: vectors that are null, or hold a null or a non-finite component, are
dropped. The first ``entries`` vectors by id (then by components; null ids
last) start the codebooks; fewer vectors make fewer entries. The dimension is
that of the first vector; when it does not divide by the parts, zeros fill the
last part. Vectors of another length, empty ones and ones with a component
beyond ``component_limit`` (whose squared distances would not fit 64 bits)
have no code: they stay as rows of null code and error and take part in no
codebook. Equal labels are summed together, nulls too; a label with no coded
vector has a null sum. Ids may repeat: every row is coded. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only
from tessera.session import scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: bits of a limb; two products of limbs and their sum over a part stay far below 2^53
LIMB_BITS = 14


def component_limit(dim: int) -> int:
    """Largest magnitude whose squared distance, over ``dim`` components, fits a signed 64-bit integer."""
    return (1 << (61 - max(0, dim - 1).bit_length()) // 2) - 1


def limbs(x: np.ndarray, bits: int = LIMB_BITS) -> list[np.ndarray]:
    """float64 limbs of an int64 array, lowest first: ``sum(limb_i << (bits * i)) == x``; the last one is signed."""
    out = []
    while True:
        high = x >> bits
        if not (high ^ (x >> 63)).any():  # only the signs are left
            return [*out, x.astype(np.float64)]
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = high


def exact_dot(a: np.ndarray, b: np.ndarray, bits: int = LIMB_BITS) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact where the result fits int64: a BLAS product per pair of limbs."""
    if 2 * (bits + 1) + max(1, a.shape[1]).bit_length() > 53:
        raise ValueError(f"limbs of {bits} bits overflow a sum of {a.shape[1]} products")
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest_entry(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest entry of each row, and its squared distance (int64)."""
    d = (book * book).sum(axis=1)[None, :] - 2 * exact_dot(x, book)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at] + (x * x).sum(axis=1)


# ---------------------------------------------------------------- preparation

def quantise(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             scale: int = SCALE) -> DataFrame:
    """``id_col, label_col, q``: integer components of every kept vector; null ``q`` where a component is beyond the
    64-bit range."""
    import pyarrow as pa

    rows = only(vectors, id_col, label_col, vec_col).select(
        F.col(f"`{id_col}`"), F.col(f"`{label_col}`"), F.col(f"`{vec_col}`").cast("array<double>").alias("_v")) \
        .filter(F.col("_v").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(2)
            sizes = np.diff(col.offsets.to_numpy())
            flat = col.flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.empty(0)  # null: nan
            row = np.repeat(np.arange(len(col)), sizes)
            keep = np.bincount(row, ~np.isfinite(x), len(col)) == 0
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(x * scale)
            limit = np.array([component_limit(int(n)) for n in range(int(sizes.max(initial=0)) + 1)], float)
            codable = (np.bincount(row, ~(np.abs(x) <= limit[sizes[row]]), len(col)) == 0) & (sizes > 0)
            q = np.where(keep[row] & codable[row], x, 0.0).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(q),
                                             mask=pa.array(~codable))
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=[id_col, label_col, "q"])
            yield out.filter(pa.array(keep))

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2]]
    return bounded_batches(rows, 10_000).mapInArrow(run, ", ".join([*kinds, "q array<int>"]))


def _matrix(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow list column that hold ``dim`` components (positions), and their int64 matrix."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    return at, flat.astype(np.int64).reshape(len(at), dim)


def _parts(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, part length); zeros fill up the last part."""
    width = -(-x.shape[1] // parts)
    full = np.zeros((len(x), parts * width), np.int64)
    full[:, :x.shape[1]] = x
    return full.reshape(len(x), parts, width)


# ---------------------------------------------------------------- codebooks

def start_books(q: DataFrame, id_col: str, parts: int = PARTS, entries: int = ENTRIES) -> tuple[np.ndarray, int] | None:
    """The first vectors by id as codebooks (parts, entries, part length), and the dimension; None without a vector."""
    rows = q.filter(F.size("q") > 0).orderBy(F.col(f"`{id_col}`").asc_nulls_last(), "q")
    first = rows.select("q").limit(1).collect()
    if not first:
        return None
    dim = len(first[0]["q"])
    head = rows.filter(F.size("q") == dim).select("q").limit(entries).collect()
    return _parts(np.array([r["q"] for r in head], np.int64), parts).transpose(1, 0, 2).copy(), dim


def next_books(q: DataFrame, books: np.ndarray, dim: int) -> np.ndarray:
    """One round: assign every part, then floor the means; unused entries stay."""
    import pyarrow as pa

    n_parts, n_entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((n_parts, n_entries), np.int64)
        total = np.zeros((n_parts, n_entries, width), np.int64)
        for b in batches:
            _, x = _matrix(b.column(0), dim)
            x = _parts(x, n_parts)
            for p in range(n_parts):
                code, _ = nearest_entry(x[:, p], books[p])
                count[p] += np.bincount(code, minlength=n_entries)
                np.add.at(total[p], code, x[:, p])
        used = np.argwhere(count > 0)
        if len(used):
            sums = np.concatenate([count[:, :, None], total], axis=2)[used[:, 0], used[:, 1]]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * (width + 1), pa.int32()), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(used[:, 0]), pa.array(used[:, 1]), lists], names=["part", "entry", "sums"])

    partial = q.select("q").mapInArrow(run, "part long, entry long, sums array<bigint>")
    # the sum over tasks may pass 64 bits before it is divided
    sums = partial.select("part", "entry", F.posexplode("sums").alias("pos", "s")) \
        .groupBy("part", "entry", "pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by_entry: dict[tuple, dict] = {}
    for r in sums:
        by_entry.setdefault((r["part"], r["entry"]), {})[r["pos"]] = int(r["s"])
    out = books.copy()
    for (p, e), s in by_entry.items():
        out[p, e] = [s[i + 1] // s[0] for i in range(width)]
    return out


def books_hash(books: np.ndarray) -> str:
    """sha256 of the entries' decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(q: DataFrame, books: np.ndarray, dim: int) -> DataFrame:
    """``q`` with ``code`` (hex of the nearest entries in part order) and ``error`` (their squared distances)."""
    import pyarrow as pa

    n_parts, names = len(books), [f.name for f in q.schema.fields if f.name != "q"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = _matrix(b.column(len(names)), dim)
            x = _parts(x, n_parts)
            code, error = np.zeros((len(x), n_parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(n_parts):
                code[:, p], e = nearest_entry(x[:, p], books[p])
                error += e
            codes, errors = np.full(b.num_rows, None, object), np.full(b.num_rows, None, object)
            codes[at], errors[at] = [c.tobytes().hex() for c in code], error.tolist()
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             names=[*names, "code", "error"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in q.schema.fields if f.name != "q"]
    return q.select(*[f"`{c}`" for c in names], "q").mapInArrow(run, ", ".join([*kinds, "code string", "error long"]))


def decode(codes: DataFrame, books: np.ndarray, dim: int, scale: int = SCALE, code_col: str = "code") -> DataFrame:
    """``codes`` with ``decoded``: the vector that each code stands for (null for a null code)."""
    flat = F.array(*[F.array(*[F.array(*[F.lit(float(v) / scale) for v in entry]) for entry in book]) for book in books])
    digits = [F.conv(F.substring(code_col, 2 * p + 1, 2), 16, 10).cast("int") for p in range(len(books))]
    parts = [F.get(F.get(flat, F.lit(p)), d) for p, d in enumerate(digits)]
    return codes.withColumn("decoded", F.when(F.col(code_col).isNotNull(), F.slice(F.concat(*parts), 1, dim)))


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
             ) -> tuple[DataFrame, np.ndarray | None, int]:
    """(``id_col, label_col, code, error`` of every kept vector, codebooks, dimension)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark: SparkSession = vectors.sparkSession
    path = scratch_path(spark, "vector-integers")
    quantise(vectors, id_col, vec_col, label_col, scale).write.parquet(path)
    q = bounded_batches(spark.read.parquet(path), 10_000)
    started = start_books(q, id_col, parts, entries)
    if started is None:
        return q.select(f"`{id_col}`", f"`{label_col}`", F.lit(None).cast("string").alias("code"),
                        F.lit(None).cast("long").alias("error")), None, 0
    books, dim = started
    for _ in range(rounds):
        books = next_books(q, books, dim)
    coded = scratch_path(spark, "vector-codes")
    encode(q, books, dim).write.parquet(coded)
    return spark.read.parquet(coded), books, dim


def report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", **options
           ) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept vector."""
    coded, books, _ = compress(vectors, id_col, vec_col, label_col, **options)
    coded = coded.select(F.col(f"`{id_col}`"), F.col(f"`{label_col}`").alias("_label"), "code", "error")
    sums = scratch_path(vectors.sparkSession, "label-errors")
    coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error")).write.parquet(sums)
    by_label = vectors.sparkSession.read.parquet(sums)
    return coded.join(by_label, F.col("_label").eqNullSafe(F.col("_of")), "left") \
        .select(id_col, "code", "error", "label_error",
                F.lit(None if books is None else books_hash(books)).cast("string").alias("codebooks_sha256"))
