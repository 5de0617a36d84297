"""Image sources: S6 (decode images from any Hadoop path), S7 (batch tensors
[rows, c, h, w] + one-hot labels + normalisation), S8 (flat row vectors).

Files are read with Spark's ``image`` source (decoding runs in executors;
paths on any Hadoop filesystem). Its pixels are row-major HWC bytes in BGR
order; ``to_features`` turns them into CHW (RGB) doubles, resizing when a
target size differs, in an Arrow-batched pandas UDF (NumPy per batch).
For bytes that are already in a column (archive entries, S12), ``decode_png``
decodes PNG content in the same way.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.labels import base_name, parent_dir_label

_FEATURES = T.ArrayType(T.DoubleType())
#: tasks that read a folder of images: so many per core, or ``MIN_TASKS`` if that is more
TASKS_PER_CORE = 32
MIN_TASKS = 512


def read_images(spark: SparkSession, folder: str, drop_invalid: bool = False, path_glob: str | None = None
                ) -> DataFrame:
    """``(path, height, width, channels, mode, data, error)`` for every image
    under ``folder`` (recursive). Undecodable files are kept with an
    ``error`` text unless ``drop_invalid``.

    Spark plans one partition per 32 small files (``openCostInBytes``); they are
    put together without a shuffle, so the number of tasks follows the cores and
    not the number of files."""
    reader = (spark.read.format("image").option("dropInvalid", str(drop_invalid).lower())
                   .option("recursiveFileLookup", "true"))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.load(folder).coalesce(max(MIN_TASKS, TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    return df.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"),
                     F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"),
                     F.col("image.mode").alias("mode"), F.col("image.data").alias("data"),
                     F.when(F.col("image.height") < 0, F.lit("cannot decode image")).alias("error"))


def _resize(img: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear resize of an (H, W, C) array (pixel-centre aligned)."""
    H, W = img.shape[:2]
    if (H, W) == (h, w):
        return img.astype(np.float64)
    ys = np.clip((np.arange(h) + 0.5) * H / h - 0.5, 0, H - 1)
    xs = np.clip((np.arange(w) + 0.5) * W / w - 0.5, 0, W - 1)
    y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
    y1, x1 = np.minimum(y0 + 1, H - 1), np.minimum(x0 + 1, W - 1)
    wy, wx = (ys - y0)[:, None, None], (xs - x0)[None, :, None]
    f = img.astype(np.float64)
    top = f[y0][:, x0] * (1 - wx) + f[y0][:, x1] * wx
    bot = f[y1][:, x0] * (1 - wx) + f[y1][:, x1] * wx
    return top * (1 - wy) + bot * wy


def _hwc_to_features(img: np.ndarray, h: int | None, w: int | None, c: int | None, bgr: bool,
                     channel_first: bool) -> np.ndarray:
    if img.ndim == 2:
        img = img[:, :, None]
    if bgr and img.shape[2] >= 3:
        img = img[:, :, [2, 1, 0] + list(range(3, img.shape[2]))]
    if c is not None and img.shape[2] != c:
        if c == 1:
            img = img[:, :, :3].mean(axis=2, keepdims=True) if img.shape[2] >= 3 else img[:, :, :1]
        elif img.shape[2] == 1:
            img = np.repeat(img, c, axis=2)
        else:
            img = img[:, :, :c]
    img = _resize(img, h or img.shape[0], w or img.shape[1])
    return (np.transpose(img, (2, 0, 1)) if channel_first else img).ravel()


def to_features(df: DataFrame, height: int | None = None, width: int | None = None, channels: int | None = None,
                channel_first: bool = True, out_col: str = "features") -> DataFrame:
    """Image bytes -> flat ``ARRAY<DOUBLE>`` (CHW by default, RGB),
    resized to ``height`` x ``width`` when given. Non-square targets keep
    their own height and width."""

    @F.pandas_udf(_FEATURES)
    def decode(data: pd.Series, hh: pd.Series, ww: pd.Series, cc: pd.Series) -> pd.Series:
        out = []
        for d, h0, w0, c0 in zip(data, hh, ww, cc):
            if d is None or h0 is None or h0 < 0 or len(d) == 0:
                out.append(None)
                continue
            img = np.frombuffer(d, dtype=np.uint8).reshape(int(h0), int(w0), int(c0))
            out.append(_hwc_to_features(img, height, width, channels, True, channel_first))
        return pd.Series(out)

    return df.withColumn(out_col, decode(F.col("data"), F.col("height"), F.col("width"), F.col("channels")))


def labelled_images(spark: SparkSession, folder: str, height: int | None = None, width: int | None = None,
                    channels: int | None = None, label: Column | None = None) -> DataFrame:
    """S6 + P1 + S8: images under ``folder`` with their parent directory as
    label name and flat features (errors kept in ``error``)."""
    imgs = read_images(spark, folder)
    imgs = imgs.withColumn("label_name", label if label is not None else parent_dir_label("path"))
    return to_features(imgs, height, width, channels).drop("data")


# ---------------------------------------------------------------- PNG bytes (a small codec helper)

def encode_png(pixels: np.ndarray) -> bytes:
    """8-bit grey (H, W) or RGB (H, W, 3) array -> PNG bytes (filter 0)."""
    px = np.asarray(pixels, dtype=np.uint8)
    if px.ndim == 2:
        color = 0
    elif px.shape[2] == 3:
        color = 2
    else:
        raise ValueError("grey or RGB only")
    h, w = px.shape[:2]
    raw = b"".join(b"\x00" + px[r].tobytes() for r in range(h))

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def _png_rows(raw: bytes, h: int, stride: int, bpp: int) -> np.ndarray:
    out = np.zeros((h, stride), dtype=np.uint8)
    prev = np.zeros(stride, dtype=np.int32)
    pos = 0
    for r in range(h):
        ft = raw[pos]
        line = np.frombuffer(raw, dtype=np.uint8, count=stride, offset=pos + 1).astype(np.int32)
        pos += 1 + stride
        cur = np.zeros(stride, dtype=np.int32)
        if ft == 0:
            cur = line
        elif ft == 2:
            cur = (line + prev) & 0xFF
        else:
            for i in range(stride):
                a = cur[i - bpp] if i >= bpp else 0
                b = prev[i]
                c = prev[i - bpp] if i >= bpp else 0
                if ft == 1:
                    p = a
                elif ft == 3:
                    p = (a + b) // 2
                else:
                    pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    p = a if pa <= pb and pa <= pc else (b if pb <= pc else c)
                cur[i] = (line[i] + p) & 0xFF
        out[r] = cur
        prev = cur
    return out


def decode_png(data: bytes) -> np.ndarray:
    """PNG bytes (8-bit grey / grey+alpha / RGB / RGBA, not interlaced) ->
    (H, W, C) uint8 array; raises ValueError otherwise."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    pos, idat, hdr = 8, [], None
    while pos < len(data):
        (n,) = struct.unpack(">I", data[pos:pos + 4])
        tag = data[pos + 4:pos + 8]
        body = data[pos + 8:pos + 8 + n]
        if tag == b"IHDR":
            hdr = struct.unpack(">IIBBBBB", body)
        elif tag == b"IDAT":
            idat.append(body)
        elif tag == b"IEND":
            break
        pos += 12 + n
    if hdr is None:
        raise ValueError("PNG without header")
    w, h, depth, color, _, _, interlace = hdr
    ch = {0: 1, 2: 3, 4: 2, 6: 4}.get(color)
    if depth != 8 or ch is None or interlace:
        raise ValueError("unsupported PNG layout")
    rows = _png_rows(zlib.decompress(b"".join(idat)), h, w * ch, ch)
    return rows.reshape(h, w, ch)


def png_features(content: Column, height: int | None = None, width: int | None = None,
                 channels: int | None = None, channel_first: bool = True) -> Column:
    """Column of PNG bytes -> flat ``ARRAY<DOUBLE>`` (NULL when undecodable)."""

    @F.pandas_udf(_FEATURES)
    def dec(s: pd.Series) -> pd.Series:
        out = []
        for d in s:
            try:
                out.append(_hwc_to_features(decode_png(bytes(d)), height, width, channels, False, channel_first))
            except Exception:  # noqa: BLE001 - bad content becomes NULL
                out.append(None)
        return pd.Series(out)

    return dec(content)


def image_batches(spark: SparkSession, folder: str, batch_size: int, height: int, width: int, channels: int,
                  n_classes: int, seed: int = 123, scale: bool = True) -> DataFrame:
    """Images under ``folder`` (class = parent directory, numeric) as
    batches: one row per batch with the tensor ``[rows, channels, height,
    width]`` (row-major ``values``), the one-hot label matrix (row-major),
    the label names, and the paths in row order. Rows are ordered by a
    seeded hash of the class folder and file name (T2), so a dataset keeps its
    batches wherever it is stored, and batched by the scalable global index
    (T3); undecodable images and labels outside the class range are left
    out of the tensors and kept in the ``error`` column of
    ``labelled_images``. The files are read and decoded once, into the shared
    scratch folder: counting, ordering and batching read what was decoded."""
    from tessera.functions.arrays import scale_pixels
    from tessera.functions.labels import one_hot
    from tessera.operators.sampling import minibatches
    from tessera.session import scratch_path

    imgs = labelled_images(spark, folder, height, width, channels)
    imgs = imgs.withColumn("label", F.col("label_name").try_cast("int"))
    ok = imgs.where(F.col("error").isNull() & (F.col("label") >= 0) & (F.col("label") < n_classes)) \
        .select("path", "label_name", "label", "features")
    decoded = scratch_path(spark, "decoded")
    ok.write.parquet(decoded)
    ok = spark.read.schema(ok.schema).parquet(decoded)
    if scale:
        ok = ok.withColumn("features", scale_pixels("features"))
    ok = ok.withColumn("onehot", one_hot("label", n_classes))
    ok = ok.withColumn("rel_path", F.concat_ws("/", parent_dir_label("path"), base_name("path")))
    b = minibatches(ok, "rel_path", batch_size, seed=seed)
    items = F.struct("row_in_batch", "features", "onehot", "label_name", "path")
    g = b.groupBy("batch_id").agg(F.array_sort(F.collect_list(items)).alias("_it"))  # <= batch_size rows
    return g.select(
        "batch_id",
        F.array(F.size("_it"), F.lit(channels), F.lit(height), F.lit(width)).alias("shape"),
        F.flatten(F.transform("_it", lambda s: s["features"])).alias("values"),
        F.array(F.size("_it"), F.lit(n_classes)).alias("label_shape"),
        F.flatten(F.transform("_it", lambda s: s["onehot"])).alias("labels"),
        F.transform("_it", lambda s: s["label_name"]).alias("label_names"),
        F.transform("_it", lambda s: s["path"]).alias("paths"))
