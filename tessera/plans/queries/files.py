"""Driver queries: images, archives, listings and CSV."""

from __future__ import annotations

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import labels as L
from tessera.functions import strings as S
from tessera.operators import sampling as SM
from tessera.plans.queries._registry import _SQL_U, _emb, register
from tessera.session import table


# ------------------------------------------------------------------ images and archives
# The files are derived from the tables by Spark tasks and written to the
# shared scratch folder, then read back through the file sources.

def _embedding_pngs(spark, sf) -> str:
    """Every embedding row rendered as an 8x8 grey PNG under
    <label>/<vec_id>.png in a fresh scratch folder (pixel = the value scaled
    to 0..255 over the table's range); returns the folder."""
    from tessera.session import scratch_path
    from tessera.sources.images import encode_png
    from tessera.sources.sinks import write_files

    e = _emb(spark, sf)
    r = e.agg(F.min(F.array_min("embedding")).cast("double").alias("mn"),
              F.max(F.array_max("embedding")).cast("double").alias("mx")).first()
    mn, mx = float(r["mn"]), float(r["mx"])

    @F.pandas_udf("binary")
    def to_png(vs: pd.Series) -> pd.Series:
        out = []
        for v in vs:
            a = np.asarray(v, dtype=np.float64)
            px = np.floor((a - mn) / (mx - mn) * 255 + 0.5).clip(0, 255).astype(np.uint8)
            out.append(encode_png(px.reshape(8, 8)))
        return pd.Series(out)

    root = scratch_path(spark, "images")
    files = e.select(F.concat(F.col("label").cast("string"), F.lit("/"), F.col("vec_id").cast("string"),
                              F.lit(".png")).alias("rel_path"), to_png("embedding").alias("content"))
    write_files(files, root).write.format("noop").mode("overwrite").save()
    return root


@register("image_records", """
WITH r AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS mn, CAST(max(list_max(embedding)) AS DOUBLE) AS mx
           FROM embeddings),
x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(label AS VARCHAR) AS label_name, CAST(pos AS BIGINT) AS pos,
       round(floor((v - mn) / (mx - mn) * 255 + 0.5) / 255, 6) AS value
FROM x, r
""")
def q_image_records(spark, sf):
    """S1 + S6 + S8 + P1 + P2 + P6: every embedding row rendered as an 8x8
    grey PNG under <label>/<vec_id>.png, then listed, decoded by the image
    source, labelled by parent directory and scaled to [0, 1]."""
    from tessera.sources.images import labelled_images

    root = _embedding_pngs(spark, sf)
    imgs = labelled_images(spark, root, channels=1)
    imgs = imgs.select(L.base_name_label("path").cast("bigint").alias("vec_id"), "label_name",
                       A.scale_pixels("features").alias("v"))
    return imgs.select("vec_id", "label_name", F.posexplode("v").alias("pos", "value")).select(
        "vec_id", "label_name", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@register("labelled_listing", """
SELECT CAST(label AS VARCHAR) || '/' || CAST(vec_id AS VARCHAR) || '.png' AS rel_path,
       CAST(label AS VARCHAR) AS label_name,
       CAST(('0x' || substr(md5('123:' || CAST(label AS VARCHAR) || '/' || CAST(vec_id AS VARCHAR) || '.png'), 1, 8))
            AS BIGINT) AS order_key
FROM embeddings
""")
def q_labelled_listing(spark, sf):
    """S2 + F1: the PNG files of every embedding row listed recursively with
    an extension whitelist, labelled by class folder, with the seeded order
    key of their dataset-relative path (a partition per class folder, no driver index)."""
    from tessera.sources.listing import labelled_listing

    root = _embedding_pngs(spark, sf)
    return labelled_listing(spark, root, ["png"], seed=123).select("rel_path", "label_name", "order_key")


@register("image_to_records", """
WITH r AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS mn, CAST(max(list_max(embedding)) AS DOUBLE) AS mx
           FROM embeddings),
x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(label AS INTEGER) AS label,
       array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), ',') AS one_hot,
       CAST(count(*) AS INTEGER) AS n_features,
       round(sum(floor((v - mn) / (mx - mn) * 255 + 0.5) / 255), 6) AS feature_sum
FROM x, r GROUP BY vec_id, label
""")
def q_image_to_records(spark, sf):
    """U1 + U3 + P4 + P6: the image-folder job turning paths into labelled,
    normalised records (numeric class folder -> label -> one-hot)."""
    from tessera.plans.jobs import images_to_records

    root = _embedding_pngs(spark, sf)
    rec = images_to_records(spark, root, n_classes=10, channels=1)
    return rec.where(F.col("error").isNull()).select(
        L.base_name_label("key").cast("bigint").alias("vec_id"), "label",
        F.array_join("label_onehot", ",").alias("one_hot"), F.size("features").alias("n_features"),
        F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"))


@register("image_to_records_custom", """
WITH r AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS mn, CAST(max(list_max(embedding)) AS DOUBLE) AS mx
           FROM embeddings),
x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(vec_id % 5 AS INTEGER) AS label, CAST(vec_id % 5 AS VARCHAR) AS label_name,
       round(sum(floor((v - mn) / (mx - mn) * 255 + 0.5) / 127.5 - 1), 6) AS feature_sum
FROM x, r GROUP BY vec_id
""")
def q_image_to_records_custom(spark, sf):
    """The image-folder job with a label rule and a normaliser of the caller's."""
    from tessera.plans.jobs import images_to_records

    root = _embedding_pngs(spark, sf)
    rec = images_to_records(spark, root, n_classes=5, channels=1, label=lambda p: L.base_name_label(p).cast("int") % 5,
                            normalise=lambda c: F.transform(c, lambda x: x / 127.5 - 1))
    return rec.where(F.col("error").isNull()).select(
        L.base_name_label("key").cast("bigint").alias("vec_id"), "label", "label_name",
        F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"))


_SQL_PIXELS = """
WITH r AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS mn, CAST(max(list_max(embedding)) AS DOUBLE) AS mx
           FROM embeddings),
x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings),
px AS (SELECT vec_id, label, pos, floor((v - mn) / (mx - mn) * 255 + 0.5) AS p FROM x, r),
"""


@register("image_batches", _SQL_PIXELS + f"""
small AS (SELECT vec_id, label, (pos // 16) * 4 + (pos % 8) // 2 AS i, avg(p) / 255 AS v FROM px GROUP BY ALL),
o AS (SELECT vec_id, label, row_number() OVER (ORDER BY {_SQL_U.format(seed=123, key="rel")}, rel) - 1 AS n
      FROM (SELECT vec_id, label, CAST(label AS VARCHAR) || '/' || CAST(vec_id AS VARCHAR) || '.png' AS rel FROM embeddings)),
s AS (SELECT n // 20 AS b, sum(v * (n % 20 * 16 + i + 1)) AS c FROM small JOIN o USING (vec_id) GROUP BY 1)
SELECT CAST(b AS BIGINT) AS batch_id, '[' || CAST(count(*) AS VARCHAR) || ',1,4,4]' AS shape, round(any_value(c), 4) AS checksum,
       CAST(sum((n % 20 * 10 + o.label + 1)) AS BIGINT) AS label_checksum,
       string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY n) AS row_ids
FROM o JOIN s ON s.b = n // 20 GROUP BY b
""")
def q_image_batches(spark, sf):
    """Image files as batches of tensors, resized to 4 x 4, with one-hot labels; checksums over position and value."""
    from tessera.sources.images import image_batches

    b = image_batches(spark, _embedding_pngs(spark, sf), batch_size=20, height=4, width=4, channels=1, n_classes=10)
    weighted = lambda c: F.aggregate(F.transform(c, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return b.select(
        F.col("batch_id").cast("bigint").alias("batch_id"), F.concat(F.lit("["), F.array_join("shape", ","), F.lit("]")).alias("shape"),
        F.round(weighted("values"), 4).alias("checksum"), weighted("labels").cast("bigint").alias("label_checksum"),
        F.array_join(F.transform("paths", lambda p: F.split_part(F.element_at(F.split(p, "/"), -1), F.lit("."), F.lit(1))), ",")
        .alias("row_ids"))


def _fixed_base_and_head():
    """A frozen 64 -> 10 layer 'fc2' and a 10 -> 10 head, their weights given by a rule that SQL states as well."""
    from tessera.operators.models import Model
    k, d = np.arange(10)[:, None], np.arange(64)[None, :]
    base = Model([{"name": "fc2", "kind": "dense", "activation": "relu", "n_in": 64, "n_out": 10, "frozen": True},
                  {"name": "predictions", "kind": "output", "activation": "softmax", "n_in": 10, "n_out": 10}],
                 [{"W": ((k + 1) * (d + 1) % 7 - 3) / 50.0, "b": np.zeros(10)}, {"W": np.eye(10), "b": np.zeros(10)}], (64,), "base")
    c = np.arange(10)
    head = Model([{"name": "output", "kind": "output", "activation": "softmax", "n_in": 10, "n_out": 10}],
                 [{"W": ((c[:, None] + 2 * c[None, :]) % 5 - 2) / 10.0, "b": c / 100.0}], (10,), "head")
    return base, head


@register("predict_images", _SQL_PIXELS + """
k AS (SELECT unnest(range(10)) AS k),
h AS (SELECT vec_id, label, k, greatest(sum((((k + 1) * (pos + 1)) % 7 - 3) / 50.0 * (p - 127.5)), 0) AS a
      FROM px, k GROUP BY vec_id, label, k),
z AS (SELECT vec_id, h.label, c.k AS c, sum(((c.k + 2 * h.k) % 5 - 2) / 10.0 * a) + c.k / 100.0 AS z
      FROM h, k AS c GROUP BY vec_id, h.label, c.k),
p AS (SELECT *, row_number() OVER w AS rn, 1 / sum(exp(z - mz)) OVER (PARTITION BY vec_id) AS top
      FROM (SELECT *, max(z) OVER (PARTITION BY vec_id) AS mz FROM z) WINDOW w AS (PARTITION BY vec_id ORDER BY z DESC, c))
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(label AS VARCHAR) AS label_name, CAST(c AS INTEGER) AS prediction,
       CAST(c AS VARCHAR) AS predicted_name, round(top, 5) AS max_prob
FROM p WHERE rn = 1
""")
def q_predict_images(spark, sf):
    """I1 + I2 + P7 over image files: mean subtraction, the frozen base's features, a head's classes next to the folder's."""
    from tessera.plans.jobs import predict_images

    base, head = _fixed_base_and_head()
    pred = predict_images(spark, _embedding_pngs(spark, sf), base, "fc2", head, 10, 8, 8, 1, means=[127.5])
    return pred.where(F.col("error").isNull()).select(
        L.base_name_label("path").cast("bigint").alias("vec_id"), "label_name", "prediction", "predicted_name",
        F.round(F.array_max("scores"), 5).alias("max_prob"))


@register("archive_entries", """
SELECT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) || '/' || CAST(page_id AS VARCHAR) || '.html'
         AS entry,
       CAST(strlen(html) AS BIGINT) AS size, false AS unsafe, md5(html) AS content_md5
FROM pages
""")
def q_archive_entries(spark, sf):
    """S12 + A8: pages packed into zip / jar / tar / tar.gz archives (about
    500 pages per archive, a hot host spread over many), then expanded back
    into entry rows by the archive source; directory entries are counted
    separately."""
    import io
    import tarfile
    import zipfile

    from tessera.session import scratch_path
    from tessera.sources.archives import archive_entries, whole_entries
    from tessera.sources.sinks import write_files

    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    n_buckets = max(1, -(-pages.count() // 500))
    fmt = ["zip", "tar.gz", "tar", "jar"]
    pages = pages.select(
        S.url_host("url").alias("host"),
        F.pmod(F.xxhash64("page_id"), F.lit(n_buckets)).alias("bucket"),
        F.concat(S.url_host("url"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".html")).alias("entry"),
        F.encode("html", "UTF-8").alias("content"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        host, bucket = pdf["host"].iloc[0], int(pdf["bucket"].iloc[0])
        kind = fmt[bucket % len(fmt)]
        buf = io.BytesIO()
        if kind in ("zip", "jar"):
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr(f"{host}/", b"")
                for name, data in zip(pdf["entry"], pdf["content"]):
                    zf.writestr(name, bytes(data))
        else:
            with tarfile.open(fileobj=buf, mode="w:gz" if kind == "tar.gz" else "w") as tf:
                d = tarfile.TarInfo(f"{host}/")
                d.type = tarfile.DIRTYPE
                tf.addfile(d)
                for name, data in zip(pdf["entry"], pdf["content"]):
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    tf.addfile(info, io.BytesIO(bytes(data)))
        return pd.DataFrame({"rel_path": [f"{host}-{bucket}.{kind}"], "content": [buf.getvalue()]})

    archives = pages.groupBy("host", "bucket").applyInPandas(pack, "rel_path string, content binary")
    root = scratch_path(spark, "archives")
    write_files(archives, root).write.format("noop").mode("overwrite").save()
    ent = whole_entries(archive_entries(spark, root, with_content=True).where(~F.col("is_dir")))
    return ent.select("entry", "size", "unsafe", F.md5("content").alias("content_md5"))


# ------------------------------------------------------------------ more sources

@register("first_pages", """
SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 3
""")
def q_first_pages(spark, sf):
    """the first 3 items of a listing in a fixed order (a top-n report)."""
    return SM.first_n(table(spark, sf, "pages").select("page_id", "url"), 3, ["url", "page_id"])


@register("delimited_records", """
SELECT CAST(l_linenumber - 1 AS INTEGER) AS label, count(*) AS n,
       round(avg(l_quantity), 6) AS avg_f0, round(avg(l_extendedprice), 6) AS avg_f1,
       round(avg(l_discount), 6) AS avg_f2, round(avg(l_tax), 6) AS avg_f3
FROM lineitem GROUP BY l_linenumber
""")
def q_delimited_records(spark, sf):
    """S3 + P14 + P16: lineitem written as CSV part files (each with a header
    line), read back with an explicit schema skipping the first line of every
    file, then summarised per class."""
    from tessera.session import scratch_path
    from tessera.sources.text import read_delimited
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "csv")
    li.select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
              (F.col("l_linenumber") - 1).alias("label")).write.option("header", "true").csv(path)
    rec = read_delimited(spark, path, n_features=4, skip_lines=1, strict=True)
    return rec.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(F.col("features")[i]), 6).alias(f"avg_f{i}") for i in range(4)])


@register("records_roundtrip", """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n_features,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS feature_sum,
       array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), ',') AS one_hot
FROM embeddings
""")
def q_records_roundtrip(spark, sf):
    """K1 + S9: labelled records (features, label, one-hot) saved as parquet
    and read back."""
    from tessera.session import scratch_path
    from tessera.sources.sinks import read_records, save_records
    e = _emb(spark, sf)
    rec = e.select("vec_id", A.as_double_array("embedding").alias("features"), "label",
                   L.one_hot("label", 10).alias("label_onehot"))
    path = scratch_path(spark, "records")
    save_records(rec, path)
    back = read_records(spark, path)
    return back.select("vec_id", "label", F.size("features").alias("n_features"),
                       F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"),
                       F.array_join("label_onehot", ",").alias("one_hot"))


@register("bundle_splits", f"""
WITH u AS (SELECT page_id, html, {_SQL_U.format(seed=13, key="page_id")} AS u FROM pages),
r AS (SELECT *, row_number() OVER (ORDER BY u, page_id) AS rn, count(*) OVER () AS n FROM u)
SELECT page_id, CASE WHEN rn * 100 <= n * 80 THEN 'train' ELSE 'test' END AS split, md5(html) AS content_md5 FROM r
""")
def q_bundle_splits(spark, sf):
    """K3 + T1: the pages split 80/20 in seeded order and shipped with their
    content as one table partitioned by split; read back."""
    from tessera.session import scratch_path
    from tessera.sources.sinks import bundle
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    sp = SM.split_train_test(pages, None, "page_id", 80, seed=13)
    path = scratch_path(spark, "bundle")
    bundle({"train": sp.where(F.col("split") == "train").drop("split"),
            "test": sp.where(F.col("split") == "test").drop("split")}, path)
    return spark.read.parquet(path).select("page_id", F.col("split").cast("string").alias("split"),
                                           F.md5(F.col("html").cast("binary")).alias("content_md5"))


@register("text_lines", r"""
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM l WHERE line <> ''
""")
def q_text_lines(spark, sf):
    """S5 + F6: every document's whole text written as text files, read back
    as lines (newline-separated), empty lines dropped."""
    from tessera.session import scratch_path
    from tessera.sources.text import read_lines
    path = scratch_path(spark, "text")
    table(spark, sf, "documents").select("text").write.option("lineSep", "\n").text(path)
    lines = read_lines(spark, path, line_sep="\n")
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).cast("bigint").alias("n_chars"))
