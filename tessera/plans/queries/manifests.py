"""Driver queries: URL manifests and file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.functions import strings as S
from tessera.plans.queries._registry import ORACLE, register
from tessera.session import table


# ------------------------------------------------------------------ manifests

MANIFEST_ROOT = "/data/images"

# pages -> manifest files: one file per host ("<host>.txt"), one line per page
# "<page_id>  <url>" (two spaces: empty tokens must be skipped)
_SQL_MANIFEST = r"""
WITH lines AS (
  SELECT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) || '.txt' AS file_name,
         CAST(page_id AS VARCHAR) || '  ' || url AS value
  FROM pages),
tok AS (
  SELECT file_name,
         list_filter(list_transform(string_split(value, ' '), lambda t: trim(t)), lambda t: t <> '') AS t
  FROM lines),
m AS (
  SELECT file_name, CAST(t[1] AS BIGINT) AS page_id, CASE WHEN len(t) >= 2 THEN t[2] END AS url FROM tok),
n AS (
  SELECT *, string_split_regex(regexp_replace(url, '[/\\]+$', ''), '[/\\]')[-1] AS local
  FROM m),
x AS (
  SELECT *, CASE WHEN strpos(reverse(local), '.') > 0
                  AND length(local) - strpos(reverse(local), '.') + 1 > 1
             THEN regexp_extract(local, '[.]([^.]*)$', 1) END AS ext
  FROM n),
plan AS (
  SELECT page_id, file_name, url, ext,
         CAST(dense_rank() OVER (ORDER BY file_name) - 1 AS INTEGER) AS class_index,
         CASE WHEN coalesce(list_contains(['bmp', 'gif', 'jpg', 'jpeg', 'jp2', 'pbm', 'pgm', 'ppm', 'pnm',
                  'png', 'tif', 'tiff', 'exr', 'webp', 'BMP', 'GIF', 'JPG', 'JPEG', 'JP2', 'PBM', 'PGM', 'PPM',
                  'PNM', 'PNG', 'TIF', 'TIFF', 'EXR', 'WEBP'], ext), false) THEN local
              WHEN strpos(url, '.') > 0 THEN local || '.jpg' END AS local_name
  FROM x),
planned AS (
  SELECT *,
         lpad(CAST(class_index AS VARCHAR), CAST(greatest(length(CAST(class_index AS VARCHAR)), 4) AS INTEGER), '0') || '.' ||
           substr(file_name, 1, CAST(greatest(length(file_name) - 4, 0) AS INTEGER)) AS class_dir
  FROM plan),
targets AS (
  SELECT *, '/data/images/' || class_dir || '/' || local_name AS target_path FROM planned)
"""


def _manifest_lines(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select(S.url_host("url").alias("host"),
                    F.concat(F.col("page_id").cast("string"), F.lit("  "), F.col("url")).alias("value")) \
            .select(F.concat(F.col("host"), F.lit(".txt")).alias("file_name"), "value")


def _manifest_plan(spark, sf):
    from tessera.sources.manifest import manifest_tokens, parse_manifest
    lines = _manifest_lines(spark, sf).withColumn(
        "page_id", F.element_at(manifest_tokens("value"), 1).cast("bigint"))
    return parse_manifest(lines, MANIFEST_ROOT, keep=("page_id",))


@register("url_manifest", _SQL_MANIFEST + "SELECT page_id, file_name, url FROM targets")
def q_url_manifest(spark, sf):
    """Manifest lines -> (file, second token = URL)."""
    return _manifest_plan(spark, sf).select("page_id", "file_name", "url")


@register("class_dir", _SQL_MANIFEST + "SELECT DISTINCT file_name, class_index, class_dir FROM targets")
def q_class_dir(spark, sf):
    """P3 + P9 + P12: class directory per manifest file."""
    return _manifest_plan(spark, sf).select("file_name", "class_index", "class_dir").distinct()


@register("target_path", _SQL_MANIFEST + "SELECT page_id, local_name, target_path FROM targets")
def q_target_path(spark, sf):
    """P11 + P13: local file name and full target path per URL."""
    return _manifest_plan(spark, sf).select("page_id", "local_name", "target_path")


@register("manifest_skip_existing", _SQL_MANIFEST + """
, existing AS (
  SELECT t.target_path FROM targets t JOIN pages p USING (page_id) WHERE strlen(p.html) >= 10240)
SELECT page_id, target_path FROM targets t
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.target_path = t.target_path)
""")
def q_manifest_skip_existing(spark, sf):
    """skip planned downloads whose target is already present; "present"
    = the page's stored html is at least the small-file limit (F2)."""
    from tessera.sources.files import SMALL_FILE_BYTES, skip_existing
    plan = _manifest_plan(spark, sf)
    pages = table(spark, sf, "pages").select("page_id", F.octet_length("html").alias("length"))
    existing = plan.join(pages.where(F.col("length") >= SMALL_FILE_BYTES), "page_id").select("target_path")
    return skip_existing(plan, existing, on="target_path").select("page_id", "target_path")


@register("manifest_skip_stored", ORACLE["manifest_skip_existing"])
def q_manifest_skip_stored(spark, sf):
    """F3 over a stored, bucketed list of what is present (kept between runs; here it is written first)."""
    import uuid

    from tessera.session import scratch_path
    from tessera.sources.files import SMALL_FILE_BYTES, skip_existing_stored
    from tessera.sources.sinks import save_bucketed
    plan = _manifest_plan(spark, sf)
    pages = table(spark, sf, "pages").select("page_id", F.octet_length("html").alias("length"))
    existing = plan.join(pages.where(F.col("length") >= SMALL_FILE_BYTES), "page_id").select("target_path")
    stored = save_bucketed(existing, f"present_{uuid.uuid4().hex[:12]}", "target_path", 8, scratch_path(spark, "present"))
    return skip_existing_stored(plan, stored).select("page_id", "target_path")


@register("observed_counts", _SQL_MANIFEST + """
SELECT count(*) AS n_lines, count(target_path) AS n_targets, CAST(max(class_index) + 1 AS BIGINT) AS n_classes FROM targets
""")
def q_observed_counts(spark, sf):
    """Lines, targets and classes of the download plan, counted while it is written."""
    from tessera.operators.stats import observed
    from tessera.session import scratch_path
    plan, seen = observed(_manifest_plan(spark, sf), "plan", n_lines=F.count(F.lit(1)), n_targets=F.count("target_path"),
                          n_classes=(F.max("class_index") + 1).cast("long"))
    plan.write.parquet(scratch_path(spark, "plan"))
    counts = seen.get
    return spark.createDataFrame([tuple(counts[c] for c in ("n_lines", "n_targets", "n_classes"))],
                                 "n_lines long, n_targets long, n_classes long")


@register("small_items", """
SELECT 'page' AS kind, page_id AS item_id, CAST(strlen(html) AS BIGINT) AS size, strlen(html) < 10240 AS is_small
FROM pages
UNION ALL
SELECT 'document' AS kind, doc_id AS item_id, CAST(n_chars AS BIGINT) AS size, n_chars < 10240 AS is_small
FROM documents
""")
def q_small_items(spark, sf):
    """flag items under 10 KiB (flag only)."""
    from tessera.sources.files import flag_small
    p = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("item_id"),
                                         F.octet_length("html").cast("bigint").alias("size"))
    d = table(spark, sf, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("item_id"),
                                             F.col("n_chars").cast("bigint").alias("size"))
    return flag_small(p.unionByName(d), size_col="size")


@register("extension_counts", _SQL_MANIFEST + """
SELECT ext AS extension, count(*) AS n_files,
       coalesce(list_contains(['bmp', 'gif', 'jpg', 'jpeg', 'jp2', 'pbm', 'pgm', 'ppm', 'pnm',
                  'png', 'tif', 'tiff', 'exr', 'webp', 'BMP', 'GIF', 'JPG', 'JPEG', 'JP2', 'PBM', 'PGM', 'PPM',
                  'PNM', 'PNG', 'TIF', 'TIFF', 'EXR', 'WEBP'], ext), false) AS allowed
FROM targets GROUP BY ext
""")
def q_extension_counts(spark, sf):
    """F1 + A8: extension of every URL's file name, counted, with the whitelist flag."""
    p = table(spark, sf, "pages").select(L.base_name("url").alias("local"))
    ext = p.select(S.file_extension("local").alias("extension"))
    return ext.groupBy("extension").agg(F.count(F.lit(1)).alias("n_files")) \
              .withColumn("allowed", F.coalesce(F.col("extension").isin(S.ALLOWED_IMAGE_FORMATS), F.lit(False)))


@register("manifest_files", _SQL_MANIFEST + """
SELECT file_name, url, class_index, class_dir, local_name, target_path FROM targets
""")
def q_manifest_files(spark, sf):
    """S13 over files: one manifest per host, written as part files of bounded length (a hot host is many), then read and
    planned."""
    from tessera.session import scratch_path
    from tessera.sources.manifest import read_manifest, write_manifest

    p = table(spark, sf, "pages").select("page_id", "url")
    lines = p.select(F.concat(S.url_host("url"), F.lit(".txt")).alias("file_name"),
                     F.concat(F.col("page_id").cast("string"), F.lit("  "), F.col("url")).alias("value"))
    root = scratch_path(spark, "manifests")
    write_manifest(lines, root, rows_per_part=200)
    return read_manifest(spark, root, MANIFEST_ROOT, in_parts=True).select(
        "file_name", "url", "class_index", "class_dir", "local_name", "target_path")
