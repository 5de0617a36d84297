"""Operator 5: exact duplicates by progressive refinement (DataFrame functions only).

1. rows are counted by the byte length of the normalised text;
2. rows whose length is shared are counted by (length, prefix hash);
3. only rows whose (length, prefix hash) is shared have their whole text
   hashed (SHA-256); equal hashes are one class.

Counts are partial aggregates, so a group holding a third of the rows costs one
row per task; its rows meet the group's result in a left join that AQE can
split. The two key tables are written to the shared folder between the levels:
Spark then knows their size and broadcasts them only under its own limit.

Null text counts as empty; rows with a null id keep their row but form no id for
others; of equal texts the largest id stays; an empty table gives no rows. Ids may
repeat: results are told apart by id and text hash. Of rows with one id and equal
texts, ``drop_copies`` keeps the one with the smallest text, then with the smallest
hash of all columns; rows with a null id all stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import lower_ascii, only, text_or_empty
from tessera.session import scratch_path

PREFIX_CHARS = 256


def normalised(text: Column | str) -> Column:
    """Equality of texts: A-Z lower-cased, null as empty."""
    return lower_ascii(text_or_empty(text))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _classes(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> tuple[DataFrame, DataFrame]:
    """Rows that passed both counts, as ``id_col, _sha``, and the classes of two rows or more: ``_sha, keep_id, group_size``."""
    rows = only(docs, id_col, text_col).select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumns({
        "_len": F.octet_length("_text"),
        "_prefix": F.xxhash64(lower_ascii(F.substring("_text", 1, prefix_chars)))})
    lengths = _written(rows.groupBy("_len").agg(F.count("*").alias("_n")).filter("_n > 1").select("_len"), "dedup-len")
    prefixes = _written(
        rows.select("_len", "_prefix").join(lengths, "_len", "left_semi")
        .groupBy("_len", "_prefix").agg(F.count("*").alias("_n")).filter("_n > 1").select("_len", "_prefix"),
        "dedup-prefix")
    # the third level reads whole texts, of surviving rows only, and keeps 32 bytes of each
    hashed = _written(
        rows.join(prefixes, ["_len", "_prefix"], "left_semi")
        .select(id_col, F.unhex(F.sha2(lower_ascii(F.col("_text")), 256)).alias("_sha")), "dedup-hash")
    # written as well, so that the join shuffles either side for itself and AQE may split a hot class
    groups = _written(hashed.groupBy("_sha").agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size"))
                      .filter("group_size > 1"), "dedup-classes")
    return hashed, groups


def copy_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Rows of documents that share their text with another: ``id_col, keep_id, group_size``.

    Documents with no copy are left out, and their whole text is never hashed.
    """
    hashed, groups = _classes(docs, id_col, text_col, prefix_chars)
    return hashed.join(groups, "_sha").select(id_col, "keep_id", "group_size")


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256``.

    The report carries a hash of every text, so this function hashes what the
    operator did not need to, and meets the classes by that hash.
    """
    groups = _classes(docs, id_col, text_col, PREFIX_CHARS)[1]
    digest = only(docs, id_col, text_col).select(
        F.col(id_col), F.sha2(normalised(text_col), 256).alias("text_sha256"))
    joined = digest.join(groups, F.unhex(digest["text_sha256"]) == groups["_sha"], "left")
    keep = F.coalesce(F.col("keep_id"), F.col(id_col))
    return joined.select(id_col, keep.alias("keep_id"),
                         F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         (keep.eqNullSafe(F.col(id_col))).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the copies that go, all columns kept."""
    hashed, groups = _classes(docs, id_col, text_col, PREFIX_CHARS)
    counts = hashed.groupBy(F.col(id_col).alias("_gone"), "_sha").agg(F.count("*").alias("_n"))
    gone = _written(counts.join(groups, "_sha").filter((F.col("keep_id") != F.col("_gone")) | (F.col("_n") > 1))
                    .select("_gone", "_sha", (F.col("keep_id") == F.col("_gone")).alias("_repeated")), "dedup-gone")
    sha = F.unhex(F.sha2(normalised(docs[text_col]), 256))
    same = lambda pairs: (docs[id_col] == pairs["_gone"]) & (sha == pairs["_sha"])
    left = docs.join(gone, same(gone), "left_anti")
    repeated = gone.filter("_repeated")
    if repeated.isEmpty():
        return left
    rows = docs.join(repeated, same(repeated), "left_semi")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    first = rows.groupBy(F.col(f"`{id_col}`").alias("_id"), F.sha2(normalised(F.col(f"`{text_col}`")), 256).alias("_key")) \
        .agg(F.min_by(F.struct(*cols), F.struct(text_or_empty(F.col(f"`{text_col}`")), F.xxhash64(*cols))).alias("_row"))
    return left.unionByName(first.select("_row.*"))
