"""Seeded ordering, balancing, splitting and batching: F4, F5, F7, T1, T2, T3, P15.

Design rules (all hold at any table size):

* Order never comes from physical partitioning. It comes from a seeded
  32-bit hash of the key (``hash_uniform``), with the key itself as
  tie-break, so results are the same for any partition count or rerun.
* No window without ``partitionBy`` over the whole table (that is a single
  task). The seeded position (T2/T3) is a bucketed rank over hash buckets
  whose number follows the row count; a general total order (``global_index``) uses range partitioning
  + per-partition counts + offsets of a table with one row per partition.
* Ranking inside a class (F4/T1) splits every class into 2^bits hash
  buckets first, so a class holding a third of all rows is spread over many
  tasks; the per-bucket counts are a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

HASH_BITS = 32


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(seed, key) -> Column:
    """Seeded uniform integer in [0, 2^32) from md5(``seed:key``).

    SQL equivalent: ('0x' || substr(md5(seed || ':' || key), 1, 8))::BIGINT
    """
    text = F.concat(F.lit(str(seed)), F.lit(":"), _col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def validate_train_percent(train_percent: int) -> None:
    """the training share must leave something for the test side."""
    if not (0 < train_percent < 100):
        raise ValueError(
            f"train percentage must be in (0, 100); got {train_percent}: the test share "
            "(100 - train) has to be greater than 0")


def global_index(df: DataFrame, order_cols: Sequence, index_col: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order_cols``.

    ``order_cols`` must be a total order (end with a unique key). Plan:
    range-partition + local sort, tag rows with (partition id, increasing id),
    cut lineage to the shared checkpoint folder so ids are stable under task
    retries, count rows per partition (one row per partition), turn counts
    into offsets, and add offset + local position. One range shuffle; the
    offset table is bounded by the partition count, not by the data.
    """
    order = [_col(c) for c in order_cols]
    # no explicit count: the shuffle-partition setting applies and AQE may
    # coalesce small ranges, so tiny inputs do not become hundreds of tasks
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged.sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = cut_lineage(tagged)
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_mid0"))
    # one row per partition: this window is over a table of size n_partitions
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = (tagged.join(F.broadcast(offsets.select("_pid", "_off", "_mid0")), "_pid")
                 .withColumn(index_col, (F.col("_off") + F.col("_mid") - F.col("_mid0")).cast("bigint"))
                 .drop("_pid", "_mid", "_off", "_mid0"))
    return out


#: rows aimed at per (group, bucket) window; the number of buckets follows the table
ROWS_PER_BUCKET = 50_000


def bucket_bits_for(n_rows: int) -> int:
    """Bits of the hash that cut ``n_rows`` rows into buckets of about ``ROWS_PER_BUCKET``."""
    return max(2, min(HASH_BITS - 2, (n_rows // ROWS_PER_BUCKET).bit_length() + 2))


def group_offsets(df: DataFrame, group_cols: Sequence[str], hash_col: str, bucket_bits: int | None = None
                  ) -> DataFrame:
    """Per (group, hash bucket): rows before the bucket inside its group
    (``_before``) and the group size (``_gsize``).

    One partial aggregate over the data; the result has at most
    groups x 2^bucket_bits rows (the bits follow the row count unless given)
    and is cut to the shared checkpoint folder, so later uses (the join, the
    smallest class) do not scan the data again."""
    group_cols = list(group_cols)
    if bucket_bits is None:
        bucket_bits = bucket_bits_for(df.count())
    shift = HASH_BITS - bucket_bits
    counts = (df.withColumn("_bkt", F.shiftright(F.col(hash_col), shift))
                .groupBy(*group_cols, "_bkt").agg(F.count(F.lit(1)).alias("_bn")))
    # one group's window sees at most 2^bucket_bits rows
    wg = Window.partitionBy(*group_cols).orderBy("_bkt")
    offsets = (counts
               .withColumn("_before", F.coalesce(F.sum("_bn").over(wg.rowsBetween(Window.unboundedPreceding, -1)),
                                                 F.lit(0)))
               .withColumn("_gsize", F.sum("_bn").over(Window.partitionBy(*group_cols)))
               .withColumn("_shift", F.lit(shift))
               .drop("_bn"))
    return cut_lineage(offsets)


def rank_within_groups(df: DataFrame, group_cols: Sequence[str], hash_col: str, key_col: str,
                       rank_col: str = "rank", size_col: str | None = None,
                       bucket_bits: int | None = None, offsets: DataFrame | None = None) -> DataFrame:
    """Exact 1-based rank of each row inside its group, ordered by
    (``hash_col``, ``key_col``), without putting a whole group in one task.

    ``hash_col`` must be uniform in [0, 2^32) and may be NULL (such rows come
    first in their group). Rows are split into 2^bucket_bits buckets by the top
    bits of the hash; per-(group, bucket) counts (partial aggregate,
    ``group_offsets``) give each bucket its offset inside the group; the final
    row_number runs per (group, bucket). NULL groups are groups of their own.
    ``size_col`` adds the group size. Spark picks the join by the measured size
    of the written offsets.
    """
    group_cols = list(group_cols)
    if offsets is None:
        offsets = group_offsets(df, group_cols, hash_col, bucket_bits)
    first = offsets.select("_shift").first()
    shift = first["_shift"] if first is not None else HASH_BITS - 2
    with_bucket = df.withColumn("_bkt", F.shiftright(F.col(hash_col), shift))
    keys = group_cols + ["_bkt"]
    side = offsets.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(keys)], "_before",
                          *([F.col("_gsize").alias(size_col)] if size_col else []))
    same = reduce(lambda a, b: a & b, [with_bucket[c].eqNullSafe(side[f"_o{i}"]) for i, c in enumerate(keys)])
    joined = with_bucket.join(side, same, "inner").drop(*[f"_o{i}" for i in range(len(keys))])
    wb = Window.partitionBy(*keys).orderBy(F.col(hash_col), F.col(key_col))
    return (joined.withColumn(rank_col, (F.col("_before") + F.row_number().over(wb)).cast("bigint"))
                  .drop("_bkt", "_before"))


def balanced_sample(df: DataFrame, label_col: str, key_col: str, seed: int = 13,
                    bucket_bits: int | None = None) -> DataFrame:
    """keep the same number of rows from every class — the size of the
    smallest class — choosing rows by seeded hash order. Rows without a
    class take no part."""
    u = df.where(F.col(label_col).isNotNull()).withColumn("_u", hash_uniform(seed, F.col(key_col)))
    offsets = group_offsets(u, [label_col], "_u", bucket_bits)
    min_class = offsets.agg(F.min("_gsize")).first()[0]
    if min_class is None:
        return df.limit(0)
    ranked = rank_within_groups(u, [label_col], "_u", key_col, rank_col="_r", bucket_bits=bucket_bits,
                                offsets=offsets)
    return ranked.where(F.col("_r") <= F.lit(min_class)).drop("_u", "_r")


def split_train_test(df: DataFrame, label_col: str | None, key_col: str, train_percent: int = 80,
                     seed: int = 13, exact: bool = True, split_col: str = "split",
                     bucket_bits: int | None = None) -> DataFrame:
    """Deterministic train/test split.

    ``exact=True``: per class, the first floor(train% of the class) rows by
    seeded hash order are 'train' (rank * 100 <= train% * class size).
    ``exact=False``: per row, 'train' iff its hash falls under train% of the
    hash range — no aggregation at all, approximately train% per class.
    """
    validate_train_percent(train_percent)
    u = df.withColumn("_u", hash_uniform(seed, F.col(key_col)))
    if not exact:
        cut = (train_percent * (1 << HASH_BITS)) // 100
        return (u.withColumn(split_col, F.when(F.col("_u") < F.lit(cut), "train").otherwise("test"))
                 .drop("_u"))
    groups = [label_col] if label_col else []
    if not groups:
        u = u.withColumn("_g", F.lit(0))
        groups = ["_g"]
    ranked = rank_within_groups(u, groups, "_u", key_col, rank_col="_r", size_col="_n",
                                bucket_bits=bucket_bits)
    out = ranked.withColumn(
        split_col, F.when(F.col("_r") * 100 <= F.col("_n") * train_percent, "train").otherwise("test"))
    return out.drop("_u", "_r", "_n", "_g")


def seeded_order(df: DataFrame, key_col: str, seed: int = 123, pos_col: str = "pos",
                 bucket_bits: int | None = None) -> DataFrame:
    """Seeded shuffle — each row's 0-based position in md5(seed:key) order.

    The order key is a uniform 32-bit hash, so the position is the bucketed
    rank of one global group: per-bucket counts (a partial aggregate over
    buckets of about ``ROWS_PER_BUCKET`` rows) give offsets, and a window per bucket numbers
    the rows. No range sampling pass and no full-data checkpoint; a window
    task holds about one bucket."""
    u = df.withColumn("_u", hash_uniform(seed, F.col(key_col))).withColumn("_g", F.lit(0))
    ranked = rank_within_groups(u, ["_g"], "_u", key_col, rank_col="_r", bucket_bits=bucket_bits)
    return ranked.withColumn(pos_col, F.col("_r") - 1).drop("_u", "_g", "_r")


def minibatches(df: DataFrame, key_col: str, batch_size: int, seed: int = 123,
                batch_col: str = "batch_id", row_col: str = "row_in_batch", within: Sequence[str] = ()) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in seeded order; the
    last batch may be short. With ``within`` each value of those columns (e.g.
    the split) has its own batches, from one pass."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    if within:
        u = df.withColumn("_u", hash_uniform(seed, F.col(key_col)))
        ordered = rank_within_groups(u, within, "_u", key_col, rank_col="_r") \
            .withColumn("_pos", F.col("_r") - 1).drop("_u", "_r")
    else:
        ordered = seeded_order(df, key_col, seed=seed, pos_col="_pos")
    return (ordered.withColumn(batch_col, F.floor(F.col("_pos") / batch_size).cast("bigint"))
                   .withColumn(row_col, (F.col("_pos") % batch_size).cast("int"))
                   .drop("_pos"))


def assemble_batches(df: DataFrame, batch_col: str, row_col: str, features_col: str,
                     label_col: str | None = None, extra_shape: Sequence[int] | None = None) -> DataFrame:
    """One row per batch holding a dense tensor ``[rows, *example_shape]``
    (row-major ``values``) plus the labels in row order.

    Groups are bounded by the batch size (T3), so collecting a batch is
    bounded whatever the table size. ``extra_shape`` gives the example shape
    (e.g. [c, h, w]); by default an example is a vector. Total rank must be
    2, 3 or 4.
    """
    items = [F.col(row_col).alias("r"), F.col(features_col).alias("f")]
    if label_col:
        items.append(F.col(label_col).alias("l"))
    g = df.groupBy(batch_col).agg(F.array_sort(F.collect_list(F.struct(*items))).alias("_items"))
    ex_shape = [F.lit(int(s)) for s in extra_shape] if extra_shape else [F.size(F.col("_items")[0]["f"])]
    rank = 1 + len(ex_shape)
    if rank not in (2, 3, 4):
        raise ValueError(f"Unexpected rank: {rank}")
    out = g.select(
        F.col(batch_col),
        F.size("_items").alias("n_rows"),
        F.array(F.size("_items"), *ex_shape).alias("shape"),
        F.flatten(F.transform("_items", lambda s: s["f"])).alias("values"),
        *([F.transform("_items", lambda s: s["l"]).alias("labels")] if label_col else []),
    )
    return out


def first_n(df: DataFrame, n: int, order_cols: Sequence) -> DataFrame:
    """the first ``n`` rows in a given order (a top-n, by design)."""
    return df.orderBy(*[_col(c) for c in order_cols]).limit(n)


def drop_empty_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """keep non-empty lines."""
    return df.where(F.col(col) != "")


def running_totals(df: DataFrame, order_col: str, value_cols: Sequence[str],
                   num_partitions: int | None = None) -> DataFrame:
    """Cumulative sums of integer columns in ``order_col`` order (``cum_<c>``),
    without a whole-table window: range partition + local sort, lineage cut,
    per-partition totals (one row per partition) -> offsets, then a running
    sum inside each partition (Arrow batches, state carried across batches).
    ``order_col`` must be unique.
    """
    value_cols = list(value_cols)
    ranged = (df.repartitionByRange(num_partitions, F.col(order_col)) if num_partitions
              else df.repartitionByRange(F.col(order_col)))
    tagged = (ranged.sortWithinPartitions(order_col)
                .withColumn("_pid", F.spark_partition_id()))
    tagged = cut_lineage(tagged)
    totals = tagged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # n_partitions rows
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(w), F.lit(0)).cast("bigint")
                                      .alias(f"_o_{c}") for c in value_cols])

    out_schema = T.StructType(list(tagged.schema.fields)
                              + [T.StructField(f"_l_{c}", T.LongType()) for c in value_cols])

    def local_cumsum(batches):
        carry = {c: 0 for c in value_cols}
        for pdf in batches:
            for c in value_cols:
                cs = pdf[c].fillna(0).astype("int64").cumsum() + carry[c]
                if len(cs):
                    carry[c] = int(cs.iloc[-1])
                pdf[f"_l_{c}"] = cs
            yield pdf

    local = tagged.mapInPandas(local_cumsum, out_schema)
    out = local.join(F.broadcast(offsets), "_pid")
    for c in value_cols:
        out = out.withColumn(f"cum_{c}", (F.col(f"_l_{c}") + F.col(f"_o_{c}")).cast("bigint"))
    return out.drop("_pid", *[f"_l_{c}" for c in value_cols], *[f"_o_{c}" for c in value_cols])
