"""Training statistics: K5 (append to ``train_stats``), K6 (score report),
A7 (best entry), A8 (counters)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.constants import (REPORT_EPOCH_WIDTH, REPORT_HEADER_LEFT, REPORT_HEADER_LEFT_WIDTH,
                               REPORT_HEADER_RIGHT, REPORT_HEADER_RIGHT_WIDTH, REPORT_SCORE_WIDTH, REPORT_SEPARATOR)
from tessera.functions.strings import pad_right_keep


def best_epoch(scores: DataFrame, epoch_col: str = "epoch", score_col: str = "score") -> DataFrame:
    """The epoch with the lowest score (one aggregate row)."""
    return scores.agg(F.min_by(F.col(epoch_col), F.col(score_col)).cast("bigint").alias("best_epoch"),
                      F.min(score_col).alias("best_score"),
                      F.count(F.lit(1)).alias("n_epochs"))


def score_report(scores: DataFrame, epoch_col: str = "epoch", score_col: str = "score") -> DataFrame:
    """K6: a header line and one left-justified line per epoch
    (epoch padded to 15, score with 6 decimals padded to 10; never cut)."""
    spark = scores.sparkSession
    header = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("epoch"),
        F.concat(pad_right_keep(F.lit(REPORT_HEADER_LEFT), REPORT_HEADER_LEFT_WIDTH), F.lit(REPORT_SEPARATOR),
                 pad_right_keep(F.lit(REPORT_HEADER_RIGHT), REPORT_HEADER_RIGHT_WIDTH)).alias("line"))
    body = scores.select(
        F.col(epoch_col).cast("bigint").alias("epoch"),
        F.concat(pad_right_keep(F.col(epoch_col).cast("string"), REPORT_EPOCH_WIDTH), F.lit(REPORT_SEPARATOR),
                 pad_right_keep(F.format_string("%.6f", F.col(score_col)), REPORT_SCORE_WIDTH)).alias("line"))
    return header.unionByName(body)


def append_stats(stats: DataFrame, path: str) -> None:
    """K5: append rows to the ``train_stats`` parquet table."""
    stats.write.mode("append").parquet(path)


#: One row per worker and mini-batch
TRAIN_STATS = ["run", "epoch", "round", "worker", "iteration", "score", "n_rows", "millis"]


def append_iterations(epoch_rows: DataFrame, run: str, epoch: int, path: str) -> None:
    """K5: the workers' rows of one epoch (``epochs.EPOCH_SCHEMA``) appended to the ``train_stats`` table by the tasks that
    hold them; a second try of the epoch replaces its rows."""
    rows = epoch_rows.where(F.col("kind") == "iteration").withColumn("run", F.lit(run)).withColumn("epoch", F.lit(epoch))
    rows.select(*TRAIN_STATS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("run", "epoch").parquet(path)


def epoch_scores(iterations: DataFrame) -> DataFrame:
    """``run, epoch, score, n_rows``: the mean loss of each epoch over all rows its workers saw (partial aggregate)."""
    seen = F.sum("n_rows")
    return iterations.groupBy("run", "epoch").agg((F.sum(F.col("score") * F.col("n_rows")) / seen).alias("score"),
                                                  seen.alias("n_rows"))


def observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Aggregates counted in flight: ``df``, and an ``Observation`` whose ``get`` holds ``measures`` once an action has run
    over it. The job that writes the rows counts them; there is no job for the counts."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in measures.items()]), seen


def counters(df: DataFrame, group_col: str, flag_cols: list[str] | None = None) -> DataFrame:
    """Counts per group, plus ``count_if`` of boolean flags."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in flag_cols or []:
        aggs.append(F.count_if(F.col(c)).alias(f"n_{c}"))
    return df.groupBy(group_col).agg(*aggs)
