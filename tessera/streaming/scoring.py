"""Incremental scoring of arriving records with Structured Streaming.

The reference's jobs are all bounded; this module runs the same inference
(I1) and confusion counts (A1) over records that keep arriving as parquet
files in a folder, so a deployed head scores new batches as they land.
State (the running confusion counts) lives in the streaming checkpoint in
the shared scratch folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.operators.infer import predict
from tessera.operators.models import Model
from tessera.session import scratch_path


def read_records_stream(spark: SparkSession, folder: str, schema: StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """New parquet record files under ``folder`` as a stream (explicit schema)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def score_stream(records: DataFrame, model: Model, features_col: str = "features",
                 keep: Sequence[str] = ("key", "label")) -> DataFrame:
    """I1 on a stream: scores and prediction per arriving record."""
    return predict(records, model, features_col, keep=keep)


def running_confusion(scored: DataFrame, label_col: str = "label") -> DataFrame:
    """A1 on a stream: confusion counts over everything seen so far."""
    return (scored.where(F.col(label_col).isNotNull())
                  .groupBy(F.col(label_col).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
                  .agg(F.count(F.lit(1)).alias("n")))


def start_predictions(scored: DataFrame, out_path: str, checkpoint: str | None = None,
                      trigger_seconds: int | None = None) -> StreamingQuery:
    """Append predictions to a parquet table (exactly-once via the checkpoint)."""
    spark = scored.sparkSession
    w = (scored.select(*[c for c in scored.columns if c != "scores"], "scores").writeStream
               .format("parquet").option("path", out_path)
               .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
               .outputMode("append"))
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
