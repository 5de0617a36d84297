"""Streaming scoring: predictions and running confusion over arriving files."""

import numpy as np

from tessera.operators.models import Model
from tessera.streaming import scoring as ST


def test_stream_scores_and_counts(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/in"
    schema = "key long, features array<double>, label int"
    rows = [(i, [float(i % 2), 1.0 - float(i % 2)], i % 2) for i in range(20)]
    spark.createDataFrame(rows[:10], schema).write.parquet(f"{src}/part1")
    model = Model([{"name": "head", "kind": "output", "activation": "softmax", "n_in": 2, "n_out": 2}],
                  [{"W": np.eye(2), "b": np.zeros(2)}], (2,), "head")
    stream = ST.read_records_stream(spark, f"{src}/*", spark.createDataFrame([], schema).schema)
    scored = ST.score_stream(stream, model)
    conf = ST.running_confusion(scored)
    q = (conf.writeStream.format("memory").queryName("conf_test").outputMode("complete")
             .option("checkpointLocation", f"{tmpdir_fresh}/ckpt").start())
    try:
        q.processAllAvailable()
        spark.createDataFrame(rows[10:], schema).write.parquet(f"{src}/part2")
        q.processAllAvailable()
        got = {(r["label"], r["prediction"]): r["n"] for r in spark.sql("select * from conf_test").collect()}
    finally:
        q.stop()
    # feature [1, 0] -> class 0 for label 1: the identity head predicts the mirrored class
    assert got == {(1, 0): 10, (0, 1): 10}
    out = f"{tmpdir_fresh}/pred"
    q2 = ST.start_predictions(scored, out, checkpoint=f"{tmpdir_fresh}/ckpt2")
    try:
        q2.processAllAvailable()
    finally:
        q2.stop()
    assert spark.read.parquet(out).count() == 20
