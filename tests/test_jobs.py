"""End-to-end jobs: image folder -> records -> featurized batches -> trained head."""

import os

import numpy as np
from pyspark.sql import functions as F

from tessera.operators.models import Model, transfer_head
from tessera.operators.train import TrainConfig
from tessera.plans import jobs
from tessera.sources import images as IM


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_image_to_head_pipeline(spark, tmpdir_fresh):
    rng = np.random.default_rng(3)
    for cls in range(2):
        for i in range(12):
            base = 40 if cls == 0 else 200
            img = np.clip(rng.normal(base, 20, size=(8, 8)), 0, 255).astype(np.uint8)
            _write(f"{tmpdir_fresh}/img/{cls}/{i}.png", IM.encode_png(img))
    _write(f"{tmpdir_fresh}/img/1/bad.png", b"corrupt")
    _write(f"{tmpdir_fresh}/img/7/12.png", IM.encode_png(np.zeros((8, 8), dtype=np.uint8)))  # label out of range
    rec = jobs.images_to_records(spark, f"{tmpdir_fresh}/img", n_classes=2, channels=1,
                                 out_path=f"{tmpdir_fresh}/records")
    back = spark.read.parquet(f"{tmpdir_fresh}/records")
    assert back.where(F.col("error").isNull()).count() == 24 and back.where(F.col("error").isNotNull()).count() == 2
    assert max(back.where(F.col("error").isNull()).select(F.array_max("features")).first()) <= 1.0

    base = Model.build([{"kind": "dense", "activation": "relu", "n_out": 6, "name": "fc2"},
                        {"kind": "output", "activation": "softmax", "n_out": 2, "name": "out"}], (64,), seed=1)
    batches = jobs.featurize_and_save(rec, base, "fc2", f"{tmpdir_fresh}/batches", batch_size=5)
    splits = dict(batches.groupBy("split").count().collect())
    assert splits == {"train": 18, "test": 6}  # 12 per class, balanced, 80/20 exact per class (floor)
    again = jobs.featurize_and_save(rec, base, "fc2", f"{tmpdir_fresh}/batches", batch_size=5)
    assert again.count() == 24  # present: read back, not recomputed

    t = transfer_head(base, "fc2", 2)
    head = Model(t.layers[1:], t.params[1:], (6,), "head")
    res, stats = jobs.train_transfer_head(f"{tmpdir_fresh}/batches", head, 2,
                                          TrainConfig(n_workers=2, batch_size=4, max_epochs=2, learning_rate=0.1,
                                                      patience=None),
                                          save_model_path=f"{tmpdir_fresh}/models")
    assert stats.count() == 2 and res.total_epochs == 2
    assert Model.load(spark, f"{tmpdir_fresh}/models", "head").n_params() == head.n_params()


def test_predict_text_lines_and_saved_batches(spark, tmpdir_fresh):
    _write(f"{tmpdir_fresh}/t/a.txt", b"1,0,0\n0,1,1\n\n1,0,1\nbad,1,0\n")
    head = Model([{"name": "head", "kind": "output", "activation": "softmax", "n_in": 2, "n_out": 2}],
                 [{"W": np.eye(2), "b": np.zeros(2)}], (2,), "head")
    out = {r["value"]: r for r in jobs.predict_text_lines(spark, f"{tmpdir_fresh}/t", head, 2,
                                                          expected_width=3).collect()}
    assert out["1,0,0"]["prediction"] == 0 and out["0,1,1"]["predicted_name"] == "1"
    assert out["1,0,1"]["label"] == 1 and out["1,0,1"]["prediction"] == 0
    assert out["bad,1,0"]["error"] == "non-numeric cell" and len(out) == 4

    rows = [(i, [1.0, 0.0] if i % 2 == 0 else [0.0, 1.0], i % 2, i // 4) for i in range(12)]
    df = spark.createDataFrame(rows, "key long, features array<double>, label int, batch_id long")
    from tessera.sources.sinks import save_batches
    save_batches(df, f"{tmpdir_fresh}/b", "test")
    running, stats = jobs.evaluate_saved_batches(spark, f"{tmpdir_fresh}/b", head, 2)
    assert [r["cum_n"] for r in running.orderBy("batch_id").collect()] == [4, 8, 12]
    assert all(r["recall"] == 1.0 for r in stats.collect())


def test_predict_images_first_n(spark, tmpdir_fresh):
    for i in range(5):
        _write(f"{tmpdir_fresh}/im/{i % 2}/{i}.png", IM.encode_png(np.full((4, 4, 3), 10 * i, dtype=np.uint8)))
    base = Model.build([{"kind": "dense", "activation": "relu", "n_out": 3, "name": "fc2"}], (48,), seed=1)
    head = Model.build([{"kind": "output", "activation": "softmax", "n_out": 2}], (3,), seed=2)
    out = jobs.predict_images(spark, f"{tmpdir_fresh}/im", base, "fc2", head, 2, height=4, width=4,
                              means=[1.0, 2.0, 3.0], first=3).collect()
    assert len(out) == 3 and all(r["predicted_name"] in ("0", "1") for r in out)


def test_named_class_folders_get_alphabetical_index(spark, tmpdir_fresh):
    for cls in ("dog", "cat", "010.beer-mug"):
        _write(f"{tmpdir_fresh}/n/{cls}/1.png", IM.encode_png(np.zeros((3, 3), dtype=np.uint8)))
    rec = jobs.images_to_records(spark, f"{tmpdir_fresh}/n", n_classes=3, channels=1, label="index").collect()
    got = {r["label_name"]: (r["label"], r["error"]) for r in rec}
    assert got == {"010.beer-mug": (0, None), "cat": (1, None), "dog": (2, None)}
