"""Training as Spark jobs: determinism, equivalence with a plain loop, early stopping, model tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import nets
from tessera.operators import train as TR
from tessera.operators.models import Model, summary, transfer_head


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(3, 4)) * 2
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((i, [float(v) for v in centers[c] + rng.normal(size=4) * 0.5], c))
    return spark.createDataFrame(rows, "key long, features array<double>, label int")


def _model():
    return Model.build([{"kind": "dense", "activation": "relu", "n_out": 6},
                        {"kind": "output", "activation": "softmax", "n_out": 3}], (4,), seed=11)


def test_single_worker_equals_plain_loop(spark, data):
    cfg = TR.TrainConfig(n_workers=1, batch_size=16, averaging_frequency=5, max_epochs=1, learning_rate=0.05,
                         momentum=0.9, l2=1e-3, patience=None)
    res = TR.fit(data, _model(), cfg, key_col="key")
    # plain NumPy loop over the same order (worker table written by `prepare`)
    path, n_rounds = TR.prepare(data, "key", "features", "label", cfg)
    t = spark.read.parquet(path).toPandas().sort_values(["round_id", "batch_in_round", "row_order"])
    m = _model()
    w, v = m.flat(), np.zeros(m.n_params())
    shp = m.shapes()
    for _, g in t.groupby(["round_id", "batch_in_round"], sort=True):
        x = np.stack(g["features"].to_numpy())
        loss, grads = nets.loss_and_grads(m.layers, nets.unflatten_params(w, shp), x,
                                          g["label"].to_numpy(), l2=1e-3)
        gv = nets.flatten_params(grads)
        v_prev = v.copy()
        v = 0.9 * v - 0.05 * gv
        w = w - 0.9 * v_prev + 1.9 * v
    assert np.allclose(res.model.flat(), w, atol=1e-9)


def test_result_independent_of_partitioning(spark, data):
    cfg = TR.TrainConfig(n_workers=3, batch_size=8, averaging_frequency=2, max_epochs=2, learning_rate=0.05,
                         patience=None)
    a = TR.fit(data, _model(), cfg, key_col="key").model.flat()
    b = TR.fit(data.repartition(7), _model(), cfg, key_col="key").model.flat()
    assert np.allclose(a, b, atol=1e-12)


def test_training_reduces_loss_and_early_stops(spark, data):
    train, test = data.where(F.col("key") % 5 != 0), data.where(F.col("key") % 5 == 0)
    cfg = TR.TrainConfig(n_workers=2, batch_size=16, averaging_frequency=3, max_epochs=30, learning_rate=0.1,
                         patience=2, min_improvement=1e-3)
    res = TR.fit(train, _model(), cfg, key_col="key", test=test)
    scores = [res.scores[e] for e in sorted(res.scores)]
    assert scores[0] < 1.2 and min(scores) < scores[0]
    assert res.termination_detail.startswith("ScoreImprovement") or res.total_epochs == 30
    # a new best needs an improvement of more than min_improvement
    assert res.best_score == res.scores[res.best_epoch] and res.best_score <= min(scores) + 1e-3


def test_max_score_condition(spark, data):
    cfg = TR.TrainConfig(n_workers=2, batch_size=16, max_epochs=5, learning_rate=0.01, max_score=0.0,
                         patience=None)
    res = TR.fit(data, _model(), cfg, key_col="key")
    assert res.termination_detail.startswith("MaxScore") and res.total_epochs == 1


def test_model_tables_roundtrip_and_summary(spark, tmpdir_fresh):
    m = _model()
    m.name = "m1"
    m.save(spark, tmpdir_fresh)
    back = Model.load(spark, tmpdir_fresh, "m1")
    assert np.allclose(back.flat(), m.flat()) and back.layers[0]["kind"] == "dense"
    layers, params = m.to_tables(spark)
    s = {r["pos"]: r["n_params"] for r in summary(layers, params).collect()}
    assert s == {0: 4 * 6 + 6, 1: 6 * 3 + 3}


def test_transfer_head_freezes_and_replaces():
    base = Model.build([{"kind": "dense", "activation": "relu", "n_out": 5, "name": "fc1"},
                        {"kind": "dense", "activation": "relu", "n_out": 4, "name": "fc2"},
                        {"kind": "output", "activation": "softmax", "n_out": 3, "name": "out"}], (6,), seed=2)
    t = transfer_head(base, "fc2", 7)
    assert [ly.get("frozen") for ly in t.layers] == [True, True, False]
    assert t.params[2]["W"].shape == (7, 4)
    assert np.array_equal(t.params[0]["W"], base.params[0]["W"])


def test_stats_table_appended(spark, data, tmpdir_fresh):
    cfg = TR.TrainConfig(n_workers=2, batch_size=32, averaging_frequency=2, max_epochs=2, learning_rate=0.05,
                         patience=None)
    import glob
    from tessera.session import ensure_checkpoint_dir
    ckpt = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{ckpt}/train-table-*"))
    res = TR.fit(data, _model(), cfg, key_col="key", run="r1", stats_path=f"{tmpdir_fresh}/stats")
    assert set(glob.glob(f"{ckpt}/train-table-*")) == before  # this run's table is removed afterwards
    st = spark.read.parquet(f"{tmpdir_fresh}/stats")
    n_rounds = max(r[2] for r in res.stats) + 1
    assert st.where("round >= 0").count() == 2 * n_rounds and st.where("round = -1").count() == 2
    assert set(r["run"] for r in st.collect()) == {"r1"}
    table = TR.epoch_table(res, spark).collect()
    assert [r["epoch"] for r in table] == [0, 1] and sum(r["is_best"] for r in table) == 1


def test_evaluate_every_n_epochs(spark, data):
    train, test = data.where(F.col("key") % 5 != 0), data.where(F.col("key") % 5 == 0)
    cfg = TR.TrainConfig(n_workers=2, batch_size=32, averaging_frequency=2, max_epochs=5, learning_rate=0.05,
                         patience=None, evaluate_every=2)
    res = TR.fit(train, _model(), cfg, key_col="key", test=test)
    assert sorted(res.scores) == [1, 3, 4]  # every 2nd epoch and the last one
    empty = TR.fit(train, _model(), TR.TrainConfig(n_workers=1, batch_size=64, max_epochs=1, patience=None),
                   key_col="key", test=test.where("key < 0"))
    assert np.isnan(empty.scores[0]) and empty.best_epoch == 0


def test_target_accuracy_and_cache(spark, data):
    train, test = data.where(F.col("key") % 5 != 0), data.where(F.col("key") % 5 == 0)
    cfg = TR.TrainConfig(n_workers=2, batch_size=16, averaging_frequency=3, max_epochs=20, learning_rate=0.1,
                         patience=None, target_accuracy=0.9, cache=True)
    res = TR.fit(train, _model(), cfg, key_col="key", test=test)
    assert res.termination_detail == "TargetAccuracy(0.9)" and res.total_epochs < 20


def test_saved_model_keeps_updater_and_input_shape(spark, data, tmpdir_fresh):
    cfg = TR.TrainConfig(n_workers=1, batch_size=32, max_epochs=1, learning_rate=0.05, patience=None)
    res = TR.fit(data, _model(), cfg, key_col="key")
    assert np.any(res.model.meta["updater"] != 0)
    res.model.name = "with_state"
    res.model.save(spark, tmpdir_fresh)
    back = Model.load(spark, tmpdir_fresh, "with_state")
    assert np.allclose(back.meta["updater"], res.model.meta["updater"]) and back.input_dims == (4,)
    conv = Model.build([{"kind": "conv", "activation": "relu", "n_out": 2, "kernel": 3, "channels_in": 3},
                        {"kind": "output", "activation": "softmax", "n_out": 2}], (3, 6, 10), seed=1)
    conv.name = "wide"
    conv.save(spark, tmpdir_fresh)
    assert Model.load(spark, tmpdir_fresh, "wide").input_dims == (3, 6, 10)


def test_saving_one_model_keeps_the_others(spark, tmpdir_fresh):
    a, b = _model(), _model()
    a.name, b.name = "a", "b"
    a.save(spark, tmpdir_fresh)
    b.save(spark, tmpdir_fresh)
    a.save(spark, tmpdir_fresh)  # overwrite only partition model=a
    names = {r["model"] for r in spark.read.parquet(f"{tmpdir_fresh}/model_layers").select("model").collect()}
    assert names == {"a", "b"}


def test_time_budget_stops_after_first_round(spark, data):
    cfg = TR.TrainConfig(n_workers=2, batch_size=16, averaging_frequency=1, max_epochs=5, learning_rate=0.05,
                         patience=None, max_minutes=1e-9)
    res = TR.fit(data, _model(), cfg, key_col="key")
    assert res.termination_reason == "IterationTerminationCondition"
    assert res.termination_detail.startswith("MaxTime") and res.total_epochs == 1
    assert sum(1 for r in res.stats if r[2] >= 0) == 1  # one round ran


def test_a_round_runs_one_task_per_worker_and_skips_null_rows(spark, monkeypatch):
    rows = [(i, [float(i % 3), 1.0], i % 2) for i in range(400)] + [(900, None, 1), (901, [1.0, 2.0], None)]
    data = spark.createDataFrame(rows, "key long, features array<double>, label int")
    cfg = TR.TrainConfig(n_workers=4, batch_size=8, averaging_frequency=2, max_epochs=1, patience=None)
    path, n_rounds = TR.prepare(data, "key", "features", "label", cfg)
    table = spark.read.parquet(path)
    assert table.count() == 400 and n_rounds > 1
    part = table.where("round_id = 0").repartitionById(cfg.n_workers, "worker_id")
    where = part.selectExpr("worker_id", "spark_partition_id() AS p").distinct().collect()
    assert sorted((r["worker_id"], r["p"]) for r in where) == [(i, i) for i in range(4)]


def test_large_layers_are_stored_in_chunks(spark, tmpdir_fresh, monkeypatch):
    from tessera.operators import models
    monkeypatch.setattr(models, "PARAM_CHUNK", 7)
    m = _model()
    m.name = "chunked"
    m.save(spark, tmpdir_fresh)
    rows = spark.read.parquet(f"{tmpdir_fresh}/model_params")
    assert rows.selectExpr("max(size(values))").first()[0] == 7 and rows.count() > 6
    back = Model.load(spark, tmpdir_fresh, "chunked")
    assert np.array_equal(back.flat(), m.flat()) and back.input_dims == m.input_dims
