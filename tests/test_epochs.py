"""Barrier epochs, parameters as a table, resumed runs, statistics of the workers, counter-based initialisation."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import epochs as EP
from tessera.operators import models, nets
from tessera.operators import sharded as SH
from tessera.operators import train as TR
from tessera.operators.models import Model
from tessera.operators.stats import TRAIN_STATS, best_epoch, epoch_scores, score_report
from tessera.sources.sinks import delete_path


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(3, 4)) * 2
    rows = [(i, [float(v) for v in centers[i % 3] + rng.normal(size=4) * 0.5], i % 3) for i in range(240)]
    return spark.createDataFrame(rows, "key long, features array<double>, label int")


LAYERS = [{"kind": "dense", "activation": "relu", "n_out": 6}, {"kind": "output", "activation": "softmax", "n_out": 3}]


def _model():
    return Model.build(LAYERS, (4,), seed=11)


def _cfg(**options):
    return TR.TrainConfig(**{**dict(n_workers=3, batch_size=8, averaging_frequency=2, max_epochs=2, l2=1e-3,
                                    learning_rate={0: 0.08, 6: 0.04}, patience=None), **options})


def test_an_epoch_is_one_job_with_the_parameters_of_single_rounds(spark, data):
    def jobs(plan):
        spark.sparkContext.setJobGroup(plan, plan)
        out = TR.fit(data, _model(), _cfg(plan=plan), key_col="key")
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(plan))

    (a, n_a), (b, n_b) = jobs("barrier"), jobs("rounds")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert np.allclose(a.model.flat(), b.model.flat(), atol=1e-9)
    assert np.allclose(a.model.meta["updater"], b.model.meta["updater"], atol=1e-9)
    n_rounds = sum(1 for r in a.stats if r[1] == 0 and r[2] >= 0)
    assert n_rounds > 3 and n_b - n_a >= 2 * (n_rounds - 1)
    assert [(r[1], r[2], r[3]) for r in a.stats] == [(r[1], r[2], r[3]) for r in b.stats]
    assert np.allclose([r[4] for r in a.stats if r[4] is not None], [r[4] for r in b.stats if r[4] is not None])


@pytest.mark.parametrize("workers", [1, 4, 9])  # local[4]: nine workers share four tasks
def test_more_workers_than_slots(spark, data, workers):
    a, b = (TR.fit(data, _model(), _cfg(n_workers=workers, max_epochs=1, plan=p), key_col="key") for p in ("barrier", "rounds"))
    assert np.allclose(a.model.flat(), b.model.flat(), atol=1e-9)
    assert EP.slots(spark, workers) == min(workers, spark.sparkContext.defaultParallelism)


def test_parameters_are_gathered_in_pieces(spark, data, monkeypatch):
    model = Model.build([{"kind": "dense", "activation": "tanh", "n_out": 700}, LAYERS[1]], (4,), seed=2)
    a = TR.fit(data, model, _cfg(max_epochs=1, plan="rounds"), key_col="key").model.flat()
    monkeypatch.setattr(EP, "GATHER", 1000)
    monkeypatch.setattr(EP, "CHUNK", 900)
    b = TR.fit(data, model, _cfg(max_epochs=1), key_col="key").model.flat()
    assert len(a) > 5000 and np.allclose(a, b, atol=1e-9)


def test_sums_over_the_barrier_equal_sums_through_files(spark, data, monkeypatch):
    cfg = _cfg(max_epochs=1, batch_size=16, averaging_frequency=3)
    a = TR.fit(data, _model(), cfg, key_col="key").model.flat()
    monkeypatch.setattr(TR, "exchange_for", lambda folder: EP.GatherExchange())
    assert np.array_equal(a, TR.fit(data, _model(), cfg, key_col="key").model.flat())
    assert isinstance(EP.exchange_for("viewfs://only/jvm"), EP.GatherExchange)


def test_file_sums(tmpdir_fresh):
    """Tasks as threads: slices, order of the sum, files of earlier sums removed."""
    import glob
    from concurrent.futures import ThreadPoolExecutor

    class Context:
        def __init__(self, me):
            self.me = me

        def partitionId(self):
            return self.me

    rng = np.random.default_rng(0)
    parts = [[rng.normal(size=n) for _ in range(5)] for n in (1, 7, 200_001, 3)]

    def task(me):
        x = EP.FileExchange(tmpdir_fresh, patience=20)
        return [x.sum(Context(me), 5, p[me]) for p in parts]
    with ThreadPoolExecutor(5) as pool:
        got = list(pool.map(task, range(5)))
    for i, p in enumerate(parts):
        assert all(np.array_equal(g[i], np.sum(p, axis=0)) for g in got)
    left = glob.glob(f"{tmpdir_fresh}/*/*")
    assert {f.split("/")[-2] for f in left} <= {"2", "3"}
    with ThreadPoolExecutor(5) as pool:  # a second attempt finds the last sums and gives the same
        again = list(pool.map(task, range(5)))
    assert all(np.array_equal(a, b) for x, y in zip(got, again) for a, b in zip(x, y))
    with pytest.raises(TimeoutError):
        EP.FileExchange(tmpdir_fresh + "/alone", patience=0.01).sum(Context(0), 2, np.ones(3))


def test_plan_and_slots(spark):
    from types import SimpleNamespace as Stub

    def session(master, parallelism=8, **conf):
        return Stub(conf={k.replace("_", "."): v for k, v in conf.items()}, sparkContext=Stub(master=master, defaultParallelism=parallelism))
    plan = lambda *a, **k: TR.TrainConfig().epoch_plan(session(*a, **k))
    assert TR.TrainConfig().epoch_plan(spark) == "barrier" and plan("yarn") == "barrier"
    assert plan("yarn", spark_dynamicAllocation_enabled="true") == plan("yarn", spark_default_parallelism="900") == "rounds"
    assert EP.slots(session("local[3]", 50), 9) == 3 and EP.slots(session("local-cluster[3, 2, 1024]", 50), 9) == 6
    assert EP.slots(session("yarn", 4), 9) == 4 and EP.slots(session("local", 1), 9) == 1 and EP.slots(session("local[*]", 5), 9) == 5


def test_minibatches_across_arrow_batches():
    import pyarrow as pa
    rows = [(0, 0, 0), (0, 0, 0), (0, 0, 1), (0, 2, 0), (1, 0, 0), (1, 0, 0), (1, 0, 0)]
    cols = [pa.array([r[i] for r in rows], pa.int32()) for i in range(3)]
    cols += [pa.array([[float(i), 1.0] for i in range(7)]), pa.array(range(7), pa.int32())]
    whole = pa.RecordBatch.from_arrays(cols, names=list("abcde"))
    for cuts in ([7], [1, 6], [2, 3, 2], [1] * 7):
        at = np.cumsum([0, *cuts])
        got = list(EP.mini_batches(whole.slice(lo, n) for lo, n in zip(at, cuts)))
        assert [k for k, _, _ in got] == [(0, 0, 0), (0, 0, 1), (0, 2, 0), (1, 0, 0)]
        assert [y.tolist() for _, _, y in got] == [[0, 1], [2], [3], [4, 5, 6]] and got[3][1].shape == (3, 2)


def test_worker_statistics(spark, data, tmpdir_fresh):
    path = f"{tmpdir_fresh}/train_stats"
    res = TR.fit(data, _model(), _cfg(), key_col="key", run="r", iterations_path=path)
    stats = spark.read.parquet(path)
    assert set(stats.columns) == set(TRAIN_STATS)
    rows = stats.collect()
    n_rounds = 1 + max(r["round"] for r in rows)
    assert {(r["epoch"], r["worker"]) for r in rows} == {(e, w) for e in (0, 1) for w in range(3)}
    assert all(r["iteration"] // 2 == r["epoch"] * n_rounds + r["round"] for r in rows)
    assert sum(r["n_rows"] for r in rows) == 2 * 240 and {r["run"] for r in rows} == {"r"}
    per_epoch = {r["epoch"]: r["score"] for r in epoch_scores(stats).collect()}
    for e in (0, 1):
        rounds = [(r[3], r[4]) for r in res.stats if r[1] == e and r[2] >= 0]
        assert per_epoch[e] == pytest.approx(sum(n * s for n, s in rounds) / 240)
    assert best_epoch(epoch_scores(stats)).first()["best_epoch"] == min(per_epoch, key=per_epoch.get)
    assert score_report(epoch_scores(stats)).count() == 3
    TR.fit(data, _model(), _cfg(), key_col="key", run="r", iterations_path=path)  # the same run again replaces its rows
    assert spark.read.parquet(path).count() == len(rows)


def _stopping(**options):
    return _cfg(max_epochs=12, learning_rate=0.03, patience=2, min_improvement=5e-2, **options)


def test_a_killed_run_goes_on(spark, data, tmpdir_fresh, monkeypatch):
    train, test = data.where("key % 5 <> 0"), data.where("key % 5 = 0")
    whole = TR.fit(train, _model(), _stopping(), key_col="key", test=test)
    assert whole.total_epochs > 3 and whole.termination_detail == "ScoreImprovement(2)"
    state, real, calls = f"{tmpdir_fresh}/state", TR._epoch, []

    def dies(*args):
        if len(calls) == 2:
            raise RuntimeError("killed")
        calls.append(1)
        return real(*args)
    monkeypatch.setattr(TR, "_epoch", dies)
    with pytest.raises(RuntimeError):
        TR.fit(train, _model(), _stopping(), key_col="key", test=test, state_path=state)
    monkeypatch.setattr(TR, "_epoch", real)
    done, _ = TR.load_state(spark, state, 12)
    assert done.next_epoch == 2
    # a state without its marker is not whole
    spark.range(1).write.parquet(f"{state}/epoch-000003")
    assert delete_path(spark, f"{state}/epoch-000003/_SUCCESS")
    again = TR.fit(train, _model(), _stopping(), key_col="key", test=test, state_path=state)
    assert np.allclose(again.model.flat(), whole.model.flat(), atol=1e-9)
    assert (again.termination_detail, again.best_epoch, again.total_epochs) == (whole.termination_detail, whole.best_epoch, whole.total_epochs)
    ended = TR.fit(train, _model(), _stopping(), key_col="key", test=test, state_path=state)  # nothing left to do
    assert ended.total_epochs == whole.total_epochs and np.allclose(ended.model.flat(), whole.model.flat(), atol=1e-9)


# ---------------------------------------------------------------- the model as a table

def _as_table(spark, model):
    rows = []
    for pos, p in enumerate(model.params):
        for name in ("W", "b"):
            flat = p[name].ravel()
            for c, lo in enumerate(range(0, len(flat), models.PARAM_CHUNK)):
                v = [float(x) for x in flat[lo:lo + models.PARAM_CHUNK]]
                rows.append((pos, name, [int(n) for n in p[name].shape], c, v, [0.0] * len(v)))
    return spark.createDataFrame(rows, "layer_pos int, param string, shape array<int>, chunk_id int, values array<double>, momentum array<double>")


def _flat(rows):
    return np.concatenate([np.array(r["values"]) for r in sorted(rows, key=lambda r: (r["layer_pos"], r["param"], r["chunk_id"]))])


@pytest.mark.parametrize("chunk", [1 << 16, 5])
def test_sharded_run_equals_the_run_over_the_driver(spark, data, tmpdir_fresh, monkeypatch, chunk):
    monkeypatch.setattr(models, "PARAM_CHUNK", chunk)
    train, test = data.where("key % 5 <> 0"), data.where("key % 5 = 0")
    a = TR.fit(train, _model(), _cfg(), key_col="key", test=test)
    b = SH.fit_sharded(train, _as_table(spark, _model()), LAYERS, (4,), _cfg(), f"{tmpdir_fresh}/run", test=test, run="s")
    assert np.allclose(_flat(b.params(spark).collect()), a.model.flat(), atol=1e-9)
    assert [b.progress.scores[e] for e in sorted(b.progress.scores)] == pytest.approx([a.scores[e] for e in sorted(a.scores)])
    assert (b.progress.best_epoch, b.progress.detail) == (a.best_epoch, a.termination_detail)
    stats = spark.read.parquet(f"{tmpdir_fresh}/run/train_stats")
    assert stats.agg(F.sum("n_rows")).first()[0] == 2 * train.count()
    loaded = b.params(spark)  # rows of model_params
    assert loaded.columns == models.PARAM_SCHEMA.names


def test_sharded_run_goes_on_after_a_kill(spark, data, tmpdir_fresh, monkeypatch):
    path, calls, real = f"{tmpdir_fresh}/run", [], SH.sharded_round

    def dies(*args):
        calls.append(1)
        if len(calls) == 8:
            raise RuntimeError("killed")
        return real(*args)
    cfg = _cfg(n_workers=2, batch_size=16, max_epochs=2)
    start = _as_table(spark, _model())
    monkeypatch.setattr(SH, "sharded_round", dies)
    with pytest.raises(RuntimeError):
        SH.fit_sharded(data, start, LAYERS, (4,), cfg, path)
    monkeypatch.setattr(SH, "sharded_round", real)
    res = SH.fit_sharded(data, start, LAYERS, (4,), cfg, path)
    whole = TR.fit(data, _model(), cfg, key_col="key")
    want = whole.model.flat()
    assert np.allclose(_flat(res.params(spark).collect()), want, atol=1e-9) and res.progress.next_epoch == 2


def test_workers_without_rows_leave_the_model_as_it_is(spark, data, tmpdir_fresh):
    start = _as_table(spark, _model())
    res = SH.fit_sharded(data.limit(0), start, LAYERS, (4,), _cfg(max_epochs=1), f"{tmpdir_fresh}/none")
    assert np.array_equal(_flat(res.params(spark).collect()), _model().flat())


def test_counter_based_start(spark, monkeypatch):
    def plain(seed, layer, i):
        d = hashlib.md5(f"{seed}:{layer}:{i}".encode()).hexdigest()
        a, b = ((int(d[k:k + 8], 16) + 0.5) / 2 ** 32 for k in (0, 8))
        return math.sqrt(-2 * math.log(a)) * math.cos(2 * math.pi * b)

    def start(**options):
        return {(r["layer_pos"], r["param"]): r for r in SH.init_params(spark, LAYERS, (4,), seed=5, **options).collect()}
    rows = start()
    assert rows[0, "W"]["shape"] == [6, 4] and rows[1, "b"]["values"] == [0.0] * 3
    assert rows[1, "W"]["values"] == pytest.approx([plain(5, 1, i) * math.sqrt(2 / 9) for i in range(18)])
    assert start(init="normal", init_std=0.1)[0, "W"]["values"] == pytest.approx([plain(5, 0, i) * 0.1 for i in range(24)])
    assert set(start(init="zero")[0, "W"]["values"]) == {0.0} and set(rows[0, "W"]["momentum"]) == {0.0}
    monkeypatch.setattr(models, "PARAM_CHUNK", 7)
    parts = [r for r in SH.init_params(spark, LAYERS, (4,), seed=5).collect() if (r["layer_pos"], r["param"]) == (1, "W")]
    assert [v for r in sorted(parts, key=lambda r: r["chunk_id"]) for v in r["values"]] == rows[1, "W"]["values"]
    big = SH.init_params(spark, [{"kind": "output", "activation": "softmax", "n_out": 100}], (300,), init="normal", init_std=1.0)
    v = np.array([x for r in big.where("param = 'W'").collect() for x in r["values"]])
    assert len(v) == 30000 and abs(v.mean()) < 0.03 and abs(v.std() - 1) < 0.03


def test_shapes_with_several_dimensions():
    assert nets.param_shapes([{"kind": "output", "n_out": 2}], (3, 4))[0]["W"] == (2, 12)
