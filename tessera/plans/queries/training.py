"""Driver queries: training runs (M1-M10, A6, A7, K5-K6). Runs that SQL can unroll step by step have a SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import sampling as SM
from tessera.plans.queries._registry import N_CLASSES, _SQL_U, _SQL_UE, _emb, register
from tessera.session import scratch_path
from tessera.sources.sinks import materialize


# ------------------------------------------------------------------ training (rows-only: iterative)

def _train_split(spark, sf):
    e = _emb(spark, sf)
    split = SM.split_train_test(e, "label", "vec_id", train_percent=80, seed=13)
    split = split.withColumn("features", A.as_double_array("embedding")).drop("embedding")
    sp = materialize(spark, scratch_path(spark, "split"), lambda: split)
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


_LR, _MU = 0.5, 0.9

_SQL_X = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
x AS (SELECT vec_id, label, generate_subscripts(f, 1) - 1 AS d, unnest(f) AS v FROM e
      UNION ALL SELECT vec_id, label, -1, 1.0 FROM e),
k AS (SELECT unnest(range({N_CLASSES})) AS k),"""

# two full-batch steps from zero weights: s1 and s2 hold velocity v and weight w after each, p the probabilities at s1
_SQL_STEPS = _SQL_X + f"""
g1 AS (SELECT d, k, avg((1.0 / {N_CLASSES} - CASE WHEN label = k THEN 1 ELSE 0 END) * v) AS g
       FROM x, k GROUP BY d, k),
s1 AS (SELECT d, k, -{_LR} * g AS v, (1 + {_MU}) * -{_LR} * g AS w FROM g1),
z AS (SELECT vec_id, label, k, sum(x.v * s1.w) AS z FROM x JOIN s1 USING (d) GROUP BY vec_id, label, k),
m AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z),
p AS (SELECT vec_id, label, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM m),
g2 AS (SELECT d, k, avg((p - CASE WHEN x.label = k THEN 1 ELSE 0 END) * v) AS g
       FROM x JOIN p USING (vec_id) GROUP BY d, k)
"""


def _full_batch_config(e, **options):
    """Workers that each take their rows (about 4096) as one batch, so that an average over workers is a step over the table."""
    from tessera.operators.train import TrainConfig
    return TrainConfig(**{**dict(n_workers=max(4, -(-e.count() // 4096)), batch_size=8192, averaging_frequency=1, max_epochs=2,
                                 learning_rate=_LR, momentum=_MU, l2=0.0, patience=None, max_minutes=None), **options})


def _zero_head():
    from tessera.operators.models import Model
    model = Model.build([{"kind": "output", "activation": "softmax", "n_out": N_CLASSES, "name": "output"}], (64,))
    return model.with_flat(0.0 * model.flat())


def _features(spark, sf):
    return _emb(spark, sf).select("vec_id", "label", A.as_double_array("embedding").alias("features"))


_SQL_TWO_STEPS = _SQL_STEPS + f"""
SELECT CAST(d AS INTEGER) AS feature, CAST(k AS INTEGER) AS class_id,
       round(s1.w - {_MU} * s1.v + (1 + {_MU}) * ({_MU} * s1.v - {_LR} * g2.g), 6) AS weight
FROM s1 JOIN g2 USING (d, k)
"""


@register("train_softmax_params", _SQL_TWO_STEPS)
def q_train_softmax_params(spark, sf):
    """M1 + A6 + M6 + M9 + T4: a softmax head from zero weights, two averaging rounds over md5-assigned workers with
    Nesterov momentum; the averaged parameters themselves (feature -1: the bias).

    Each worker takes its rows (about 4096) as one batch, so the row-weighted average of the workers is the step of the
    whole table, which SQL can unroll."""
    from tessera.operators.train import fit
    e = _features(spark, sf)
    return _weights(spark, fit(e, _zero_head(), _full_batch_config(e), key_col="vec_id").model.params[0])


def _weights(spark, layer):
    rows = [(d, k, float(layer["W"][k, d]) if d >= 0 else float(layer["b"][k]))
            for d in range(-1, layer["W"].shape[1]) for k in range(N_CLASSES)]
    out = spark.createDataFrame(rows, "feature int, class_id int, weight double")
    return out.withColumn("weight", F.round("weight", 6))


@register("train_resumed", _SQL_TWO_STEPS)
def q_train_resumed(spark, sf):
    """M2: a run that ends after its first epoch and is called again: it goes on from the state written there."""
    from tessera.operators.train import fit
    e, state = _features(spark, sf), scratch_path(spark, "run-state")
    for epochs in (1, 2):
        res = fit(e, _zero_head(), _full_batch_config(e, max_epochs=epochs), key_col="vec_id", state_path=state)
    return _weights(spark, res.model.params[0])


_W_SQL = _SQL_U.format(seed="w12345", key="vec_id")


@register("train_batches_params", _SQL_X + f"""
r AS (SELECT vec_id, label, wk, row_number() OVER (PARTITION BY wk ORDER BY u, vec_id) - 1 AS i, count(*) OVER (PARTITION BY wk) AS n
      FROM (SELECT vec_id, label, {_W_SQL} % greatest(2, ((SELECT count(*) FROM e) + 8191) // 8192) AS wk,
                   {_SQL_UE.format(seed=12345)} AS u FROM e)),
o AS (SELECT vec_id, wk, n, CAST(i // ((SELECT max(n) FROM r) // 2 + 1) AS INTEGER) AS b FROM r),
n AS (SELECT wk, any_value(n) AS n FROM o GROUP BY wk),
g1 AS (SELECT wk, d, k, avg((1.0 / {N_CLASSES} - CASE WHEN label = k THEN 1 ELSE 0 END) * v) AS g
       FROM x JOIN o USING (vec_id), k WHERE b = 0 GROUP BY wk, d, k),
s1 AS (SELECT wk, d, k, -0.5 * g AS v, 1.9 * -0.5 * g AS w FROM g1),
z AS (SELECT vec_id, x.label, wk, k, sum(x.v * s1.w) AS z FROM x JOIN o USING (vec_id) JOIN s1 USING (wk, d) WHERE b = 1
      GROUP BY vec_id, x.label, wk, k),
m AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z),
p AS (SELECT vec_id, wk, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM m),
g2 AS (SELECT wk, d, k, avg((p - CASE WHEN label = k THEN 1 ELSE 0 END) * v) AS g FROM x JOIN p USING (vec_id) GROUP BY wk, d, k),
h2 AS (SELECT wk, d, k, s1.v, s1.w, g2.g + CASE WHEN d >= 0 THEN 0.01 * s1.w ELSE 0 END AS g FROM s1 LEFT JOIN g2 USING (wk, d, k)),
s2 AS (SELECT wk, d, k, CASE WHEN g IS NULL THEN w ELSE w - 0.9 * v + 1.9 * (0.9 * v - 0.25 * g) END AS w FROM h2)
SELECT CAST(d AS INTEGER) AS feature, CAST(k AS INTEGER) AS class_id, round(sum(w * n) / sum(n), 6) AS weight
FROM s2 JOIN n USING (wk) GROUP BY d, k
""")
def q_train_batches_params(spark, sf):
    """M5 + M6 + A6: two mini-batches a worker between averages, with L2, Nesterov momentum and a rate that falls with the
    iteration; the averaged parameters."""
    from tessera.operators.sampling import hash_uniform
    from tessera.operators.train import TrainConfig, fit
    e = _features(spark, sf)
    workers = max(2, -(-e.count() // 8192))
    of = F.pmod(hash_uniform("w12345", F.col("vec_id")), F.lit(workers))
    largest = e.groupBy(of.alias("w")).count().agg(F.max("count")).first()[0] or 0
    cfg = TrainConfig(n_workers=workers, batch_size=largest // 2 + 1, averaging_frequency=2, max_epochs=1,
                      learning_rate={0: 0.5, 1: 0.25}, momentum=0.9, l2=0.01, seed=12345, patience=None, max_minutes=None)
    return _weights(spark, fit(e, _zero_head(), cfg, key_col="vec_id").model.params[0])


def _iterations(spark, sf, epochs: int):
    """``train_stats`` of a full-batch run, as its workers wrote it."""
    from tessera.operators.train import fit
    e, path = _features(spark, sf), scratch_path(spark, "train-stats")
    fit(e, _zero_head(), _full_batch_config(e, max_epochs=epochs), key_col="vec_id", run="head", iterations_path=path)
    return spark.read.parquet(path)


@register("train_iterations", _SQL_STEPS + f""",
r AS (SELECT vec_id, {_W_SQL} % greatest(4, ((SELECT count(*) FROM e) + 4095) // 4096) AS worker FROM e)
SELECT 'head' AS run, epoch, 0 AS round, CAST(worker AS INTEGER) AS worker, epoch AS iteration, count(*) AS n_rows,
       round(avg(CASE WHEN epoch = 0 THEN ln({N_CLASSES}) ELSE -ln(p) END), 6) AS score
FROM p JOIN r USING (vec_id), (SELECT unnest([0, 1]) AS epoch) WHERE label = k GROUP BY epoch, worker
""")
def q_train_iterations(spark, sf):
    """K5: a row per worker and iteration, written from inside the tasks (times left out: they differ from run to run)."""
    return _iterations(spark, sf, 2).select("run", "epoch", "round", "worker", "iteration", "n_rows",
                                            F.round("score", 6).alias("score"))


_SQL_HISTORY = _SQL_STEPS + f""",
s2 AS (SELECT d, k, s1.w - {_MU} * s1.v + (1 + {_MU}) * ({_MU} * s1.v - {_LR} * g2.g) AS w FROM s1 JOIN g2 USING (d, k)),
z2 AS (SELECT vec_id, label, k, sum(x.v * s2.w) AS z FROM x JOIN s2 USING (d) GROUP BY vec_id, label, k),
l2 AS (SELECT vec_id, label, k, z - max(z) OVER w - ln(sum(exp(z)) OVER w) + max(z) OVER w AS logp FROM z2
       WINDOW w AS (PARTITION BY vec_id)),
bl AS (SELECT 0 AS epoch, ln({N_CLASSES}) AS score UNION ALL SELECT 1, avg(-ln(p)) FROM p WHERE label = k
       UNION ALL SELECT 2, avg(-logp) FROM l2 WHERE label = k)
"""


@register("train_best_epoch", _SQL_HISTORY + """
SELECT CAST(arg_min(epoch, score) AS BIGINT) AS best_epoch, round(min(score), 6) AS best_score, count(*) AS n_epochs FROM bl
""")
def q_train_best_epoch(spark, sf):
    """The best epoch of a real run, from its statistics table."""
    from tessera.operators.stats import best_epoch, epoch_scores
    return best_epoch(epoch_scores(_iterations(spark, sf, 3))).select(
        "best_epoch", F.round("best_score", 6).alias("best_score"), "n_epochs")


@register("train_score_report", _SQL_HISTORY + """
SELECT CAST(-1 AS BIGINT) AS epoch, rpad('Iterator', 30, ' ') || ' | ' || rpad('Score', 10, ' ') AS line
UNION ALL
SELECT CAST(epoch AS BIGINT), rpad(CAST(epoch AS VARCHAR), 15, ' ') || ' | ' || rpad(printf('%.6f', score), 10, ' ') FROM bl
""")
def q_train_score_report(spark, sf):
    """K6: the score report of a real run, from its statistics table."""
    from tessera.operators.stats import epoch_scores, score_report
    return score_report(epoch_scores(_iterations(spark, sf, 3)))


# ------------------------------------------------------------------ end-to-end jobs

_SQL_SPLIT = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f, CASE WHEN 100 * row_number() OVER w <= 80 * count(*) OVER
           (PARTITION BY label) THEN 'train' ELSE 'test' END AS split
           FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY {_SQL_UE.format(seed=13)}, vec_id)),
x AS (SELECT vec_id, label, split, generate_subscripts(f, 1) - 1 AS d, unnest(f) AS v FROM e
      UNION ALL SELECT vec_id, label, split, -1, 1.0 FROM e),
k AS (SELECT unnest(range({N_CLASSES})) AS k),
"""


@register("job_early_stopping", _SQL_SPLIT + f"""
g1 AS (SELECT d, k, avg((1.0 / {N_CLASSES} - CASE WHEN label = k THEN 1 ELSE 0 END) * v) AS g
       FROM x, k WHERE split = 'train' GROUP BY d, k),
s1 AS (SELECT d, k, -{_LR} * g AS v, (1 + {_MU}) * -{_LR} * g AS w FROM g1),
z1 AS (SELECT vec_id, label, split, k, sum(x.v * s1.w) AS z FROM x JOIN s1 USING (d) GROUP BY ALL),
p1 AS (SELECT vec_id, label, split, k, exp(z) / sum(exp(z)) OVER (PARTITION BY vec_id) AS p FROM z1),
g2 AS (SELECT d, k, avg((p - CASE WHEN x.label = k THEN 1 ELSE 0 END) * v) AS g
       FROM x JOIN p1 USING (vec_id) WHERE x.split = 'train' GROUP BY d, k),
s2 AS (SELECT d, k, s1.w - {_MU} * s1.v + (1 + {_MU}) * ({_MU} * s1.v - {_LR} * g2.g) AS w FROM s1 JOIN g2 USING (d, k)),
z2 AS (SELECT vec_id, label, k, sum(x.v * s2.w) AS z FROM x JOIN s2 USING (d) WHERE split = 'test' GROUP BY ALL),
p2 AS (SELECT label, k, exp(z) / sum(exp(z)) OVER (PARTITION BY vec_id) AS p FROM z2),
h AS (SELECT 0 AS epoch, avg(-ln(p)) AS score FROM p1 WHERE split = 'test' AND label = k
      UNION ALL SELECT 1, avg(-ln(p)) FROM p2 WHERE label = k)
SELECT epoch, round(score, 6) AS score, score = min(score) OVER () AS is_best, 'EpochTerminationCondition' AS reason,
       'MaxEpochs(2)' AS detail FROM h
""")
def q_job_early_stopping(spark, sf):
    """U4 + M2 + A5 + A7 + K4: the early-stopping job end to end: split, train, score each epoch, save the best model."""
    from tessera.operators.train import epoch_table
    from tessera.plans.jobs import train_early_stopping
    tr, te = _train_split(spark, sf)
    res = train_early_stopping(tr, te, _zero_head(), _full_batch_config(tr, max_epochs=2, patience=3, max_minutes=60.0),
                               save_model_path=scratch_path(spark, "best-model"), key_col="vec_id")
    return epoch_table(res, spark).withColumn("score", F.round("score", 6))


@register("job_transfer_chain", _SQL_SPLIT + f"""
f AS (SELECT vec_id, label, split, k AS j, greatest(sum((((k + 1) * (d + 1)) % 7 - 3) / 50.0 * v), 0) AS a
      FROM x, k WHERE d >= 0 GROUP BY vec_id, label, split, k
      UNION ALL SELECT vec_id, label, split, -1, 1.0 FROM e),
g AS (SELECT j, k, avg((1.0 / {N_CLASSES} - CASE WHEN label = k THEN 1 ELSE 0 END) * a) AS g FROM f, k WHERE split = 'train' GROUP BY j, k),
z AS (SELECT vec_id, label, k, sum(-a * g) AS z FROM f JOIN g USING (j) WHERE split = 'test' GROUP BY vec_id, label, k),
pr AS (SELECT vec_id, label, k AS prediction FROM z QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, k) = 1),
st AS (SELECT k AS class_id, CAST(count(*) FILTER (WHERE label = k AND prediction = k) AS BIGINT) AS tp,
              CAST(count(*) FILTER (WHERE label = k) AS BIGINT) AS n_label, CAST(count(*) FILTER (WHERE prediction = k) AS BIGINT) AS n_pred
       FROM k, pr GROUP BY k),
s2 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
              CASE WHEN n_label > 0 THEN tp / n_label ELSE 0.0 END AS recall FROM st)
SELECT CAST(class_id AS INTEGER) AS class_id, tp, n_label, n_pred, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1 FROM s2
""")
def q_job_transfer_chain(spark, sf):
    """U5 + I2 + K2 + K7 + M4 + A3: featurize with a frozen base and save batches, train a head on the saved train batches,
    evaluate it on the saved test batches."""
    from tessera.operators.models import Model
    from tessera.plans.jobs import featurize_and_save, train_transfer_head
    from tessera.plans.queries.files import _fixed_base_and_head
    records = _features(spark, sf).withColumnRenamed("vec_id", "key")
    path = scratch_path(spark, "featurized")
    saved = featurize_and_save(records, _fixed_base_and_head()[0], "fc2", path, balance=False)
    head = Model.build([{"kind": "output", "activation": "softmax", "n_out": N_CLASSES, "name": "output"}], (N_CLASSES,))
    _, stats = train_transfer_head(path, head.with_flat(0.0 * head.flat()), N_CLASSES, _full_batch_config(saved, max_epochs=1))
    return stats.select(F.col("class_id").cast("int").alias("class_id"), "tp", "n_label", "n_pred",
                        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


_SHAPE_SQL = ("(SELECT max(len(embedding)) FROM embeddings)", "(SELECT max(label) + 1 FROM embeddings)")
_INIT_SQL = f"""
i AS (SELECT unnest(range({_SHAPE_SQL[0]} * {_SHAPE_SQL[1]})) AS i),
u AS (SELECT i, (CAST(('0x' || substr(md5('12345:0:' || CAST(i AS VARCHAR)), 1, 8)) AS BIGINT) + 0.5) / 4294967296.0 AS a,
             (CAST(('0x' || substr(md5('12345:0:' || CAST(i AS VARCHAR)), 9, 8)) AS BIGINT) + 0.5) / 4294967296.0 AS b FROM i),
w0 AS (SELECT i, CAST(i % {_SHAPE_SQL[0]} AS INTEGER) AS d, CAST(i // {_SHAPE_SQL[0]} AS INTEGER) AS k,
              sqrt(-2 * ln(CAST(a AS DOUBLE))) * cos(2 * pi() * CAST(b AS DOUBLE)) * sqrt(2.0 / ({_SHAPE_SQL[0]} + {_SHAPE_SQL[1]})) AS w FROM u)"""


def _head_shape(spark, sf):
    """(vector length, classes) of the embeddings table."""
    r = _emb(spark, sf).agg(F.max(F.size("embedding")), F.max("label") + 1).first()
    return int(r[0]), int(r[1])


@register("model_init", "WITH " + _INIT_SQL + f"""
SELECT 0 AS layer_pos, 'W' AS param, CAST(i AS BIGINT) AS pos, round(w, 6) AS value FROM w0
UNION ALL SELECT 0, 'b', CAST(unnest(range({_SHAPE_SQL[1]})) AS BIGINT), 0.0
""")
def q_model_init(spark, sf):
    """M7: the seeded start of a softmax head of the table's dimension and classes, as rows of the parameter table."""
    from tessera.operators import models
    from tessera.operators.sharded import init_params
    dim, classes = _head_shape(spark, sf)
    rows = init_params(spark, [{"kind": "output", "activation": "softmax", "n_out": classes}], (dim,), seed=12345)
    return rows.select("layer_pos", "param", "chunk_id", F.posexplode("values").alias("at", "value")) \
        .select("layer_pos", "param", (F.col("chunk_id").cast("long") * models.PARAM_CHUNK + F.col("at")).alias("pos"),
                F.round("value", 6).alias("value"))


@register("train_sharded_params", _SQL_X + _INIT_SQL + f""",
z AS (SELECT vec_id, label, w0.k, sum(x.v * w) AS z FROM x JOIN w0 USING (d) GROUP BY vec_id, label, w0.k),
m AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z),
p AS (SELECT vec_id, label, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM m),
g AS (SELECT d, k, avg((p - CASE WHEN x.label = k THEN 1 ELSE 0 END) * v) AS g FROM x JOIN p USING (vec_id) GROUP BY d, k)
SELECT CAST(d AS INTEGER) AS feature, CAST(k AS INTEGER) AS class_id,
       round(coalesce(w, 0.0) - (1 + {_MU}) * {_LR} * g, 6) AS weight
FROM g LEFT JOIN w0 USING (d, k)
""")
def q_train_sharded_params(spark, sf):
    """A6 + K4 + M7: one averaging round over a model that is a table from its seeded start to its end."""
    from tessera.operators import models
    from tessera.operators.sharded import fit_sharded, init_params
    e, (dim, classes) = _features(spark, sf), _head_shape(spark, sf)
    layers = [{"kind": "output", "activation": "softmax", "n_out": classes}]
    res = fit_sharded(e, init_params(spark, layers, (dim,), seed=12345), layers, (dim,), _full_batch_config(e, max_epochs=1),
                      key_col="vec_id")
    rows = res.params(spark).select("param", "chunk_id", F.posexplode("values").alias("at", "weight")) \
        .withColumn("pos", F.col("chunk_id").cast("long") * models.PARAM_CHUNK + F.col("at"))
    is_bias = F.col("param") == "b"
    return rows.select(F.when(is_bias, -1).otherwise(F.col("pos") % dim).cast("int").alias("feature"),
                       F.when(is_bias, F.col("pos")).otherwise(F.floor(F.col("pos") / dim)).cast("int").alias("class_id"),
                       F.round("weight", 6).alias("weight"))


@register("train_param_avg")
def q_train_param_avg(spark, sf):
    """M1 + A6 + M6 + M7: 4 workers, batch 16, averaging every 5 batches,
    3 epochs; one row per epoch with the test score."""
    from tessera.operators.models import Model
    from tessera.operators.train import TrainConfig, epoch_table, fit
    tr, te = _train_split(spark, sf)
    model = Model.build([{"kind": "dense", "activation": "relu", "n_out": 32, "name": "hidden"},
                         {"kind": "output", "activation": "softmax", "n_out": N_CLASSES, "name": "output"}],
                        (64,), seed=12345)
    cfg = TrainConfig(n_workers=4, batch_size=16, averaging_frequency=5, max_epochs=3,
                      learning_rate={0: 0.1, 500: 0.05, 1000: 0.01}, l2=1e-4, patience=None)
    return epoch_table(fit(tr, model, cfg, key_col="vec_id", test=te), spark)


@register("train_early_stop")
def q_train_early_stop(spark, sf):
    """M2 + A5 + A7: early stopping on the test loss (max 8 epochs, patience 2)."""
    from tessera.operators.models import Model
    from tessera.operators.train import TrainConfig, epoch_table, fit
    tr, te = _train_split(spark, sf)
    model = Model.build([{"kind": "output", "activation": "softmax", "n_out": N_CLASSES, "name": "output"}],
                        (64,), seed=10)
    cfg = TrainConfig(n_workers=4, batch_size=32, averaging_frequency=5, max_epochs=8, learning_rate=0.5,
                      l2=1e-3, patience=2, max_minutes=30.0)
    return epoch_table(fit(tr, model, cfg, key_col="vec_id", test=te), spark)


@register("train_transfer_head")
def q_train_transfer_head(spark, sf):
    """M4 + M5 + I2: freeze the base up to 'fc2', featurize once, train only a
    new softmax head on the featurized rows."""
    from tessera.operators.infer import featurize
    from tessera.operators.models import Model, class_mean_head, transfer_head
    from tessera.operators.train import TrainConfig, epoch_table, fit
    tr, te = _train_split(spark, sf)
    head = class_mean_head(tr, "features", "label", N_CLASSES)
    base = Model([{"name": "fc2", "kind": "dense", "activation": "identity", "n_in": 64, "n_out": N_CLASSES},
                  dict(head.layers[0], name="predictions")],
                 [head.params[0], head.params[0]], (64,), "base")
    tl = transfer_head(base, "fc2", N_CLASSES, remove_output_layers=1, seed=123, init="normal",
                       init_std=0.2 * 2.0 / (N_CLASSES + N_CLASSES))
    n_frozen = sum(1 for ly in tl.layers if ly.get("frozen"))
    trainable = Model(tl.layers[n_frozen:], tl.params[n_frozen:], (N_CLASSES,), "head")
    f_tr, f_te = (materialize(spark, scratch_path(spark, "featurized"), lambda part=part: featurize(
        part, base, "fc2", "features", keep=("vec_id", "label"))) for part in (tr, te))
    cfg = TrainConfig(n_workers=2, batch_size=16, averaging_frequency=5, max_epochs=3, learning_rate=0.01,
                      momentum=0.9, l2=1e-4, patience=None)
    return epoch_table(fit(f_tr, trainable, cfg, key_col="vec_id", test=f_te), spark)


@register("train_cnn")
def q_train_cnn(spark, sf):
    """M8 + M10: a small conv net (conv 3x3 tanh - max-pool 2 - dense relu -
    softmax) on the 64-value rows read as 1 x 8 x 8 images."""
    from tessera.operators.models import Model
    from tessera.operators.train import TrainConfig, epoch_table, fit
    tr, te = _train_split(spark, sf)
    model = Model.build([{"kind": "conv", "activation": "tanh", "n_out": 4, "kernel": 3, "stride": 1,
                          "channels_in": 1, "name": "conv1"},
                         {"kind": "pool", "kernel": 2, "stride": 2, "name": "pool1"},
                         {"kind": "dense", "activation": "relu", "n_out": 16, "name": "fc"},
                         {"kind": "output", "activation": "softmax", "n_out": N_CLASSES, "name": "output"}],
                        (1, 8, 8), seed=12345)
    cfg = TrainConfig(n_workers=2, batch_size=16, averaging_frequency=5, max_epochs=2, learning_rate=0.05,
                      patience=None)
    return epoch_table(fit(tr, model, cfg, key_col="vec_id", test=te), spark)
