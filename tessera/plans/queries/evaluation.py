"""Driver queries: inference and evaluation."""

from __future__ import annotations

import numpy as np

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import labels as L
from tessera.operators import sampling as SM
from tessera.plans.queries._registry import N_CLASSES, _SQL_UE, _emb, _long_form, register
from tessera.session import table


# ------------------------------------------------------------------ inference & evaluation
# A softmax head fitted on the train split (class means, bias -|m|^2/2),
# applied to the rows with Arrow-batched inference.


_SQL_HEAD = f"""
WITH u AS (SELECT vec_id, label, embedding, {_SQL_UE.format(seed=13)} AS u FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, vec_id) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM u),
sp AS (SELECT vec_id, label, embedding, CASE WHEN rn * 100 <= n * 80 THEN 'train' ELSE 'test' END AS split FROM r),
x AS (SELECT vec_id, label, split, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM sp),
m AS (SELECT label AS cls, pos, avg(v) AS w FROM x WHERE split = 'train' GROUP BY label, pos),
bias AS (SELECT cls, -0.5 * sum(w * w) AS b FROM m GROUP BY cls),
sc AS (SELECT x.vec_id, x.label, x.split, m.cls, sum(x.v * m.w) + any_value(bias.b) AS score
       FROM x JOIN m ON x.pos = m.pos JOIN bias ON bias.cls = m.cls
       GROUP BY x.vec_id, x.label, x.split, m.cls),
pr AS (SELECT *, max(score) OVER (PARTITION BY vec_id) AS mx,
              row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, cls) AS rk FROM sc),
lse AS (SELECT vec_id, any_value(mx) + ln(sum(exp(score - mx))) AS lse FROM pr GROUP BY vec_id),
pred AS (SELECT pr.vec_id, pr.label, pr.split, pr.cls AS prediction, exp(pr.score - lse.lse) AS max_prob
         FROM pr JOIN lse USING (vec_id) WHERE rk = 1),
loss AS (SELECT pr.vec_id, pr.split, lse.lse - pr.score AS nll FROM pr JOIN lse USING (vec_id)
         WHERE pr.cls = pr.label),
test AS (SELECT * FROM pred WHERE split = 'test'),
ob AS (SELECT t.*, l.nll,
              (row_number() OVER (ORDER BY {_SQL_UE.format(seed=123)}, vec_id) - 1) // 20 AS batch_id
       FROM test t JOIN loss l USING (vec_id)),
conf AS (SELECT CAST(label AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n
         FROM test GROUP BY ALL),
cls AS (SELECT CAST(range AS INTEGER) AS class_id FROM range({N_CLASSES})),
st AS (
  SELECT c.class_id,
         CAST(coalesce((SELECT sum(n) FROM conf WHERE label = c.class_id AND prediction = c.class_id), 0) AS BIGINT) AS tp,
         CAST(coalesce((SELECT sum(n) FROM conf WHERE label = c.class_id), 0) AS BIGINT) AS n_label,
         CAST(coalesce((SELECT sum(n) FROM conf WHERE prediction = c.class_id), 0) AS BIGINT) AS n_pred
  FROM cls c),
st2 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                  CASE WHEN n_label > 0 THEN tp / n_label ELSE 0.0 END AS recall FROM st),
st3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
                  AS f1 FROM st2),
bl AS (SELECT batch_id AS epoch, avg(nll) AS score FROM ob GROUP BY batch_id)
"""


def _head_pipeline(spark, sf):
    """(split rows, fitted head) — the head is the model table of the train split."""
    from tessera.operators.models import class_mean_head
    e = _emb(spark, sf)
    from tessera.session import scratch_path
    from tessera.sources.sinks import materialize
    split = SM.split_train_test(e, "label", "vec_id", train_percent=80, seed=13)
    split = split.withColumn("features", A.as_double_array("embedding")).drop("embedding")
    sp = materialize(spark, scratch_path(spark, "split"), lambda: split)  # written once: read by fit and scoring
    head = class_mean_head(sp.where(F.col("split") == "train"), "features", "label", N_CLASSES)
    return sp, head


def _test_predictions(spark, sf):
    from tessera.operators.infer import predict
    sp, head = _head_pipeline(spark, sf)
    test = sp.where(F.col("split") == "test")
    return predict(test, head, "features", keep=("vec_id", "label"),
                   names=L.label_names(spark, N_CLASSES)), head


@register("linear_head_predict", _SQL_HEAD + """
SELECT vec_id, label, CAST(prediction AS INTEGER) AS prediction, CAST(prediction AS VARCHAR) AS predicted_name,
       round(max_prob, 6) AS max_prob
FROM test
""")
def q_linear_head_predict(spark, sf):
    """I1 + A3: scores, predicted class and predicted label name per test row."""
    pred, _ = _test_predictions(spark, sf)
    return pred.select("vec_id", "label", "prediction", "predicted_name",
                       F.round(F.array_max("scores"), 6).alias("max_prob"))


@register("mean_test_loss", _SQL_HEAD + """
SELECT count(*) AS n, round(avg(nll), 6) AS mean_loss FROM loss WHERE split = 'test'
""")
def q_mean_test_loss(spark, sf):
    """A5: mean negative log-likelihood on the test split (early-stopping score)."""
    from tessera.operators.evaluate import mean_loss
    pred, _ = _test_predictions(spark, sf)
    return mean_loss(pred, "scores", "label").select("n", F.round("mean_loss", 6).alias("mean_loss"))


@register("confusion_matrix", _SQL_HEAD + "SELECT label, prediction, n FROM conf")
def q_confusion_matrix(spark, sf):
    """A1: sparse confusion counts on the test split."""
    from tessera.operators.evaluate import confusion
    pred, _ = _test_predictions(spark, sf)
    return confusion(pred)


@register("confusion_dense", _SQL_HEAD + """
SELECT a.class_id AS label, b.class_id AS prediction, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM cls a JOIN cls b ON true LEFT JOIN conf c ON c.label = a.class_id AND c.prediction = b.class_id
""")
def q_confusion_dense(spark, sf):
    """A1: dense N x N confusion matrix with zeros."""
    from tessera.operators.evaluate import confusion, confusion_dense
    pred, _ = _test_predictions(spark, sf)
    return confusion_dense(spark, confusion(pred), N_CLASSES)


@register("confusion_wide", _SQL_HEAD + """
SELECT label,
       CAST(coalesce(sum(CASE WHEN prediction = 0 THEN n END), 0) AS BIGINT) AS p0,
       CAST(coalesce(sum(CASE WHEN prediction = 1 THEN n END), 0) AS BIGINT) AS p1,
       CAST(coalesce(sum(CASE WHEN prediction = 2 THEN n END), 0) AS BIGINT) AS p2,
       CAST(coalesce(sum(CASE WHEN prediction = 3 THEN n END), 0) AS BIGINT) AS p3,
       CAST(coalesce(sum(CASE WHEN prediction = 4 THEN n END), 0) AS BIGINT) AS p4,
       CAST(coalesce(sum(CASE WHEN prediction = 5 THEN n END), 0) AS BIGINT) AS p5,
       CAST(coalesce(sum(CASE WHEN prediction = 6 THEN n END), 0) AS BIGINT) AS p6,
       CAST(coalesce(sum(CASE WHEN prediction = 7 THEN n END), 0) AS BIGINT) AS p7,
       CAST(coalesce(sum(CASE WHEN prediction = 8 THEN n END), 0) AS BIGINT) AS p8,
       CAST(coalesce(sum(CASE WHEN prediction = 9 THEN n END), 0) AS BIGINT) AS p9
FROM conf GROUP BY label
""")
def q_confusion_wide(spark, sf):
    """A1 (wide): one row per actual class present, one count column per
    predicted class (pivot over the known class list)."""
    from tessera.operators.evaluate import confusion, confusion_wide
    pred, _ = _test_predictions(spark, sf)
    wide = confusion_wide(confusion(pred), N_CLASSES)
    return wide.select("label", *[F.col(str(i)).cast("bigint").alias(f"p{i}") for i in range(N_CLASSES)])


@register("eval_stats", _SQL_HEAD + """
SELECT class_id, tp, n_label, n_pred, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1
FROM st3
""")
def q_eval_stats(spark, sf):
    """A2: per-class precision / recall / F1."""
    from tessera.operators.evaluate import class_stats, confusion
    pred, _ = _test_predictions(spark, sf)
    st = class_stats(spark, confusion(pred), N_CLASSES)
    return st.select("class_id", "tp", "n_label", "n_pred",
                     *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


_SQL_SUMMARY = """
SELECT CAST(sum(n_label) AS BIGINT) AS n, round(sum(tp) / sum(n_label), 6) AS accuracy,
       round(avg(precision) FILTER (WHERE n_label > 0), 6) AS macro_precision,
       round(avg(recall) FILTER (WHERE n_label > 0), 6) AS macro_recall,
       round(avg(f1) FILTER (WHERE n_label > 0), 6) AS macro_f1,
       count(*) FILTER (WHERE n_label > 0) AS n_classes_present
FROM st3
"""


@register("eval_summary", _SQL_HEAD + _SQL_SUMMARY)
def q_eval_summary(spark, sf):
    """A2: accuracy and macro averages over the classes present."""
    from tessera.operators.evaluate import class_stats, confusion, summary_stats
    pred, _ = _test_predictions(spark, sf)
    s = summary_stats(class_stats(spark, confusion(pred), N_CLASSES))
    return s.select("n", *[F.round(c, 6).alias(c) for c in ("accuracy", "macro_precision", "macro_recall",
                                                            "macro_f1")], "n_classes_present")


@register("running_eval", _SQL_HEAD + """
, pb AS (SELECT batch_id, count(*) AS n, CAST(sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS correct
         FROM ob GROUP BY batch_id),
cu AS (SELECT *, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS cum_n,
              CAST(sum(correct) OVER (ORDER BY batch_id) AS BIGINT) AS cum_correct FROM pb)
SELECT CAST(batch_id AS BIGINT) AS batch_id, n, correct, cum_n, cum_correct,
       round(cum_correct / cum_n, 6) AS cum_accuracy FROM cu
""")
def q_running_eval(spark, sf):
    """A4: evaluation after every batch of 20 test rows (seeded order)."""
    from tessera.operators.evaluate import running_eval
    pred, _ = _test_predictions(spark, sf)
    b = SM.minibatches(pred, "vec_id", 20, seed=123)
    r = running_eval(b)
    return r.select("batch_id", "n", "correct", "cum_n", "cum_correct",
                    F.round("cum_accuracy", 6).alias("cum_accuracy"))


def _batch_scores(spark, sf):
    """Score history: mean test loss per batch of 20 (batch_id = 'epoch')."""
    from tessera.operators.infer import nll_column
    pred, _ = _test_predictions(spark, sf)
    b = SM.minibatches(pred, "vec_id", 20, seed=123)
    return b.groupBy(F.col("batch_id").alias("epoch")).agg(F.avg(nll_column("scores", "label")).alias("score"))


@register("best_epoch", _SQL_HEAD + """
SELECT CAST(arg_min(epoch, score) AS BIGINT) AS best_epoch, round(min(score), 6) AS best_score,
       count(*) AS n_epochs FROM bl
""")
def q_best_epoch(spark, sf):
    """The best entry of a score history (lowest loss)."""
    from tessera.operators.stats import best_epoch
    return best_epoch(_batch_scores(spark, sf)).select(
        "best_epoch", F.round("best_score", 6).alias("best_score"), "n_epochs")


@register("score_report", _SQL_HEAD + """
SELECT CAST(-1 AS BIGINT) AS epoch,
       rpad('Iterator', 30, ' ') || ' | ' || rpad('Score', 10, ' ') AS line
UNION ALL
SELECT CAST(epoch AS BIGINT) AS epoch,
       rpad(CAST(epoch AS VARCHAR), CAST(greatest(length(CAST(epoch AS VARCHAR)), 15) AS INTEGER), ' ') || ' | ' ||
       rpad(printf('%.6f', score), CAST(greatest(length(printf('%.6f', score)), 10) AS INTEGER), ' ') AS line
FROM bl
""")
def q_score_report(spark, sf):
    """K6 + P10: score-per-epoch report with left-justified columns."""
    from tessera.operators.stats import score_report
    return score_report(_batch_scores(spark, sf))


@register("model_summary", _SQL_HEAD + """
SELECT 'class_mean_head' AS model, 0 AS pos, 'head' AS name, 'output' AS kind, 'softmax' AS activation,
       CAST((SELECT max(len(embedding)) FROM embeddings) AS INTEGER) AS n_in,
       CAST((SELECT count(DISTINCT cls) FROM m) AS INTEGER) AS n_out, false AS frozen,
       CAST((SELECT count(*) FROM m) + (SELECT count(*) FROM bias) AS BIGINT) AS n_params
""")
def q_model_summary(spark, sf):
    """Layers and parameter counts, from the model tables (K4 layout)."""
    from tessera.operators.models import summary
    _, head = _head_pipeline(spark, sf)
    layers, params = head.to_tables(spark)
    return summary(layers, params).select("model", "pos", "name", "kind", "activation", "n_in", "n_out",
                                          "frozen", "n_params")


@register("featurize_head", _SQL_HEAD + """
SELECT vec_id, CAST(cls AS BIGINT) AS pos, round(score, 6) AS value FROM sc
""")
def q_featurize_head(spark, sf):
    """Features -> output of the frozen layer 'fc2' (a linear layer with
    the class-mean weights), for every row."""
    from tessera.operators.infer import featurize
    from tessera.operators.models import Model
    sp, head = _head_pipeline(spark, sf)
    base = Model([{"name": "fc2", "kind": "dense", "activation": "identity", "n_in": head.input_dims[0],
                   "n_out": N_CLASSES, "frozen": True},
                  {"name": "output", "kind": "output", "activation": "softmax", "n_in": N_CLASSES,
                   "n_out": N_CLASSES}],
                 [head.params[0], {"W": np.eye(N_CLASSES), "b": np.zeros(N_CLASSES)}],
                 head.input_dims, "fc2_base")
    feats = featurize(sp, base, "fc2", "features", keep=("vec_id",))
    return _long_form(feats, "vec_id", "features")


@register("eval_binary", """
WITH j AS (SELECT l.quality AS label, CASE WHEN l.toxic = 1 OR length(d.text) < 100
                  OR 20 * (length(d.text) - length(translate(d.text, '!|#*$%&<>', ''))) > length(d.text) THEN 0 ELSE 1 END AS prediction
           FROM labels l JOIN documents d USING (doc_id)),
conf AS (SELECT label, prediction, count(*) AS n FROM j GROUP BY ALL),
cls AS (SELECT CAST(range AS INTEGER) AS class_id FROM range(2)),
st AS (
  SELECT c.class_id,
         CAST(coalesce((SELECT sum(n) FROM conf WHERE label = c.class_id AND prediction = c.class_id), 0) AS BIGINT) AS tp,
         CAST(coalesce((SELECT sum(n) FROM conf WHERE label = c.class_id), 0) AS BIGINT) AS n_label,
         CAST(coalesce((SELECT sum(n) FROM conf WHERE prediction = c.class_id), 0) AS BIGINT) AS n_pred
  FROM cls c),
st2 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                  CASE WHEN n_label > 0 THEN tp / n_label ELSE 0.0 END AS recall FROM st),
st3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
                  AS f1 FROM st2)
SELECT class_id, tp, n_label, n_pred, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM st3
""")
def q_eval_binary(spark, sf):
    """A1 + A2 on two classes: document quality vs a rule over the whole text (long enough, few symbols, not toxic)."""
    from tessera.operators.evaluate import class_stats, confusion
    n = F.char_length("text")
    texts = table(spark, sf, "documents").select("doc_id", (
        (n < 100) | (20 * (n - F.char_length(F.translate("text", "!|#*$%&<>", ""))) > n)).alias("poor"))
    j = table(spark, sf, "labels").join(texts, "doc_id")
    j = j.select(F.col("quality").alias("label"), F.when((F.col("toxic") == 1) | F.col("poor"), 0).otherwise(1).alias("prediction"))
    st = class_stats(spark, confusion(j), 2)
    return st.select("class_id", "tp", "n_label", "n_pred",
                     *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@register("saved_model_predict", _SQL_HEAD + """
SELECT vec_id, label, CAST(prediction AS INTEGER) AS prediction, round(max_prob, 6) AS max_prob FROM test
""")
def q_saved_model_predict(spark, sf):
    """K4 + S15 + I1: the fitted head is written as model tables (one
    ``model=`` partition), read back, and the reloaded model scores the test rows."""
    from tessera.operators.infer import predict
    from tessera.operators.models import Model
    from tessera.session import scratch_path
    sp, head = _head_pipeline(spark, sf)
    path = scratch_path(spark, "models")
    head.name = "class_mean_head"
    head.save(spark, path)
    loaded = Model.load(spark, path, "class_mean_head")
    pred = predict(sp.where(F.col("split") == "test"), loaded, "features", keep=("vec_id", "label"))
    return pred.select("vec_id", "label", "prediction", F.round(F.array_max("scores"), 6).alias("max_prob"))
