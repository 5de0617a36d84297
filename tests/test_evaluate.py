"""Confusion matrix and statistics, including empty classes."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from tessera.operators import evaluate as E


@pytest.fixture(scope="module")
def preds(spark):
    # class 2 is never predicted; class 3 never occurs as a label
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 3), (2, 0), (2, 1), (1, 1)]
    return spark.createDataFrame(rows, "label int, prediction int")


def test_confusion_sparse_dense_wide(spark, preds):
    conf = E.confusion(preds)
    dense = {(r["label"], r["prediction"]): r["n"] for r in E.confusion_dense(spark, conf, 4).collect()}
    assert len(dense) == 16 and dense[(0, 0)] == 2 and dense[(2, 2)] == 0 and dense[(1, 3)] == 1
    wide = {r["label"]: r for r in E.confusion_wide(conf, 4).collect()}
    assert wide[2]["0"] == 1 and wide[2]["2"] == 0


def test_stats_and_empty_classes(spark, preds):
    st = {r["class_id"]: r for r in E.class_stats(spark, E.confusion(preds), 4).collect()}
    assert st[2]["precision"] == 0.0 and st[2]["recall"] == 0.0 and st[2]["f1"] == 0.0
    assert st[3]["n_label"] == 0 and st[3]["recall"] == 0.0 and st[3]["precision"] == 0.0
    s = E.summary_stats(E.class_stats(spark, E.confusion(preds), 4)).first()
    assert s["n"] == 8 and s["accuracy"] == 4 / 8 and s["n_classes_present"] == 3
    assert abs(s["macro_recall"] - (2 / 3 + 2 / 3 + 0) / 3) < 1e-12


def test_accuracy_matches_spark_ml(spark, preds):
    df = preds.selectExpr("cast(label as double) label", "cast(prediction as double) prediction")
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert E.summary_stats(E.class_stats(spark, E.confusion(preds), 4)).first()["accuracy"] == pytest.approx(acc)
    # per-class precision for a class that is predicted
    p1 = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=1.0).evaluate(df)
    st = {r["class_id"]: r for r in E.class_stats(spark, E.confusion(preds), 4).collect()}
    assert st[1]["precision"] == pytest.approx(p1)


def test_running_eval(spark):
    rows = [(b, b % 2, 0) for b in range(10) for _ in range(3)]
    df = spark.createDataFrame(rows, "batch_id long, label int, prediction int")
    out = {r["batch_id"]: r for r in E.running_eval(df).collect()}
    assert out[9]["cum_n"] == 30 and out[9]["cum_correct"] == 15 and out[0]["cum_accuracy"] == 1.0
    assert out[1]["cum_accuracy"] == 0.5


def test_counters(spark):
    from tessera.operators.stats import counters
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "g string, small boolean")
    got = {r["g"]: (r["n"], r["n_small"]) for r in counters(df, "g", ["small"]).collect()}
    assert got == {"a": (2, 1), "b": (1, 1)}


def test_out_of_range_classes_stay_counted(spark):
    conf = E.confusion(spark.createDataFrame([(5, 1)] * 90 + [(0, 0)] * 6 + [(1, 0)] * 3 + [(1, 7)], "label int, prediction int"))
    stats = E.class_stats(spark, conf, 2)
    rows = {r["class_id"]: r for r in stats.collect()}
    assert rows[E.OUT_OF_RANGE]["n_label"] == 90 and rows[E.OUT_OF_RANGE]["n_pred"] == 1 and rows[E.OUT_OF_RANGE]["tp"] == 0
    total = E.summary_stats(stats).first()
    assert total["n"] == 100 and abs(total["accuracy"] - 0.06) < 1e-12 and total["n_classes_present"] == 2
    cells = {(r["label"], r["prediction"]): r["n"] for r in E.confusion_dense(spark, conf, 2).collect()}
    assert cells == {(0, 0): 6, (0, 1): 0, (1, 0): 3, (1, 1): 0, (-1, 1): 90, (1, -1): 1}
    with pytest.raises(Exception, match="out of range"):
        E.confusion_wide(conf, 2).collect()


def test_rows_without_a_label_or_prediction_are_counted(spark):
    from tessera.operators import evaluate as E
    df = spark.createDataFrame([(0, 0), (0, None), (1, 1), (None, 1), (None, None)], "label int, prediction int")
    conf = {(r["label"], r["prediction"]): r["n"] for r in E.confusion(df).collect()}
    assert conf == {(0, 0): 1, (0, -1): 1, (1, 1): 1, (-1, 1): 1}
    stats = {r["class_id"]: (r["tp"], r["n_label"], r["n_pred"]) for r in E.class_stats(spark, E.confusion(df), 2).collect()}
    assert stats[0] == (1, 2, 1) and stats[1] == (1, 1, 2)
