"""Evaluation: A1 confusion counts, A2 statistics, A4 running evaluation,
A5 mean loss. All aggregates are partial (map-side combined), so a hot class
adds no skew; class dimensions are small by construction (n_classes rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.infer import nll_column
from tessera.operators.sampling import running_totals


def confusion(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """A1 (sparse): ``(label, prediction, n)`` for every observed pair. A row that has only one of the two is counted with
    ``OUT_OF_RANGE`` for the other; a row with neither (a bad record) is no example."""
    known = lambda c, name: F.coalesce(F.col(c).cast("int"), F.lit(OUT_OF_RANGE)).alias(name)
    return (df.where(F.col(label_col).isNotNull() | F.col(pred_col).isNotNull())
              .groupBy(known(label_col, "label"), known(pred_col, "prediction")).agg(F.count(F.lit(1)).alias("n")))


#: class id that stands for every missing label or prediction and every one outside 0..n_classes-1
OUT_OF_RANGE = -1


def _in_range(conf: DataFrame, n_classes: int) -> DataFrame:
    """The counts with labels and predictions outside the classes gathered under ``OUT_OF_RANGE``."""
    fold = lambda c: F.when(F.col(c).between(0, n_classes - 1), F.col(c)).otherwise(OUT_OF_RANGE).alias(c)
    return conf.select(fold("label"), fold("prediction"), "n").groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def confusion_dense(spark: SparkSession, conf: DataFrame, n_classes: int) -> DataFrame:
    """A1 (dense): all n_classes^2 cells, zeros included. The grid comes from a
    generator over the class range (n_classes^2 rows). Counts outside the classes
    are extra cells under class ``OUT_OF_RANGE``, present only when there are any."""
    grid = (spark.range(n_classes).select(F.col("id").cast("int").alias("label"))
                 .withColumn("prediction", F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1)))))
    return (grid.join(_in_range(conf, n_classes), ["label", "prediction"], "full")
                .select("label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def confusion_wide(conf: DataFrame, n_classes: int) -> DataFrame:
    """A1 (wide): one row per actual class, one column per predicted class.

    A prediction outside the classes has no column and is an error."""
    checked = conf.withColumn("prediction", F.when(F.col("prediction").between(0, n_classes - 1), F.col("prediction"))
                              .otherwise(F.raise_error(F.concat(F.lit("prediction out of range: "),
                                                                F.col("prediction").cast("string")))))
    return (checked.groupBy("label").pivot("prediction", list(range(n_classes))).agg(F.sum("n"))
                   .na.fill(0))


def class_stats(spark: SparkSession, conf: DataFrame, n_classes: int) -> DataFrame:
    """A2 per class: tp, support, predicted, precision, recall, f1.

    Precision (recall) is 0 when nothing was predicted as (labelled) the
    class; f1 is 0 when precision + recall is 0. Labels and predictions outside
    the classes are counted in a row of class ``OUT_OF_RANGE`` (present only when
    there are any; its tp is 0), so they lower the accuracy instead of vanishing."""
    conf = _in_range(conf, n_classes)
    outside = conf.where((F.col("label") == OUT_OF_RANGE) | (F.col("prediction") == OUT_OF_RANGE)) \
        .select(F.lit(OUT_OF_RANGE).alias("class_id")).distinct()
    classes = spark.range(n_classes).select(F.col("id").cast("int").alias("class_id")).unionByName(outside)
    tp = conf.where((F.col("label") == F.col("prediction")) & (F.col("label") != OUT_OF_RANGE)).select(F.col("label").alias("class_id"),
                                                                   F.col("n").alias("tp"))
    sup = conf.groupBy(F.col("label").alias("class_id")).agg(F.sum("n").alias("n_label"))
    prd = conf.groupBy(F.col("prediction").alias("class_id")).agg(F.sum("n").alias("n_pred"))
    t = (classes.join(tp, "class_id", "left").join(sup, "class_id", "left").join(prd, "class_id", "left")
                .na.fill(0, ["tp", "n_label", "n_pred"]))
    p = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    r = F.when(F.col("n_label") > 0, F.col("tp") / F.col("n_label")).otherwise(F.lit(0.0))
    t = t.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return t.withColumn("f1", f1).select(
        "class_id", F.col("tp").cast("bigint").alias("tp"), F.col("n_label").cast("bigint").alias("n_label"),
        F.col("n_pred").cast("bigint").alias("n_pred"), "precision", "recall", "f1")


def summary_stats(stats: DataFrame) -> DataFrame:
    """A2 overall: accuracy and macro averages over the classes present in
    the labels (n_label > 0). Rows labelled outside the classes count as wrong."""
    present = (F.col("n_label") > 0) & (F.col("class_id") != OUT_OF_RANGE)
    return stats.agg(
        F.sum("n_label").cast("bigint").alias("n"),
        (F.sum("tp") / F.sum("n_label")).alias("accuracy"),
        F.avg(F.when(present, F.col("precision"))).alias("macro_precision"),
        F.avg(F.when(present, F.col("recall"))).alias("macro_recall"),
        F.avg(F.when(present, F.col("f1"))).alias("macro_f1"),
        F.count(F.when(present, 1)).cast("bigint").alias("n_classes_present"))


def running_eval(df: DataFrame, batch_col: str = "batch_id", label_col: str = "label",
                 pred_col: str = "prediction") -> DataFrame:
    """A4: per-batch counts and the cumulative accuracy after each batch.

    The per-batch table is a partial aggregate; the running sums use the
    scalable prefix sum (no whole-table window)."""
    per = df.groupBy(batch_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(F.col(label_col) == F.col(pred_col)).cast("bigint").alias("correct"))
    cum = running_totals(per, batch_col, ["n", "correct"])
    return cum.withColumn("cum_accuracy", F.col("cum_correct") / F.col("cum_n"))


def mean_loss(df: DataFrame, scores_col: str = "scores", label_col: str = "label") -> DataFrame:
    """A5: mean negative log-likelihood of the true class."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                  F.avg(nll_column(scores_col, label_col)).alias("mean_loss"))
