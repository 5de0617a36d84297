"""End-to-end jobs (the reference's entry points, as Spark plans):

* ``images_to_records``  — image folder -> labelled, normalised records -> parquet (U1, K1)
* ``featurize_and_save`` — balance, split 80/20, featurize with a frozen base,
  save numbered batches per split, only when absent (F4, T1, T3, I2, K2, K7)
* ``train_early_stopping`` — train with parameter averaging and early stopping,
  save model and statistics (M1, M2, K4, K5)
* ``train_transfer_head`` — train a new head on saved featurized batches,
  evaluate on the test split, save the head (M4, A3, K4)
* ``predict_text_lines`` — score delimited text lines, predicted next to actual (S5, S4, I1)
* ``predict_images`` — featurize raw images with a frozen base, score with a head (S6, P7, I2, I1, F5)
* ``evaluate_saved_batches`` — running accuracy per saved batch and final statistics (S10, A4, A2)

Options mirror the reference jobs (U4, U5) as keyword arguments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import scale_pixels
from tessera.functions.labels import base_name_label, index_labels, one_hot, parent_dir_label
from tessera.operators import evaluate as E
from tessera.operators import sampling as SM
from tessera.operators.infer import featurize, predict
from tessera.operators.models import Model
from tessera.operators.train import TrainConfig, TrainResult, epoch_table, fit
from tessera.sources import images as IM
from tessera.sources import sinks as SK


def images_to_records(spark: SparkSession, folder: str, n_classes: int, out_path: str | None = None,
                      height: int | None = None, width: int | None = None, channels: int | None = None,
                      label: str | Callable[[Column], Column] = "parent",
                      normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """Path -> labelled normalised record.

    ``label``: "parent" (P1, class = parent folder name, numeric), "base"
    (P2, number before the first dot of the file name), "index" (P3,
    alphabetical index of the parent folder name) or any ``Column -> Column``
    over the path. ``normalise`` defaults to pixel scaling to [0, 1] (P6).
    Undecodable images keep an ``error`` and no features. Written with K1
    when ``out_path`` is given."""
    imgs = IM.read_images(spark, folder)
    if callable(label):
        lab = label(F.col("path"))
    elif label == "base":
        lab = base_name_label("path")
    else:
        lab = parent_dir_label("path")
    imgs = imgs.withColumn("label_name", lab.cast("string"))
    if label == "index":
        imgs = index_labels(imgs, "label_name", "label")
    else:
        imgs = imgs.withColumn("label", F.col("label_name").try_cast("int"))
    rec = IM.to_features(imgs, height, width, channels).drop("data")
    norm = normalise or (lambda c: scale_pixels(c))
    rec = rec.withColumn("features", F.when(F.col("error").isNull(), norm(F.col("features"))))
    ok_label = (F.col("label") >= 0) & (F.col("label") < n_classes)
    rec = rec.withColumn("error", F.coalesce(F.col("error"), F.when(~ok_label | F.col("label").isNull(),
                                                                   F.lit("label not in class range"))))
    rec = rec.withColumn("label_onehot", F.when(F.col("error").isNull(), one_hot(F.col("label"), n_classes)))
    rec = rec.select(F.col("path").alias("key"), "features", "label", "label_onehot", "label_name", "error")
    if out_path:
        SK.save_records(rec, out_path)
    return rec


def featurize_and_save(records: DataFrame, base: Model, layer: str, out_path: str, batch_size: int = 20,
                       train_percent: int = 80, seed: int = 13, balance: bool = True) -> DataFrame:
    """Balanced 80/20 split, featurize up to ``layer``, save numbered batches
    per split (partitioned table) — only when the output is absent (K7)."""
    spark = records.sparkSession
    SM.validate_train_percent(train_percent)

    def build() -> DataFrame:
        df = records.where(F.col("error").isNull()) if "error" in records.columns else records
        if balance:
            df = SM.balanced_sample(df, "label", "key", seed=seed)
        df = SM.split_train_test(df, "label", "key", train_percent, seed=seed)
        feats = featurize(df, base, layer, "features", keep=("key", "label", "split"))
        batched = SM.minibatches(feats, "key", batch_size, seed=seed)
        return batched.withColumn("layer", F.lit(layer))

    return SK.materialize(spark, out_path, build, partition_by=["split"])


def train_early_stopping(train: DataFrame, test: DataFrame, model: Model, cfg: TrainConfig | None = None,
                         save_model_path: str | None = None, stats_path: str | None = None,
                         key_col: str = "key") -> TrainResult:
    """Train with averaging + early stopping; save the best model (K4) and
    append the run's statistics (K5)."""
    cfg = cfg or TrainConfig()
    res = fit(train, model, cfg, key_col=key_col, test=test, stats_path=stats_path)
    if save_model_path:
        res.model.save(train.sparkSession, save_model_path)
    return res


def train_transfer_head(batches_path: str, head: Model, n_classes: int, cfg: TrainConfig | None = None,
                        save_model_path: str | None = None) -> tuple[TrainResult, DataFrame]:
    """Train ``head`` on the saved train batches (features already computed),
    then evaluate on the test batches: returns the result and A2 statistics."""
    spark = SparkSession.getActiveSession()
    train = SK.read_split(spark, batches_path, "train")
    test = SK.read_split(spark, batches_path, "test")
    cfg = cfg or TrainConfig(max_epochs=3, patience=None)
    res = fit(train, head, cfg, key_col="key", features_col="features", label_col="label")
    pred = predict(test, res.model, "features", keep=("key", "label"))
    stats = E.class_stats(spark, E.confusion(pred), n_classes)
    if save_model_path:
        res.model.save(spark, save_model_path)
    return res, stats


def predict_text_lines(spark: SparkSession, path: str, model: Model, n_classes: int, delimiter: str = ",",
                       expected_width: int | None = None) -> DataFrame:
    """Batch prediction over text lines (S5 + S4 + I1): each non-empty line is
    parsed into features + actual label, scored, and the predicted label
    name is put next to the actual one. Bad lines keep their ``error``."""
    from tessera.functions.labels import label_names
    from tessera.sources.text import parse_lines, read_lines
    lines = read_lines(spark, path)
    parsed = parse_lines(lines, delimiter, n_classes=n_classes, expected_width=expected_width,
                         keep=("value", "file_path"))
    ok = parsed.where(F.col("error").isNull())
    pred = predict(ok, model, "features", keep=("value", "file_path", "label"), names=label_names(spark, n_classes))
    bad = parsed.where(F.col("error").isNotNull()).select("value", "file_path", "label", "error")
    return pred.select("value", "file_path", "label", "prediction", "predicted_name",
                       F.lit(None).cast("string").alias("error")).unionByName(bad, allowMissingColumns=True)


def predict_images(spark: SparkSession, folder: str, base: Model, layer: str, head: Model, n_classes: int,
                   height: int | None = None, width: int | None = None, channels: int | None = None,
                   means: list[float] | None = None, first: int | None = None) -> DataFrame:
    """Featurize raw images with the frozen ``base`` up to ``layer`` (after
    per-channel mean subtraction, P7) and score them with ``head``; the
    first ``first`` images by path when asked (F5). Images that cannot be decoded
    keep their row with the ``error``."""
    from tessera.functions.arrays import subtract_channel_means
    from tessera.functions.labels import label_names
    imgs = IM.labelled_images(spark, folder, height, width, channels)
    bad = imgs.where(F.col("error").isNotNull()).select("path", "label_name", "error")
    imgs = imgs.where(F.col("error").isNull())
    if first:
        imgs = SM.first_n(imgs, first, ["path"])
    if means:
        plane = (height or 0) * (width or 0)
        if not plane:
            raise ValueError("height and width are needed for mean subtraction")
        imgs = imgs.withColumn("features", subtract_channel_means("features", means, plane_size=plane))
    feats = featurize(imgs, base, layer, "features", keep=("path", "label_name"))
    pred = predict(feats, head, "features", keep=("path", "label_name"), names=label_names(spark, n_classes))
    return pred.withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def evaluate_saved_batches(spark: SparkSession, batches_path: str, model: Model, n_classes: int,
                           split: str = "test") -> tuple[DataFrame, DataFrame]:
    """Evaluate a model over saved batches of one split: running accuracy
    after every batch (A4) and final per-class statistics (A2)."""
    batches = SK.read_split(spark, batches_path, split)
    pred = predict(batches, model, "features", keep=("batch_id", "label"))
    return E.running_eval(pred), E.class_stats(spark, E.confusion(pred), n_classes)


__all__ = ["images_to_records", "featurize_and_save", "train_early_stopping", "train_transfer_head",
           "predict_text_lines", "predict_images", "evaluate_saved_batches", "epoch_table"]
