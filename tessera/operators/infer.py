"""Batch inference (I1, A3) and featurization (I2) over Arrow batches.

The model travels once per executor as a broadcast variable (its size is the
parameter count); each task runs whole Arrow batches through NumPy. The
arg-max and the label-name join stay JVM-side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import argmax
from tessera.operators import nets
from tessera.operators.models import Model


def _stack_features(series: pd.Series, dims: tuple) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in series.to_numpy()])
    return x.reshape((len(series),) + tuple(dims)) if len(dims) > 1 else x


_MAX_CELLS = 1 << 24  # activations held at once by one task (128 MiB of doubles)


def _rows_per_slice(layers, params, dims, upto, max_cells: int = _MAX_CELLS) -> int:
    """Rows per forward slice so that the largest activation of the net
    stays under ``max_cells`` values."""
    probe = np.zeros((1,) + tuple(dims))
    _, cache = nets.forward(layers, params, probe, upto=upto, keep=True)
    widest = max([int(np.prod(dims))] + [c[2].size for c in cache] + [c[1].size for c in cache])
    return max(1, max_cells // max(1, widest))


def _run(df: DataFrame, model: Model, features_col: str, keep: Sequence[str], upto: int | None,
         out_col: str, max_cells: int = _MAX_CELLS) -> DataFrame:
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((model.layers, model.params, model.input_dims))
    keep = list(keep)
    in_df = df.select(*keep, F.col(features_col).alias("_x"))
    fields = [f for f in in_df.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layers, params, dims = bc.value
        step = _rows_per_slice(layers, params, dims, upto, max_cells)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            ok = pdf["_x"].notna().to_numpy()
            out = [None] * len(pdf)
            idx = np.nonzero(ok)[0]
            for lo in range(0, len(idx), step):
                part = idx[lo:lo + step]
                x = _stack_features(pdf["_x"].iloc[part], dims)
                y = nets.forward(layers, params, x, upto=upto)
                y = y.reshape(len(y), -1)
                for i, row in zip(part, y):
                    out[i] = row
            res = pdf[keep].copy()
            res[out_col] = out
            yield res

    return in_df.mapInPandas(score, schema)


def predict(df: DataFrame, model: Model, features_col: str = "features", keep: Sequence[str] = (),
            names: DataFrame | None = None, max_cells: int = _MAX_CELLS) -> DataFrame:
    """Class scores, predicted class (first maximum), optional predicted
    label name (broadcast join to the small label dimension)."""
    out = _run(df, model, features_col, keep, None, "scores", max_cells)
    out = out.withColumn("prediction", argmax("scores"))
    if names is not None:
        dim = names.select(F.col("label").alias("prediction"), F.col("label_name").alias("predicted_name"))
        out = out.join(F.broadcast(dim), "prediction", "left")
    return out


def featurize(df: DataFrame, model: Model, layer: str, features_col: str = "features",
              keep: Sequence[str] = (), max_cells: int = _MAX_CELLS) -> DataFrame:
    """Forward through the layers up to and including ``layer``; the
    output replaces the features, other kept columns (label) pass through."""
    return _run(df, model, features_col, keep, model.layer_index(layer), "features", max_cells)


def nll_column(scores: str = "scores", label: str = "label") -> F.Column:
    """-ln p[label] of a probability vector (clipped at 1e-15)."""
    p = F.element_at(F.col(scores), F.col(label) + 1)
    return -F.log(F.greatest(p, F.lit(1e-15)))
