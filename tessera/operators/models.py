"""Models as two ordinary tables.

``model_layers(model, pos, name, kind, activation, n_in, n_out, kernel,
stride, channels_in, frozen)`` and ``model_params(model, layer_pos, param,
shape ARRAY<INT>, chunk_id, values ARRAY<DOUBLE>)``, rows of at most
``PARAM_CHUNK`` values. A model is small next to the
data (its size is the parameter count, not the row count); the driver holds
one copy and ships it to tasks as a broadcast.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import nets

LAYER_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("pos", T.IntegerType()),
    T.StructField("name", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("activation", T.StringType()), T.StructField("n_in", T.IntegerType()),
    T.StructField("n_out", T.IntegerType()), T.StructField("kernel", T.IntegerType()),
    T.StructField("stride", T.IntegerType()), T.StructField("channels_in", T.IntegerType()),
    T.StructField("frozen", T.BooleanType()),
])
PARAM_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("layer_pos", T.IntegerType()),
    T.StructField("param", T.StringType()), T.StructField("shape", T.ArrayType(T.IntegerType())),
    T.StructField("chunk_id", T.IntegerType()), T.StructField("values", T.ArrayType(T.DoubleType())),
])
#: values per row of the parameter table, so that a large layer is many small rows
PARAM_CHUNK = 1 << 16
_LAYER_KEYS = ["name", "kind", "activation", "n_in", "n_out", "kernel", "stride", "channels_in", "frozen"]


@dataclass
class Model:
    layers: list[dict]
    params: list[dict]
    input_dims: tuple
    name: str = "model"
    meta: dict = field(default_factory=dict)

    # ------------------------------------------------------------ building
    @staticmethod
    def build(layers: list[dict], input_dims: tuple, seed: int = 12345, name: str = "model",
              init: str = "xavier", init_std: float | None = None) -> "Model":
        """M7: seeded initialisation. ``xavier``: N(0, 2/(fan_in+fan_out));
        ``normal``: N(0, init_std)."""
        rng = np.random.default_rng(seed)
        shapes = nets.param_shapes(layers, input_dims)
        params = []
        for ly, sh in zip(layers, shapes):
            p = {}
            if "W" in sh:
                w_shape = sh["W"]
                fan_out = w_shape[0] * (int(np.prod(w_shape[2:])) if len(w_shape) > 2 else 1)
                fan_in = int(np.prod(w_shape[1:]))
                std = init_std if init == "normal" else np.sqrt(2.0 / (fan_in + fan_out))
                p["W"] = rng.normal(0.0, std, size=w_shape)
                p["b"] = np.zeros(sh["b"])
            params.append(p)
        layers = [dict({"name": f"layer{i}", "activation": "identity", "frozen": False}, **ly)
                  for i, ly in enumerate(layers)]
        # fill n_in from the data shape
        shape = tuple(input_dims)
        for ly, sh in zip(layers, shapes):
            ly.setdefault("n_in", int(np.prod(shape)))
            if "W" in sh and ly["kind"] in ("dense", "output"):
                shape = (sh["W"][0],)
            elif ly["kind"] in ("conv", "pool", "flatten"):
                shape = _next_shape(ly, shape)
        return Model(layers, params, tuple(input_dims), name)

    def n_params(self) -> int:
        return int(sum(v.size for p in self.params for v in p.values()))

    def flat(self) -> np.ndarray:
        return nets.flatten_params(self.params)

    def with_flat(self, vec: np.ndarray, updater: np.ndarray | None = None) -> "Model":
        """A copy with new parameters (and, when given, new updater state)."""
        m = copy.copy(self)
        m.params = nets.unflatten_params(np.asarray(vec, dtype=np.float64), self.shapes())
        m.meta = dict(self.meta)
        if updater is not None:
            m.meta["updater"] = np.asarray(updater, dtype=np.float64)
        return m

    def shapes(self) -> list[dict]:
        return [{k: v.shape for k, v in p.items()} for p in self.params]

    def layer_index(self, name: str) -> int:
        for i, ly in enumerate(self.layers):
            if ly["name"] == name:
                return i
        raise KeyError(f"no layer named {name}")

    # ------------------------------------------------------------ tables
    def layer_rows(self) -> list[tuple]:
        return [(self.name, i, ly.get("name"), ly.get("kind"), ly.get("activation"),
                 _int(ly.get("n_in")), _int(ly.get("n_out")), _int(ly.get("kernel")), _int(ly.get("stride")),
                 _int(ly.get("channels_in")), bool(ly.get("frozen", False)))
                for i, ly in enumerate(self.layers)]

    def param_chunks(self) -> Iterator[tuple]:
        """(model, layer, param, shape, chunk, values): weights per layer in chunks of ``PARAM_CHUNK`` values, plus
        model-level rows (layer_pos -1): the input shape and, when present, the updater state (momentum buffers) so a
        saved model can resume training."""
        parts = [(i, k, p[k]) for i, p in enumerate(self.params) for k in ("W", "b") if k in p]
        parts.append((-1, "input_shape", np.asarray(self.input_dims, dtype=np.float64)))
        if self.meta.get("updater") is not None:
            parts.append((-1, "updater", np.ravel(self.meta["updater"])))
        for pos, name, values in parts:
            flat = np.asarray(values, dtype=np.float64).ravel()
            for c, at in enumerate(range(0, max(1, flat.size), PARAM_CHUNK)):
                yield self.name, pos, name, [int(n) for n in np.shape(values)], c, flat[at:at + PARAM_CHUNK]

    def to_tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        kinds = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.float64())]
        columns = [pa.array(list(c), k) for c, k in zip(zip(*self.param_chunks()), kinds)]
        return (spark.createDataFrame(self.layer_rows(), LAYER_SCHEMA),
                spark.createDataFrame(pa.table(columns, names=PARAM_SCHEMA.names), PARAM_SCHEMA))

    def save(self, spark: SparkSession, path: str) -> None:
        """K4: write the model as two tables; one ``model=`` partition per model
        (dynamic partition overwrite replaces only this model)."""
        layers, params = self.to_tables(spark)
        for df, sub in ((layers, "model_layers"), (params, "model_params")):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("model").parquet(f"{path}/{sub}"))

    @staticmethod
    def load(spark: SparkSession, path: str, name: str) -> "Model":
        """Read one model back (partition-pruned to ``model=name``)."""
        layers = spark.read.parquet(f"{path}/model_layers").where(F.col("model") == name)
        params = spark.read.parquet(f"{path}/model_params").where(F.col("model") == name)
        return Model.from_tables(layers, params, name)

    @staticmethod
    def from_tables(layers_df: DataFrame, params_df: DataFrame, name: str) -> "Model":
        lrows = sorted(layers_df.where(F.col("model") == name).collect(), key=lambda r: r["pos"])
        # the model itself, in chunks: arrays of doubles, not Python floats
        table = params_df.where(F.col("model") == name).select(
            "layer_pos", "param", "shape", "chunk_id", "values").toArrow().combine_chunks()
        pieces: dict[tuple, dict] = {}
        for r in range(table.num_rows):
            pos, param, shape, chunk = (table[c][r].as_py() for c in ("layer_pos", "param", "shape", "chunk_id"))
            values = table["values"][r].values.to_numpy(zero_copy_only=False)
            pieces.setdefault((pos, param, tuple(shape)), {})[chunk] = values
        layers = [{k: r[k] for k in _LAYER_KEYS if r[k] is not None} for r in lrows]
        params = [dict() for _ in layers]
        meta: dict = {}
        dims = None
        for (pos, param, shape), chunks in pieces.items():
            values = np.concatenate([chunks[c] for c in sorted(chunks)])
            if pos < 0:
                if param == "input_shape":
                    dims = tuple(int(v) for v in values)
                else:
                    meta[param] = values
                continue
            params[pos][param] = values.reshape(shape)
        if dims is None:  # tables written without the input shape
            first = layers[0]
            if first["kind"] in ("conv", "pool"):
                c = int(first.get("channels_in") or 1)
                side = int(round((int(first["n_in"]) / c) ** 0.5))
                dims = (c, side, int(first["n_in"]) // (c * side))
            else:
                dims = (int(first["n_in"]),)
        return Model(layers, params, dims, name, meta)


def _int(v):
    return None if v is None else int(v)


def _next_shape(ly, shape):
    if ly["kind"] == "flatten":
        return (int(np.prod(shape)),)
    c, h, w = shape
    k = int(ly["kernel"])
    if ly["kind"] == "pool":
        s = int(ly.get("stride") or k)
        return (c, (h - k) // s + 1, (w - k) // s + 1)
    s = int(ly.get("stride") or 1)
    return (int(ly["n_out"]), (h - k) // s + 1, (w - k) // s + 1)


# ------------------------------------------------------------ summaries

def summary(layers: DataFrame, params: DataFrame) -> DataFrame:
    """One row per layer with its parameter count (a join of two small tables)."""
    counts = params.where(F.col("layer_pos") >= 0).groupBy("model", F.col("layer_pos").alias("pos")).agg(
        F.sum(F.size("values")).cast("bigint").alias("n_params"))
    return (layers.join(counts, ["model", "pos"], "left")
                  .select("model", "pos", "name", "kind", "activation", "n_in", "n_out", "frozen",
                          F.coalesce("n_params", F.lit(0).cast("bigint")).alias("n_params")))


# ------------------------------------------------------------ transfer (M4 / M5)

def transfer_head(base: Model, freeze_until: str, n_out: int, remove_output_layers: int = 1,
                  hidden: list[dict] | None = None, seed: int = 123, init: str = "xavier",
                  init_std: float | None = None, name: str | None = None) -> Model:
    """M4: freeze layers up to and including ``freeze_until``, drop the last
    ``remove_output_layers`` layers, append ``hidden`` layers (optional) and
    a new softmax output of ``n_out`` classes, freshly initialised."""
    keep = len(base.layers) - remove_output_layers
    layers = [dict(ly) for ly in base.layers[:keep]]
    params = [dict(p) for p in base.params[:keep]]
    cut = base.layer_index(freeze_until)
    for i, ly in enumerate(layers):
        ly["frozen"] = i <= cut
    new = list(hidden or []) + [{"kind": "output", "activation": "softmax", "n_out": n_out, "name": "output"}]
    probe = Model.build(layers + new, base.input_dims, seed=seed, init=init, init_std=init_std)
    for i in range(keep):
        probe.params[i] = params[i]
        probe.layers[i] = layers[i]
    probe.name = name or f"{base.name}-head"
    return probe


# ------------------------------------------------------------ data-derived heads

def class_mean_head(df: DataFrame, features_col: str, label_col: str, n_classes: int,
                    name: str = "class_mean_head") -> Model:
    """A fixed linear softmax head from the data: W[c] = mean feature vector of
    class c, b[c] = -0.5 * |W[c]|^2 (so the arg-max is the nearest class
    mean). The means are one partial aggregate per class (``Summarizer``);
    the collected table is classes x dims, i.e. the model size."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vec = array_to_vector(F.col(features_col).cast("array<double>"))
    means = (df.where(F.col(label_col).isNotNull() & F.col(features_col).isNotNull())
               .groupBy(F.col(label_col).alias("c"))
               .agg(Summarizer.mean(vec).alias("m"))  # partial aggregate, no row explosion
               .select("c", vector_to_array("m").alias("m"))
               .collect())  # one row per class: the model size
    dim = max(len(r["m"]) for r in means)
    W = np.zeros((n_classes, dim))
    for r in means:
        if 0 <= r["c"] < n_classes:
            W[r["c"]] = np.asarray(r["m"], dtype=np.float64)
    b = -0.5 * (W * W).sum(axis=1)
    layers = [{"name": "head", "kind": "output", "activation": "softmax", "n_in": dim, "n_out": n_classes,
               "frozen": False}]
    return Model(layers, [{"W": W, "b": b}], (dim,), name)
