"""Training with the model as a table (A6, K4, S15, M1, M2, M7): no parameter vector on the driver.

A model in training is the table ``layer_pos, param, shape, chunk_id, values,
momentum`` (rows of at most ``models.PARAM_CHUNK`` values), made where it lives
by ``init_params``. A round is one job: the chunks are dealt to every worker's
task next to the worker's rows and sorted before them, so a task reads the model
first and then streams its mini-batches; the workers' chunks, weighted by rows
seen, are summed per chunk (map-side combined) and joined back to the table,
which keeps chunks that no worker trained. The next round reads the written
table. Scoring deals the test rows in the same way. The driver sees one row of
statistics per round and of progress per epoch.

Everything of a run lies below one path: the training table, the model after
each epoch, and the state of early stopping, each complete once its ``_SUCCESS``
stands. A run that was killed goes on from its last whole epoch.
"""

from __future__ import annotations

import itertools
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import models, nets
from tessera.operators.epochs import Optimiser, mini_batches
from tessera.operators.train import (ROUNDS_PER_FOLDER, TABLE_SCHEMA, Progress, TrainConfig, load_state, prepare,
                                     save_state)
from tessera.session import scratch_path

KEYS = ["layer_pos", "param", "chunk_id"]
#: statistics rows stand in the same table, as a parameter of no layer
STATS_LAYER = -1


# ---------------------------------------------------------------- M7 initialisation

def uniform_pair(seed: int, layer: int, index: Column) -> tuple[Column, Column]:
    """Two uniforms in (0, 1) from md5(``seed:layer:index``): counter-based, so any value can be made anywhere."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{layer}:"), index.cast("string")))
    part = lambda at: (F.conv(F.substring(digest, at, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return part(1), part(9)


def normal_value(seed: int, layer: int, index: Column) -> Column:
    """Standard normal number ``index`` of a layer (Box-Muller)."""
    a, b = uniform_pair(seed, layer, index)
    return F.sqrt(-2.0 * F.log(a)) * F.cos(2.0 * np.pi * b)


def _scaled_normals(seed: int, layer: int, std: float):
    return lambda i: normal_value(seed, layer, i) * F.lit(std)


def init_params(spark: SparkSession, layers: list[dict], input_dims: tuple, seed: int = 12345, init: str = "xavier",
                init_std: float | None = None, name: str = "model") -> DataFrame:
    """M7: the parameter table of a new model as column expressions; every chunk is made by the task that writes it.

    ``xavier``: N(0, 2 / (fan_in + fan_out)); ``normal``: N(0, init_std); ``zero``: zeros. Biases and momentum are 0."""
    out = None
    for pos, shapes in enumerate(nets.param_shapes(layers, input_dims)):
        for param in ("W", "b"):
            if param not in shapes:
                continue
            shape = shapes[param]
            size, chunk = int(np.prod(shape)), models.PARAM_CHUNK
            fan_out = shape[0] * (int(np.prod(shape[2:])) if len(shape) > 2 else 1)
            std = init_std if init == "normal" else np.sqrt(2.0 / (fan_out + int(np.prod(shape[1:]))))
            lo = F.col("id") * chunk
            index = F.sequence(lo, F.least(lo + chunk, F.lit(size)) - 1)
            drawn = param == "W" and init != "zero"
            value = _scaled_normals(seed, pos, float(std)) if drawn else lambda i: F.lit(0.0)
            part = spark.range(-(-size // chunk)).select(
                F.lit(name).alias("model"), F.lit(pos).alias("layer_pos"), F.lit(param).alias("param"),
                F.array(*[F.lit(int(n)) for n in shape]).alias("shape"), F.col("id").cast("int").alias("chunk_id"),
                F.transform(index, value).alias("values"), F.transform(index, lambda i: F.lit(0.0)).alias("momentum"))
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("the network has no parameters")
    return out


# ---------------------------------------------------------------- rows next to the model

_ROW_COLUMNS = ["round_id", "worker_id", "batch_in_round", "features", "label"]
_MODEL_COLUMNS = [*KEYS, "values", "momentum"]


def beside_model(rows: DataFrame, params: DataFrame, tasks: int) -> DataFrame:
    """``rows`` (with ``task`` and ``row_order``) in ``tasks`` partitions, each with the whole model before its rows."""
    model = params.where(F.col("layer_pos") >= 0).select(*_MODEL_COLUMNS) \
        .withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).withColumn("is_row", F.lit(False))
    both = model.unionByName(rows.withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    order = ["is_row", *KEYS, "round_id", "worker_id", "batch_in_round", "row_order"]
    return both.repartitionById(tasks, F.col("task")).sortWithinPartitions(*order) \
        .select("is_row", *_MODEL_COLUMNS, *_ROW_COLUMNS)


@dataclass
class _Held:
    """A model as a task read it: the flat vectors and the chunk each slice of them belongs to."""
    keys: list
    flat: np.ndarray
    momentum: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def read(batches: Iterator[pa.RecordBatch]) -> tuple["_Held | None", Iterator[pa.RecordBatch]]:
        """The model at the head of a partition of ``beside_model``, and the batches of rows after it."""
        keys, values, momentum, rest = [], [], [], iter(())
        for b in batches:
            is_row = b.column(0).to_numpy(zero_copy_only=False).astype(bool)
            n = int(is_row.argmax()) if is_row.any() else b.num_rows
            for i in range(n):
                keys.append(tuple(b.column(c)[i].as_py() for c in (1, 2, 3)))
                values.append(b.column(4)[i].values.to_numpy(zero_copy_only=False))
                momentum.append(b.column(5)[i].values.to_numpy(zero_copy_only=False))
            if n < b.num_rows:
                rest = itertools.chain([b.slice(n)], batches)
                break
        if not keys:
            return None, rest
        cuts = np.cumsum([0, *map(len, values)])
        rows = (pa.RecordBatch.from_arrays(b.columns[6:], names=_ROW_COLUMNS) for b in rest)
        return _Held(keys, np.concatenate(values), np.concatenate(momentum), cuts), rows


# ---------------------------------------------------------------- a round

_OUT = "layer_pos int, param string, chunk_id int, n_rows long, values array<double>, momentum array<double>"


def sharded_round(rows: DataFrame, params: DataFrame, optimiser: Optimiser, rates: list[float], iteration: int,
                  n_workers: int) -> DataFrame:
    """The parameter table after one round over ``rows`` (training rows of one ``round_id``), with a statistics row (layer
    ``STATS_LAYER``, named by worker, chunk = iteration, values loss and milliseconds) per mini-batch."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rest = _Held.read(batches)
        out, seen = [], 0
        if held is not None:
            w, v = held.flat, held.momentum
            for b, ((_, worker, _), x, y) in enumerate(mini_batches(rest)):
                at = time.monotonic()
                w, v, loss = optimiser.step(w, v, x, y, rates[min(b, len(rates) - 1)])
                out.append((STATS_LAYER, str(worker), iteration + b, len(y), [loss * len(y), (time.monotonic() - at) * 1000 * len(y)], [0.0]))
                seen += len(y)
            if seen:
                out += [(*k, seen, w[lo:hi] * seen, v[lo:hi] * seen) for k, lo, hi in zip(held.keys, held.cuts, held.cuts[1:])]
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        columns = zip(*out) if out else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                         names=[c.split()[0] for c in _OUT.split(", ")])

    dealt = beside_model(rows.withColumn("task", F.col("worker_id")), params, n_workers)
    total = lambda c: vector_to_array(Summarizer.sum(array_to_vector(c))).alias(c)
    summed = dealt.mapInArrow(run, _OUT).groupBy(*KEYS).agg(total("values"), total("momentum"), F.sum("n_rows").alias("n_rows"))
    mean = lambda c: F.transform(c, lambda x: x / F.col("n_rows")).alias(f"_{c}")
    summed = summed.select(*KEYS, "n_rows", mean("values"), mean("momentum"))
    return params.where(F.col("layer_pos") >= 0).drop("n_rows").join(summed, KEYS, "full").select(
        *KEYS, "shape", F.coalesce("_values", "values").alias("values"), F.coalesce("_momentum", "momentum").alias("momentum"),
        "n_rows")


def sharded_score(test: DataFrame, params: DataFrame, optimiser: Optimiser, tasks: int) -> tuple[float, float]:
    """Mean loss and accuracy over ``features, label`` rows; the model reaches the tasks as in a round."""
    rows = test.where(F.col("features").isNotNull() & F.col("label").isNotNull()) \
        .select("features", F.col("label").cast("int").alias("label")) \
        .withColumn("row_order", F.xxhash64("features", "label")) \
        .withColumn("task", F.pmod("row_order", F.lit(tasks)).cast("int")) \
        .withColumn("round_id", F.lit(0)).withColumn("worker_id", F.col("task")) \
        .withColumn("batch_in_round", (F.pmod(F.shiftright("row_order", 32), F.lit(1 << 10))).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rest = _Held.read(batches)
        n, loss, hits = 0, 0.0, 0
        if held is not None:
            model = nets.unflatten_params(held.flat, optimiser.shapes)
            for _, x, y in mini_batches(rest):
                if len(optimiser.dims) > 1:
                    x = x.reshape((len(x),) + tuple(optimiser.dims))
                p = nets.forward(optimiser.layers, model, x)
                n, loss, hits = n + len(y), loss + float(nets.nll(p, y).sum()), hits + int((p.argmax(axis=1) == y).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([loss]), pa.array([hits])], names=["n", "loss", "hits"])

    r = beside_model(rows, params, tasks).mapInArrow(run, "n long, loss double, hits long") \
        .agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"), F.sum("hits").alias("hits")).first()
    return (float("nan"), float("nan")) if not r["n"] else (r["loss"] / r["n"], r["hits"] / r["n"])


# ---------------------------------------------------------------- a run

@dataclass
class ShardedResult:
    """Where the best model lies, and how the run went."""
    params_path: str
    progress: Progress

    def params(self, spark: SparkSession, name: str = "model") -> DataFrame:
        """The best model as rows of ``model_params``."""
        return spark.read.parquet(self.params_path).where(F.col("layer_pos") >= 0) \
            .select(F.lit(name).alias("model"), "layer_pos", "param", "shape", "chunk_id", "values")


def fit_sharded(train: DataFrame, params: DataFrame, layers: list[dict], input_dims: tuple, cfg: TrainConfig,
                path: str | None = None, key_col: str = "key", features_col: str = "features", label_col: str = "label",
                test: DataFrame | None = None, run: str | None = None) -> ShardedResult:
    """Train the model of table ``params`` (``init_params``) on ``train``, all below ``path`` (default: scratch folder).

    Options, layout of rounds, early stopping and results are those of ``train.fit``. ``path/train_stats`` gets a row per worker and
    mini-batch (K5). With a path used before, the run goes on from its last whole epoch.
    """
    from tessera.operators.stats import TRAIN_STATS
    from tessera.sources.sinks import delete_path, exists

    spark = train.sparkSession
    path, run = (path or scratch_path(spark, "sharded")).rstrip("/"), run or uuid.uuid4().hex[:8]
    optimiser = Optimiser(layers, [dict(s) for s in nets.param_shapes(layers, input_dims)], tuple(input_dims), cfg.momentum,
                          cfg.nesterov, cfg.l2)
    if exists(spark, f"{path}/table/_SUCCESS"):
        last = spark.read.schema(TABLE_SCHEMA).parquet(f"{path}/table").agg(F.max("round_id")).first()[0]
        n_rounds = 0 if last is None else last + 1
    else:
        if exists(spark, f"{path}/table"):  # half written
            delete_path(spark, f"{path}/table")
        _, n_rounds = prepare(train, key_col, features_col, label_col, cfg, f"{path}/table")
    table = spark.read.schema(TABLE_SCHEMA).parquet(f"{path}/table")
    scored = None
    if test is not None:
        scored = test.select(F.col(features_col).cast("array<double>").alias("features"), F.col(label_col).alias("label"))
    at = lambda epoch: f"{path}/params/epoch-{epoch:06d}"

    known = load_state(spark, f"{path}/state", cfg.max_epochs)
    progress = known[0] if known else Progress()
    if known is None:
        params.select(*KEYS, "shape", "values", "momentum", F.lit(None).cast("long").alias("n_rows")) \
            .write.mode("overwrite").parquet(at(0))
    progress.check(cfg, float("nan"))
    while not progress.reason and progress.next_epoch < cfg.max_epochs:
        epoch, began, here = progress.next_epoch, time.time(), at(progress.next_epoch)
        temporary = []
        for r in range(n_rounds):
            rows = table.where((F.col("folder") == r // ROUNDS_PER_FOLDER) & (F.col("round_id") == r)).drop("folder")
            iteration = progress.iteration + r * cfg.averaging_frequency
            rates = [cfg.rate(iteration + i) for i in range(cfg.averaging_frequency)]
            after = sharded_round(rows, spark.read.parquet(here), optimiser, rates, iteration, cfg.n_workers)
            here = at(epoch + 1) if r == n_rounds - 1 else f"{path}/rounds/{epoch:06d}-{r:06d}"
            after.write.mode("overwrite").parquet(here)
            written = spark.read.parquet(here).where(F.col("layer_pos") == STATS_LAYER).select(
                F.lit(run).alias("run"), F.lit(epoch).alias("epoch"), F.lit(r).alias("round"),
                F.col("param").cast("int").alias("worker"), F.col("chunk_id").alias("iteration"), F.get("values", F.lit(0)).alias("score"),
                "n_rows", F.get("values", F.lit(1)).cast("long").alias("millis"))
            written.select(*TRAIN_STATS).write.mode("overwrite").parquet(f"{path}/train_stats/part={epoch:06d}-{r:06d}")
            n, loss = written.agg(F.sum("n_rows"), F.sum(F.col("score") * F.col("n_rows")) / F.sum("n_rows")).first()
            progress.stats.append((run, epoch, r, int(n or 0), loss, None, int((time.time() - began) * 1000)))
            temporary.append(here)
            spent = progress.seconds + time.time() - began
            if cfg.max_score is not None and loss is not None and loss > cfg.max_score:
                progress.reason, progress.detail = "IterationTerminationCondition", f"MaxScore({cfg.max_score})"
            elif cfg.max_minutes is not None and spent / 60.0 > cfg.max_minutes:
                progress.reason, progress.detail = "IterationTerminationCondition", f"MaxTime({cfg.max_minutes} min)"
            if progress.reason:
                break
        if here != at(epoch + 1):  # no round, or stopped amid the epoch
            spark.read.parquet(here).write.mode("overwrite").parquet(at(epoch + 1))
        progress.next_epoch = epoch + 1
        progress.iteration += len(temporary) * cfg.averaging_frequency
        if progress.reason or progress.next_epoch == cfg.max_epochs or (epoch + 1) % max(1, cfg.evaluate_every) == 0:
            score, acc = progress.stats[-1][4] if progress.stats else float("nan"), float("nan")
            if scored is not None:
                score, acc = sharded_score(scored, spark.read.parquet(at(epoch + 1)), optimiser, cfg.n_workers)
            progress.scored(epoch, float("nan") if score is None else score, cfg.min_improvement)
            progress.check(cfg, acc)
        progress.seconds += time.time() - began
        ended = progress.reason
        if progress.detail.startswith("MaxEpochs"):
            progress.reason = ""  # a later call may ask for more epochs
        save_state(spark, f"{path}/state", progress, {})
        progress.reason = ended
        for p in temporary:
            if p != at(epoch + 1):
                delete_path(spark, p)
    if not progress.reason:
        progress.reason, progress.detail = "EpochTerminationCondition", f"MaxEpochs({cfg.max_epochs})"
    return ShardedResult(at(progress.best_epoch + 1), progress)
