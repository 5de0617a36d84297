"""Synchronous data-parallel training with parameter averaging (M1, M3, A6),
early stopping (M2, A5, A7), optimiser settings (M5, M6) and statistics (K5).

Plan of one run
---------------
1. ``prepare``: every training row gets ``worker_id`` (seeded hash of the
   key), an exact seeded rank inside its worker, ``round_id`` =
   rank // (averaging_frequency * batch_size) and its mini-batch inside the
   round. The table is written once to the shared scratch folder, in folders
   of ``ROUNDS_PER_FOLDER`` rounds with one file per worker sorted by round:
   lineage is cut (executor loss costs one re-read) and each round reads only
   its folder's row groups.
2. An epoch is one Spark job (``plan="barrier"``, see ``epochs``): worker tasks
   run ``averaging_frequency`` mini-batches of SGD a round and average their
   parameters + momentum, weighted by rows seen, among themselves. Barrier
   stages need all tasks at once, which dynamic allocation cannot promise; with
   it, or with ``plan="rounds"``, each round is a job of ``n_workers`` tasks
   instead and averaging is a partial aggregate (``Summarizer.sum`` per chunk
   id). The driver receives one averaged vector per epoch (round) — the model,
   whose size does not grow with the data — and broadcasts it. Models that must
   not pass the driver are trained by ``sharded``.
3. After every epoch the test score is the distributed mean loss (A5);
   early-stopping conditions are checked; the best parameters are kept. With
   ``state_path`` all of that is written after each epoch, so that a run that
   was killed goes on from its last whole epoch.

Results do not depend on the physical partitioning: worker ids and orders
come from md5 of the key.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.constants import (AVERAGING_FREQUENCY_DEFAULT, BATCH_SIZE_DEFAULT, INIT_SEED_DEFAULT, L2_DEFAULT,
                               LEARNING_RATE_SCHEDULE, MAX_EPOCHS_DEFAULT, MAX_MINUTES_DEFAULT, PATIENCE_DEFAULT)
from tessera.operators.epochs import CHUNK, Optimiser, assembled, barrier_epoch, barrier_ready, exchange_for
from tessera.operators.models import Model
from tessera.operators.sampling import group_offsets, hash_uniform, rank_within_groups
from tessera.session import scratch_path

_CHUNK_SCHEMA = T.StructType([
    T.StructField("chunk_id", T.IntegerType()),
    T.StructField("values", T.ArrayType(T.DoubleType())),
])


@dataclass
class TrainConfig:
    """M5/M6/U4/U5 options. Defaults follow the reference jobs where they exist."""
    n_workers: int = 4
    batch_size: int = BATCH_SIZE_DEFAULT
    averaging_frequency: int = AVERAGING_FREQUENCY_DEFAULT
    max_epochs: int = MAX_EPOCHS_DEFAULT
    learning_rate: float | dict = field(default_factory=lambda: dict(LEARNING_RATE_SCHEDULE))
    momentum: float = 0.9
    nesterov: bool = True
    l2: float = L2_DEFAULT
    seed: int = INIT_SEED_DEFAULT
    cache: bool = False
    # early stopping (M2); None = condition off
    patience: int | None = PATIENCE_DEFAULT
    max_minutes: float | None = float(MAX_MINUTES_DEFAULT)
    max_score: float | None = None
    target_accuracy: float | None = None
    min_improvement: float = 0.0
    evaluate_every: int = 1  # score the test set every N epochs (and after the last one)
    keep_tables: bool = False  # keep the run's training / test tables in the scratch folder
    plan: str = "barrier"  # "barrier": an epoch is a job; "rounds": a round is a job

    def optimiser(self, model: Model) -> Optimiser:
        return Optimiser(model.layers, model.shapes(), model.input_dims, self.momentum, self.nesterov, self.l2)

    def epoch_plan(self, spark: SparkSession) -> str:
        return self.plan if barrier_ready(spark) else "rounds"

    def rate(self, iteration: int) -> float:
        if isinstance(self.learning_rate, dict):
            keys = sorted(k for k in self.learning_rate if k <= iteration)
            return float(self.learning_rate[keys[-1]] if keys else self.learning_rate[min(self.learning_rate)])
        return float(self.learning_rate)


@dataclass
class TrainResult:
    model: Model
    best_epoch: int
    best_score: float
    scores: dict
    termination_reason: str
    termination_detail: str
    total_epochs: int
    stats: list = field(default_factory=list)

    def stats_frame(self, spark: SparkSession) -> DataFrame:
        schema = ("run string, epoch int, round int, n_rows long, train_loss double, "
                  "test_score double, millis long")
        return spark.createDataFrame(self.stats, schema)


# ---------------------------------------------------------------- data layout

ROUNDS_PER_FOLDER = 64
#: what training reads of the table (an empty table has no files to infer it from)
TABLE_SCHEMA = "features array<double>, label int, worker_id int, round_id int, batch_in_round int, row_order long, folder int"


def prepare(df: DataFrame, key_col: str, features_col: str, label_col: str, cfg: TrainConfig,
            path: str | None = None) -> tuple[str, int]:
    """Write the training table by folders of rounds; returns (path, n_rounds).

    Rows without a key, features or a label cannot be trained on and are left out."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "train-table")
    per_round = cfg.averaging_frequency * cfg.batch_size
    x = df.select(F.col(key_col).alias("key"), F.col(features_col).cast("array<double>").alias("features"),
                  F.col(label_col).cast("int").alias("label")).dropna()
    x = x.withColumn("worker_id", F.pmod(hash_uniform(f"w{cfg.seed}", F.col("key")), F.lit(cfg.n_workers))
                     .cast("int"))
    x = x.withColumn("_u", hash_uniform(cfg.seed, F.col("key")))
    offsets = group_offsets(x, ["worker_id"], "_u")  # small, cut to the checkpoint folder
    largest = offsets.agg(F.max("_gsize")).first()[0] or 0
    x = rank_within_groups(x, ["worker_id"], "_u", "key", rank_col="_r", offsets=offsets)
    x = (x.withColumn("round_id", ((F.col("_r") - 1) / per_round).cast("int"))
          .withColumn("batch_in_round", (((F.col("_r") - 1) % per_round) / cfg.batch_size).cast("int"))
          .withColumn("row_order", F.col("_r").cast("long"))
          .withColumn("folder", F.floor(F.col("round_id") / ROUNDS_PER_FOLDER).cast("int"))
          .drop("_u", "_r"))
    # one shuffle: about one file per folder and worker, its rounds in order
    (x.repartition("folder", "worker_id").sortWithinPartitions("folder", "worker_id", "round_id")
      .write.mode("errorifexists").partitionBy("folder").parquet(path))
    return path, int(-(-int(largest) // per_round))  # rounds = ceil(largest worker / rows per round)


# ---------------------------------------------------------------- one round

def _round(spark: SparkSession, table: DataFrame, model: Model, flat: np.ndarray, mom: np.ndarray,
           iteration: int, cfg: TrainConfig) -> tuple[np.ndarray, np.ndarray, float, int, int]:
    rates = [cfg.rate(iteration + i) for i in range(cfg.averaging_frequency)]
    bc = spark.sparkContext.broadcast((cfg.optimiser(model), flat, mom, rates))

    def worker(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opt, w, v, rts = bc.value
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True)  # one worker's share of one round
        pdf = pdf.sort_values(["batch_in_round", "row_order"])
        loss_sum, n_rows = 0.0, 0
        for b, (_, grp) in enumerate(pdf.groupby("batch_in_round", sort=True)):
            x = np.stack([np.asarray(f, dtype=np.float64) for f in grp["features"].to_numpy()])
            y = grp["label"].to_numpy(dtype=np.int64)
            w, v, loss = opt.step(w, v, x, y, rts[min(b, len(rts) - 1)])
            loss_sum += loss * len(y)
            n_rows += len(y)
        vec = np.concatenate([w, v]) * n_rows
        rows = [(i // CHUNK, vec[i:i + CHUNK].tolist()) for i in range(0, len(vec), CHUNK)]
        rows.append((-1, [loss_sum, float(n_rows), 1.0]))
        yield pd.DataFrame(rows, columns=["chunk_id", "values"])

    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    # partition i holds worker i, so a round is n_workers tasks
    chunks = table.repartitionById(cfg.n_workers, F.col("worker_id")).mapInPandas(worker, _CHUNK_SCHEMA)
    summed = (chunks.groupBy("chunk_id")
                    .agg(Summarizer.sum(array_to_vector("values")).alias("s"))
                    .select("chunk_id", vector_to_array("s").alias("s"))
                    .collect())  # one row per chunk: the model size, not the data size
    bc.unpersist()
    parts = {r["chunk_id"]: np.asarray(r["s"]) for r in summed}
    loss_sum, n_rows, n_workers = parts.pop(-1)
    if n_rows <= 0:
        return flat, mom, float("nan"), 0, 0
    vec = np.concatenate([parts[i] for i in sorted(parts)]) / n_rows
    half = len(flat)
    return vec[:half], vec[half:], loss_sum / n_rows, int(n_rows), int(n_workers)


# ---------------------------------------------------------------- scoring (A5)

def test_score(test: DataFrame, model: Model, features_col: str, label_col: str) -> tuple[float, float]:
    """Mean NLL and accuracy of ``model`` on ``test`` (distributed)."""
    from tessera.operators.infer import nll_column, predict
    pred = predict(test.select(F.col(features_col).alias("features"), F.col(label_col).alias("label")),
                   model, "features", keep=("label",))
    r = pred.agg(F.avg(nll_column("scores", "label")).alias("loss"),
                 F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc")).first()
    if r is None or r["loss"] is None:  # empty test set
        return float("nan"), float("nan")
    return float(r["loss"]), float(r["acc"])


# ---------------------------------------------------------------- fit (M1/M2/M3)

@dataclass
class Progress:
    """Where a run stands after an epoch (M2, A7): what early stopping looks at, and why it ended."""
    next_epoch: int = 0
    iteration: int = 0
    best_epoch: int = -1
    best_score: float = float("inf")
    since_best: int = 0
    scores: dict = field(default_factory=dict)
    seconds: float = 0.0
    reason: str = ""
    detail: str = ""
    stats: list = field(default_factory=list)

    def scored(self, epoch: int, score: float, min_improvement: float) -> bool:
        """Take in the score of an epoch; True when it is the best so far."""
        self.scores[epoch] = score
        if score < self.best_score - min_improvement or self.best_epoch < 0 or np.isnan(self.best_score):
            self.best_score, self.best_epoch, self.since_best = score, epoch, 0
            return True
        self.since_best += 1
        return False

    def check(self, cfg: TrainConfig, acc: float) -> None:
        """Epoch conditions: target accuracy, patience, number of epochs."""
        if self.reason:
            return
        if cfg.target_accuracy is not None and acc >= cfg.target_accuracy:
            self.reason, self.detail = "EpochTerminationCondition", f"TargetAccuracy({cfg.target_accuracy})"
        elif cfg.patience is not None and self.since_best >= cfg.patience:
            self.reason, self.detail = "EpochTerminationCondition", f"ScoreImprovement({cfg.patience})"
        elif self.next_epoch >= cfg.max_epochs:
            self.reason, self.detail = "EpochTerminationCondition", f"MaxEpochs({cfg.max_epochs})"

    def dump(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def load(text: str) -> "Progress":
        p = Progress(**json.loads(text))
        p.scores = {int(k): v for k, v in p.scores.items()}
        p.stats = [tuple(r) for r in p.stats]
        return p


def _state_folder(path: str, epoch: int) -> str:
    return f"{path.rstrip('/')}/epoch-{epoch:06d}"


def save_state(spark: SparkSession, path: str, progress: Progress, vectors: dict[str, np.ndarray]) -> None:
    """The state after an epoch as one table, ``_SUCCESS`` last: a row of scalars and the vectors in chunks."""
    rows = [("progress", 0, progress.dump(), None)]
    rows += [(name, i // CHUNK, None, vec[i:i + CHUNK].tolist()) for name, vec in vectors.items() for i in range(0, len(vec), CHUNK)]
    spark.createDataFrame(rows, "part string, chunk_id int, text string, values array<double>") \
        .coalesce(1).write.mode("overwrite").parquet(_state_folder(path, progress.next_epoch))


def load_state(spark: SparkSession, path: str, max_epochs: int) -> tuple[Progress, dict[str, np.ndarray]] | None:
    """The last whole state below ``path``; None when there is none."""
    from tessera.sources.sinks import exists

    for epoch in range(max_epochs, 0, -1):
        folder = _state_folder(path, epoch)
        if exists(spark, f"{folder}/_SUCCESS"):
            parts: dict[str, list] = {}
            for r in spark.read.parquet(folder).collect():  # the model and a row
                parts.setdefault(r["part"], []).append(r)
            return Progress.load(parts.pop("progress")[0]["text"]), {k: assembled(v) for k, v in parts.items()}
    return None


def _epoch(spark: SparkSession, table: DataFrame, model: Model, flat: np.ndarray, mom: np.ndarray, progress: Progress,
           n_rounds: int, cfg: TrainConfig, run: str, epoch: int, iterations_path: str | None
           ) -> tuple[np.ndarray, np.ndarray]:
    """All rounds of one epoch; a limit that was passed goes into ``progress.reason``."""
    began = time.time()
    left = None if cfg.max_minutes is None else cfg.max_minutes * 60 - progress.seconds
    rounds: list[tuple] = []  # round, rows, loss, millis
    if cfg.epoch_plan(spark) == "barrier":
        rates = [[cfg.rate(progress.iteration + r * cfg.averaging_frequency + i) for i in range(cfg.averaging_frequency)]
                 for r in range(n_rounds)]
        from tessera.sources.sinks import delete_path
        meeting = scratch_path(spark, "meeting")
        out = barrier_epoch(table, cfg.optimiser(model), flat, mom, rates, progress.iteration, cfg.n_workers, cfg.max_score,
                            left, iterations_path is not None, exchange_for(meeting))
        if iterations_path is not None:  # rows of the workers go to the table, not through the driver
            from tessera.operators.stats import append_iterations
            path = scratch_path(spark, "epoch")
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
            append_iterations(out, run, epoch, iterations_path)
        rows = out.where("kind <> 'iteration'").collect()  # the model, and a row per round
        vec = assembled([r for r in rows if r["kind"] == "params"])
        flat, mom = vec[:len(flat)], vec[len(flat):]
        rounds = sorted((r["round"], r["n_rows"], r["score"], r["millis"]) for r in rows if r["kind"] == "round")
        delete_path(spark, meeting)
        if iterations_path is not None:
            delete_path(spark, path)
    else:
        for r in range(n_rounds):
            at = time.time()
            part = table.where((F.col("folder") == r // ROUNDS_PER_FOLDER) & (F.col("round_id") == r))
            flat, mom, loss, n_rows, _ = _round(spark, part, model, flat, mom,
                                                progress.iteration + r * cfg.averaging_frequency, cfg)
            rounds.append((r, int(n_rows), float(loss), int((time.time() - at) * 1000)))
            if cfg.max_score is not None and loss > cfg.max_score or left is not None and time.time() - began > left:
                break
    progress.iteration += len(rounds) * cfg.averaging_frequency
    progress.seconds += time.time() - began
    progress.stats += [(run, epoch, r, n, loss, None, millis) for r, n, loss, millis in rounds]
    if cfg.max_score is not None and rounds and rounds[-1][2] > cfg.max_score:
        progress.reason, progress.detail = "IterationTerminationCondition", f"MaxScore({cfg.max_score})"
    elif cfg.max_minutes is not None and progress.seconds / 60.0 > cfg.max_minutes:
        progress.reason, progress.detail = "IterationTerminationCondition", f"MaxTime({cfg.max_minutes} min)"
    return flat, mom


def fit(train: DataFrame, model: Model, cfg: TrainConfig, key_col: str = "key", features_col: str = "features",
        label_col: str = "label", test: DataFrame | None = None, run: str | None = None,
        stats_path: str | None = None, iterations_path: str | None = None, state_path: str | None = None) -> TrainResult:
    """Train ``model`` on ``train``; with ``test`` given, evaluate each epoch
    and stop early (M2); ``n_workers=1`` is plain local training (M3).

    ``stats_path``: append a row per round and per score. ``iterations_path``
    (barrier plan): append a row per worker and mini-batch, straight from the
    tasks (K5). ``state_path``: write the state after every epoch, and go on
    from the last whole one found there; the caller gives one run one path."""
    spark = train.sparkSession
    run = run or uuid.uuid4().hex[:8]
    path, n_rounds = prepare(train, key_col, features_col, label_col, cfg)
    table = spark.read.schema(TABLE_SCHEMA).parquet(path)
    test_path = None
    if test is not None:
        # score input written once: each epoch re-reads it instead of recomputing its lineage
        test_path = scratch_path(spark, "test-table")
        test.select(F.col(features_col).cast("array<double>").alias(features_col),
                    F.col(label_col).cast("int").alias(label_col)).write.parquet(test_path)
        test = spark.read.parquet(test_path)
    if cfg.cache:
        table = table.persist(StorageLevel.MEMORY_AND_DISK)
    flat = model.flat()
    upd = model.meta.get("updater")
    mom = np.array(upd, dtype=np.float64) if upd is not None and np.size(upd) == flat.size else np.zeros_like(flat)
    best, best_mom = flat.copy(), mom.copy()
    progress = Progress()
    known = load_state(spark, state_path, cfg.max_epochs) if state_path else None
    if known is not None:
        progress, v = known
        flat, mom, best, best_mom = v["flat"], v["mom"], v["best"], v["best_mom"]
        progress.check(cfg, float("nan"))  # a run with more epochs than before goes on
    while not progress.reason and progress.next_epoch < cfg.max_epochs:
        epoch = progress.next_epoch
        flat, mom = _epoch(spark, table, model, flat, mom, progress, n_rounds, cfg, run, epoch, iterations_path)
        progress.next_epoch = epoch + 1
        if progress.reason or progress.next_epoch == cfg.max_epochs or (epoch + 1) % max(1, cfg.evaluate_every) == 0:
            at, acc = time.time(), float("nan")
            score = progress.stats[-1][4] if n_rounds else float("nan")
            if test is not None:
                score, acc = test_score(test, model.with_flat(flat), features_col, label_col)
            progress.seconds += time.time() - at
            progress.stats.append((run, epoch, -1, 0, None, float(score), int(progress.seconds * 1000)))
            if progress.scored(epoch, score, cfg.min_improvement):
                best, best_mom = flat.copy(), mom.copy()
            progress.check(cfg, acc)
        if state_path:
            ended, progress.reason = progress.reason, "" if progress.detail.startswith("MaxEpochs") else progress.reason
            save_state(spark, state_path, progress, {"flat": flat, "mom": mom, "best": best, "best_mom": best_mom})
            progress.reason = ended
    if not progress.reason:
        progress.reason, progress.detail = "EpochTerminationCondition", f"MaxEpochs({cfg.max_epochs})"
    if cfg.cache:
        table.unpersist()
    if not cfg.keep_tables:
        from tessera.sources.sinks import delete_path
        for p in (path, test_path):
            if p:
                delete_path(spark, p)
    result = TrainResult(model.with_flat(best, updater=best_mom), progress.best_epoch, progress.best_score, progress.scores,
                         progress.reason, progress.detail, progress.next_epoch, progress.stats)
    if stats_path:
        from tessera.operators.stats import append_stats
        append_stats(result.stats_frame(spark), stats_path)
    return result


def epoch_table(result: TrainResult, spark: SparkSession) -> DataFrame:
    """Score per epoch with the best epoch and the termination reason."""
    rows = [(int(e), float(s), int(e) == result.best_epoch, result.termination_reason, result.termination_detail)
            for e, s in sorted(result.scores.items())]
    return spark.createDataFrame(rows, "epoch int, score double, is_best boolean, reason string, detail string")
