"""One training epoch as one Spark job: a barrier stage of worker tasks.

The epoch's rows are dealt out by worker and sorted by round inside each task,
so a task streams them: it holds one mini-batch at a time, however long the
epoch is. After each round the tasks add up their row-weighted parameters, in task
order, and go on from the average; no job, scan or shuffle lies between two rounds.

The sum goes through the shared scratch folder (``FileExchange``): a task writes
its vector as one file, a few tasks each sum a slice of all files, and everyone
reads the sums; a round then costs milliseconds on a local disk. The barrier
guarantees that all tasks run, which is what makes waiting for files safe.
``GatherExchange`` sums by ``BarrierTaskContext.allGather`` instead, ``GATHER``
values at a time; it needs no folder that Python can open, but Spark looks for the
answer once a second only, so a round costs a second.

With fewer slots than workers a task runs several workers, one after the other,
each from the round's common start. A failed task makes Spark run the stage, that
is the epoch, again from its start parameters, with the same result.

The averaged vector comes back in chunks, each from one task; statistics come
back as rows: one per round, and on request one per worker and iteration, which
are written by the tasks and never gathered on the driver.
"""

from __future__ import annotations

import base64
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import nets

#: values of one gathered message (512 KiB)
GATHER = 1 << 16
#: values per returned parameter row
CHUNK = 4096
EPOCH_SCHEMA = ("kind string, round int, worker int, iteration int, n_rows long, score double, millis long, "
                "chunk_id int, values array<double>")
_ROW_COLUMNS = ("round_id", "worker_id", "batch_in_round", "features", "label")


@dataclass(frozen=True)
class Optimiser:
    """What a worker needs besides the parameters: the network and the update rule."""
    layers: list
    shapes: list
    dims: tuple
    momentum: float
    nesterov: bool
    l2: float

    def step(self, w: np.ndarray, v: np.ndarray, x: np.ndarray, y: np.ndarray, rate: float
             ) -> tuple[np.ndarray, np.ndarray, float]:
        """One mini-batch: new parameters, new momentum buffer, loss before the step."""
        if len(self.dims) > 1:
            x = x.reshape((len(x),) + tuple(self.dims))
        params = nets.unflatten_params(w, self.shapes)
        loss, grads = nets.loss_and_grads(self.layers, params, x, y, l2=self.l2)
        g = np.concatenate([gr[k].ravel() if k in gr else np.zeros(p[k].size)
                            for gr, p in zip(grads, params) for k in ("W", "b") if k in p])
        new = self.momentum * v - rate * g
        w = w + (-self.momentum * v + (1 + self.momentum) * new) if self.nesterov else w + new
        return w, new, loss


def mini_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """((round, worker, batch), features, labels) of rows that arrive in that order."""
    key, xs, ys = None, [], []
    for b in batches:
        if b.num_rows == 0:
            continue
        keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
        feats, labels = b.column(3), b.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            now = tuple(keys[lo].tolist())
            if key is not None and now != key:
                yield key, np.concatenate(xs), np.concatenate(ys)
                xs, ys = [], []
            key = now
            part = feats.slice(lo, hi - lo)
            xs.append(part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(hi - lo, -1))
            ys.append(labels[lo:hi])
    if key is not None:
        yield key, np.concatenate(xs), np.concatenate(ys)


class _Rows:
    """Output rows of ``EPOCH_SCHEMA``."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def stat(self, kind: str, round_: int, worker: int, iteration: int, n: int, score: float, millis: int) -> None:
        self.rows.append((kind, round_, worker, iteration, n, score, millis, None, None))

    def chunks(self, vec: np.ndarray, task: int, tasks: int) -> None:
        for c in range(task, -(-len(vec) // CHUNK), tasks):
            self.rows.append(("params", None, None, None, None, None, None, c, vec[c * CHUNK:(c + 1) * CHUNK]))

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int32(),
                 pa.list_(pa.float64())]
        names = [c.split()[0] for c in EPOCH_SCHEMA.split(", ")]
        columns = zip(*self.rows) if self.rows else [()] * len(kinds)
        out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
        self.rows = []
        return out


class GatherExchange:
    """Sums of the tasks' vectors by messages over the barrier."""

    def sum(self, context, tasks: int, message: np.ndarray) -> np.ndarray:
        out = []
        for lo in range(0, len(message), GATHER):
            texts = context.allGather(base64.b64encode(message[lo:lo + GATHER].tobytes()).decode())
            out.append(np.sum([np.frombuffer(base64.b64decode(t)) for t in texts], axis=0))
        return np.concatenate(out)


class FileExchange:
    """Sums of the tasks' vectors through files of a folder all tasks share.

    Of ``n`` values, ``n / GATHER`` tasks (at least one) sum a slice each. A file appears under its name when it is whole, and a
    sum once written stays as it is: if Spark runs the stage again, its tasks all take the sums that are there already and go on
    alike. A task removes its files of two sums ago: whoever has the last sum has read them."""

    def __init__(self, folder: str, patience: float = 900.0):
        self.folder, self.patience = folder, patience
        self.round, self.mine = 0, []

    def _write(self, fs, path: str, values: np.ndarray) -> None:
        with fs.open_output_stream(f"{path}.part") as f:
            f.write(values.tobytes())
        fs.move(f"{path}.part", path)

    def _read(self, fs, path: str, lo: int, hi: int) -> np.ndarray:
        began, pause = time.monotonic(), 0.001
        while True:
            try:
                with fs.open_input_file(path) as f:
                    return np.frombuffer(f.read_at((hi - lo) * 8, lo * 8))
            except FileNotFoundError:
                if time.monotonic() - began > self.patience:
                    raise TimeoutError(f"no {path} after {self.patience} s") from None
                time.sleep(pause)
                pause = min(0.05, pause * 1.5)

    def sum(self, context, tasks: int, message: np.ndarray) -> np.ndarray:
        from tessera.sources.listing import open_filesystem

        fs, base, _ = open_filesystem(self.folder)
        me, n = context.partitionId(), len(message)
        here = f"{base}/{self.round}"
        cuts = np.linspace(0, n, min(tasks, -(-n // GATHER)) + 1).astype(int).tolist()
        fs.create_dir(here, recursive=True)
        self._write(fs, f"{here}/of-{me}", message)
        if me < len(cuts) - 1:
            lo, hi = cuts[me], cuts[me + 1]
            total = np.sum([self._read(fs, f"{here}/of-{t}", lo, hi) for t in range(tasks)], axis=0)
            if fs.get_file_info(f"{here}/sum-{me}").type == pafs.FileType.NotFound:
                self._write(fs, f"{here}/sum-{me}", total)
        out = np.concatenate([self._read(fs, f"{here}/sum-{i}", 0, hi - lo) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])
        self.mine.append([f"{here}/of-{me}", *([f"{here}/sum-{me}"] if me < len(cuts) - 1 else [])])
        self.round += 1
        if len(self.mine) > 2:
            for path in self.mine.pop(0):
                fs.delete_file(path)
        return out


def exchange_for(folder: str):
    """Through files where Python can open the shared folder, else over the barrier."""
    from tessera.sources.listing import open_filesystem

    try:
        open_filesystem(folder)
    except Exception:  # noqa: BLE001 - a filesystem only the JVM knows
        return GatherExchange()
    return FileExchange(folder)


def slots(spark, wanted: int) -> int:
    """Tasks of the barrier stage: a worker each, but not more than run at once."""
    sc = spark.sparkContext
    local = re.match(r"local(?:-cluster)?\[(\d+)(?:,\s*(\d+))?", sc.master)
    cores = int(local[1]) * int(local[2] or 1) if local and sc.master.startswith("local-cluster") else \
        int(local[1]) if local else sc.defaultParallelism
    return max(1, min(wanted, cores, sc.defaultParallelism))


def barrier_ready(spark) -> bool:
    """Whether a barrier stage can be had, with a known number of slots: not under dynamic allocation, nor where a default
    parallelism of the user's hides how many tasks a cluster runs at once."""
    given = spark.conf.get("spark.default.parallelism", None) is not None
    return spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() != "true" and \
        (spark.sparkContext.master.startswith("local") or not given)


def barrier_epoch(table: DataFrame, optimiser: Optimiser, flat: np.ndarray, mom: np.ndarray, rates: list[list[float]],
                  iteration: int, n_workers: int, max_score: float | None = None, seconds_left: float | None = None,
                  with_iterations: bool = False, exchange: GatherExchange | FileExchange | None = None) -> DataFrame:
    """All rounds of one epoch over ``table`` (the layout of ``train.prepare``) as one barrier stage.

    ``rates``: learning rates of each round's batches. Rounds end early when
    the mean loss of a round is above ``max_score`` or ``seconds_left`` have
    passed (by the clock of the first task); all tasks see the same sums and
    the same flag, so all stop together. Returns rows of ``EPOCH_SCHEMA``:
    ``params`` chunks of parameters and momentum, ``round`` rows, and
    ``iteration`` rows if asked for.
    """
    spark = table.sparkSession
    tasks = slots(spark, n_workers)
    shared = spark.sparkContext.broadcast((optimiser, flat, mom, rates))
    exchange = exchange or GatherExchange()
    task = F.pmod(F.col("worker_id"), F.lit(tasks))
    dealt = table.select(*_ROW_COLUMNS, "row_order").repartitionById(tasks, task) \
        .sortWithinPartitions("round_id", "worker_id", "batch_in_round", "row_order").drop("row_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        me = context.partitionId()
        opt, w, v, by_round = shared.value
        half, began = len(w), time.monotonic()
        stream, out = mini_batches(batches), _Rows()
        ahead = next(stream, None)
        for r, rate in enumerate(by_round):
            t = time.monotonic()
            total = np.zeros(2 * half + 4)  # parameters, momentum, loss sum, rows, workers, time is up
            while ahead is not None and ahead[0][0] == r:
                worker, ww, wv, seen, b = ahead[0][1], w, v, 0, 0
                while ahead is not None and ahead[0][:2] == (r, worker):
                    at = time.monotonic()
                    _, x, y = ahead
                    ww, wv, loss = opt.step(ww, wv, x, y, rate[min(b, len(rate) - 1)])
                    if with_iterations:
                        out.stat("iteration", r, worker, iteration + r * len(rate) + b, len(y), loss,
                                 int((time.monotonic() - at) * 1000))
                    total[2 * half] += loss * len(y)
                    seen, b = seen + len(y), b + 1
                    ahead = next(stream, None)
                total[:half] += ww * seen
                total[half:2 * half] += wv * seen
                total[2 * half + 1] += seen
                total[2 * half + 2] += 1
            if me == 0 and seconds_left is not None and time.monotonic() - began > seconds_left:
                total[-1] = 1
            total = exchange.sum(context, tasks, total)
            loss_sum, n, workers, late = total[2 * half:]
            if n > 0:
                w, v = total[:half] / n, total[half:2 * half] / n
            score = loss_sum / n if n > 0 else float("nan")
            if me == 0:
                out.stat("round", r, int(workers), iteration + r * len(rate), int(n), score, int((time.monotonic() - t) * 1000))
            if len(out.rows) >= 4096:
                yield out.batch()
            if late or (max_score is not None and score > max_score):
                break
        for _ in stream:  # an epoch that ends early still takes its input to the end
            pass
        out.chunks(np.concatenate([w, v]), me, tasks)
        yield out.batch()

    return dealt.mapInArrow(run, EPOCH_SCHEMA, barrier=True)


def assembled(chunks: list) -> np.ndarray:
    """The vector of ``params`` rows (any order)."""
    return np.concatenate([np.asarray(r["values"], dtype=np.float64) for r in sorted(chunks, key=lambda r: r["chunk_id"])])
