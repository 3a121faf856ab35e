"""Synchronous data-parallel training: all tasks of a barrier stage take one step together.

Each pass deals the rows anew to ``workers`` tasks. A step's mini-batch is made of one
part from each task; tasks exchange gradients by an all-gather, add them in the order of
the tasks and take the same Adam step, so there is one set of weights as if one task had
seen the whole mini-batch part by part. Batch norm uses the moments of a part; running
moments are those of the whole mini-batch. A part of more than ``BLOCK`` rows is held
on the task's own disk and taken through the network layer by layer, block by block.
"""

from __future__ import annotations

import base64
import copy
import os
import tempfile
from collections.abc import Callable, Iterator
from contextlib import ExitStack, closing

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.plans import ledger as turns
from farelane.plans.dense import _EPS, DenseModel, DenseSpec, EarlyStop, _join, _matrix, _mini_batches, _split, _step, initial_weights, losses
from farelane.schema import FEATURE_COLUMNS, TARGET_COLUMN
from farelane.staging import staged

#: Places of gamma, beta, weights and bias in a layer; the running moments lie between.
_TRAINED, _MOMENTS = (0, 1, 4, 5), (2, 3)

#: Rows that a task takes through the network at once.
BLOCK = 8_192


class Adam:
    """Adam with bias correction over one flat vector of parameters; its moments outlive a pass."""

    def __init__(self, size: int, rate: float, m: np.ndarray | None = None, v: np.ndarray | None = None, t: int = 0):
        self.rate, self.t = rate, t
        self.m = np.zeros(size) if m is None else m.copy()
        self.v = np.zeros(size) if v is None else v.copy()

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-7)


def _places(spec: DenseSpec) -> tuple[np.ndarray, np.ndarray]:
    """Flat places of the trained parameters, and of the running moments."""
    kinds = np.concatenate([np.full(int(np.prod(s)), k % 6) for k, s in enumerate(spec.shapes())])
    return np.flatnonzero(np.isin(kinds, _TRAINED)), np.flatnonzero(np.isin(kinds, _MOMENTS))


def part_message(spec: DenseSpec, flat: np.ndarray, x: np.ndarray, y: np.ndarray, seed: int) -> np.ndarray:
    """What a task tells the others about its part: rows, squared error, moments of every norm, and summed gradients.

    Zeros for a part without rows.
    """
    trained, moments = _places(spec)
    if not len(y):
        return np.zeros(2 + len(moments) + len(trained))
    layers = _split(spec, flat.astype(np.float32))
    for layer in layers:
        for k in _MOMENTS:
            layer[k][:] = 0.0
    squared, grads = _step(spec, layers, x, y, np.random.default_rng(seed), 0.0)  # keep nothing: the moments are the part's
    return _message(spec, layers, len(y), squared, grads)


def _message(spec: DenseSpec, layers, rows: int, squared: float, grads) -> np.ndarray:
    trained, moments = _places(spec)
    full = _join([[gs[0], gs[1], *layer[2:4], gs[2], gs[3]] for layer, gs in zip(layers, grads)]).astype(np.float64)
    return np.concatenate([[rows, squared], full[moments] * rows, full[trained] * rows])


class Spool:
    """Rows of single-precision numbers in blocks on the task's own disk, and their moments; gone once it is closed."""

    def __init__(self, width: int):
        self.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        self.width, self.sizes, self.rows = width, [], 0
        self.mean, self._squares = np.zeros(width), np.zeros(width)

    def add(self, table: np.ndarray) -> None:
        for at in range(0, len(table), BLOCK):
            block = np.ascontiguousarray(table[at : at + BLOCK], np.float32)
            self.file.write(block.data)
            n, mean = len(block), block.mean(0, dtype=np.float64)
            off, total = mean - self.mean, self.rows + n
            self._squares += ((block - mean) ** 2).sum(0) + off * off * (self.rows * n / total)
            self.mean += off * (n / total)
            self.rows = total
            self.sizes.append(n)

    @property
    def var(self) -> np.ndarray:
        return self._squares / self.rows

    def __iter__(self) -> Iterator[np.ndarray]:
        """The blocks in the order in which they came; one reader at a time."""
        self.file.seek(0)
        for n in self.sizes:
            yield np.frombuffer(self.file.read(4 * n * self.width), np.float32).reshape(n, self.width)

    def close(self) -> None:
        self.file.close()


def spooled_message(spec: DenseSpec, flat: np.ndarray, part: Spool, seed: int) -> np.ndarray:
    """:func:`part_message` of a part on disk; its last column is the target.

    A layer needs the moments of all rows before it can pass one on, and on the way back the sums
    of all rows' gradients. So the rows go forward once per layer, which leaves its inputs on disk,
    and once per layer back. Dropout draws the numbers that it draws for the part in one piece.
    """
    layers, rng, last = _split(spec, flat.astype(np.float32)), np.random.default_rng(seed), len(spec.hidden)
    scales, draws, rows, squared = [], [], part.rows, 0.0

    def through(i: int, x: np.ndarray, rng: np.random.Generator):
        """(normed, mask, output of the norm) of a block at layer ``i``."""
        gamma, beta, mean = layers[i][:3]
        unit = (x - mean) * scales[i]
        z = unit * gamma + beta
        mask = (rng.random(z.shape, dtype=np.float32) >= spec.dropout).astype(z.dtype) / (1 - spec.dropout) if i and spec.dropout else 1.0
        return unit, mask, z * mask

    with ExitStack() as stack:
        inputs = [part, *(stack.enter_context(closing(Spool(n))) for n in spec.hidden)]
        for i in range(last + 1):
            width = len(layers[i][0])
            layers[i][2][:], layers[i][3][:] = inputs[i].mean[:width], inputs[i].var[:width]
            scales.append(1.0 / np.sqrt(layers[i][3] + _EPS))
            draws.append(copy.deepcopy(rng))
            if i < last:
                for x in inputs[i]:
                    inputs[i + 1].add(np.maximum(through(i, x[:, :width], rng)[2] @ layers[i][4] + layers[i][5], 0.0))
        grads: list = [None] * (last + 1)
        for i in range(last, -1, -1):
            sums = [np.zeros(p.shape) for p in (layers[i][0], layers[i][1], layers[i][4], layers[i][5])]
            own = [copy.deepcopy(d) for d in draws]
            for first, *tables in zip(part, *inputs[max(i, 1) :]):
                blocks = dict(zip(range(max(i, 1), last + 1), tables)) | ({} if i else {0: first[:, :-1]})
                passed = {k: through(k, blocks[k], own[k]) for k in range(i, last + 1)}
                error = (passed[last][2] @ layers[last][4] + layers[last][5])[:, 0] - first[:, -1]
                grad = (2.0 / rows) * error[:, None]
                for k in range(last, i, -1):  # the layers behind this one, whose sums are known
                    unit, mask, _ = passed[k]
                    gu = (grad @ layers[k][4].T) * mask * layers[k][0]
                    ggamma, gbeta = grads[k][0] * layers[k][0] / rows, grads[k][1] * layers[k][0] / rows
                    grad = scales[k] * (gu - gbeta - unit * ggamma) * (blocks[k] > 0)
                unit, mask, z = passed[i]
                gz = (grad @ layers[i][4].T) * mask
                for total, more in zip(sums, ((gz * unit).sum(0), gz.sum(0), z.T @ grad, grad.sum(0))):
                    total += more
                squared += float(error @ error) if i == last else 0.0
            if i < spec.penalised:
                sums[2] += 2 * spec.l2 * layers[i][4] + spec.l1 * np.sign(layers[i][4])
            grads[i] = [g.astype(np.float32) for g in sums]
    return _message(spec, layers, rows, squared, grads)


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Spool]:
    """Cut Arrow batches into parts of ``size`` rows on disk; a part is closed when the next one is asked for."""
    part = None
    for batch in batches:
        table = _matrix(batch)
        while len(table):
            part = part or Spool(table.shape[1])
            take = size - part.rows
            part.add(table[:take])
            table = table[take:]
            if part.rows == size:
                with closing(part):
                    yield part
                part = None
    if part:
        with closing(part):
            yield part


def combined(spec: DenseSpec, flat: np.ndarray, parts: list[np.ndarray], adam: Adam, keep: float) -> tuple[np.ndarray, float, float]:
    """(weights, rows, squared error) after one step from the messages of all parts, in their order."""
    trained, moments = _places(spec)
    total = np.zeros_like(parts[0])
    for p in parts:
        total += p
    rows = total[0]
    flat = flat.copy()
    flat[moments] += (total[2 : 2 + len(moments)] / rows - flat[moments]) * (1 - keep)
    flat[trained] -= adam.step(total[2 + len(moments) :] / rows)
    return flat, rows, total[1]


def _keep(t: int) -> float:
    """How much of the running moments a step keeps: little at first, 0.99 in the end."""
    return min(0.99, (1 + t) / (10 + t))


def one_pass(
    spec: DenseSpec, flat: np.ndarray, adam: Adam, batches: Iterator[tuple[np.ndarray, np.ndarray] | Spool], part: int, seed: int,
    gather: Callable[[np.ndarray], list[np.ndarray]],
) -> tuple[np.ndarray, float, float]:
    """One task's side of a pass: it steps with the others until no task has rows left."""
    rows = squared = 0.0
    none = np.zeros((0, spec.inputs), np.float32), np.zeros(0, np.float32)
    while True:
        own, draw = next(batches, none), hash((seed, adam.t, part)) & 0xFFFFFFFF
        parts = gather(spooled_message(spec, flat, own, draw) if isinstance(own, Spool) else part_message(spec, flat, *own, draw))
        if not any(p[0] for p in parts):
            return flat, rows, squared
        flat, n, loss = combined(spec, flat, parts, adam, _keep(adam.t))
        rows, squared = rows + n, squared + loss


def dealt(table: DataFrame, columns: list[str], workers: int, seed: int) -> DataFrame:
    """The rows in ``workers`` even parts, in an order that only the seed changes."""
    return table.select(*columns).repartition(workers).sortWithinPartitions(F.xxhash64(F.lit(seed), *columns))


def _run_pass(table: DataFrame, columns: list[str], spec: DenseSpec, flat: np.ndarray, adam: Adam, workers: int, seed: int):
    sc = table.sparkSession.sparkContext
    shared = sc.broadcast((flat, adam))
    size = max(1, spec.batch_size // workers)
    cut = _mini_batches if size <= BLOCK else _parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        own = context.partitionId()
        start, rule = shared.value
        rule = Adam(len(rule.m), rule.rate, rule.m, rule.v, rule.t)

        def gather(message: np.ndarray) -> list[np.ndarray]:
            told = context.allGather(base64.b64encode(message.tobytes()).decode())
            return [np.frombuffer(base64.b64decode(m)) for m in told]

        out, rows, squared = one_pass(spec, start, rule, cut(batches, size), own, seed, gather)
        if own == 0:
            yield pa.RecordBatch.from_pydict({"rows": [rows], "squared": [squared], "t": [rule.t], "w": [out], "m": [rule.m], "v": [rule.v]})

    made = dealt(table, columns, workers, seed)
    found = made.mapInArrow(run, "rows double, squared double, t long, w array<double>, m array<double>, v array<double>", barrier=True).collect()
    shared.unpersist()
    row = found[0]  # a barrier runs all its tasks; the first one answers
    if not row["rows"]:
        raise ValueError("no rows to train on")
    return np.array(row["w"]), Adam(len(row["m"]), spec.learning_rate, np.array(row["m"]), np.array(row["v"]), row["t"]), row["squared"] / row["rows"]


def fit_sync(
    train: DataFrame,
    valid: DataFrame | None = None,
    warm: DenseModel | None = None,
    spec: DenseSpec | None = None,
    epochs: int = 100,
    patience: int = 2,
    workers: int | None = None,
    seed: int = 7,
    ledger: str | None = None,
    target: str = TARGET_COLUMN,
) -> DenseModel:
    """Train on processed rows with one Adam step per mini-batch of ``spec.batch_size`` rows, whatever the number of tasks.

    ``workers`` tasks run at once (by default half of the slots), each with an even part of the rows and of each
    mini-batch; a lost one makes Spark run the pass again from its weights. With
    ``ledger``, a folder, every pass leaves weights, Adam's moments and the patience there,
    and a call with the same arguments goes on after the last whole pass. Otherwise as
    :func:`farelane.plans.dense.fit_dense`.
    """
    spark = train.sparkSession
    features = warm.features if warm else tuple(FEATURE_COLUMNS if not spec or spec.inputs == len(FEATURE_COLUMNS) else [c for c in train.columns if c != target])
    spec = warm.spec if warm else spec or DenseSpec(inputs=len(features))
    columns = [*features, target]
    workers = workers or max(1, spark.sparkContext.defaultParallelism // 2)
    trained, _ = _places(spec)
    stop, history, start, best = EarlyStop(patience), [], 0, None
    with ExitStack() as stack:
        table = stack.enter_context(staged(train.select(*columns), "train"))
        checks = stack.enter_context(staged(valid.select(*columns), "valid")) if valid is not None else None
        held = turns.last(spark, ledger) if ledger else None
        if held:
            turn, state, arrays = held
            flat, adam, start = arrays["w"], Adam(len(trained), spec.learning_rate, arrays["m"], arrays["v"], state["t"]), turn + 1
            best, history = arrays["best"], state["history"]
            stop.best, stop.waited = state["best_loss"], state["waited"]
        else:
            flat = warm.weights if warm else initial_weights(table, columns, spec, seed)
            adam = Adam(len(trained), spec.learning_rate)
        for epoch in range(start, epochs):
            if stop.over:
                break
            flat, adam, loss = _run_pass(table, columns, spec, flat, adam, workers, seed + epoch)
            entry = {"epoch": epoch, "train_loss": loss}
            history.append(entry)
            if checks is not None:
                entry["val_loss"], entry["val_mae"] = losses(checks, DenseModel(spec, flat, features), target)
                best = flat if stop.improved(entry["val_loss"]) else best
            else:
                best = flat
            if ledger and best is not None:
                state = {"t": adam.t, "history": history, "best_loss": stop.best, "waited": stop.waited}
                turns.record(spark, ledger, epoch, state, {"w": flat, "m": adam.m, "v": adam.v, "best": best})
    if best is None:
        raise ValueError("no round of training, or no finite validation loss")
    return DenseModel(spec, best, features, history)
