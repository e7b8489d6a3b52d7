"""A small reconstruction network trained on the executors in synchronous steps.

The network is d-12-8-k-8-12-d with rectifiers inside and linear code and output.  A hash deals
the training rows into a fixed number of steps an epoch.  In a step the executors add up the
gradients of its rows and the driver makes one Adam step with their mean; rows never leave the
executors, and the driver holds the few hundred numbers of the state.

Each row's gradient is computed without regard to its neighbours and rounded to a fixed point
before it is added, so the sums, and with them the weights, do not depend on how rows are dealt
over files, partitions and tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path

# Workers need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# The rate suits steps of a quarter of the rows; small batches would take a smaller one.
RATE, DECAY, EPOCHS, PATIENCE = 1e-2, 1e-5, 50, 10
STEPS = 4
BETA1, BETA2, TINY = 0.9, 0.999, 1e-8

# Sums are whole multiples of 2^-32.  Parts of a row's gradient and its loss are cut at 2^20, so
# the sum of CHUNK rows stays within 64 bits; sums of chunks are added without a limit.
UNIT, LARGEST, CHUNK = float(1 << 32), float(1 << 20), 512


def layer_sizes(d: int, code: int = 4) -> list[int]:
    return [d, 12, 8, code, 8, 12, d]


def linear_layers(sizes: list[int]) -> set[int]:
    """Layers without rectifier: the code and the output."""
    return {len(sizes) // 2 - 1, len(sizes) - 2}


def start_weights(sizes: list[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes, sizes[1:]):
        bound = 1 / np.sqrt(a)
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def unpack(w: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((w[at : at + a * b].reshape(a, b), w[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def _times(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """x @ m, one term after the other, so that a row's result is the same in any batch."""
    out = np.zeros((len(x), m.shape[1]))
    for k in range(m.shape[0]):
        out += x[:, k, None] * m[k]
    return out


def forward(w: np.ndarray, x: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Input and the output of every layer."""
    seen, linear = [x], linear_layers(sizes)
    for i, (m, b) in enumerate(unpack(w, sizes)):
        y = _times(seen[-1], m) + b
        seen.append(y if i in linear else np.maximum(y, 0))
    return seen


def row_gradients(w: np.ndarray, x: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each row the gradient and the value of its mean squared reconstruction error."""
    seen, linear = forward(w, x, sizes), linear_layers(sizes)
    miss = seen[-1] - x
    back = 2 * miss / miss.shape[1]
    parts: list[np.ndarray] = []
    for i, (m, _) in reversed(list(enumerate(unpack(w, sizes)))):
        if i not in linear:
            back = back * (seen[i + 1] > 0)
        parts[:0] = [(seen[i][:, :, None] * back[:, None, :]).reshape(len(x), -1), back]
        back = _times(back, m.T)
    return np.concatenate(parts, axis=1), _row_losses(miss)


def gradient(w: np.ndarray, x: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, float]:
    """Gradient and value of the mean squared reconstruction error of all rows."""
    g, losses = row_gradients(w, x, sizes)
    return g.mean(axis=0), float(losses.mean())


def _row_losses(miss: np.ndarray) -> np.ndarray:
    return _times(miss**2, np.full((miss.shape[1], 1), 1 / miss.shape[1]))[:, 0]


def _fixed_sum(values: np.ndarray) -> np.ndarray:
    """Sum over the rows in whole units, as Python integers."""
    cut = np.clip(np.nan_to_num(values, nan=0.0), -LARGEST, LARGEST)
    return np.rint(cut * UNIT).astype(np.int64).sum(axis=0).astype(object)


def _step(w: np.ndarray, sizes: list[int]):
    """Sums over the rows of a task: gradient, loss and number of the training rows, loss and
    number of the validation rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) + 4, object)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, sizes[0])
            judged = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for rows, learn in ((x[~judged], True), (x[judged], False)):
                for at in range(0, len(rows), CHUNK):
                    part = rows[at : at + CHUNK]
                    if learn:
                        g, losses = row_gradients(w, part, sizes)
                        total[: len(w)] += _fixed_sum(g)
                    else:
                        losses = _row_losses(forward(w, part, sizes)[-1] - part)
                    place = len(w) + (0 if learn else 2)
                    total[place] += _fixed_sum(losses)
                    total[place + 1] += len(part)
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total]], pa.list_(pa.string()))], names=["sums"])

    return run


@dataclass
class Reconstruction:
    sizes: list[int]
    weights: np.ndarray
    history: list[tuple[int, float, float]] = field(default_factory=list)

    def history_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.history, "epoch int, train_loss double, val_loss double"
        )

    def reconstruct(self, df: DataFrame, x: str, out: str) -> DataFrame:
        """Add the reconstruction of an array column, in Arrow batches."""
        w, sizes = self.weights, self.sizes

        @F.pandas_udf("array<double>")
        def rebuilt(column: pd.Series) -> pd.Series:
            if column.empty:
                return pd.Series([], dtype=object)
            values = np.stack(column.to_numpy()).astype(np.float64)
            return pd.Series(list(forward(w, values, sizes)[-1]))

        return df.withColumn(out, rebuilt(F.col(x)))


def _dealt(df: DataFrame, steps: int) -> DataFrame:
    """The rows with the step that their hash names, written so that a step reads its own only.
    Validation rows are judged in the first step."""
    step = F.when(F.col("v"), 0).otherwise(F.pmod(F.xxhash64("x"), F.lit(steps)).cast("int"))
    dealt = df.where(F.col("x").isNotNull()).withColumn("step", step)
    path = fresh_path(df.sparkSession, "steps")
    dealt.write.partitionBy("step").parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def _summed(rows: DataFrame, w: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, float, int, float, int]:
    """Gradient sum, loss sum and number of training rows, loss sum and number of validation rows."""
    passed = rows.select("x", "v").mapInArrow(_step(w, sizes), "sums array<string>")
    added = passed.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    total = {r["i"]: int(r["s"]) for r in added.collect()}  # as many numbers as the state has
    values = [total.get(i, 0) for i in range(len(w) + 4)]
    *g, loss, n, loss_val, n_val = values
    return np.array([v / UNIT for v in g]), loss / UNIT, n, loss_val / UNIT, n_val


def train_network(
    df: DataFrame,
    x: str,
    is_val: str,
    code: int = 4,
    epochs: int = EPOCHS,
    patience: int = PATIENCE,
    seed: int = 42,
    keep_best: bool = False,
    steps: int = STEPS,
    rate: float = RATE,
) -> Reconstruction:
    """Train on the rows of `df` whose flag is false and watch the loss of the others.

    Every epoch makes `steps` Adam steps, each with the mean gradient of the rows that a hash of
    their values deals to it: one job a step, however many rows there are.  As a rule the weights
    of the last epoch are kept; `keep_best` keeps those with the least validation loss.
    """
    data = _dealt(df.select(F.col(x).cast("array<double>").alias("x"), F.coalesce(F.col(is_val), F.lit(False)).alias("v")), steps)
    first = data.select(F.size("x")).first()
    sizes = layer_sizes(first[0] if first else 1, code)
    w = start_weights(sizes, seed)
    m, v, t = np.zeros(len(w)), np.zeros(len(w)), 0
    model, best, waited = Reconstruction(sizes, w), float("inf"), 0
    train_loss = float("nan")
    for epoch in range(1, epochs + 2):
        loss, n = 0.0, 0
        for step in range(steps):
            rows = data.where(F.col("step") == step)
            # The pass after the last epoch only judges.
            g, step_loss, step_n, loss_val, n_val = _summed(rows if epoch <= epochs else rows.where("v"), w, sizes)
            if step == 0 and epoch > 1:
                val_loss = loss_val / n_val if n_val else float("nan")
                model.history.append((epoch - 1, train_loss, val_loss))
                improved = val_loss < best
                if improved or not keep_best:
                    model.weights = w
                best, waited = (val_loss, 0) if improved else (best, waited + 1)
                if waited >= patience or epoch > epochs:
                    return model
            if step_n:
                g = g / step_n + DECAY * w
                t += 1
                m = BETA1 * m + (1 - BETA1) * g
                v = BETA2 * v + (1 - BETA2) * g * g
                w = w - rate * (m / (1 - BETA1**t)) / (np.sqrt(v / (1 - BETA2**t)) + TINY)
                loss, n = loss + step_loss, n + step_n
        train_loss = loss / n if n else float("nan")
    return model


def best_epoch(history: DataFrame) -> DataFrame:
    """Epochs run, best epoch and final losses."""
    return history.agg(
        F.count("*").alias("epochs_run"),
        F.min_by("epoch", "val_loss").alias("best_val_epoch"),
        F.min("val_loss").alias("best_val_loss"),
        F.max_by("train_loss", "epoch").alias("final_train_loss"),
        F.max_by("val_loss", "epoch").alias("final_val_loss"),
    )
