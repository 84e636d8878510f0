"""A feed-forward network trained by data-parallel mini-batches: gradient sums per step as a Spark job, Adam at the driver.

The rows are dealt to mini-batches by a hash of their key and written partitioned by batch, so a step reads its own rows
only.  In a step every task adds up the gradient of its rows and the sums are added in two levels (tasks into
``merge`` groups, those at the driver), so the driver receives ``merge`` arrays of the model's size whatever the number
of tasks.  Layers are ReLU, the output is a sigmoid with cross-entropy, classes weigh ``n / (2 n_class)``.

A hash of the key also sets validation rows aside.  After each epoch their recall of class 1 is counted; training
ends after ``patience`` epochs without a better one, and the weights of the best epoch are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


@dataclass(frozen=True)
class NetworkParams:
    hidden: tuple[int, ...] = (64, 64, 64)
    epochs: int = 50
    batches: int = 8
    learning_rate: float = 0.002
    validation: float = 0.1
    patience: int = 5
    seed: int = 42
    merge: int = 8


Layers = list[tuple[np.ndarray, np.ndarray]]


def initial_layers(inputs: int, hidden: Sequence[int], seed: int) -> Layers:
    """Uniform weights within sqrt(6 / (in + out)) and zero biases."""
    rng = np.random.default_rng(seed)
    sizes = [inputs, *hidden, 1]
    out = []
    for a, b in zip(sizes, sizes[1:]):
        edge = np.sqrt(6 / (a + b))
        out.append((rng.uniform(-edge, edge, (a, b)), np.zeros(b)))
    return out


def forward(layers: Layers, x: np.ndarray) -> list[np.ndarray]:
    """Activations of every layer, the last being the probability of class 1."""
    out = [x]
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(np.maximum(z, 0) if i < len(layers) - 1 else 1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return out


def loss_and_gradient(layers: Layers, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, Layers]:
    """Sums over the rows of the weighted cross-entropy and of its gradient."""
    acts = forward(layers, x)
    p = np.clip(acts[-1][:, 0], 1e-12, 1 - 1e-12)
    loss = float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())
    delta = (weight * (acts[-1][:, 0] - y))[:, None]
    grads: Layers = []
    for i in range(len(layers) - 1, -1, -1):
        grads.append((acts[i].T @ delta, delta.sum(0)))
        if i:
            delta = (delta @ layers[i][0].T) * (acts[i] > 0)
    return loss, grads[::-1]


def flat(layers: Layers) -> np.ndarray:
    return np.concatenate([a.ravel() for pair in layers for a in pair])


def shaped(values: np.ndarray, like: Layers) -> Layers:
    out, at = [], 0
    for w, b in like:
        out.append((values[at : at + w.size].reshape(w.shape), values[at + w.size : at + w.size + b.size]))
        at += w.size + b.size
    return out


class Adam:
    def __init__(self, size: int, rate: float, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-7):
        self.rate, self.beta1, self.beta2, self.eps = rate, beta1, beta2, eps
        self.m, self.v, self.t = np.zeros(size), np.zeros(size), 0

    def step(self, values: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = self.beta1 * self.m + (1 - self.beta1) * gradient
        self.v = self.beta2 * self.v + (1 - self.beta2) * gradient**2
        rate = self.rate * np.sqrt(1 - self.beta2**self.t) / (1 - self.beta1**self.t)
        return values - rate * self.m / (np.sqrt(self.v) + self.eps)


def _rows(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
    return x, batch.column(1).to_numpy().astype(np.float64), batch.column(2).to_numpy()


def gradient_sums(rows: DataFrame, layers: Layers, merge: int) -> tuple[np.ndarray, float, float]:
    """(gradient, loss, weight) summed over ``rows`` (x, y, weight)."""
    features, size = layers[0][0].shape[0], flat(layers).size

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, loss, weight = np.zeros(size), 0.0, 0.0
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                x, y, w = _rows(batch.slice(start, 4096), features)
                part, grads = loss_and_gradient(layers, x, y, w)
                total, loss, weight = total + flat(grads), loss + part, weight + float(w.sum())
        columns = [pa.array([TaskContext.get().partitionId() % merge], pa.int32()), pa.array([total.tobytes()]), pa.array([loss]), pa.array([weight])]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "gradient", "loss", "weight"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, weight = np.zeros(size), 0.0, 0.0
        for batch in batches:
            total = total + sum(np.frombuffer(g, np.float64) for g in batch.column(1).to_pylist())
            loss, weight = loss + sum(batch.column(2).to_pylist()), weight + sum(batch.column(3).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([loss]), pa.array([weight])], names=["gradient", "loss", "weight"])

    sums = rows.mapInArrow(add_up, "part int, gradient binary, loss double, weight double")
    found = sums.repartition(merge, "part").mapInArrow(merged, "gradient binary, loss double, weight double").collect()  # ``merge`` rows
    return sum(np.frombuffer(r["gradient"], np.float64) for r in found), sum(r["loss"] for r in found), sum(r["weight"] for r in found)


@dataclass
class Network:
    layers: Layers
    #: (training loss, validation recall) of each epoch, and the epoch whose weights were kept.
    history: list[tuple[float, float]] = field(default_factory=list)
    best_epoch: int = 0

    def predict(self, df: DataFrame, features: str, score: str = "score", pred: str = "pred") -> DataFrame:
        """``df`` with the probability of class 1 and the class at one half; ``features`` is an array of doubles."""
        from pyspark.sql.functions import pandas_udf

        layers, width = self.layers, self.layers[0][0].shape[0]

        @pandas_udf("double")
        def probability(x):
            import pandas as pd

            if not len(x):
                return pd.Series([], dtype="float64")
            return pd.Series(forward(layers, np.stack(x.to_numpy()).reshape(-1, width))[-1][:, 0])

        return df.withColumn(score, probability(F.col(features))).withColumn(pred, (F.col(score) > 0.5).cast("int"))


def _recall(rows: DataFrame, network: Network) -> float:
    row = network.predict(rows.where("y = 1"), "x").agg(F.avg("pred").alias("recall")).first()
    return row["recall"] or 0.0


def fit_network(df: DataFrame, features: str, label: str = "TARGET", key: str = "SK_ID_CURR", params: NetworkParams = NetworkParams()) -> Network:
    """Train on the rows of ``df``: ``features`` an array of doubles without nulls, ``label`` 0 or 1; rows without a label are left out."""
    number = F.pmod(F.xxhash64(F.col(key), F.lit(params.seed)), F.lit(1_000_000))
    rows = df.where(F.col(label).isNotNull()).select(F.col(features).alias("x"), F.col(label).cast("int").alias("y"), number.alias("_n"))
    held = F.col("_n") < int(params.validation * 1_000_000)
    batch = F.when(held, -1).otherwise(F.pmod(F.col("_n"), F.lit(params.batches))).cast("int")
    import uuid

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/network-{uuid.uuid4().hex}"
    rows.select("x", "y", batch.alias("batch")).write.partitionBy("batch").parquet(path)
    table = df.sparkSession.read.schema("x array<double>, y int, batch int").parquet(path)
    counts = {r["y"]: r["count"] for r in table.where("batch >= 0").groupBy("y").count().collect()}  # one row per class
    if set(counts) != {0, 1}:
        raise ValueError("the network needs rows of both classes")
    n = sum(counts.values())
    weight = F.when(F.col("y") == 1, n / (2 * counts[1])).otherwise(n / (2 * counts[0]))
    train = table.where("batch >= 0").select("x", "y", weight.alias("weight"), "batch")
    width = len(table.select("x").first()["x"])
    layers = initial_layers(width, params.hidden, params.seed)
    values, adam = flat(layers), Adam(flat(layers).size, params.learning_rate)
    best, history, kept = -1.0, [], (values, 0)
    validation = table.where("batch = -1")
    for epoch in range(params.epochs):
        loss = total = 0.0
        for k in range(params.batches):
            # A different order of the batches each epoch.
            now = (k * 5 + epoch) % params.batches if params.batches % 5 else (k + epoch) % params.batches
            gradient, part, w = gradient_sums(train.where(F.col("batch") == now).drop("batch"), shaped(values, layers), params.merge)
            if w:
                values = adam.step(values, gradient / w)
            loss, total = loss + part, total + w
        recall = _recall(validation, Network(shaped(values, layers)))
        history.append((loss / total, recall))
        if recall > best:
            best, kept = recall, (values, epoch)
        elif epoch - kept[1] >= params.patience:
            break
    return Network(shaped(kept[0], layers), history, kept[1])
