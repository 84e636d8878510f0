"""Linear hinge-loss classifier by partition-parallel averaged stochastic gradient descent.

Objective: mean over the rows of ``max(0, 1 - y (w x + b))`` plus ``alpha`` times the penalty, which is
``l1_ratio |w| + (1 - l1_ratio) / 2 |w|^2`` (0: ridge, 1: lasso, between: elastic net); y is -1 or 1.

In a round every task runs one pass of stochastic steps over its rows from the common weights; the mean of all tasks'
iterates is the weights of the next round.  Steps shrink with the root of the round; the one-norm is applied by a soft
threshold after each step.  After a round the objective is counted for its weights and for the mean of the later half of
all rounds; the best so far is the model, and ``patience`` rounds that hardly better it end the training.  Sums over tasks
are added in two levels, so the driver receives ``merge`` rows of the models' size a round.

The objective of a round is counted in the pass of the next one, and several models of the same rows (the points of a grid)
take their passes together, so a round is one Spark job however many models there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table


@dataclass(frozen=True)
class HingeParams:
    alpha: float = 1e-4
    l1_ratio: float = 0.0
    rounds: int = 60
    tolerance: float = 1e-5
    patience: int = 12
    batch: int = 32
    seed: int = 42
    merge: int = 8


def penalty(w: np.ndarray, alpha: float, l1_ratio: float) -> float:
    return alpha * (l1_ratio * float(np.abs(w).sum()) + (1 - l1_ratio) / 2 * float(w @ w))


def local_pass(w: np.ndarray, b: float, x: np.ndarray, y: np.ndarray, rate: float, params: HingeParams) -> tuple[np.ndarray, float, np.ndarray, float]:
    """One pass over the rows in steps of ``batch`` rows of size ``rate``: the last iterate, and the sum of the iterates by rows."""
    total_w, total_b = np.zeros_like(w), 0.0
    for start in range(0, len(x), params.batch):
        xs, ys = x[start : start + params.batch], y[start : start + params.batch]
        open_ = ys * (xs @ w + b) < 1
        w = w * max(0.0, 1 - rate * params.alpha * (1 - params.l1_ratio)) + rate * (ys[open_, None] * xs[open_]).sum(0) / len(xs)
        if params.l1_ratio:
            w = np.sign(w) * np.maximum(np.abs(w) - rate * params.alpha * params.l1_ratio, 0)
        b = b + rate * float(ys[open_].sum()) / len(xs)
        total_w, total_b = total_w + len(xs) * w, total_b + len(xs) * b
    return w, b, total_w, total_b


@dataclass
class HingeModel:
    weights: np.ndarray
    bias: float
    objective: float

    def predict(self, df: DataFrame, features: str, score: str = "score", pred: str = "pred") -> DataFrame:
        """``df`` with the margin and the class by its sign; ``features`` is an array of doubles."""
        pairs = F.zip_with(F.col(features), F.array(*[F.lit(float(v)) for v in self.weights]), lambda a, c: a * c)
        margin = F.aggregate(pairs, F.lit(float(self.bias)), lambda s, v: s + v)
        return df.withColumn(score, margin).withColumn(pred, (F.col(score) > 0).cast("int"))


def _matrix(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
    return x, batch.column(1).to_numpy().astype(np.float64)


def _summed(parts: DataFrame, names: list[str], merge: int) -> list[np.ndarray]:
    """Binary arrays of the rows (part, names...) added up, in two levels."""
    schema = ", ".join(f"{n} binary" for n in names)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list = [None] * len(names)
        for batch in batches:
            for i in range(len(names)):
                for raw in batch.column(i + 1).to_pylist():
                    a = np.frombuffer(raw, np.float64)
                    sums[i] = a if sums[i] is None else sums[i] + a
        if sums[0] is not None:
            yield pa.RecordBatch.from_arrays([pa.array([s.tobytes()]) for s in sums], names=names)

    rows = parts.repartition(merge, "part").mapInArrow(merged, schema).collect()  # ``merge`` rows
    return [sum(np.frombuffer(r[n], np.float64) for r in rows) for n in names]


@dataclass
class _Course:
    """One model in training."""

    params: HingeParams
    now: tuple[np.ndarray, float]
    candidates: list[tuple[np.ndarray, float]]
    rounds: list[tuple[np.ndarray, float]]
    best: float = np.inf
    best_at: tuple[np.ndarray, float] | None = None
    since: int = 0
    ended: bool = False

    def judge(self, sums: np.ndarray, n: float) -> None:
        """Take the objectives of the candidates; too many rounds that hardly better the best end the training."""
        p = self.params
        values = [float(s / n) + penalty(c[0], p.alpha, p.l1_ratio) for s, c in zip(sums, self.candidates)]
        if self.rounds:
            self.since = 0 if self.best - min(values) > p.tolerance * abs(self.best) else self.since + 1
        if self.best_at is None or min(values) < self.best:
            self.best, self.best_at = min(values), self.candidates[values.index(min(values))]
        self.ended = self.since >= p.patience or len(self.rounds) >= p.rounds

    def advance(self, sums: np.ndarray, n: float) -> None:
        """Take the mean of the tasks' iterates; it and the mean of the later rounds are the next candidates."""
        self.now = (sums[:-1] / n, float(sums[-1] / n))
        self.rounds.append(self.now)
        half = self.rounds[len(self.rounds) // 2 :]
        self.candidates = [self.now, (np.mean([r[0] for r in half], axis=0), float(np.mean([r[1] for r in half])))]


def _round(rows: DataFrame, courses: list[_Course], number: int, rate: float, size: int) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """One pass over ``rows`` (x, y): the objective sums of each model's candidates, its sums of iterates, and the rows."""
    seed, merge = courses[0].params.seed, courses[0].params.merge
    models = [(c.params, *c.now, np.column_stack([w for w, _ in c.candidates]), np.array([b for _, b in c.candidates]), len(c.rounds) < c.params.rounds) for c in courses]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        own, n = [(w, b) for _, w, b, *_ in models], 0
        counted, total = [np.zeros(len(m[4])) for m in models], [np.zeros(size + 1) for _ in models]
        rng = np.random.default_rng([seed, number, task])
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch, size)
                for i, (_, _, _, ws, bs, _) in enumerate(models):
                    counted[i] += np.maximum(0, 1 - y[:, None] * (x @ ws + bs)).sum(0)
                order = rng.permutation(len(x))
                x, y = x[order], y[order]
                for i, (params, _, _, _, _, goes_on) in enumerate(models):
                    if goes_on:
                        w, b, sum_w, sum_b = local_pass(*own[i], x, y, rate, params)
                        own[i], total[i] = (w, b), total[i] + np.append(sum_w, sum_b)
                n += len(x)
        sums = np.concatenate([*counted, *total, [n]])
        yield pa.RecordBatch.from_arrays([pa.array([task % merge], pa.int32()), pa.array([sums.tobytes()])], names=["part", "sums"])

    sums = _summed(rows.mapInArrow(run, "part int, sums binary"), ["sums"], merge)[0]
    widths = [len(c.candidates) for c in courses] + [size + 1] * len(courses)
    parts = np.split(sums[:-1], np.cumsum(widths)[:-1])
    return parts[: len(courses)], parts[len(courses) :], float(sums[-1])


def fit_hinges(df: DataFrame, features: str, label: str, key: str, points: Sequence[HingeParams]) -> list[HingeModel]:
    """A model for each of ``points``, which share ``seed`` and ``merge``, trained on the rows of ``df``: ``features`` an array of
    doubles without nulls, ``label`` 0 or 1; rows without a label are left out."""
    if len({(p.seed, p.merge) for p in points}) > 1:
        raise ValueError("models that are trained together need one seed and one merge")
    y = F.when(F.col(label) == 1, 1).otherwise(-1)
    order = F.xxhash64(F.col(key), F.lit(points[0].seed))
    known = df.where(F.col(label).isNotNull()).select(F.col(features).alias("x"), y.alias("y"), order.alias("_o"))
    # Random order within the tasks: each pass meets the classes mixed.
    rows = scratch_table(known.sortWithinPartitions("_o").select("x", "y"), "hinge-rows")
    first = rows.select("x").first()
    if first is None:
        raise ValueError("no rows to train on")
    size = len(first["x"])
    square = rows.agg(F.avg(F.aggregate("x", F.lit(0.0), lambda t, v: t + v * v))).first()[0]
    first_rate = 4.0 / (1.0 + square)
    start = (np.zeros(size), 0.0)
    courses = [_Course(p, start, [start], []) for p in points]
    number = 0
    while open_ := [c for c in courses if not c.ended]:
        counted, total, n = _round(rows, open_, number, first_rate / (1 + number) ** 0.5, size)
        for c, values, sums in zip(open_, counted, total):
            c.judge(values, n)
            if not c.ended:
                c.advance(sums, n)
        number += 1
    return [HingeModel(*c.best_at, c.best) for c in courses]


def fit_hinge(df: DataFrame, features: str, label: str = "TARGET", key: str = "SK_ID_CURR", params: HingeParams = HingeParams()) -> HingeModel:
    """Train one model, as ``fit_hinges``."""
    return fit_hinges(df, features, label, key, [params])[0]
