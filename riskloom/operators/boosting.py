"""Second-order gradient boosting on binned features: histograms as Spark aggregates, leaf-wise trees.

Features become bin numbers by quantile edges; missing values have a bin of their own.  For each depth of a tree
one pass over the rows sums gradients, Hessians and rows by (node, feature, bin): each task adds up its rows in
arrays, and Spark sums the tasks' arrays by key.  A split is the threshold of greatest regularised gain, with missing values
sent to the side where they gain more.

A leaf-wise tree takes the best leaf again and again.  Here the passes go down to ``max_depth`` first, so that the gain of
every possible node is known, and the driver then picks best-first until ``num_leaves`` are reached: the same tree in
``max_depth`` passes instead of one pass a split.  Histograms at the driver have at most ``2 ** max_depth`` x
features x bins rows, whatever the number of rows.

Scores are written with the rows every ``refresh`` trees; between, a pass adds the trees since then itself.

A grid fits many models, and every pass of one is a Spark job however few the rows are.  Where the bins of the rows fit into
``TASK_CELLS`` bytes, ``fit_points`` therefore has one task read all rows and grow the whole model from the same sums, one task
a model; larger rows take the passes.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from .drift import quantile_edges


#: Rows x features that one task may hold, at a byte each (and some 60 bytes a row besides).
TASK_CELLS = 1 << 26
CHUNK = 1 << 16


@dataclass(frozen=True)
class BoostingParams:
    trees: int = 100
    learning_rate: float = 0.1
    max_depth: int = 5
    num_leaves: int = 31
    bins: int = 64
    reg_lambda: float = 1.0
    min_gain: float = 0.0
    min_child_weight: float = 1.0
    scale_pos_weight: float = 1.0
    refresh: int = 10


@dataclass
class Split:
    """Rows with a bin of at most ``bin`` go left; those without a value where ``missing_left`` says."""

    feature: int
    bin: int
    missing_left: bool
    gain: float


@dataclass
class Tree:
    """Nodes as in a heap: the children of i are 2 i + 1 and 2 i + 2."""

    splits: dict[int, Split] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def nodes_of(self, bins: np.ndarray, splits: dict[int, Split] | None = None) -> np.ndarray:
        """The node each row (bins of its features, 0 for missing) ends in: all rows go down a level at a time."""
        splits = self.splits if splits is None else splits
        at = np.zeros(len(bins), np.int64)
        feature, limit, missing_left = _split_columns(splits)
        rows = np.arange(len(bins))
        while len(rows):
            here = at[rows]
            split = (here < len(feature)) & (feature[np.minimum(here, len(feature) - 1)] >= 0)
            rows, here = rows[split], here[split]
            b = bins[rows, feature[here]]
            left = np.where(b == 0, missing_left[here], b <= limit[here])
            at[rows] = 2 * here + 2 - left
        return at

    def scores(self, bins: np.ndarray) -> np.ndarray:
        at = self.nodes_of(bins)
        values = np.zeros(max([*self.values, *(2 * n + 2 for n in self.splits)], default=0) + 1)
        for node, value in self.values.items():
            values[node] = value
        return values[at]


def _split_columns(splits: dict[int, Split]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1: not split), bin and side of missing values by node."""
    size = max(splits, default=0) + 1
    feature, limit, missing_left = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, bool)
    for node, s in splits.items():
        feature[node], limit[node], missing_left[node] = s.feature, s.bin, s.missing_left
    return feature, limit, missing_left


@dataclass
class BoostedModel:
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]

    def predict(self, df: DataFrame, score: str = "score", pred: str = "pred") -> DataFrame:
        """``df`` with the probability of class 1 and the class at one half.

        Bins are Spark expressions; the trees run over Arrow batches of them, since as one expression they would soon be too
        large to compile.
        """
        from pyspark.sql.functions import pandas_udf

        trees, base, width = self.trees, self.base, len(self.features)

        @pandas_udf("double")
        def probability(bins):
            import pandas as pd

            if not len(bins):
                return pd.Series([], dtype="float64")
            b = np.stack(bins.to_numpy()).reshape(-1, width)
            raw = base + sum((tree.scores(b) for tree in trees), np.zeros(len(b)))
            return pd.Series(1 / (1 + np.exp(-raw)))

        out = df.withColumn(score, probability(binned(df, self.features, self.edges)))
        return out.withColumn(pred, (F.col(score) > 0.5).cast("int"))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Upper edges of the bins of each feature but the last: its distinct inner quantiles."""
    found: dict[str, set[float]] = {c: set() for c in features}
    for r in quantile_edges(df, list(features), buckets=bins, relative_error=1e-3).collect():  # bins + 1 numbers a feature
        if 0 < r["q_index"] < bins and r["value"] is not None:
            found[r["feature"]].add(float(r["value"]))
    return [sorted(found[c]) for c in features]


def binned(df: DataFrame, features: Sequence[str], edges: list[list[float]]) -> Column:
    """An array of bin numbers: 0 where missing, else 1 + edges below the value."""
    return F.array(*[_bin(F.col(c).cast("double"), e) for c, e in zip(features, edges)])


def _bin(x: Column, edges: list[float]) -> Column:
    below = F.size(F.filter(F.array(*[F.lit(v) for v in edges]), lambda v: v < x)) if edges else F.lit(0)
    return F.when(x.isNull() | F.isnan(x), 0).otherwise(below + 1).cast("int")


def best_split(g: np.ndarray, h: np.ndarray, params: BoostingParams) -> Split | None:
    """The split of greatest gain from histograms (features x bins, bin 0 missing); ties to the first feature, bin, and missing right."""
    best: Split | None = None
    lam = params.reg_lambda
    total_g, total_h = g[0].sum(), h[0].sum()
    whole = total_g**2 / (total_h + lam)
    # features x (missing right, missing left) x bins
    left_g, left_h = (np.cumsum(a[:, None, 1:], axis=2) + np.stack([np.zeros(len(a)), a[:, 0]], axis=1)[:, :, None] for a in (g, h))
    right_g, right_h = total_g - left_g, total_h - left_h
    gain = 0.5 * (left_g**2 / (left_h + lam) + right_g**2 / (right_h + lam) - whole) - params.min_gain
    gain[(left_h < params.min_child_weight) | (right_h < params.min_child_weight)] = -np.inf
    at = gain.argmax(axis=2)
    greatest = np.take_along_axis(gain, at[:, :, None], axis=2)[:, :, 0].tolist()
    for feature, sides in enumerate(greatest):
        for missing_left, here in zip((False, True), sides):
            if here > 1e-12 and (best is None or here > best.gain + 1e-12):
                best = Split(feature, int(at[feature, int(missing_left)]) + 1, missing_left, here)
    return best


def _histograms(rows: DataFrame, trees: list[Tree], splits: dict[int, Split], depth: int, features: int, bins: int, weight: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(gradients, Hessians), features x bins, of each node of ``depth``, from rows (bins, y, raw)."""
    first, nodes = 2**depth - 1, 2**depth
    now = Tree()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, nodes, features, bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            b = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
            y, raw = batch.column(1).to_numpy(), batch.column(2).to_numpy().copy()
            for tree in trees:
                raw += tree.scores(b)
            p = 1 / (1 + np.exp(-raw))
            w = np.where(y == 1, weight, 1.0)
            at = now.nodes_of(b, splits) - first
            live = at >= 0  # rows whose node was not split earlier stay above
            g, h, start, columns = (w * (p - y))[live], (w * p * (1 - p))[live], at[live] * bins, np.ascontiguousarray(b[live].T)
            for feature in range(features):
                slot = start + columns[feature]
                for k, value in enumerate((g, h)):
                    sums[k, :, feature] += np.bincount(slot, value, nodes * bins).reshape(nodes, bins)
        sums = sums.reshape(2, -1)
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[0, used]), pa.array(sums[1, used])], names=["slot", "g", "h"])

    parts = rows.mapInArrow(add_up, "slot long, g double, h double")
    out = {first + n: (np.zeros((features, bins)), np.zeros((features, bins))) for n in range(nodes)}
    for r in parts.groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():  # nodes x features x bins rows at most
        node, rest = divmod(r["slot"], features * bins)
        feature, b = divmod(rest, bins)
        out[first + node][0][feature, b], out[first + node][1][feature, b] = r["g"], r["h"]
    return out


Histograms = dict[int, tuple[np.ndarray, np.ndarray]]


def _grow(rows: DataFrame, since: list[Tree], features: int, bins: int, params: BoostingParams) -> Tree:
    """The next tree of all rows, a Spark job a pass."""
    return _grown(lambda splits, depth: _histograms(rows, since, splits, depth, features, bins, params.scale_pos_weight), params)


def _grown(histograms: Callable[[dict[int, Split], int], Histograms], params: BoostingParams) -> Tree:
    """The next tree: gains of all nodes pass by pass, then best-first up to ``num_leaves``.

    The histograms of a node hold the sums of both its children, so the deepest leaves need no pass of their own.
    """
    splits: dict[int, Split] = {}
    values: dict[int, float] = {}
    for depth in range(max(params.max_depth, 1)):
        here = histograms(splits, depth)
        for node, (g, h) in here.items():
            if node and (node - 1) // 2 not in splits:
                continue
            values[node] = -params.learning_rate * float(g[0].sum() / (h[0].sum() + params.reg_lambda))
            if depth < params.max_depth and (found := best_split(g, h, params)):
                splits[node] = found
                for child, (child_g, child_h) in zip((2 * node + 1, 2 * node + 2), _child_sums(g, h, found)):
                    values[child] = -params.learning_rate * float(child_g / (child_h + params.reg_lambda))
        if not any(n >= 2**depth - 1 for n in splits):
            break
    return best_first(splits, values, params.num_leaves)


def _child_sums(g: np.ndarray, h: np.ndarray, split: Split) -> list[tuple[float, float]]:
    """(gradients, Hessians) of the left and the right child of a node with histograms ``g`` and ``h``."""
    left = np.zeros(g.shape[1], bool)
    left[0], left[1 : split.bin + 1] = split.missing_left, True
    return [(g[split.feature, side].sum(), h[split.feature, side].sum()) for side in (left, ~left)]


def best_first(splits: dict[int, Split], values: dict[int, float], num_leaves: int) -> Tree:
    """The leaf-wise tree: the leaf of greatest gain is split until there are ``num_leaves`` or no gain is left."""
    tree, leaves = Tree(), [0]
    queue = [(-splits[0].gain, 0)] if 0 in splits else []
    while queue and len(leaves) < num_leaves:
        _, node = heapq.heappop(queue)
        tree.splits[node] = splits[node]
        leaves.remove(node)
        for child in (2 * node + 1, 2 * node + 2):
            leaves.append(child)
            if child in splits:
                heapq.heappush(queue, (-splits[child].gain, child))
    tree.values = {n: values.get(n, 0.0) for n in leaves}
    return tree


def _refreshed(rows: DataFrame, trees: list[Tree], features: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
            raw = batch.column(2).to_numpy() + sum(tree.scores(b) for tree in trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw)], names=["bins", "y", "raw"])

    return scratch_table(rows.mapInArrow(add, "bins array<int>, y int, raw double"), "boosting-rows")


@dataclass
class BinnedRows:
    """Training rows as (bins, y), written once; any number of models can learn from them."""

    features: list[str]
    edges: list[list[float]]
    rows: DataFrame
    number: int
    positive: float


def bin_rows(df: DataFrame, features: Sequence[str], label: str = "TARGET", bins: int = BoostingParams.bins, edges: list[list[float]] | None = None) -> BinnedRows:
    """The rows of ``df`` with a label, in bins by ``edges`` or by quantiles of their own."""
    names = list(features)
    train = df.where(F.col(label).isNotNull())
    edges = bin_edges(train, names, bins) if edges is None else edges
    totals = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("pos")).first()
    if not totals["n"] or not totals["pos"] or totals["pos"] == totals["n"]:
        raise ValueError("boosting needs rows of both classes")
    rows = scratch_table(train.select(binned(train, names, edges).alias("bins"), F.col(label).cast("int").alias("y")), "boosting-rows")
    return BinnedRows(names, edges, rows, totals["n"], totals["pos"])


def fit_boosting(df: DataFrame, features: Sequence[str], label: str = "TARGET", params: BoostingParams = BoostingParams(), edges: list[list[float]] | None = None) -> BoostedModel:
    """Binary logistic boosting on the rows of ``df`` with a label; a null label leaves a row out."""
    return fit_binned(bin_rows(df, features, label, params.bins, edges), params)


def fit_binned(train: BinnedRows, params: BoostingParams = BoostingParams()) -> BoostedModel:
    """Binary logistic boosting on rows that are in bins."""
    names, edges = train.features, train.edges
    bins = 2 + max((len(e) for e in edges), default=0)
    base = _base(train, params)
    rows = train.rows.withColumn("raw", F.lit(base))
    trees: list[Tree] = []
    since: list[Tree] = []
    for _ in range(params.trees):
        tree = _grow(rows, since, len(names), bins, params)
        if not tree.splits:
            break
        trees.append(tree)
        since.append(tree)
        if len(since) >= params.refresh:
            rows, since = _refreshed(rows, since, len(names)), []
    return BoostedModel(names, edges, base, trees)


def fit_points(train: BinnedRows, points: Sequence[BoostingParams]) -> BoostedModel:
    """The model of the most trees of ``points``, which differ in ``trees`` alone: the others' models are its first trees."""
    params = max(points, key=lambda p: p.trees)
    if train.number * len(train.features) > TASK_CELLS:
        return fit_binned(train, params)
    names, edges = train.features, train.edges
    bins = 2 + max((len(e) for e in edges), default=0)
    base = _base(train, params)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if bins <= 256 else np.int32
        columns, labels = [], []
        for batch in batches:
            if batch.num_rows:
                columns.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(names)).astype(kind).T)
                labels.append(batch.column(1).to_numpy().astype(np.int8))
        trees = trees_of(np.concatenate(columns, axis=1), np.concatenate(labels), base, bins, params)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps([({n: (s.feature, s.bin, s.missing_left, s.gain) for n, s in t.splits.items()}, t.values) for t in trees])])], names=["trees"])

    found = train.rows.select("bins", "y").coalesce(1).mapInArrow(fit, "trees binary").first()["trees"]  # one model
    return BoostedModel(names, edges, base, [Tree({n: Split(*s) for n, s in splits.items()}, values) for splits, values in pickle.loads(found)])


def first_trees(model: BoostedModel, trees: int) -> BoostedModel:
    return replace(model, trees=model.trees[:trees])


def _base(train: BinnedRows, params: BoostingParams) -> float:
    pos = train.positive * params.scale_pos_weight
    if not pos:
        raise ValueError("boosting needs rows of both classes")
    return float(np.log(pos / (train.number - train.positive)))


def trees_of(columns: np.ndarray, y: np.ndarray, base: float, bins: int, params: BoostingParams) -> list[Tree]:
    """The trees of a model of the rows whose bins are ``columns`` (features x rows), all in memory."""
    features, n = columns.shape
    raw = np.full(n, base)
    weight = np.where(y == 1, params.scale_pos_weight, 1.0)
    trees: list[Tree] = []
    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (p - y), weight * p * (1 - p)
        at = np.zeros(n, np.int32)

        def histograms(splits: dict[int, Split], depth: int, g=g, h=h, at=at) -> Histograms:
            first, nodes = 2**depth - 1, 2**depth
            sums = np.zeros((2, nodes, features, bins))
            for start in range(0, n, CHUNK):
                part = slice(start, start + CHUNK)
                _descend(at[part], columns[:, part], splits)
                here = at[part] >= first  # rows whose node was not split earlier stay above
                live = slice(None) if here.all() else np.flatnonzero(here)
                slot, gs, hs = (at[part][live].astype(np.int64) - first) * bins, g[part][live], h[part][live]
                for feature in range(features):
                    place = slot + columns[feature, part][live]
                    for k, value in enumerate((gs, hs)):
                        sums[k, :, feature] += np.bincount(place, value, nodes * bins).reshape(nodes, bins)
            return {first + node: (sums[0, node], sums[1, node]) for node in range(nodes)}

        tree = _grown(histograms, params)
        if not tree.splits:
            break
        trees.append(tree)
        at[:] = 0
        values = np.zeros(max(tree.values) + 1)
        values[list(tree.values)] = list(tree.values.values())
        for start in range(0, n, CHUNK):
            part = slice(start, start + CHUNK)
            for _ in range(max(params.max_depth, 1)):
                _descend(at[part], columns[:, part], tree.splits)
            raw[part] += values[at[part]]
    return trees


def _descend(at: np.ndarray, columns: np.ndarray, splits: dict[int, Split]) -> None:
    """Rows in a node of ``splits`` go on to its child, in place; others stay."""
    if not splits:
        return
    feature, limit, missing_left = _split_columns(splits)
    rows = np.flatnonzero((at < len(feature)) & (feature[np.minimum(at, len(feature) - 1)] >= 0))
    here = at[rows]
    b = columns[feature[here], rows]
    left = np.where(b == 0, missing_left[here], b <= limit[here])
    at[rows] = 2 * here + 2 - left
