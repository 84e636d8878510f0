"""Models from preparation to report: folds, encoding, balancing, nine classifiers, their predictions, reports and grids.

Preparation is fitted on training rows alone and applied to others as expressions, so a grid search fits it anew inside
each fold.  Categories get their codes by an ordered scan over their distinct values, so no dictionary passes through
the driver.  Classifiers without class weights see a training set balanced by synthetic rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import Any

from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from . import evaluation as EV
from . import ml as ML
from .boosting import BinnedRows, BoostedModel, BoostingParams, bin_rows, first_trees, fit_binned, fit_points
from .distribution import log10_upper_tail
from .hinge import HingeModel, HingeParams, fit_hinge, fit_hinges
from .network import NetworkParams, fit_network
from .ordered import ordered_scan
from .oversampling import synthetic_vectors

SEED = 42


# ---------------------------------------------------------------------------
# folds and preparation
# ---------------------------------------------------------------------------


def stratified_folds(df: DataFrame, folds: int, label: str = "TARGET", key: str = "SK_ID_CURR", seed: int = SEED, out: str = "fold") -> DataFrame:
    """``df`` with a fold number from 0: the rows of each class, in the order of a hash of their key, go to the folds in turn.

    Shares are exact: within a class the folds differ by at most one row.
    """
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed)))
    ranked = ordered_scan(df.withColumn("_h", h), [label], [F.col("_h"), F.col(key)], rank_col="_r")
    return ranked.select(*df.columns, F.pmod(F.col("_r") - 1, F.lit(folds)).cast("int").alias(out))


def category_codes(train: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(feature, value, code): the distinct non-null values of each column, numbered from 0 in their order."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in categorical])
    values = train.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    ranked = ordered_scan(values, ["feature"], [F.col("value")], rank_col="_r")
    return ranked.select("feature", "value", (F.col("_r") - 1).cast("int").alias("code"))


def one_hot_entries(df: DataFrame, codes: DataFrame, categorical: Sequence[str], key: str = "SK_ID_CURR") -> DataFrame:
    """(key, feature, index): the place of the one in each row's encoding; unseen and null values have none.

    The columns of ``categorical`` stand one after another, each with as many places as it has codes.
    """
    codes = scratch_table(codes, "codes")
    widths = {r["feature"]: r["n"] for r in codes.groupBy("feature").agg((F.max("code") + 1).alias("n")).collect()}  # one row per column
    offset, at = {}, 0
    for c in categorical:
        offset[c], at = at, at + widths.get(c, 0)
    start = F.coalesce(*[F.when(F.col("feature") == c, F.lit(offset[c])) for c in categorical])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in categorical])
    return df.select(key, F.inline(pairs)).join(codes, ["feature", "value"]).select(key, "feature", (start + F.col("code")).alias("index"))


@dataclass
class Preparation:
    """Medians, modes, scaling and codes of some training rows."""

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    modes: dict[str, str]
    scaler: dict[str, tuple[float, float]]
    codes: DataFrame
    places: int

    def apply(self, df: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
        """``df`` with ``x``: the scaled numbers and the one-hot places as an array of doubles."""
        others = [F.col(c) for c in df.columns if c not in (*self.numeric, *self.categorical)]
        filled = ML.standard_scale(ML.impute_mode(ML.impute_median(df, self.medians), self.modes), self.scaler)
        entries = one_hot_entries(filled, self.codes, self.categorical, key).groupBy(key).agg(F.collect_set("index").alias("_on"))
        joined = filled.join(entries, key, "left")
        hot = F.transform(F.sequence(F.lit(0), F.lit(self.places - 1)), lambda i: F.coalesce(F.array_contains("_on", i), F.lit(False)).cast("double")) if self.places else F.array().cast("array<double>")
        return joined.select(*others, F.concat(F.array(*[F.col(c).cast("double") for c in self.numeric]), hot).alias("x"))


def fit_preparation(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], relative_error: float = 0.001) -> Preparation:
    medians = ML.fit_medians(train, numeric, relative_error)
    medians |= {c: 0.0 for c in numeric if medians.get(c) is None}  # a column without a value
    modes = {c: m for c, m in ML.fit_modes(train, categorical).items() if m is not None} if categorical else {}
    filled = ML.impute_mode(ML.impute_median(train, medians), modes)
    scaler = ML.fit_scaler(filled, numeric)
    codes = scratch_table(category_codes(filled, categorical), "codes")
    return Preparation(list(numeric), list(categorical), medians, modes, scaler, codes, codes.count())


# ---------------------------------------------------------------------------
# classifiers: (train rows with key, label and x) -> function that adds score and pred
# ---------------------------------------------------------------------------

Predictor = Callable[[DataFrame], DataFrame]


def _balanced(train: DataFrame, label: str, key: str) -> DataFrame:
    new = synthetic_vectors(train, "x", label, key).select(F.lit(None).cast(train.schema[key].dataType).alias(key), label, F.col("vector").alias("x"))
    return scratch_table(train.select(key, label, "x").unionByName(new), "balanced")


def _spark_ml(estimator: Any, train: DataFrame, label: str) -> Predictor:
    model = ML.without_summary(estimator.setFeaturesCol("_v").setLabelCol(label).fit(train.select(label, array_to_vector("x").alias("_v"))), train.sparkSession)

    def predict(df: DataFrame) -> DataFrame:
        out = model.transform(df.withColumn("_v", array_to_vector("x")))
        return out.select(*df.columns, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("pred"))

    return predict


def _columns(df: DataFrame, width: int) -> DataFrame:
    return df.select("*", *[F.col("x")[i].alias(f"_x{i}") for i in range(width)])


def _binned(train: DataFrame, label: str) -> BinnedRows:
    width = len(train.select("x").first()["x"])
    return bin_rows(_columns(train, width), [f"_x{i}" for i in range(width)], label)


def _boosted(model: BoostedModel) -> Predictor:
    width = len(model.features)
    return lambda df: model.predict(_columns(df, width)).drop(*[f"_x{i}" for i in range(width)])


def boosting_params(kind: str, o: dict[str, Any], rows: BinnedRows) -> BoostingParams:
    if kind == "boosted_trees":  # depth-wise, on the balanced rows
        depth = o.get("max_depth", 3)
        return BoostingParams(trees=o.get("trees", 30), max_depth=depth, num_leaves=2**depth, learning_rate=o.get("learning_rate", 0.1))
    # leaf-wise, positives weigh as much as negatives
    scale = (rows.number - rows.positive) / max(rows.positive, 1)
    return BoostingParams(trees=o.get("trees", 30), max_depth=o.get("max_depth", 5), num_leaves=o.get("num_leaves", 15), learning_rate=o.get("learning_rate", 0.1), reg_lambda=0.0 + 1e-3, scale_pos_weight=scale)


def hinge_params(o: dict[str, Any]) -> HingeParams:
    ratio = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.15}[o.get("penalty", "l2")]
    return HingeParams(alpha=o.get("alpha", 1e-3), l1_ratio=ratio, rounds=o.get("rounds", 25))


def _hinge(model: HingeModel) -> Predictor:
    return lambda df: model.predict(df, "x")


def learning_rows(kind: str, train: DataFrame, label: str = "TARGET", key: str = "SK_ID_CURR") -> Any:
    """What a classifier of ``KINDS`` learns from, made of ``train`` (key, label, x): balanced and in bins where the family
    asks for it.  It depends on no option, so the points of a grid share it."""
    if kind not in KINDS:
        raise ValueError(f"unknown model kind: {kind}")
    if kind == "network":
        return train
    if kind == "leafwise_trees":
        return _binned(train, label)
    rows = _balanced(train, label, key)
    return _binned(rows, label) if kind == "boosted_trees" else rows


def fit_model(kind: str, train: DataFrame, options: dict[str, Any] | None = None, label: str = "TARGET", key: str = "SK_ID_CURR") -> Predictor:
    """Fit a classifier of ``KINDS`` on ``train`` (key, label, x); ``options`` are those of the family."""
    return fit_learning_rows(kind, learning_rows(kind, train, label, key), options, label, key)


def fit_learning_rows(kind: str, rows: Any, options: dict[str, Any] | None = None, label: str = "TARGET", key: str = "SK_ID_CURR") -> Predictor:
    """Fit a classifier of ``KINDS`` on its ``learning_rows``."""
    o = dict(options or {})
    if kind.startswith("logreg"):
        reg = 1.0 / (o.get("C", 1.0) * max(rows.count(), 1))
        return _spark_ml(LogisticRegression(elasticNetParam=float(kind == "logreg_l1"), regParam=reg, standardization=False, maxIter=300), rows, label)
    if kind == "gaussian_nb":
        return _spark_ml(NaiveBayes(modelType="gaussian"), rows, label)
    if kind == "random_forest":
        return _spark_ml(RandomForestClassifier(numTrees=o.get("trees", 100), maxDepth=o.get("max_depth", 5), seed=SEED), rows, label)
    if kind == "gbt":
        return _spark_ml(GBTClassifier(maxIter=o.get("trees", 50), maxDepth=o.get("max_depth", 4), stepSize=0.1, seed=SEED), rows, label)
    if kind in ("boosted_trees", "leafwise_trees"):
        return _boosted(fit_binned(rows, boosting_params(kind, o, rows)))
    if kind == "hinge_sgd":
        return _hinge(fit_hinge(rows, "x", label, key, hinge_params(o)))
    if kind == "network":
        net = fit_network(rows, "x", label, key, NetworkParams(epochs=o.get("epochs", 12), batches=o.get("batches", 4)))
        return lambda df: net.predict(df, "x")
    raise ValueError(f"unknown model kind: {kind}")


def shared_fits(kind: str, grid: Sequence[dict[str, Any]]) -> list[list[int]]:
    """The points of a grid in groups, one fit each: boosting with fewer trees is a part of boosting with more, a tree cannot have
    more leaves than its depth allows, and the hinge models take their passes together."""
    groups: dict[Any, list[int]] = {}
    for at, point in enumerate(grid):
        same: Any = at
        if kind == "hinge_sgd":
            same = kind
        elif kind in ("boosted_trees", "leafwise_trees"):
            params = boosting_params(kind, point, BinnedRows([], [], None, 1, 1))
            same = replace(params, trees=0, num_leaves=min(params.num_leaves, 2**params.max_depth))
        groups.setdefault(same, []).append(at)
    return list(groups.values())


def fit_grid_rows(kind: str, rows: Any, grid: Sequence[dict[str, Any]], label: str = "TARGET", key: str = "SK_ID_CURR") -> list[Predictor]:
    """A classifier for each point of a group of ``shared_fits``, fitted on the kind's ``learning_rows``."""
    if kind == "hinge_sgd":
        return [_hinge(m) for m in fit_hinges(rows, "x", label, key, [hinge_params(o) for o in grid])]
    if kind in ("boosted_trees", "leafwise_trees"):
        points = [boosting_params(kind, o, rows) for o in grid]
        whole = fit_points(rows, points)
        return [_boosted(first_trees(whole, p.trees)) for p in points]
    return [fit_learning_rows(kind, rows, o, label, key) for o in grid]


KINDS = ("logreg_l2", "logreg_l1", "gaussian_nb", "random_forest", "gbt", "boosted_trees", "leafwise_trees", "hinge_sgd", "network")


# ---------------------------------------------------------------------------
# predictions, reports, grids
# ---------------------------------------------------------------------------


def predictions(frame: DataFrame, kind: str, options: dict[str, Any] | None = None, label: str = "TARGET", key: str = "SK_ID_CURR") -> DataFrame:
    """(key, part, y, pred, score) of every row, written once.

    ``frame`` holds key, label, x and ``split``.  Training and validation rows train and are the part ``train``; the
    network, which sets validation rows of its own aside, learns from training rows alone.
    """
    base = frame.select(key, label, "x", "split")
    learn = base.where("split = 'train'" if kind == "network" else "split <> 'test'")
    predict = fit_model(kind, learn.select(key, label, "x"), options, label, key)
    scored = predict(base).select(key, F.when(F.col("split") == "test", "test").otherwise("train").alias("part"), F.col(label).cast("int").alias("y"), F.col("pred").cast("int").alias("pred"), F.col("score").cast("double").alias("score"))
    return scratch_table(scored, f"predictions-{kind}")


def model_report(scored: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """(metric, class_label, value) of stored predictions (key, part, y, pred, score).

    On the test part: confusion counts, precision, recall, F1 and support by class, accuracy, AUC.  Then recall of class 1
    on either part and their gap, and the signed-rank test of the hits of both parts paired by position: differences
    (``n``), the statistic, z and log10 of the two-sided p.
    """
    test = scored.where("part = 'test'")
    report = EV.evaluation_report(test)
    recall = scored.where("y = 1").agg(*[F.avg(F.when(F.col("part") == p, F.col("pred").cast("double"))).alias(p) for p in ("train", "test")])
    gap = recall.selectExpr("stack(3, 'recall_train', train, 'recall_test', test, 'recall_gap', train - test) AS (metric, value)")
    hits = scored.select(key, "part", ((F.col("pred") == 1) & (F.col("y") == 1)).cast("int").alias("hit"))
    paired = EV.wilcoxon_paired(hits.where("part = 'train'"), hits.where("part = 'test'"), key, "hit")
    p = F.least(F.lit(0.0), log10_upper_tail(-F.col("z")) + math.log10(2))
    paired = paired.withColumn("p", p).selectExpr("stack(4, 'wilcoxon_n', CAST(n AS DOUBLE), 'wilcoxon_w', w, 'wilcoxon_z', z, 'wilcoxon_log10_p', p) AS (metric, value)")
    more = gap.unionByName(paired).select("metric", F.lit(None).cast("string").alias("class_label"), "value")
    return report.unionByName(more)


def recall_of(scored: DataFrame, label: str) -> float:
    row = scored.where(F.col(label) == 1).agg(F.avg(F.col("pred").cast("double")).alias("r")).first()
    return row["r"] if row["r"] is not None else 0.0


def grid_scores(
    df: DataFrame, kind: str, grid: Sequence[dict[str, Any]], numeric: Sequence[str], categorical: Sequence[str], folds: int = 3,
    label: str = "TARGET", key: str = "SK_ID_CURR", side_by_side: int = 4,
) -> DataFrame:
    """(params, fold, recall, mean_recall, best): the recall of class 1 of every grid point on every fold.

    Folds are stratified, the preparation is fitted and the learning rows are made once inside each fold, points share fits, and
    ``side_by_side`` folds or fits run at once; each is a series of Spark jobs.  The best point has the greatest mean, the first of equals.
    """
    folded = scratch_table(stratified_folds(df.select(key, F.col(label).cast("int").alias(label), *numeric, *categorical), folds, label, key), "folds")

    def prepare(f: int) -> tuple[DataFrame, Any]:
        preparation = fit_preparation(folded.where(F.col("fold") != f), numeric, categorical)
        rows = scratch_table(preparation.apply(folded, key), "fold")
        return rows.where(F.col("fold") == f).select(key, label, "x"), learning_rows(kind, rows.where(F.col("fold") != f).select(key, label, "x"), label, key)

    def some(job: tuple[list[int], int]) -> list[tuple[int, int, float]]:
        points, f = job
        held, rows = prepared[f]
        fitted = fit_grid_rows(kind, rows, [grid[p] for p in points], label, key)
        return [(p, f, recall_of(predict(held), label)) for p, predict in zip(points, fitted)]

    with ThreadPoolExecutor(side_by_side) as pool:
        prepared = list(pool.map(prepare, range(folds)))
        found = sorted(r for rows in pool.map(some, [(points, f) for points in shared_fits(kind, grid) for f in range(folds)]) for r in rows)
    mean = {p: sum(r for q, _, r in found if q == p) / folds for p in range(len(grid))}
    best = max(mean, key=lambda p: (mean[p], -p))
    named = [", ".join(f"{k}={v}" for k, v in point.items()) for point in grid]
    rows = [(named[p], f, float(r), float(mean[p]), p == best) for p, f, r in found]
    return df.sparkSession.createDataFrame(rows, "params string, fold int, recall double, mean_recall double, best boolean")


#: The grids of the study by family: its values of the parameters that are searched.
GRIDS: dict[str, list[dict[str, Any]]] = {
    "logreg_l2": [{"C": c} for c in (0.1, 1.0)],
    "random_forest": [{"max_depth": d, "trees": 200} for d in (5, 10)],
    "boosted_trees": [{"trees": t, "max_depth": d, "learning_rate": 0.1} for t in (100, 200) for d in (3, 5)],
    "leafwise_trees": [{"trees": 100, "max_depth": d, "learning_rate": r, "num_leaves": n} for d in (3, 5) for r in (0.05, 0.1) for n in (15, 31)],
    "hinge_sgd": [{"alpha": a, "penalty": p, "rounds": 1000} for a in (0.0001, 0.001, 0.01) for p in ("l2", "elasticnet")],
}
