"""Folds, encoding, reports, grids and mergeable sketches."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ml as ML
from riskloom.operators import modelling as MO
from riskloom.operators import profile as P
from riskloom.operators import sketches as SK


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(420):
        a, b = rng.normal(size=2)
        y = int(a + 0.5 * b + rng.normal(scale=0.6) > 1.1)
        rows.append((i, y, None if i % 17 == 0 else float(a), float(b), ["red", "green", "blue", None][i % 4], "test" if i % 5 == 0 else "train"))
    return spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double, b double, c string, split string").repartition(3)


def test_folds_have_exact_shares(frame):
    folded = MO.stratified_folds(frame, 5).collect()
    assert len(folded) == 420
    for y in (0, 1):
        sizes = [sum(r.TARGET == y and r.fold == f for r in folded) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    again = {r.SK_ID_CURR: r.fold for r in MO.stratified_folds(frame.repartition(7), 5).collect()}
    assert again == {r.SK_ID_CURR: r.fold for r in folded}


def test_preparation_is_fitted_on_training_rows_alone(spark, frame):
    train = frame.where("split = 'train' AND c <> 'blue'")
    preparation = MO.fit_preparation(train, ["a", "b"], ["c"], 0.0)
    rows = {r.SK_ID_CURR: r for r in preparation.apply(frame).collect()}
    raw = {r.SK_ID_CURR: r for r in frame.collect()}
    fit = [r for r in raw.values() if r.split == "train" and r.c not in (None, "blue")]
    known = sorted(r.a for r in fit if r.a is not None)
    median = known[math.ceil(len(known) / 2) - 1]
    a = np.array([median if r.a is None else r.a for r in fit])
    for key, r in raw.items():
        x = rows[key].x
        assert abs(x[0] - ((median if r.a is None else r.a) - a.mean()) / a.std()) < 1e-9
        mode = preparation.modes["c"]
        assert x[2:] == [float((r.c or mode) == v) for v in ("green", "red")]  # blue was never seen: all zero
    assert len(rows) == 420 and rows[0].split == "test"


@pytest.mark.parametrize("kind", ["logreg_l2", "boosted_trees", "leafwise_trees", "hinge_sgd", "network"])
def test_reports_follow_from_the_predictions(frame, kind):
    options = {"boosted_trees": {"trees": 3}, "leafwise_trees": {"trees": 3}, "hinge_sgd": {"rounds": 4}, "network": {"epochs": 2}}.get(kind)
    preparation = MO.fit_preparation(frame.where("split = 'train'"), ["a", "b"], ["c"])
    scored = MO.predictions(preparation.apply(frame), kind, options)
    rows = scored.collect()
    assert len(rows) == 420 and {r.part for r in rows} == {"train", "test"}
    got = {(r.metric, r.class_label): r.value for r in MO.model_report(scored).collect()}
    test = [r for r in rows if r.part == "test"]
    recall = {p: np.mean([r.pred for r in rows if r.part == p and r.y == 1]) for p in ("train", "test")}
    pairs = [(u.score > v.score) + 0.5 * (u.score == v.score) for u in test for v in test if u.y == 1 and v.y == 0]
    assert abs(got["auc", None] - np.mean(pairs)) < 1e-9 and got["auc", None] > 0.6
    assert abs(got["recall_train", None] - recall["train"]) < 1e-9 and abs(got["recall_gap", None] - recall["train"] + recall["test"]) < 1e-9
    assert abs(got["precision", None] - np.mean([r.pred == r.y for r in test])) < 1e-9
    hits = {p: [int(r.y == 1 and r.pred == 1) for r in sorted(rows, key=lambda r: r.SK_ID_CURR) if r.part == p] for p in ("train", "test")}
    d = [u - v for u, v in zip(hits["train"], hits["test"]) if u != v]
    assert got["wilcoxon_n", None] == len(d)
    if d:
        z = -abs(got["wilcoxon_z", None])
        assert abs(10 ** got["wilcoxon_log10_p", None] - math.erfc(-z / math.sqrt(2))) < 1e-9


def test_grid_reports_every_point_on_every_fold(frame):
    grid = [{"C": 0.1}, {"C": 1.0}]
    rows = MO.grid_scores(frame, "logreg_l2", grid, ["a", "b"], ["c"], folds=3, side_by_side=3).collect()
    assert sorted((r.params, r.fold) for r in rows) == [(f"C={c}", f) for c in (0.1, 1.0) for f in range(3)]
    for p in {r.params for r in rows}:
        own = [r for r in rows if r.params == p]
        assert abs(own[0].mean_recall - np.mean([r.recall for r in own])) < 1e-12
    best = {r.params for r in rows if r.best}
    assert len(best) == 1 and max(rows, key=lambda r: r.mean_recall).mean_recall == next(r for r in rows if r.best).mean_recall


@pytest.mark.parametrize("kind, grid", [("hinge_sgd", [{"alpha": a, "rounds": 2} for a in (0.001, 0.01)]), ("boosted_trees", [{"trees": 1, "max_depth": d} for d in (1, 2)])])
def test_grid_points_share_the_balanced_rows_of_a_fold(frame, monkeypatch, kind, grid):
    made, own = [], MO._balanced
    monkeypatch.setattr(MO, "_balanced", lambda *args: made.append(1) or own(*args))
    rows = MO.grid_scores(frame, kind, grid, ["a", "b"], ["c"], folds=2).collect()
    assert len(rows) == 4 and len(made) == 2


def test_preparation_is_fitted_on_a_written_split(frame, monkeypatch):
    seen, own = [], ML.fit_medians
    monkeypatch.setattr(ML, "fit_medians", lambda train, *args: seen.append(train._jdf.queryExecution().executedPlan().toString()) or own(train, *args))
    out, _ = ML.prepare_model_frame(frame, ["a", "b"], ["c"])
    assert out.count() == frame.count() and "Window" not in seen[0]


def test_sketches_merge_to_the_whole(spark):
    df = spark.range(60_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(5000)) / 7).alias("u"), F.when(F.col("id") % 4 > 0, F.exp(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 200)).alias("v"), F.lit(None).cast("double").alias("none"), F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(-0.0)).alias("z")).repartition(6)
    columns = ["u", "v", "none", "z"]
    parts = SK.column_sketches(df, columns, F.pmod("id", F.lit(7)))
    assert parts.count() == 28
    profile = {r.feature: r for r in SK.sketch_profile(SK.merged(parts)).collect()}
    whole = {r.feature: r for r in SK.sketch_profile(SK.merged(SK.column_sketches(df, columns))).collect()}
    for c in ("u", "v"):
        values = np.sort([r[0] for r in df.select(c).where(f"{c} is not null").collect()])
        for got in (profile[c], whole[c]):
            assert abs(got.n_distinct - len(set(values))) < 0.05 * len(set(values)) and (got.lo, got.hi) == (values[0], values[-1])
            for share, q in zip((0.25, 0.5, 0.75), got.quantiles):
                assert np.searchsorted(values, q, "left") / len(values) - 0.01 <= share <= np.searchsorted(values, q, "right") / len(values) + 0.01
        assert profile[c].n_distinct == whole[c].n_distinct
    assert profile["none"].quantiles is None and profile["none"].null_rate == 1 and profile["none"].n_distinct == 0
    assert profile["z"].n_distinct == 1 and profile["z"].null_rate == 0.5
    first = SK.merged(parts, ["0", "1", "2"])
    assert {r.feature: r.n_rows for r in first.collect()}["u"] == df.where("id % 7 < 3").count()
    drift = {r.feature: r.psi for r in SK.sketch_drift(first, SK.merged(SK.column_sketches(df.where("id % 7 > 2").withColumn("v", F.col("v") * 2), columns))).collect()}
    u0, v0 = (np.array([r[0] for r in df.where("id % 7 < 3").select(c).where(f"{c} is not null").collect()]) for c in ("u", "v"))
    v1 = 2 * np.array([r[0] for r in df.where("id % 7 > 2").select("v").where("v is not null").collect()])
    cut = np.append(np.quantile(v0, np.arange(1, 10) / 10), np.inf)
    share = [np.maximum(np.diff(np.r_[0, [np.mean(x <= e) for e in cut]]), 1e-6) for x in (v0, v1)]
    want = ((share[1] - share[0]) * np.log(share[1] / share[0])).sum()
    assert len(u0) and drift["u"] < 0.01 and abs(drift["v"] - want) < 0.1 * want and drift["none"] is None
