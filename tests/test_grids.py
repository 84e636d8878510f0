"""Grids: whole tables and the study's points, fits that points share."""

import numpy as np
import pytest

from conftest import SMALL
from riskloom.operators import boosting as B
from riskloom.operators import hinge as H
from riskloom.operators import modelling as MO
from riskloom.plans import catalog as C


def _asked(spark, monkeypatch, kind):
    """Keys and points that the registered grid of ``kind`` works on."""
    table = spark.createDataFrame([(i, int(i % 5 == 0), *[float(i)] * len(C.NUMERIC_MODEL), "a", "b") for i in range(40)], ["SK_ID_CURR", "TARGET", *C.NUMERIC_MODEL, *C.CATEGORICAL_MODEL])
    asked = []
    monkeypatch.setattr(C, "_model_table", lambda spark, sf_dir: table)
    monkeypatch.setattr(MO, "grid_scores", lambda df, kind, grid, *rest, **more: asked.append((sorted(r.SK_ID_CURR for r in df.collect()), grid)) or df.select("SK_ID_CURR"))
    C.QUERIES[f"ml_grid_{kind}"](spark, SMALL)
    return asked[0]


@pytest.mark.parametrize("kind", list(MO.GRIDS))
def test_grids_learn_from_every_row(spark, monkeypatch, kind):
    assert _asked(spark, monkeypatch, kind)[0] == list(range(40))


@pytest.mark.parametrize("kind, size, name, values", [("boosted_trees", 4, "trees", {100, 200}), ("leafwise_trees", 8, "trees", {100}), ("random_forest", 2, "trees", {200}), ("hinge_sgd", 6, "rounds", {1000}), ("logreg_l2", 2, "C", {0.1, 1.0})])
def test_grids_have_the_values_of_the_study(spark, monkeypatch, kind, size, name, values):
    grid = _asked(spark, monkeypatch, kind)[1]
    assert len(grid) == size and {point[name] for point in grid} == values


def test_boosting_points_share_fits():
    groups = MO.shared_fits("boosted_trees", MO.GRIDS["boosted_trees"])
    assert sorted(map(sorted, groups)) == [[0, 2], [1, 3]]  # the first trees of 200 are those of 100
    leafwise = MO.GRIDS["leafwise_trees"]
    groups = [[leafwise[p] for p in g] for g in MO.shared_fits("leafwise_trees", leafwise)]
    assert sorted(len(g) for g in groups) == [1, 1, 1, 1, 2, 2]
    assert all(len(g) == 1 or {p["max_depth"] for p in g} == {3} and len({p["learning_rate"] for p in g}) == 1 for g in groups)  # 8 leaves at most


@pytest.fixture(scope="module")
def binned(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(scale=0.5, size=700) > 0.6).astype(int)
    rows = [(int(y[i]), *(None if rng.random() < 0.1 else float(v) for v in x[i])) for i in range(700)]
    return B.bin_rows(spark.createDataFrame(rows, "TARGET int, a double, b double, c double").repartition(4), ["a", "b", "c"], bins=16)


@pytest.mark.parametrize("options", [{"max_depth": 3, "num_leaves": 8}, {"max_depth": 4, "num_leaves": 5, "scale_pos_weight": 2.5, "reg_lambda": 0.001}])
def test_trees_of_one_task_are_those_of_the_passes(binned, monkeypatch, options):
    points = [B.BoostingParams(trees=t, learning_rate=0.2, refresh=2, **options) for t in (2, 5)]
    monkeypatch.setattr(B, "CHUNK", 256)
    passes, own = [], B._histograms
    monkeypatch.setattr(B, "_histograms", lambda *args: passes.append(1) or own(*args))
    one = B.fit_points(binned, points)
    assert not passes and len(one.trees) == 5
    monkeypatch.setattr(B, "TASK_CELLS", 0)
    for model in (B.fit_points(binned, points), B.fit_binned(binned, points[1])):
        assert passes and model.base == one.base
        for a, b in zip(model.trees, one.trees, strict=True):
            assert {n: (s.feature, s.bin, s.missing_left) for n, s in a.splits.items()} == {n: (s.feature, s.bin, s.missing_left) for n, s in b.splits.items()}
            assert a.values.keys() == b.values.keys() and all(abs(a.values[n] - b.values[n]) < 1e-9 for n in a.values)
    first = B.fit_binned(binned, points[0])
    assert [t.splits.keys() for t in B.first_trees(one, 2).trees] == [t.splits.keys() for t in first.trees]


def test_shared_fits_score_as_their_own(spark):
    rng = np.random.default_rng(7)
    rows = [(i, int(a + b > 0.5), float(a), float(b), "xyz"[i % 3]) for i, (a, b) in enumerate(rng.normal(size=(240, 2)))]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double, b double, c string").repartition(2)
    grid = [{"trees": t, "max_depth": 2, "num_leaves": n, "learning_rate": 0.3} for t, n in ((1, 4), (3, 5))]
    shared = [(r.params, r.fold, r.recall) for r in MO.grid_scores(df, "leafwise_trees", grid, ["a", "b"], ["c"], folds=2).collect()]
    alone = [(r.params, r.fold, r.recall) for point in grid for r in MO.grid_scores(df, "leafwise_trees", [point], ["a", "b"], ["c"], folds=2).collect()]
    assert shared == alone


def test_hinge_models_of_a_grid_take_one_job_a_round(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    df = spark.createDataFrame([(i, v.tolist(), int(v[0] - v[1] > 0.4)) for i, v in enumerate(x)], "SK_ID_CURR long, x array<double>, TARGET int").repartition(1)  # the order of several files differs from run to run
    points = [H.HingeParams(alpha=a, l1_ratio=r, rounds=n) for a, r, n in ((0.001, 0.0, 4), (0.01, 0.15, 7), (0.1, 1.0, 0))]
    jobs, own = [], H._summed
    monkeypatch.setattr(H, "_summed", lambda *args: jobs.append(1) or own(*args))
    together = H.fit_hinges(df, "x", "TARGET", "SK_ID_CURR", points)
    assert len(jobs) == 8  # seven rounds, the last of which is judged in a pass of its own
    for model, params in zip(together, points):
        alone = H.fit_hinge(df, "x", params=params)
        assert np.allclose(model.weights, alone.weights) and abs(model.objective - alone.objective) < 1e-12
    assert not together[2].weights.any() and together[2].objective == 1.0
    with pytest.raises(ValueError):
        H.fit_hinges(df, "x", "TARGET", "SK_ID_CURR", [points[0], H.HingeParams(seed=1)])
