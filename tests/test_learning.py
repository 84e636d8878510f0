"""Neighbours, oversampling, boosting, the network and the hinge classifier against brute force and differences."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting as B
from riskloom.operators import hinge as H
from riskloom.operators import network as N
from riskloom.operators.neighbours import _closest, nearest_neighbours
from riskloom.operators.oversampling import oversample, synthetic_rows


def brute_neighbours(rows, k):
    out = {}
    for key, x in rows:
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))), other) for other, y in rows if other != key)
        out[key] = near[:k]
    return out


@pytest.mark.parametrize("kind", ["spread", "copies", "line", "few"])
def test_neighbours_equal_brute_force(spark, kind):
    rng = random.Random(kind)
    n = {"few": 4}.get(kind, 400)
    rows = [(i * 3, [round(rng.gauss(0, 1), 3) for _ in range(3)]) for i in range(n)]
    if kind == "copies":  # a third of the rows are one vector, others come in pairs
        rows = [(key, [0.5, 0.5, -0.0 if key % 2 else 0.0]) if key % 9 < 3 else (key, rows[i // 2][1]) for i, (key, _) in enumerate(rows)]
    if kind == "line":
        rows = [(key, [float(key), 0.0, 0.0]) for key, _ in rows]
    odd = [(None, [1.0, 2.0, 3.0]), (10_000, None), (10_001, [1.0, None, 2.0]), (10_002, [float("nan"), 0.0, 0.0]), (10_003, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(rows + odd, "id long, v array<double>").repartition(3)
    got = {r.key: [(n.distance, n.id) for n in r.neighbours] for r in nearest_neighbours(df, "id", "v", 5, max_pivots=16, ring_rows=20, part_rows=30).collect()}
    want = brute_neighbours(rows, 5)
    assert got.keys() == want.keys()
    for key in want:
        assert [i for _, i in got[key]] == [i for _, i in want[key]], key
        assert np.allclose([d for d, _ in got[key]], [d for d, _ in want[key]])
    assert nearest_neighbours(df.where("id = -1"), "id", "v", 5).count() == 0


def test_rings_answer_within_the_ball_only():
    rng = np.random.default_rng(5)
    points, ids = rng.normal(size=(300, 4)).round(1), np.arange(300)
    want = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    ball = np.array([0.0, 0.65, 1.05, np.inf] * 75)  # no distance of tenths is on the edge
    for q, found in enumerate(_closest(points, ids, points, ids, 5, ball)):
        near = sorted((d, i) for i, d in enumerate(want[q]) if i != q and d <= ball[q] + 1e-9)[:5]
        assert len(found) == len(near) and np.allclose([d for d, _ in found], [d for d, _ in near])
    assert [len(f) for f in _closest(points[:1], ids[:1], points, ids, 5)] == [5]


def test_only_the_nearest_are_summed_column_by_column(monkeypatch):
    from riskloom.operators import neighbours as NB

    rng = np.random.default_rng(6)
    for shift, scale in ((0.0, 1.0), (1e6, 1.0), (0.0, 1e200), (3.0, 1e-9)):  # rounding of the product, and its overflow
        points, ids = shift + scale * rng.integers(0, 4, (200, 5)), rng.permutation(200)
        with np.errstate(over="ignore"):
            want = NB._distances(points, points)
        with monkeypatch.context() as m:
            m.setattr(NB, "_distances", None)  # all pairs of a ring were summed by it
            found = _closest(points, ids, points, ids, 5)
        for q, near in enumerate(found):
            assert near == sorted((d, i) for d, i in zip(want[q].tolist(), ids.tolist()) if i != ids[q] and d < np.inf)[:5]


def test_neighbours_form_few_pairs(spark):
    df = spark.range(6000).select(F.col("id"), F.array(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1_000_000)) / 1e6) for i in range(2)]).alias("v"))
    from riskloom.operators import neighbours as NB

    seen = []
    own = NB._answers

    def counted(asked, rings, k, part_rows):
        seen.append(asked.count())
        return own(asked, rings, k, part_rows)

    NB._answers = counted
    try:
        assert nearest_neighbours(df, "id", "v", 5, ring_rows=128).count() == 6000
    finally:
        NB._answers = own
    # Each point asks a few rings of the 47 or more there are.
    assert seen[0] < 6000 * 6


def _marked(rng, n, numbers=6):
    """Vectors of normal numbers and two groups of marks, of which one each is set."""
    return np.column_stack([rng.normal(size=(n, numbers)), np.eye(5)[rng.integers(0, 5, n)], np.eye(7)[rng.integers(0, 7, n)]])


def test_points_of_many_columns_ask_a_bounded_number_of_rings(spark, monkeypatch):
    from riskloom.operators import neighbours as NB

    points, seen, own = _marked(np.random.default_rng(9), 1200), [], NB._answers
    monkeypatch.setattr(NB, "_answers", lambda asked, *args: seen.append(asked.count()) or own(asked, *args))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").repartition(3)
    got = {r.key: [n.id for n in r.neighbours] for r in nearest_neighbours(df, "id", "v", 5, ring_rows=16, part_rows=100).collect()}
    want = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(want, np.inf)
    assert got == {i: np.argsort(row, kind="stable")[:5].tolist() for i, row in enumerate(want)}
    # 16 rings of 75 points, though 75 rings of 16 were allowed, nearly all of which lie within reach.
    assert seen[0] <= 15 * 1200


def test_leaves_out_of_reach_are_not_compared(monkeypatch):
    from riskloom.operators import neighbours as NB

    rng = np.random.default_rng(3)
    points, ids = _marked(rng, 3040), rng.permutation(3040)
    points[:40, :6] *= 30  # far from all others
    want = np.sqrt(((points[:, None] - points[None, :, :]) ** 2).sum(axis=2))
    pairs, plain = [], NB._closest_pairs
    monkeypatch.setattr(NB, "_closest_pairs", lambda q, own, x, i, ready, k, ball, some=None: pairs.append(len(q) * len(x if some is None else some)) or plain(q, own, x, i, ready, k, ball, some))
    alone = NB._closest_of_leaves(points, ids, points, ids, 5).to_pylist()
    ball = np.array([f[-1]["distance"] for f in alone])
    asked = NB._closest_of_leaves(points, ids, points, ids, 5, ball).to_pylist()
    for q, (one, two) in enumerate(zip(alone, asked)):
        order = sorted((d, i) for d, i in zip(want[q].tolist(), ids.tolist()) if i != ids[q])[:5]
        assert [n["id"] for n in one] == [n["id"] for n in two] == [i for _, i in order]
    assert sum(pairs) < 0.8 * 2 * len(points) ** 2


def test_oversampling_lies_on_segments_and_evens_the_classes(spark):
    rng = random.Random(4)
    rows = [(i, 1 if i % 7 == 0 else 0, rng.random(), rng.random(), f"c{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double, b double, c string").repartition(5)
    got = synthetic_rows(df, ["a", "b"], k=5).collect()
    small = {i: (a, b) for i, y, a, b, _ in rows if y == 1}
    near = brute_neighbours(list(small.items()), 5)
    assert len(got) == sum(1 - 2 * r[1] for r in rows)
    per_row = np.bincount([r.base for r in got], minlength=300)[list(small)]
    assert per_row.max() - per_row.min() <= 1
    for r in got:
        assert r.TARGET == 1 and 0 <= r.step < 1 and r.neighbour in [i for _, i in near[r.base]]
        for x, y, z in zip(small[r.base], small[r.neighbour], (r.a, r.b)):
            assert abs(x + r.step * (y - x) - z) < 1e-12
    again = synthetic_rows(df.repartition(2), ["a", "b"], k=5).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got)) and len({r.neighbour for r in got}) > 20
    both = oversample(df, ["a", "b"])
    assert {r["TARGET"]: r["count"] for r in both.groupBy("TARGET").count().collect()} == {0: 257, 1: 257}
    assert both.where("synthetic and c is not null").count() == 0 and both.columns == [*df.columns, "synthetic"]
    assert synthetic_rows(df.where("TARGET = 0"), ["a", "b"]).count() == 0
    lonely = df.where("TARGET = 0 OR SK_ID_CURR = 7")
    assert {(r.base, r.neighbour) for r in synthetic_rows(lonely, ["a", "b"]).collect()} == {(7, 7)}


def brute_tree(bins, g, h, params):
    """Leaf-wise growth by trying every threshold of every feature in every leaf, one split after another."""

    def best(rows):
        found, lam = None, params.reg_lambda
        whole = g[rows].sum() ** 2 / (h[rows].sum() + lam)
        for f, missing_left in itertools.product(range(bins.shape[1]), (False, True)):
            for b in range(1, bins.max() + 1):
                left = np.where(bins[rows, f] == 0, missing_left, bins[rows, f] <= b)
                gl, hl, gr, hr = g[rows][left].sum(), h[rows][left].sum(), g[rows][~left].sum(), h[rows][~left].sum()
                if min(hl, hr) < params.min_child_weight:
                    continue
                gain = 0.5 * (gl**2 / (hl + lam) + gr**2 / (hr + lam) - whole)
                if gain > 1e-12 and (found is None or gain > found[0] + 1e-12):
                    found = (gain, rows[left], rows[~left])
        return found

    leaves = [(0, np.arange(len(bins)))]
    options = {0: best(leaves[0][1])}
    while len(leaves) < params.num_leaves:
        able = [(options[n][0], i) for i, (n, _) in enumerate(leaves) if options[n]]
        if not able:
            break
        _, i = max(able)
        node, _ = leaves.pop(i)
        _, left, right = options[node]
        for child, rows in ((2 * node + 1, left), (2 * node + 2, right)):
            leaves.append((child, rows))
            options[child] = best(rows) if (child + 1).bit_length() <= params.max_depth else None
    out = np.zeros(len(bins))
    for _, rows in leaves:
        out[rows] = -params.learning_rate * g[rows].sum() / (h[rows].sum() + params.reg_lambda)
    return out


def test_boosting_equals_brute_force_search(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(scale=0.5, size=240) > 0.6).astype(int)
    x[rng.random((240, 3)) < 0.15] = np.nan
    rows = [(i, int(y[i]), *(None if np.isnan(v) else float(v) for v in x[i])) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, TARGET int, a double, b double, c double").repartition(4)
    edges = [np.quantile(x[~np.isnan(x[:, j]), j], np.arange(1, 8) / 8).tolist() for j in range(3)]
    params = B.BoostingParams(trees=4, learning_rate=0.3, max_depth=3, num_leaves=6, min_child_weight=2.0, scale_pos_weight=2.0, refresh=2)
    model = B.fit_boosting(df, ["a", "b", "c"], params=params, edges=edges)
    bins = np.column_stack([np.where(np.isnan(x[:, j]), 0, 1 + (np.array(edges[j])[None, :] < x[:, j, None]).sum(1)) for j in range(3)]).astype(int)
    raw, w = np.full(240, model.base), np.where(y == 1, 2.0, 1.0)
    for tree in model.trees:
        p = 1 / (1 + np.exp(-raw))
        step = brute_tree(bins, w * (p - y), w * p * (1 - p), params)
        assert np.allclose(tree.scores(bins), step)
        assert len(tree.values) <= 6 and all(s.gain > 0 for s in tree.splits.values())
        raw = raw + step
    got = {r.id: (r.score, r.pred) for r in model.predict(df).collect()}
    assert all(abs(got[i][0] - 1 / (1 + math.exp(-raw[i]))) < 1e-9 and got[i][1] == (raw[i] > 0) for i in range(240))
    with pytest.raises(ValueError):
        B.fit_boosting(df.where("TARGET = 1"), ["a"], edges=[[0.0]])


def test_boosting_makes_no_pass_for_the_deepest_leaves(spark, monkeypatch):
    df = spark.range(300).select(F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("TARGET"), *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)).cast("double").alias(c) for i, c in enumerate("ab", 1)])
    passes, own = [], B._histograms
    monkeypatch.setattr(B, "_histograms", lambda *args: passes.append(args[3]) or own(*args))
    model = B.fit_boosting(df, ["a", "b"], params=B.BoostingParams(trees=2, max_depth=2, num_leaves=4))
    assert len(model.trees) == 2 and passes == [0, 1, 0, 1]
    assert all(len(t.values) == len(t.splits) + 1 and any(v for v in t.values.values()) for t in model.trees)


def test_network_gradient_equals_differences_and_learns(spark):
    rng = np.random.default_rng(1)
    layers = [(a, rng.normal(size=len(b))) for a, b in N.initial_layers(4, (5, 3), 7)]
    x, y, w = rng.normal(size=(9, 4)), rng.integers(0, 2, 9).astype(float), rng.random(9) + 0.5
    _, grads = N.loss_and_gradient(layers, x, y, w)
    values, grad = N.flat(layers), N.flat(grads)
    for i in range(0, len(values), 3):
        up, down = values.copy(), values.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (N.loss_and_gradient(N.shaped(up, layers), x, y, w)[0] - N.loss_and_gradient(N.shaped(down, layers), x, y, w)[0]) / 2e-6
        assert abs(slope - grad[i]) < 1e-5 * max(1, abs(slope))
    x = rng.normal(size=(1500, 3))
    y = ((x[:, 0] * x[:, 1] > 0.3) & (x[:, 2] > -1)).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(1500)], "SK_ID_CURR long, features array<double>, TARGET int").repartition(4)
    total, loss, weight = N.gradient_sums(df.select(F.col("features").alias("x"), F.col("TARGET").alias("y"), F.lit(1.0).alias("weight")), N.initial_layers(3, (8,), 1), 3)
    want_loss, want = N.loss_and_gradient(N.initial_layers(3, (8,), 1), x, y, np.ones(1500))
    assert np.allclose(total, N.flat(want)) and abs(loss - want_loss) < 1e-6 and weight == 1500
    model = N.fit_network(df, "features", params=N.NetworkParams(hidden=(32, 16), epochs=14, batches=4, learning_rate=0.03, patience=14))
    scored = model.predict(df, "features").collect()
    assert model.history[-1][0] < 0.8 * model.history[0][0]
    probability = N.forward(model.layers, x)[-1][:, 0]
    assert all(abs(r.score - probability[r.SK_ID_CURR]) < 1e-9 and r.pred == (r.score > 0.5) for r in scored)
    assert model.history[model.best_epoch][1] == max(r for _, r in model.history)


@pytest.mark.parametrize("ratio", [0.0, 1.0, 0.15])
def test_hinge_objective_is_near_a_reference_solution(spark, ratio):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5))
    y = np.where(x @ np.array([1.5, -2, 0.5, 0, 0]) + 0.3 + rng.normal(scale=1.0, size=800) > 0, 1, -1)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i] > 0)) for i in range(800)], "SK_ID_CURR long, features array<double>, TARGET int").repartition(4)
    params = H.HingeParams(alpha=0.01, l1_ratio=ratio, batch=8)
    model = H.fit_hinge(df, "features", params=params)

    def value(w, b):
        return np.maximum(0, 1 - y * (x @ w + b)).mean() + H.penalty(w, 0.01, ratio)

    # Reference: subgradient descent on all rows with shrinking steps, the best iterate kept.
    w, b, best = np.zeros(5), 0.0, math.inf
    for t in range(1, 20_001):
        open_ = y * (x @ w + b) < 1
        gw = -(y[open_, None] * x[open_]).sum(0) / 800 + 0.01 * (ratio * np.sign(w) + (1 - ratio) * w)
        w, b = w - 0.5 / math.sqrt(t) * gw, b + 0.5 / math.sqrt(t) * y[open_].sum() / 800
        best = min(best, value(w, b)) if t % 20 == 0 else best
    assert abs(model.objective - value(model.weights, model.bias)) < 1e-9
    assert model.objective <= 1.01 * best
    pred = {r.SK_ID_CURR: (r.score, r.pred) for r in model.predict(df, "features").collect()}
    assert all(abs(pred[i][0] - (x[i] @ model.weights + model.bias)) < 1e-9 and pred[i][1] == (pred[i][0] > 0) for i in range(800))
