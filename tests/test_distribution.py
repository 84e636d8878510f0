"""Shapiro-Wilk, density and signed-rank against published cases, numpy and enumeration."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import distribution as D

#: Published cases of the test: values, W and p.
MEN = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
FIRST = [0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75, 0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66]
SECOND = [1.36, 1.14, 2.92, 2.55, 1.46, 1.06, 5.27, -1.11, 3.48, 1.10, 0.88, -0.51, 1.46, 0.52, 6.20, 1.69, 0.08, 3.67, 2.81, 3.49]


def frame(spark, **columns):
    n = max(map(len, columns.values()))
    rows = [(i, *(float(v[i]) if i < len(v) and v[i] is not None else None for v in columns.values())) for i in range(n)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in columns)).repartition(3)


def test_normal_functions(spark):
    z = [-8.0, -5.0, -3.5, -2.0, -0.5, 0.0, 1e-3, 1.0, 3.4999, 3.5001, 6.0, 30.0, 60.0]
    rows = frame(spark, z=z).select("z", D.log10_upper_tail(F.col("z")).alias("p")).collect()
    for r in rows:
        want = math.log10(math.erfc(r.z / math.sqrt(2)) / 2) if r.z < 30 else -(r.z**2) / 2 / math.log(10) - math.log10(r.z * math.sqrt(2 * math.pi)) + math.log10(1 - 1 / r.z**2 + 3 / r.z**4)
        assert abs(r.p - want) < 1e-9 * max(1, abs(want)), r
    p = [1e-300, 1e-10, 0.001, 0.02, 0.3, 0.5, 0.77, 0.999, 1 - 1e-9]
    for r in frame(spark, p=p).select("p", D.normal_quantile(F.col("p")).alias("z")).collect():
        assert r.p < 1e-200 or abs(math.erfc(-r.z / math.sqrt(2)) / 2 - r.p) < 1e-12 * max(1, 1 / r.p) * r.p + 1e-15


def test_shapiro_wilk_published_cases(spark):
    df = frame(spark, men=MEN, first=FIRST, second=SECOND, three=[1, 2, 9], flat=[4] * 8, two=[1, 2], none=[None], nan=[float("nan"), 1, 2])
    got = {r.feature: r for r in D.shapiro_wilk(df, df.columns[1:], "id").collect()}
    for name, w, p in (("men", 0.7888146948, 0.006703814), ("first", 0.90047299861, 0.04208974540), ("second", 0.95902691, 0.52459925)):
        assert abs(got[name].w - w) < 2e-6 and abs(10 ** got[name].log10_p - p) < 2e-5
    assert got["flat"].w == 1 and got["flat"].z is None and got["flat"].log10_p == 0
    assert got["two"].w is None and got["two"].log10_p is None and "none" not in got and got["nan"].n == 2
    # Three values: the statistic in closed form.
    assert abs(got["three"].w - ((9 - 1) * math.sqrt(0.5)) ** 2 / sum((v - 4) ** 2 for v in (1, 2, 9))) < 1e-12
    many = spark.range(9000).select("id", F.exp(D.normal_quantile((F.pmod(F.xxhash64("id"), F.lit(99_991)) + 0.5) / 99_991)).alias("x"))
    row = D.shapiro_wilk(many, ["x"], "id").first()
    assert row.n == 5000 and row.log10_p < -50


def test_density_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.append(rng.normal(size=500), rng.normal(4, 0.5, size=200))
    df = frame(spark, x=x.tolist(), flat=[2.0] * 5, gone=[None])
    rows = sorted((r.point, r.x, r.density) for r in D.density_curve(df, ["x", "flat", "gone"], points=120).collect())
    grid = np.linspace(x.min(), x.max(), 120)
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-(((grid[:, None] - x[None, :]) / h) ** 2) / 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert len(rows) == 120 and np.allclose([r[1] for r in rows], grid)
    assert np.abs(np.array([r[2] for r in rows]) - want).max() < 2e-3 * want.max()  # what linear binning costs


def brute_signed_rank(d):
    d = [v for v in d if v]
    size = sorted(map(abs, d))
    rank = {s: np.mean([i + 1 for i, t in enumerate(size) if t == s]) for s in set(size)}
    return sum(rank[abs(v)] for v in d if v > 0), sum(rank[abs(v)] for v in d if v < 0)


@pytest.mark.parametrize("d", [[1.5, -2.5, 3, 4.25, 5, -6.5, 7, 8, 0, 9.5], [1, 1, -1, 2, 2, -3, 0, 0, 5], [0.1 * i * (-1) ** (i // 3) for i in range(1, 80)], [1.0], [0, 0], []])
def test_signed_rank(spark, d):
    df = frame(spark, a=[*d, None], b=[0.0] * len(d) + [1.0]) if d else frame(spark, a=[None], b=[1.0])
    r = D.signed_rank(df, "a", "b").first()
    plus, minus = brute_signed_rank(d)
    assert (r.w_plus, r.w_minus, r.w, r.n) == (plus, minus, min(plus, minus), sum(v != 0 for v in d))
    if 0 < r.n <= 15 and not r.n_ties:
        sums = [sum(c) for k in range(r.n + 1) for c in itertools.combinations(range(1, r.n + 1), k)]
        assert r.exact and abs(10**r.log10_p - min(1, 2 * np.mean(np.array(sums) <= r.w))) < 1e-9
    elif r.n:
        size = [abs(v) for v in d if v]
        ties = sum(size.count(s) ** 3 - size.count(s) for s in set(size))
        z = (r.w - r.n * (r.n + 1) / 4) / math.sqrt(r.n * (r.n + 1) * (2 * r.n + 1) / 24 - ties / 48)
        assert not r.exact and abs(r.z - z) < 1e-9 and abs(10**r.log10_p - math.erfc(abs(z) / math.sqrt(2))) < 1e-9
    else:
        assert r.log10_p is None and r.w == 0
