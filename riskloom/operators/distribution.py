"""Distribution tests and curves: Shapiro-Wilk, kernel density, general signed-rank.

All three are sums over an ordered or binned long form (feature, value), so Spark does the counting and ordering and
what is left are closed forms.  Normal quantiles and tail probabilities are Column expressions; tails are given as
log10, so that a probability below the smallest double still tells how small it is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .ordered import ordered_scan

# Rational approximation of the normal quantile (Wichura, algorithm AS 241, 16 digits),
# coefficients of ascending powers for the centre, the shoulder and the tail: numerator, denominator.
_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
_SHOULDER = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)
# Weights and p-values of the Shapiro-Wilk test (Royston 1995, algorithm AS R94),
# coefficients of ascending powers.
_A_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_A_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_SMALL_G = (-2.273, 0.459)
_SMALL_MEAN = (0.5440, -0.39978, 0.025054, -6.714e-4)
_SMALL_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
_LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
_LARGE_SD = (-0.4803, -0.082676, 0.0030302)


def _poly(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column) -> Column:
    """The standard normal quantile of p in (0, 1)."""
    q = p - 0.5
    r = F.lit(0.180625) - q * q
    tail = F.sqrt(-F.log(F.when(q < 0, p).otherwise(1 - p)))
    centre = q * _poly(_CENTRE[0], r) / _poly(_CENTRE[1], r)
    shoulder = _poly(_SHOULDER[0], tail - 1.6) / _poly(_SHOULDER[1], tail - 1.6)
    far = _poly(_TAIL[0], tail - 5.0) / _poly(_TAIL[1], tail - 5.0)
    outer = F.when(tail <= 5, shoulder).otherwise(far) * F.when(q < 0, -1.0).otherwise(1.0)
    return F.when(F.abs(q) <= 0.425, centre).otherwise(outer)


def _fraction(z: Column, terms: int) -> Column:
    """z + 1/(z + 2/(z + 3/(z + ...)))."""
    out = z
    for k in range(terms, 0, -1):
        out = z + F.lit(float(k)) / out
    return out


def log10_upper_tail(z: Column) -> Column:
    """log10 of the probability that a standard normal exceeds z.

    Below 3.5 by the series of the distribution function around 0, above by its continued fraction; the error is below
    1e-9 of the probability.
    """
    density = F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    # x + x^3/3 + x^5/(3 5) + ... up to where 3.5 leaves nothing.
    term, total = z, z
    step = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(term.alias("t"), total.alias("s")), lambda a, k: F.struct((a["t"] * z * z / (2 * k + 1)).alias("t"), (a["s"] + a["t"] * z * z / (2 * k + 1)).alias("s")), lambda a: a["s"])
    inner = 0.5 - density * step
    outer = -(z * z) / (2 * math.log(10)) - math.log10(math.sqrt(2 * math.pi)) - F.log10(_fraction(z, 60))
    low = F.log10(1 - F.exp(-(z * z) / 2) / math.sqrt(2 * math.pi) / _fraction(-z, 60))
    return F.when(z > 3.5, outer).when(z < -3.5, low).otherwise(F.log10(inner))


def long_form(df: DataFrame, features: Sequence[str], key: Sequence[str] = ()) -> DataFrame:
    """(key, feature, value) of the finite values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    rows = df.select(*key, F.inline(pairs))
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")))


def shapiro_wilk(df: DataFrame, features: Sequence[str], key: str, sample: int = 5000, seed: int = 42) -> DataFrame:
    """(feature, n, w, z, log10_p): the Shapiro-Wilk test of each feature.

    The test is defined for 3 to 5000 values, so of a feature with more the ``sample`` rows with the smallest hashes of
    their key are taken.  A constant feature has w = 1 and no z.  Fewer than three values give nulls.
    """
    rows = long_form(df, features, [key])
    chance = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed)))
    order = Window.partitionBy("feature").orderBy("_h", key)
    drawn = rows.withColumn("_h", chance).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= sample).select("feature", key, "value")
    drawn = scratch_table(drawn, "shapiro")
    sizes = drawn.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    ranked = ordered_scan(drawn, ["feature"], [F.col("value"), F.col(key)], rank_col="i")
    # One row per feature.
    at = ranked.join(F.broadcast(sizes), "feature").withColumn("m", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)))
    at = scratch_table(at, "shapiro-ranked")
    last = [F.max(F.when(F.col("i") == F.col("n") - k, F.col("m"))).alias(f"m{k}") for k in (0, 1)]
    weights = at.groupBy("feature", "n").agg(F.sum(F.col("m") * F.col("m")).alias("mm"), *last)
    u = 1 / F.sqrt("n")
    a0 = F.when(F.col("n") == 3, F.lit(math.sqrt(0.5))).otherwise(_poly(_A_LAST, u) + F.col("m0") / F.sqrt("mm"))
    a1 = F.when(F.col("n") > 5, _poly(_A_NEXT, u) + F.col("m1") / F.sqrt("mm"))
    weights = weights.withColumn("a0", a0).withColumn("a1", a1)
    many = (F.col("mm") - 2 * F.col("m0") ** 2 - 2 * F.col("m1") ** 2) / (1 - 2 * F.col("a0") ** 2 - 2 * F.col("a1") ** 2)
    few = (F.col("mm") - 2 * F.col("m0") ** 2) / (1 - 2 * F.col("a0") ** 2)
    weights = weights.withColumn("phi", F.when(F.col("n") > 5, many).when(F.col("n") > 3, few)).select("feature", "a0", "a1", "phi")
    side = F.least(F.col("i") - 1, F.col("n") - F.col("i"))
    size = F.when(side == 0, F.col("a0")).when((side == 1) & (F.col("n") > 5), F.col("a1")).when(F.col("n") == 3, 0.0).otherwise(F.abs("m") / F.sqrt("phi"))
    signed = F.when(2 * F.col("i") < F.col("n") + 1, -size).when(2 * F.col("i") > F.col("n") + 1, size).otherwise(0.0)
    centred = F.col("value") - F.col("mean")
    sums = at.join(F.broadcast(weights), "feature").groupBy("feature", "n", "lo", "hi").agg(F.sum(signed * centred).alias("b"), F.sum(centred * centred).alias("ss"))
    w = F.when(F.col("n") < 3, None).when(F.col("lo") == F.col("hi"), 1.0).otherwise(F.least(F.lit(1.0), F.col("b") * F.col("b") / F.col("ss")))
    out = sums.select("feature", F.col("n").cast("long").alias("n"), w.alias("w"))
    n, ln = F.col("n").cast("double"), F.log(F.col("n").cast("double"))
    small = (-F.log(_poly(_SMALL_G, n) - F.log(1 - F.col("w"))) - _poly(_SMALL_MEAN, n)) / F.exp(_poly(_SMALL_SD, n))
    large = (F.log(1 - F.col("w")) - _poly(_LARGE_MEAN, ln)) / F.exp(_poly(_LARGE_SD, ln))
    z = F.when((F.col("w") < 1) & (F.col("n") > 3), F.when(F.col("n") <= 11, small).otherwise(large))
    # Three values have an exact distribution.
    three = F.log10(F.greatest(F.lit(1e-300), 6 / math.pi * (F.asin(F.sqrt("w")) - math.asin(math.sqrt(0.75)))))
    p = F.when(F.col("w") == 1, 0.0).when(F.col("n") == 3, three).otherwise(log10_upper_tail(F.col("z")))
    return out.withColumn("z", z).withColumn("log10_p", F.when(F.col("n") >= 3, p))


def ks_normal(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n, statistic, log10_p): the Kolmogorov-Smirnov test of each feature, all rows, against the standard normal.

    Repeated values become one with their number; an ordered scan over the different values of all features counts what
    lies below each, and the statistic is the greatest distance on either side of a step.  p is the limiting
    distribution with Stephens' correction for n.
    """
    counts = long_form(df, features).groupBy("feature", (F.col("value") + F.lit(0.0)).alias("value")).agg(F.count(F.lit(1)).cast("double").alias("t"))
    ranked = ordered_scan(counts, ["feature"], [F.col("value")], sum_cols=["t"], rank_col="_r")
    ranked = scratch_table(ranked, "ks")
    sizes = ranked.groupBy("feature").agg(F.sum("t").alias("n"))  # one row per feature
    low = F.pow(F.lit(10.0), log10_upper_tail(F.col("value")))
    cdf = 1 - low
    upto = F.col("t_running") / F.col("n")
    gap = F.greatest(upto - cdf, cdf - (F.col("t_running") - F.col("t")) / F.col("n"))
    out = ranked.join(F.broadcast(sizes), "feature").groupBy("feature", "n").agg(F.max(gap).alias("statistic"))
    root = F.sqrt("n")
    size = (root + 0.12 + 0.11 / root) * F.col("statistic")
    # The terms after the first, as a share of it: small where the first is.
    rest = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.lit(0.0), lambda s, k: s + F.when(k % 2 == 0, 1.0).otherwise(-1.0) * F.exp(-2 * ((k + 1) * (k + 1) - 1) * size * size))
    p = F.least(F.lit(0.0), math.log10(2) - 2 * size * size / math.log(10) + F.log10(F.greatest(F.lit(1e-300), 1 + rest)))
    return out.select("feature", F.col("n").cast("long").alias("n"), "statistic", F.when(size < 0.2, 0.0).otherwise(p).alias("log10_p"))


def density_curve(df: DataFrame, features: Sequence[str], points: int = 200) -> DataFrame:
    """(feature, point, x, density): a Gaussian kernel density on ``points`` places from the least to the greatest value.

    Every value is shared by its two nearest places in proportion (linear binning), which Spark sums; the curve is the
    convolution of those ``points`` sums with the kernel.  The bandwidth is that of Scott, ``sd n^(-1/5)``.  A feature with
    fewer than two different values has no rows.
    """
    rows = long_form(df, features)
    stats = rows.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("sd"), F.min("value").alias("lo"), F.max("value").alias("hi")).where("hi > lo")
    stats = stats.withColumn("step", (F.col("hi") - F.col("lo")) / (points - 1)).withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = scratch_table(stats, "density")  # one row per feature
    place = (F.col("value") - F.col("lo")) / F.col("step")
    left = F.least(F.floor(place), F.lit(points - 2))
    near = rows.join(F.broadcast(stats), "feature").select("feature", left.alias("at"), (place - left).alias("part"))
    shares = F.explode(F.array(F.struct(F.col("at").alias("at"), (1 - F.col("part")).alias("mass")), F.struct((F.col("at") + 1).alias("at"), F.col("part").alias("mass"))))
    masses = near.select("feature", shares.alias("s")).groupBy("feature", F.col("s.at").cast("int").alias("at")).agg(F.sum("s.mass").alias("mass"))
    grid = masses.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("at", "mass"))).alias("grid"))  # at most ``points`` entries
    curve = grid.join(F.broadcast(stats), "feature").select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    gap = lambda g: (F.col("point") - g["at"]) * F.col("step") / F.col("h")
    total = F.aggregate("grid", F.lit(0.0), lambda s, g: s + g["mass"] * F.exp(-gap(g) * gap(g) / 2))
    density = total / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return curve.select("feature", "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"), density.alias("density"))


def signed_rank(pairs: DataFrame, a: str, b: str, exact_up_to: int = 50) -> DataFrame:
    """One row: n, n_ties, w_plus, w_minus, w, z, log10_p, exact: the Wilcoxon signed-rank test of the differences ``a - b``.

    Zero differences and those with a null are left out.  Equal sizes share the mean of their ranks.  Without ties and with at
    most ``exact_up_to`` differences p is exact, from the number of subsets of the ranks by their sum; else it follows from the normal
    approximation with the variance corrected for ties.  No differences: w = 0 and no p.
    """
    d = F.col(a).cast("double") - F.col(b).cast("double")
    sizes = pairs.select(d.alias("d")).where("d <> 0 AND NOT isnan(d)").groupBy(F.abs("d").alias("size")).agg(F.count_if(F.col("d") > 0).cast("double").alias("pos"), F.count(F.lit(1)).cast("double").alias("t"))
    ranked = ordered_scan(sizes, [], [F.col("size")], sum_cols=["t"], rank_col="_r")
    mid = F.col("t_running") - (F.col("t") - 1) / 2
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0.0)).alias(name)
    sums = ranked.agg(total(F.col("t"), "n"), total(mid * F.col("pos"), "w_plus"), total(mid * (F.col("t") - F.col("pos")), "w_minus"), total(F.col("t") ** 3 - F.col("t"), "tied"), total(F.when(F.col("t") > 1, F.col("t")), "n_ties"))
    n, w = F.col("n"), F.least("w_plus", "w_minus")
    variance = n * (n + 1) * (2 * n + 1) / 24 - F.col("tied") / 48
    z = F.when(variance > 0, (w - n * (n + 1) / 4) / F.sqrt(variance))
    out = sums.withColumn("w", w).withColumn("z", z).withColumn("exact", (F.col("n_ties") == 0) & n.between(1, exact_up_to))
    # Subsets of ranks 1 to i by their sum: those without i and, shifted by i, those with it.
    last = (n * (n + 1) / 2).cast("int")
    empty = F.transform(F.sequence(F.lit(0), last), lambda s: F.when(s == 0, 1.0).otherwise(0.0))
    shifted = lambda c, i: F.slice(F.concat(F.array_repeat(F.lit(0.0), i), c), F.lit(1), last + 1)
    counts = F.aggregate(F.sequence(F.lit(1), n.cast("int")), empty, lambda c, i: F.zip_with(c, shifted(c, i), lambda x, y: x + y))
    below = F.aggregate(F.slice(counts, F.lit(1), w.cast("int") + 1), F.lit(0.0), lambda s, x: s + x)
    exact = F.least(F.lit(0.0), F.log10(2 * below) - n * math.log10(2))
    normal = F.least(F.lit(0.0), log10_upper_tail(-F.col("z")) + math.log10(2))
    p = F.when(F.col("exact"), exact).when(F.col("z").isNotNull(), normal)
    return out.select(n.cast("long").alias("n"), F.col("n_ties").cast("long").alias("n_ties"), "w_plus", "w_minus", "w", "z", p.alias("log10_p"), "exact")
