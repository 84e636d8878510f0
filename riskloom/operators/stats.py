"""Exploratory statistics as Spark aggregates (single pass wherever possible).

* correlations (pairwise complete) and moments (skewness, kurtosis, Jarque-Bera):
  the columns are unpivoted with ``stack`` and reduced by one aggregate grouped by
  feature (or by column pair), so partial aggregation leaves one row per feature
  per task;
* contingency tables, chi-squared and Cramer's V: the categorical columns are
  unpivoted with a ``Generate`` and counted with partial + final aggregation,
  so only (column, value, class) counts are shuffled -- never the rows;
* histograms: min/max per column (one aggregate, 2 numbers per column brought
  to the driver), then equal-width bins counted in one more aggregate.

Chi-squared p-values use the closed forms of the chi-squared survival function
(even degrees of freedom: a finite Poisson sum; odd: erfc plus a finite sum);
erfc is the Chebyshev fit of Numerical Recipes (fractional error < 1.2e-7).
For a column of degrees of freedom the series runs as a SQL ``aggregate`` over a
``sequence``. Everything is built-in Spark SQL, no UDF.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import sql_ident, sql_str

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def _nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; null (not an ANSI error) when a side is constant."""
    x, y = x.cast("double"), y.cast("double")
    xp = F.when(y.isNotNull(), x)
    yp = F.when(x.isNotNull(), y)
    den = F.stddev_pop(xp) * F.stddev_pop(yp)
    return F.when(den > 0, F.covar_pop(x, y) / den)


def safe_corr_sql(a: str, b: str) -> str:
    """SQL text of :func:`safe_corr` for two column names (one parse JVM-side, no Column tree)."""
    x, y = f"CAST({sql_ident(a)} AS DOUBLE)", f"CAST({sql_ident(b)} AS DOUBLE)"
    den = f"(stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END) * stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END))"
    return f"CASE WHEN {den} > 0 THEN covar_pop({x}, {y}) / {den} END"


# ---------------------------------------------------------------------------
# class balance
# ---------------------------------------------------------------------------


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n_rows, pct): counts and percentage of all rows (nulls are a value)."""
    counts = df.groupBy(F.col(col)).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).first()[0] or 0  # one number
    return counts.select(col, "n_rows", F.try_divide(F.col("n_rows") * 100.0, F.lit(float(total))).alias("pct"))


# ---------------------------------------------------------------------------
# correlations and moments
# ---------------------------------------------------------------------------


def _long_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep.., feature, x): every column unpivoted with ``stack`` inside the scan's pipeline.

    Column statistics run on this long form as one aggregate grouped by feature:
    partial aggregation leaves one row per feature per task, so the shuffle is
    tasks x features rows.  The wide alternative (one aggregate holding several
    functions per column) generates a method too large for the JIT and runs
    several times slower.
    """
    entries = ", ".join(f"{sql_str(c)}, CAST({sql_ident(c)} AS DOUBLE)" for c in cols)
    return df.selectExpr(*keep, f"stack({len(cols)}, {entries}) AS (feature, x)")


def _pack(stats: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One row holding ``key -> struct(fields)`` for a per-key result with at most one row per column.

    A global aggregate always returns a row, so stacking the map back gives every
    column its row even when the input had none (the map is bounded by the column count).
    """
    return stats.agg(F.map_from_entries(F.collect_list(F.struct(key, F.struct(*fields)))).alias("m"))


def _entry(key: str) -> str:
    return f"try_element_at(m, {sql_str(key)})"


def corr_with_target(df: DataFrame, target: str = "TARGET", top_k: int | None = 10) -> DataFrame:
    """(feature, corr, abs_corr): Pearson correlation of every numeric column with ``target``, |r| ranked."""
    cols = numeric_columns(df, exclude=[target])
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, corr double, abs_corr double")
    long = _long_numeric(df, cols, keep=[f"CAST({sql_ident(target)} AS DOUBLE) AS y"])
    per = long.groupBy("feature").agg(F.expr(safe_corr_sql("x", "y")).alias("corr"))
    per = per.select("feature", _nan_to_null(F.col("corr")).alias("corr")).filter(F.col("corr").isNotNull())
    ranked = per.select("feature", "corr", F.abs("corr").alias("abs_corr"))
    if top_k is not None:
        ranked = ranked.orderBy(F.col("abs_corr").desc(), F.col("feature")).limit(top_k)
    return ranked


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, corr) for all ordered pairs; diagonal 1.0.

    The n(n-1)/2 pairs are unpivoted as (pair, x, y) and correlated in one aggregate grouped by pair.
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "feature_a string, feature_b string, corr double")
    entries = ", ".join(f"{sql_str(f'p{i}')}, CAST({sql_ident(a)} AS DOUBLE), CAST({sql_ident(b)} AS DOUBLE)"
                        for i, (a, b) in enumerate(pairs))
    long = df.selectExpr(f"stack({len(pairs)}, {entries}) AS (pair, x, y)")
    per = long.groupBy("pair").agg(F.expr(safe_corr_sql("x", "y")).alias("corr"))
    rows = []
    for i, (a, b) in enumerate(pairs):
        v = f"{_entry(f'p{i}')}.corr"
        rows += [f"{sql_str(a)}, {sql_str(b)}, {v}", f"{sql_str(b)}, {sql_str(a)}, {v}"]
    rows += [f"{sql_str(c)}, {sql_str(c)}, CAST(1.0 AS DOUBLE)" for c in cols]
    out = _pack(per, "pair", ["corr"]).selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (feature_a, feature_b, corr)")
    return out.select("feature_a", "feature_b", _nan_to_null(F.col("corr")).alias("corr"))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, n, skewness, kurtosis, jarque_bera, jb_p_value) per column, one aggregate grouped by feature.

    Skewness is the population (biased) one; kurtosis is excess kurtosis.
    Jarque-Bera = n/6 (S^2 + K^2/4); its chi-squared(2) p-value is exp(-JB/2).
    """
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "feature string, n bigint, skewness double, kurtosis double, jarque_bera double, jb_p_value double")
    per = _long_numeric(df, cols).groupBy("feature").agg(
        F.count("x").alias("n"), F.skewness("x").alias("s"), F.kurtosis("x").alias("k"),
        (F.min("x") == F.max("x")).alias("z"),
    )
    rows = ", ".join(
        f"{sql_str(c)}, coalesce({_entry(c)}.n, 0), {_entry(c)}.s, {_entry(c)}.k, {_entry(c)}.z" for c in cols
    )
    long = _pack(per, "feature", ["n", "s", "k", "z"]).selectExpr(
        f"stack({len(cols)}, {rows}) AS (feature, n, skewness, kurtosis, constant)")
    # a constant column has no shape: null, not NaN or rounding noise
    flat = F.coalesce(F.col("constant"), F.lit(True))
    s = F.when(flat, F.lit(None).cast("double")).otherwise(_nan_to_null(F.col("skewness")))
    k = F.when(flat, F.lit(None).cast("double")).otherwise(_nan_to_null(F.col("kurtosis")))
    jb = F.col("n") / 6.0 * (s * s + k * k / 4.0)
    return long.select("feature", "n", s.alias("skewness"), k.alias("kurtosis"), jb.alias("jarque_bera"), F.exp(-jb / 2.0).alias("jb_p_value"))


# ---------------------------------------------------------------------------
# contingency, chi-squared, Cramer's V
# ---------------------------------------------------------------------------


def contingency_long(df: DataFrame, cols: Sequence[str], target: str = "TARGET") -> DataFrame:
    """(feature, value, target, n) for every categorical column; null pairs dropped."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.col(target).alias("target"), F.inline(pairs))
    return (
        long.filter(F.col("value").isNotNull() & F.col("target").isNotNull())
        .groupBy("feature", "value", "target")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _erfc(x: Column) -> Column:
    """Complementary error function (Chebyshev fit, fractional error < 1.2e-7), x >= 0."""
    # Coefficients of the Numerical Recipes erfc fit.
    coef = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
            0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    z = F.abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    poly = F.lit(coef[-1])
    for c in reversed(coef[:-1]):
        poly = poly * t + F.lit(c)
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(2.0 - ans)


def chi2_sf(stat: Column, dof: int) -> Column:
    """Survival function of chi-squared with integer ``dof`` (closed forms)."""
    x = stat
    if dof <= 0:
        return F.lit(None).cast("double")
    half = x / 2.0
    if dof % 2 == 0:
        term = F.lit(1.0)
        total = F.lit(1.0)
        for i in range(1, dof // 2):
            term = term * half / float(i)
            total = total + term
        return F.exp(-half) * total
    base = _erfc(F.sqrt(half))
    if dof == 1:
        return base
    # odd dof = 2m + 1
    term = F.sqrt(2.0 * x / math.pi) * F.exp(-half)
    total = term
    for i in range(1, (dof - 1) // 2):
        term = term * x / float(2 * i + 1)
        total = total + term
    return base + total


def chi2_sf_any(stat: str, dof: str) -> Column:
    """:func:`chi2_sf` for an integer ``dof`` *column*: the finite series run as a JVM-side ``aggregate``.

    Same terms, in the same order, as the fixed-``dof`` form, so no pass over the
    data is needed to learn which degrees of freedom occur.
    """
    x, k = sql_ident(stat), sql_ident(dof)
    h = f"({x} / 2.0D)"

    def series(upper: str, start: str, step: str) -> str:
        idx = f"CASE WHEN {upper} >= 1 THEN sequence(1, {upper}) ELSE CAST(array() AS ARRAY<INT>) END"
        return (f"aggregate({idx}, named_struct('t', {start}, 's', {start}), "
                f"(acc, i) -> named_struct('t', acc.t * {step}, 's', acc.s + acc.t * {step}), acc -> acc.s)")

    even = F.expr(f"exp(-{h}) * {series(f'{k} DIV 2 - 1', '1.0D', f'{h} / CAST(i AS DOUBLE)')}")
    first = f"sqrt(2.0D * {x} / {math.pi!r}D) * exp(-{h})"
    odd_tail = F.expr(series(f"({k} - 1) DIV 2 - 1", first, f"{x} / CAST(2 * i + 1 AS DOUBLE)"))
    base = _erfc(F.sqrt(F.col(stat) / 2.0))
    kc = F.col(dof)
    return (F.when(kc <= 0, F.lit(None).cast("double"))
            .when(kc % 2 == 0, even)
            .when(kc == 1, base)
            .otherwise(base + odd_tail))


def chi2_table(counts: DataFrame, group: Sequence[str], a: str, b: str, yates_dof1: bool = True) -> DataFrame:
    """Per group: n, dof, n_rows, n_cols, chi2 -- from long counts (group..., a, b, n).

    Pearson: sum over *observed* cells of O^2/E minus N (so no r x c grid is built);
    2 x 2 tables (dof 1) use the Yates correction as scipy does by default, over
    their four cells.  All joins are between count tables, never the rows.
    """
    g = list(group)
    rows = counts.groupBy(*g, a).agg(F.sum("n").alias("row_n"))
    cols = counts.groupBy(*g, b).agg(F.sum("n").alias("col_n"))
    dims = rows.groupBy(*g).agg(F.count(F.lit(1)).alias("r"), F.sum("row_n").alias("total")).join(
        cols.groupBy(*g).agg(F.count(F.lit(1)).alias("c")), on=g
    )
    seen = counts.join(rows, on=g + [a]).join(cols, on=g + [b]).join(dims, on=g)
    expected = F.col("row_n") * F.col("col_n") / F.col("total")
    pearson = seen.groupBy(*g).agg(
        (F.sum(F.col("n") * F.col("n") / expected) - F.first("total")).alias("chi2_p"),
        F.first("total").alias("n"), F.first("r").alias("r"), F.first("c").alias("c"),
    )
    out = pearson
    if yates_dof1:
        small = dims.filter((F.col("r") == 2) & (F.col("c") == 2)).select(*g, "total")
        grid = rows.join(small, on=g).join(cols, on=g)  # four cells per 2 x 2 group
        grid = grid.join(counts, on=g + [a, b], how="left")
        e = F.col("row_n") * F.col("col_n") / F.col("total")
        adj = F.greatest(F.abs(F.coalesce(F.col("n"), F.lit(0)) - e) - 0.5, F.lit(0.0))
        yates = grid.groupBy(*g).agg(F.sum(adj * adj / e).alias("chi2_y"))
        out = out.join(yates, on=g, how="left")
    chi2 = F.coalesce(F.col("chi2_y"), F.col("chi2_p")) if yates_dof1 else F.col("chi2_p")
    return out.select(
        *g,
        F.col("n").cast("long").alias("n"),
        ((F.col("r") - 1) * (F.col("c") - 1)).cast("int").alias("dof"),
        F.col("r").cast("int").alias("n_rows"),
        F.col("c").cast("int").alias("n_cols"),
        chi2.alias("chi2"),
    )


def chi2_vs_target(df: DataFrame, cols: Sequence[str], target: str = "TARGET") -> DataFrame:
    """(feature, n, dof, chi2, p_value, chi2_norm) for each categorical column against the target."""
    counts = contingency_long(df, cols, target)
    table = chi2_table(counts, ["feature"], "value", "target")
    scored = table.select("feature", "n", "dof", "chi2", chi2_sf_any("chi2", "dof").alias("p_value"))
    w = Window.partitionBy()  # one row per categorical column: a bounded result
    lo, hi = F.min("chi2").over(w), F.max("chi2").over(w)
    return scored.select("*", F.try_divide(F.col("chi2") - lo, hi - lo).alias("chi2_norm"))


def cramers_v_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, cramers_v) for all ordered pairs; diagonal 1.0; Yates for 2x2.

    Each unordered pair is counted once: the statistic is the same either way round.
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([(c, c, 1.0) for c in cols], "feature_a string, feature_b string, cramers_v double")
    structs = F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                 F.col(a).cast("string").alias("va"), F.col(b).cast("string").alias("vb"))
        for a, b in pairs
    ])
    long = df.select(F.inline(structs)).filter(F.col("va").isNotNull() & F.col("vb").isNotNull())
    counts = long.groupBy("feature_a", "feature_b", "va", "vb").agg(F.count(F.lit(1)).alias("n"))
    table = chi2_table(counts, ["feature_a", "feature_b"], "va", "vb")
    k = F.least(F.col("n_rows"), F.col("n_cols")) - 1
    v = F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * k))
    both = F.explode(F.array(F.struct("feature_a", "feature_b"), F.struct(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"))))
    off = table.select(both.alias("p"), v.alias("cramers_v")).select("p.feature_a", "p.feature_b", "cramers_v")
    diag = spark.createDataFrame([(c, c, 1.0) for c in cols], "feature_a string, feature_b string, cramers_v double")
    return off.unionByName(diag)


def top_categories_by_target(df: DataFrame, col: str, target: str = "TARGET", top_n: int = 10) -> DataFrame:
    """Counts of (category, target) for the ``top_n`` most frequent categories (ties: smaller value first)."""
    top = (
        df.filter(F.col(col).isNotNull())
        .groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.col("_n").desc(), F.col(col)).limit(top_n)
        .select(col)
    )
    kept = df.join(F.broadcast(top), on=col, how="left_semi")  # <= top_n keys
    return kept.groupBy(col, target).agg(F.count(F.lit(1)).alias("n_rows"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """(feature, bin, bin_lo, bin_hi, n_rows): equal-width bins between min and max (last bin closed)."""
    spark = df.sparkSession
    cols = list(cols)
    stats = df.agg(*[a for c in cols for a in (F.min(F.col(c).cast("double")).alias(f"{c}__lo"), F.max(F.col(c).cast("double")).alias(f"{c}__hi"))]).first()
    parts = []
    for c in cols:
        lo, hi = stats[f"{c}__lo"], stats[f"{c}__hi"]
        if lo is None:
            continue
        x = F.col(c).cast("double")
        if hi == lo:
            b = F.lit(0)
        else:
            b = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("int")
        parts.append(F.struct(F.lit(c).alias("feature"), F.when(x.isNotNull(), b).alias("bin"),
                              F.lit(lo).alias("lo"), F.lit(hi).alias("hi")))
    if not parts:
        return spark.createDataFrame([], "feature string, bin int, bin_lo double, bin_hi double, n_rows bigint")
    long = df.select(F.inline(F.array(*parts))).filter(F.col("bin").isNotNull())
    counted = long.groupBy("feature", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n_rows"))
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select(
        "feature", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        "n_rows",
    )


def hash_sample(df: DataFrame, key: str, n: int = 5000, seed: int = 42) -> DataFrame:
    """Deterministic sample of ``n`` rows: smallest md5(key:seed) (a distributed top-n)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")
