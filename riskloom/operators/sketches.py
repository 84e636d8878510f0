"""Mergeable column sketches: one pass per part of a table, then profiles and drift from the sketches alone.

``column_sketches`` keeps, for each part (a day, a file, a split) and column, the rows, the nulls, the extremes, a
HyperLogLog sketch of the distinct values and a KLL sketch of the quantiles.  Both merge without loss of their error
bounds, so a new part is one more set of rows, and the profile of any union of parts never reads the data again.
A sketch is a few kilobytes whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS = 12
KLL_K = 400


def column_sketches(df: DataFrame, columns: Sequence[str], part: Column | str | None = None) -> DataFrame:
    """(part, feature, n_rows, n_null, lo, hi, distinct_sketch, quantile_sketch) of numeric columns.

    Null and not-a-number values count as null and enter no sketch; a column without values has null sketches.
    """
    of = F.lit("all") if part is None else (F.col(part) if isinstance(part, str) else part).cast("string")
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    rows = df.select(of.alias("part"), F.inline(pairs))
    value = F.when(~F.isnan("value"), F.col("value") + F.lit(0.0))  # either zero is one value
    rows = rows.select("part", "feature", value.alias("value"))
    known = F.count("value") > 0
    return rows.groupBy("part", "feature").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_null"),
        F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.when(known, F.hll_sketch_agg(F.when(F.col("value").isNotNull(), F.xxhash64("value")), F.lit(HLL_BITS))).alias("distinct_sketch"),
        F.when(known, F.kll_sketch_agg_double("value", F.lit(KLL_K))).alias("quantile_sketch"),
    )


def merged(sketches: DataFrame, parts: Sequence[str] | None = None) -> DataFrame:
    """(feature, n_rows, n_null, lo, hi, distinct_sketch, quantile_sketch) of the union of ``parts`` (all if None)."""
    rows = sketches if parts is None else sketches.where(F.col("part").isin(*parts))
    known = F.count("quantile_sketch") > 0
    return rows.groupBy("feature").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.when(known, F.hll_union_agg("distinct_sketch")).alias("distinct_sketch"),
        F.when(known, F.kll_merge_agg_double("quantile_sketch")).alias("quantile_sketch"),
    )


def sketch_profile(merged_sketches: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(feature, n_rows, null_rate, n_distinct, lo, hi, quantiles) from merged sketches."""
    known = F.col("quantile_sketch").isNotNull()
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(s))) for s in shares])
    return merged_sketches.select(
        "feature", F.col("n_rows").cast("long").alias("n_rows"), (F.col("n_null") / F.col("n_rows")).alias("null_rate"),
        F.when(known, F.hll_sketch_estimate("distinct_sketch")).otherwise(0).alias("n_distinct"), "lo", "hi", F.when(known, quantiles).alias("quantiles"),
    )


def sketch_drift(reference: DataFrame, target: DataFrame, buckets: int = 10, floor: float = 1e-6) -> DataFrame:
    """(feature, psi): population stability of merged ``target`` sketches against merged ``reference`` sketches.

    Edges are the reference's quantiles; both sides' shares between edges are differences of the sketches' ranks.  Shares
    are raised to ``floor`` before the logarithm.  A feature without values on either side has a null psi.
    """
    quantiles = F.kll_sketch_get_quantile_double("quantile_sketch", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]))
    # ``buckets`` - 1 numbers a feature; Spark asks for ranks of literals.
    edges = {r["feature"]: sorted(set(r["edges"])) for r in reference.where(F.col("quantile_sketch").isNotNull()).select("feature", quantiles.alias("edges")).collect()}
    both = reference.select("feature", F.col("quantile_sketch").alias("r")).join(target.select("feature", F.col("quantile_sketch").alias("t")), "feature")

    def shares(side: str) -> Column:
        ranks = F.lit(None).cast("array<double>")
        for feature, own in edges.items():
            ranks = F.when(F.col("feature") == feature, F.kll_sketch_get_rank_double(side, F.array(*map(F.lit, own)))).otherwise(ranks)
        upto = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
        return F.transform(F.sequence(F.lit(1), F.size(upto) - 1), lambda i: F.greatest(F.lit(floor), F.get(upto, i) - F.get(upto, i - 1)))

    known = both.where(F.col("r").isNotNull() & F.col("t").isNotNull())
    terms = F.zip_with(shares("t"), shares("r"), lambda t, r: (t - r) * F.log(t / r))
    psi = known.select("feature", F.aggregate(terms, F.lit(0.0), lambda s, v: s + v).alias("psi"))
    return both.select("feature").join(psi, "feature", "left")
