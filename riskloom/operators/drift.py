"""Population-stability (PSI) drift between a reference and a target table.

All candidate columns are handled in one pass per step, never in a driver loop:

* quantile edges of every column: one ``approxQuantile`` job (GK sketches merged
  across partitions, bounded memory), or -- when ``relative_error == 0`` -- exact
  order statistics from the skew-safe distributed sort in :mod:`.ordered`;
* the edges (at most ``buckets + 1`` per column) are the only thing brought to
  the driver; they become constant-folded ``CASE`` ladders;
* both sides are tagged, bucketed for all columns at once (a ``Generate`` of
  (feature, bucket) pairs) and counted with one partial + final hash aggregate,
  so the shuffle carries at most (partitions x features x buckets) rows;
* shares, the floored log-ratio terms and their sum per feature are computed on
  that small aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import PSI_FLOOR, psi_term, sql_ident, sql_str
from .ordered import ordered_scan

# Drift candidate prefixes, bucket count, alert levels.
DRIFT_PREFIXES = ("AMT_", "DAYS_", "EXT_SOURCE_", "REGION_", "CNT_", "OBS_", "DEF_")
PSI_BUCKETS = 10
PSI_WARN = 0.1
PSI_ALERT = 0.25
DEFAULT_RELATIVE_ERROR = 0.001

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def drift_candidates(reference: DataFrame, target: DataFrame, prefixes: Sequence[str] = DRIFT_PREFIXES, limit: int | None = None) -> list[str]:
    """Numeric columns named with a drift prefix and present on both sides; all of them unless ``limit`` says how many."""
    tgt = set(target.columns)
    cols = [
        f.name
        for f in reference.schema.fields
        if f.name.startswith(tuple(prefixes)) and f.name in tgt and isinstance(f.dataType, _NUMERIC)
    ]
    return cols[:limit]


def probabilities(buckets: int = PSI_BUCKETS) -> list[float]:
    return [i / buckets for i in range(buckets + 1)]


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(F.inline(pairs))


def quantile_edges(df: DataFrame, cols: Sequence[str], buckets: int = PSI_BUCKETS, relative_error: float = DEFAULT_RELATIVE_ERROR) -> DataFrame:
    """(feature, q_index, p, value): quantiles at 0, 1/buckets, ..., 1 of each column (nulls ignored).

    Exact definition (``relative_error == 0``): the value of rank ``max(1, ceil(p * n))``.
    """
    spark = df.sparkSession
    ps = probabilities(buckets)
    schema = "feature string, q_index int, p double, value double"
    if not cols:
        return spark.createDataFrame([], schema)
    if relative_error > 0:
        qs = df.approxQuantile(list(cols), ps, relative_error)
        rows = [(c, i, p, float(v)) for c, vals in zip(cols, qs) for i, (p, v) in enumerate(zip(ps, vals))]
        return spark.createDataFrame(rows, schema)
    values = _long_values(df, cols).filter(F.col("value").isNotNull())
    # Order statistics need cumulative counts, not a rank per row: repeated values are
    # collapsed first (partial aggregation), and the skew-safe ordered scan runs over the
    # distinct (feature, value) pairs, which is unique and so needs no tie-break.
    distinct = values.groupBy("feature", "value").agg(F.count(F.lit(1)).cast("double").alias("cnt"))
    cum = ordered_scan(distinct, ["feature"], [F.col("value")], sum_cols=["cnt"], rank_col="_pos")
    cum = cum.select("feature", "value", F.col("cnt").cast("long").alias("cnt"), F.col("cnt_running").cast("long").alias("upto"))
    counts = cum.groupBy("feature").agg(F.max("upto").alias("n"))  # from the frozen scan: no second pass
    grid = F.array(*[F.struct(F.lit(i).alias("q_index"), F.lit(p).alias("p")) for i, p in enumerate(ps)])
    # features x probabilities: a bounded table (<= 50 x (buckets+1) rows)
    targets = counts.select("feature", "n", F.inline(grid)).select(
        F.col("feature").alias("t_feature"), "q_index", "p",
        F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("n"))).cast("long").alias("rank"),
    )
    # the value whose cumulative-count interval (upto - cnt, upto] holds the target rank
    hit = (F.col("feature") == F.col("t_feature")) & (F.col("upto") - F.col("cnt") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
    return cum.join(F.broadcast(targets), hit, "inner").select("feature", "q_index", "p", "value")


def _edges_by_feature(edges: DataFrame) -> dict[str, list[float]]:
    out: dict[str, set] = {}
    for r in edges.collect():  # bounded: features x (buckets + 1)
        if r["value"] is not None and not math.isnan(r["value"]):
            out.setdefault(r["feature"], set()).add(r["value"])
    return {k: sorted(v) for k, v in out.items()}


@dataclass
class ReferenceProfile:
    """Everything PSI needs from the reference side: interior edges and bucket counts.

    Small by construction: at most ``features x (buckets + 2)`` count rows.
    """

    cols: list[str]
    interior: dict[str, list[float]]
    counts: DataFrame  # (feature, bucket, ref_count)


def _double_sql(v: float) -> str:
    """Exact SQL double literal (shortest round-trip text)."""
    if math.isinf(v):
        return "CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"{float(v)!r}D"


def bucket_label_sql(ident: str, edges: Sequence[float]) -> str:
    """SQL text of :func:`bucket_label` (same ladder: null -> 'missing', first ``x <= edge`` -> 'b{i}')."""
    whens = " ".join(f"WHEN {ident} <= {_double_sql(e)} THEN 'b{i}'" for i, e in enumerate(edges))
    return f"CASE WHEN {ident} IS NULL THEN 'missing' {whens} ELSE 'b{len(edges)}' END"


def _bucketed(df: DataFrame, interior: dict[str, list[float]]) -> DataFrame:
    """(feature, bucket) for every row and feature: one ``stack`` sent as SQL text."""
    entries = ", ".join(f"{sql_str(f)}, {bucket_label_sql(sql_ident(f), edges)}" for f, edges in interior.items())
    return df.selectExpr(f"stack({len(interior)}, {entries}) AS (feature, bucket)")


def reference_profile(reference: DataFrame, cols: Sequence[str], buckets: int = PSI_BUCKETS,
                      relative_error: float = DEFAULT_RELATIVE_ERROR) -> ReferenceProfile:
    edges = _edges_by_feature(quantile_edges(reference, cols, buckets, relative_error))
    interior = {c: edges[c][1:-1] for c in cols if len(edges.get(c, [])) >= 3}
    if interior:
        counts = _bucketed(reference, interior).groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("ref_count"))
    else:
        counts = reference.sparkSession.createDataFrame([], "feature string, bucket string, ref_count bigint")
    return ReferenceProfile(list(cols), interior, counts)


def bucket_counts(reference: DataFrame, target: DataFrame, interior: dict[str, list[float]]) -> DataFrame:
    """(feature, bucket, ref_count, tgt_count) for every feature with interior edges; one aggregate."""
    def tagged(df: DataFrame, side: int) -> DataFrame:
        return _bucketed(df, interior).select(F.lit(side).alias("side"), "feature", "bucket")

    both = tagged(reference, 0).unionByName(tagged(target, 1))
    return both.groupBy("feature", "bucket").agg(
        F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).alias("ref_count"),
        F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).alias("tgt_count"),
    )


def _terms(counts: DataFrame) -> DataFrame:
    w_tot = counts.groupBy("feature").agg(F.sum("ref_count").alias("ref_total"), F.sum("tgt_count").alias("tgt_total"))
    shares = counts.join(w_tot, "feature").select(
        "feature",
        "bucket",
        F.try_divide(F.col("ref_count").cast("double"), F.col("ref_total").cast("double")).alias("ref_share"),
        F.try_divide(F.col("tgt_count").cast("double"), F.col("tgt_total").cast("double")).alias("tgt_share"),
        ((F.col("ref_total") > 0) & (F.col("tgt_total") > 0)).alias("both_sides"),
    )
    return shares.select(
        "feature", "bucket", "ref_share", "tgt_share",
        F.when(F.col("both_sides"), psi_term(F.col("tgt_share"), F.col("ref_share"), PSI_FLOOR)).otherwise(F.lit(0.0)).alias("psi_term"),
    )


def psi_buckets(reference: DataFrame, target: DataFrame, cols: Sequence[str] | None = None, buckets: int = PSI_BUCKETS,
                relative_error: float = DEFAULT_RELATIVE_ERROR) -> DataFrame:
    """Per (feature, bucket): shares on each side and the PSI term.  Features with < 3 boundaries are absent."""
    spark = reference.sparkSession
    cols = list(cols) if cols is not None else drift_candidates(reference, target)
    schema = "feature string, bucket string, ref_share double, tgt_share double, psi_term double"
    edges = _edges_by_feature(quantile_edges(reference, cols, buckets, relative_error))
    interior = {c: edges[c][1:-1] for c in cols if len(edges.get(c, [])) >= 3}
    if not interior:
        return spark.createDataFrame([], schema)
    return _terms(bucket_counts(reference, target, interior))


def psi_from_profile(profile: ReferenceProfile, target: DataFrame) -> DataFrame:
    """(feature, psi) of a target table against a stored reference profile."""
    spark = target.sparkSession
    names = spark.createDataFrame([(c,) for c in profile.cols], "feature string")
    if not profile.interior:
        return names.select("feature", F.lit(0.0).alias("psi"))
    tgt = _bucketed(target, profile.interior).groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("tgt_count"))
    counts = profile.counts.join(tgt, ["feature", "bucket"], "full_outer").select(
        "feature", "bucket", F.coalesce("ref_count", F.lit(0)).alias("ref_count"), F.coalesce("tgt_count", F.lit(0)).alias("tgt_count")
    )
    summed = _terms(counts).groupBy("feature").agg(F.sum("psi_term").alias("psi"))
    return names.join(summed, "feature", "left").select("feature", F.coalesce(F.col("psi"), F.lit(0.0)).alias("psi"))


def psi_report(reference: DataFrame, target: DataFrame, cols: Sequence[str] | None = None, buckets: int = PSI_BUCKETS,
               relative_error: float = DEFAULT_RELATIVE_ERROR) -> DataFrame:
    """(feature, psi) for every candidate column; 0.0 when a side is empty or edges collapse."""
    spark = reference.sparkSession
    cols = list(cols) if cols is not None else drift_candidates(reference, target)
    if not cols:
        return spark.createDataFrame([], "feature string, psi double")
    terms = psi_buckets(reference, target, cols, buckets, relative_error)
    summed = terms.groupBy("feature").agg(F.sum("psi_term").alias("psi"))
    names = spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature string, col_order int")
    return (
        names.join(summed, "feature", "left")
        .select("feature", F.coalesce(F.col("psi"), F.lit(0.0)).alias("psi"))
    )


def psi_status(report: DataFrame, warn: float = PSI_WARN, alert: float = PSI_ALERT) -> DataFrame:
    """Adds ``status``: stable / warn / alert."""
    return report.select(
        "feature",
        "psi",
        F.when(F.col("psi") >= alert, "alert").when(F.col("psi") >= warn, "warn").otherwise("stable").alias("status"),
    )
