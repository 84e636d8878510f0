"""Classifier evaluation as aggregates: confusion matrix, per-class report, ROC, AUC, Wilcoxon.

Running totals over the score order (ROC) use the skew-safe ordered scan:
scores are first collapsed to one row per distinct score (partial + final
aggregate), then range-partitioned, so no single task ever holds all scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from .ordered import ordered_scan


def confusion_matrix(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """(label, prediction, n_rows): 2 x 2 (or k x k) counts."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count(F.lit(1)).alias("n_rows"))


def classification_report(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """(class_label, precision, recall, f1, support) per class plus an 'accuracy' row (class_label null).

    Undefined ratios are 0, as in the usual report.
    """
    cm = confusion_matrix(df, label, pred)
    hit, none = F.when(F.col("label") == F.col("prediction"), F.col("n_rows")).otherwise(0), F.lit(0).cast("long")
    # A cell counts for the class of its label and for that of its prediction; the rollup's total row has the accuracy.
    sides = F.array(
        F.struct(F.col("label").alias("c"), hit.alias("tp"), F.col("n_rows").alias("support"), none.alias("predicted")),
        F.struct(F.col("prediction").alias("c"), none.alias("tp"), none.alias("support"), F.col("n_rows").alias("predicted")),
    )
    per = cm.select(F.inline(sides)).rollup("c").agg(F.grouping("c").alias("total"), *[F.sum(x).alias(x) for x in ("tp", "support", "predicted")])
    ratio = lambda x: F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col(x).cast("double")), F.lit(0.0))
    scored = per.select(F.col("c").cast("string").alias("class_label"), "total", ratio("predicted").alias("precision"), ratio("support").alias("recall"), F.col("support").cast("long").alias("support"))
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    f1 = F.when(F.col("total") == 1, F.col("precision")).otherwise(f1)
    return scored.select("class_label", "precision", "recall", f1.alias("f1"), "support")


def roc_points(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """(threshold, tp, fp, fpr, tpr): one point per distinct score, thresholds descending."""
    per_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("double").alias("neg"),
    )
    per_score = scratch_table(per_score, "scores")
    run = ordered_scan(per_score, [], [F.col("threshold").desc()], sum_cols=["pos", "neg"], rank_col="_i")
    totals = per_score.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()  # two numbers
    P = F.lit(float(totals["P"] or 0.0)).alias("P")
    N = F.lit(float(totals["N"] or 0.0)).alias("N")
    return run.select(
        "threshold",
        F.col("pos_running").alias("tp"),
        F.col("neg_running").alias("fp"),
        F.try_divide(F.col("neg_running"), N).alias("fpr"),
        F.try_divide(F.col("pos_running"), P).alias("tpr"),
        "pos", "neg", P, N,
    )


def roc_curve(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    return roc_points(df, label, score).select("threshold", "tp", "fp", "fpr", "tpr")


def roc_auc(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """Area under the ROC curve (trapezoids; a tie counts 1/2).  One row: auc, n_pos, n_neg."""
    pts = roc_points(df, label, score)
    # each distinct score adds a trapezoid of width neg/N and mean height (tp_before + pos/2)/P
    area = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2.0)
    return pts.agg(
        F.try_divide(F.sum(area), F.first("P") * F.first("N")).alias("auc"),
        F.first("P").cast("long").alias("n_pos"),
        F.first("N").cast("long").alias("n_neg"),
    )


def recall_by_split(df: DataFrame, split: str = "split", label: str = "y", pred: str = "pred", positive: int = 1) -> DataFrame:
    """(split, recall) of the positive class for each split (train/test gap check)."""
    pos = df.filter(F.col(label) == positive)
    return pos.groupBy(split).agg(F.avg(F.when(F.col(pred) == positive, 1.0).otherwise(0.0)).alias("recall"))


def wilcoxon_paired(a: DataFrame, b: DataFrame, key: str, flag: str) -> DataFrame:
    """Signed-rank test of two 0/1 flag vectors paired by position (each ordered by ``key``).

    Differences are in {-1, 0, 1}; zeros are dropped, so with n = n+ + n- every
    rank is (n + 1)/2 and W = min(n+, n-) (n + 1)/2.  z uses the normal
    approximation with the tie correction for one tie group of size n.
    """
    ra = ordered_scan(a.select(key, F.col(flag).alias("fa")), [], [F.col(key)], rank_col="pos")
    rb = ordered_scan(b.select(key, F.col(flag).alias("fb")), [], [F.col(key)], rank_col="pos")
    paired = ra.select("pos", "fa").join(rb.select("pos", "fb"), "pos", "inner")  # truncates to the shorter side
    d = F.col("fa") - F.col("fb")
    counts = paired.agg(F.count_if(d > 0).alias("n_pos"), F.count_if(d < 0).alias("n_neg"))
    n = F.col("n_pos") + F.col("n_neg")
    nd = n.cast("double")
    w = F.least(F.col("n_pos"), F.col("n_neg")) * (nd + 1) / 2.0
    mu = nd * (nd + 1) / 4.0
    var = nd * (nd + 1) * (2 * nd + 1) / 24.0 - (nd * nd * nd - nd) / 48.0
    return counts.select(
        F.col("n_pos").cast("long").alias("n_pos"),
        F.col("n_neg").cast("long").alias("n_neg"),
        n.cast("long").alias("n"),
        w.alias("w"),
        F.when(var > 0, (w - mu) / F.sqrt(var)).alias("z"),
    )


def evaluation_report(df: DataFrame, label: str = "y", pred: str = "pred", score: str = "score") -> DataFrame:
    """Long (metric, class_label, value) rows: confusion counts, per-class report, accuracy, AUC."""
    cm = confusion_matrix(df, label, pred).select(
        F.concat(F.lit("count_pred_"), F.col("prediction").cast("string")).alias("metric"),
        F.col("label").cast("string").alias("class_label"),
        F.col("n_rows").cast("double").alias("value"),
    )
    rep = classification_report(df, label, pred)
    stacked = rep.selectExpr(
        "stack(4, 'precision', class_label, precision, 'recall', class_label, recall, "
        "'f1', class_label, f1, 'support', class_label, CAST(support AS DOUBLE)) AS (metric, class_label, value)"
    )
    auc = roc_auc(df, label, score).select(F.lit("auc").alias("metric"), F.lit(None).cast("string").alias("class_label"), F.col("auc").alias("value"))
    return cm.unionByName(stacked).unionByName(auc)
