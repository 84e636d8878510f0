"""Last-row-per-key and linear trend per group.

``last_status`` is the bureau-balance "most recent status": an aggregate
(``max_by``) instead of ``row_number() = 1`` plus a self-join -- no second shuffle,
partial aggregation map-side (sort-based, because its buffer holds text).  Ties on the month are broken by
the larger status (null last), so the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_value_per_key(df: DataFrame, key: str, order_col: str, value_col: str, out_col: str) -> DataFrame:
    """Value of the row with the largest ``order_col`` per key (ties: largest value, null last)."""
    return df.groupBy(key).agg(F.max_by(F.col(value_col), F.struct(F.col(order_col), F.col(value_col))).alias(out_col))


def last_status_per_key(bureau_balance: DataFrame) -> DataFrame:
    return last_value_per_key(bureau_balance, "SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS", "bb_last_status")


def last_status_by_window(bureau_balance: DataFrame) -> DataFrame:
    """The window formulation (for comparison in tests); same tie rule."""
    w = Window.partitionBy("SK_ID_BUREAU").orderBy(F.col("MONTHS_BALANCE").desc_nulls_last(), F.col("STATUS").desc_nulls_last())
    return (
        bureau_balance.select("SK_ID_BUREAU", "STATUS", F.row_number().over(w).alias("rn"))
        .filter(F.col("rn") == 1)
        .select("SK_ID_BUREAU", F.col("STATUS").alias("bb_last_status"))
    )


def linear_trend(df: DataFrame, group_cols: Sequence[str], time_col: str, value_col: str, feature_name: str) -> DataFrame:
    """Least-squares slope of value on time per group, over complete (time, value) pairs.

    Zero variance of time gives 0.0; a group without a complete pair gives null.
    (The means are taken over complete pairs only, so with partial nulls this is
    the textbook slope, not a mix of means over different row sets.)
    """
    t, y = F.col(time_col).cast("double"), F.col(value_col).cast("double")
    return df.groupBy(*group_cols).agg(
        F.when(F.regr_count(y, t) == 0, F.lit(None).cast("double"))
        .when(F.regr_sxx(y, t) == 0, F.lit(0.0))
        .otherwise(F.regr_slope(y, t))
        .alias(feature_name)
    )
