"""Skew-safe ordered scans: row numbers and running sums within (possibly hot) groups.

A ``Window.partitionBy(key).orderBy(..)`` puts every row of one key into one task.  When one key may hold a third
of all rows that task never finishes.  Instead, with DataFrame functions alone:

1. ``repartitionByRange`` on (key, order, tie-break) cuts a hot key across many contiguous ranges of bounded size,
   and a reliable checkpoint freezes which row is in which range;
2. a window over (range, key) numbers and sums the rows of each key within a range: no group is larger than a range;
3. one aggregate gives each (range, key)'s totals, and a running sum over a key's ranges (at most one row per range)
   gives what lies before each; only keys that go on from an earlier range have anything there, at most one per
   range, so these few rows are broadcast and added.

Keys stay in the JVM and are compared by Spark (nulls equal nulls), so their values and types are never altered.
Global order (no key) is the same with ranges alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

PID = "_rl_pid"


def ordered_scan(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    sum_cols: Sequence[str] = (),
    rank_col: str = "row_rank",
    sum_suffix: str = "_running",
    num_partitions: int | None = None,
) -> DataFrame:
    """Row number (1-based) and running sums per ``partition_cols`` group in ``order_cols`` order.

    ``order_cols`` should end with a unique tie-break: rows equal in all of them cannot be cut apart by range, and
    their order is left open.  Null sum inputs count as 0.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition_cols)
    orders = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]
    ranged = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], *orders)
    ranged = ranged.withColumn(PID, F.spark_partition_id()).checkpoint(eager=True)

    own = Window.partitionBy(PID, *keys).orderBy(*orders).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in sum_cols}
    sums = {c: f"{c}{sum_suffix}" for c in sum_cols}
    local = ranged.select("*", F.row_number().over(Window.partitionBy(PID, *keys).orderBy(*orders)).cast("long").alias(rank_col), *[F.sum(v).over(own).alias(sums[c]) for c, v in value.items()])

    added = [rank_col, *sums.values()]
    totals = ranged.groupBy(PID, *keys).agg(F.count(F.lit(1)).alias(rank_col), *[F.sum(v).alias(sums[c]) for c, v in value.items()])
    earlier = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col(PID).alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.sum(c).over(earlier).alias(f"_b_{c}") for c in added])
    # At most one key of a range began before it, so there are no more rows than ranges.
    before = F.broadcast(before.where(F.col(f"_b_{rank_col}").isNotNull()))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col(PID) == F.col("_p"))
    joined = local.join(before, same, "left")
    return joined.select(*[F.col(c) for c in df.columns], *[(F.col(c) + F.coalesce(F.col(f"_b_{c}"), F.lit(0))).alias(c) for c in added])


def row_rank(df: DataFrame, partition_cols: Sequence[str], order_col: str, tie_break: Sequence[str], rank_col: str = "row_rank") -> DataFrame:
    """Ascending row number per group, skew-safe; ``tie_break`` columns make the order total, so they are required."""
    if not tie_break:
        raise ValueError("row_rank needs tie-break columns: rows of equal order cannot be cut apart")
    return ordered_scan(df, partition_cols, [F.col(order_col).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tie_break]], rank_col=rank_col)
