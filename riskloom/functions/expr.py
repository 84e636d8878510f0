"""Row-level expressions used by the satellite rollups, drift and statistics.

All are plain ``pyspark.sql.functions`` compositions, so Catalyst folds and
code-generates them; none needs a UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``num / den``; null when the denominator is null or zero (never raises under ANSI)."""
    num, den = _c(numerator), _c(denominator)
    return F.when(den.isNull() | (den == 0), F.lit(None)).otherwise(num / den)


def flag_in(col: ColumnOrName, values: Iterable) -> Column:
    """1 when the value is one of ``values``, else 0 (null gives 0)."""
    return F.when(_c(col).isin(list(values)), F.lit(1)).otherwise(F.lit(0))


def flag_eq(col: ColumnOrName, value) -> Column:
    """1 when equal to ``value``, else 0 (null gives 0)."""
    return F.when(_c(col) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def flag_gt(col: ColumnOrName, threshold=0) -> Column:
    """1 when strictly above ``threshold``, else 0 (null gives 0)."""
    return F.when(_c(col) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def flag_le(col: ColumnOrName, threshold=0) -> Column:
    """1 when at most ``threshold``, else 0 (null gives 0)."""
    return F.when(_c(col) <= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def clip_negative(col: ColumnOrName) -> Column:
    """Negative values become 0; null stays null."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(0)))


def abs_recency(col: ColumnOrName) -> Column:
    """Recency of a relative day/month offset (offsets are <= 0 before the application)."""
    return F.abs(_c(col))


def floored_shortfall(due: ColumnOrName, paid: ColumnOrName) -> Column:
    """``greatest(due - paid, 0.0)``; ``greatest`` skips nulls, so a null difference gives 0.0."""
    return F.greatest(_c(due) - _c(paid), F.lit(0.0))


def bucket_label(col: ColumnOrName, edges: Sequence[float]) -> Column:
    """Range bucket as text: null -> 'missing'; first edge with ``x <= edge`` -> 'b{i}'; else last bucket."""
    c = _c(col)
    expr = F.when(c.isNull(), F.lit("missing"))
    for i, edge in enumerate(edges):
        expr = expr.when(c <= F.lit(float(edge)), F.lit(f"b{i}"))
    return expr.otherwise(F.lit(f"b{len(edges)}"))


# Fixed value: floor applied to bucket shares before the log ratio.
PSI_FLOOR = 1e-6


def psi_term(target_share: ColumnOrName, reference_share: ColumnOrName, floor: float = PSI_FLOOR) -> Column:
    """``(t - r) * ln(t / r)`` with both shares floored."""
    t = F.greatest(F.coalesce(_c(target_share), F.lit(0.0)), F.lit(floor))
    r = F.greatest(F.coalesce(_c(reference_share), F.lit(0.0)), F.lit(floor))
    return (t - r) * F.log(t / r)


def type_name(dtype: T.DataType) -> str:
    """Type name as printed by PySpark (``DoubleType()``)."""
    return repr(dtype)


def canonical_double(col: ColumnOrName) -> Column:
    """Engine-independent rounding to 6 decimals.

    Floating sums differ in their last bits between engines (summation order),
    and a value that is exactly on a rounding half (an average over 8 rows of
    4-decimal amounts) would round either way.  Snapping first to a 1e-9 grid
    removes that noise; the final step uses plain IEEE operations
    (multiply, add 0.5, floor, divide) that every engine evaluates identically.
    """
    c = _c(col).cast("double")
    fine = F.when(F.abs(c) < 1e9, F.floor(c * 1e9 + 0.5).cast("double") / 1e9).otherwise(c)
    return F.when(F.abs(fine) < 1e12, F.floor(fine * 1e6 + 0.5).cast("double") / 1e6).otherwise(fine)


def sql_ident(name: str) -> str:
    """Back-quoted SQL identifier for a column name."""
    return "`" + name.replace("`", "``") + "`"


def sql_str(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def canonical_double_sql(ident: str) -> str:
    """SQL text of :func:`canonical_double` for an already quoted column (same IEEE steps)."""
    c = f"CAST({ident} AS DOUBLE)"
    fine = f"(CASE WHEN abs({c}) < 1.0E9D THEN CAST(floor({c} * 1.0E9D + 0.5D) AS DOUBLE) / 1.0E9D ELSE {c} END)"
    return f"CASE WHEN abs({fine}) < 1.0E12D THEN CAST(floor({fine} * 1.0E6D + 0.5D) AS DOUBLE) / 1.0E6D ELSE {fine} END"


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Canonically round every double/float column (see :func:`canonical_double`).

    The projection is sent as SQL text in one ``selectExpr`` call: building one
    Column tree per column costs a py4j round trip per node, which on wide tables
    is seconds of driver time before any job starts.
    """
    exprs = []
    for field in df.schema.fields:
        ident = sql_ident(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(f"{canonical_double_sql(ident)} AS {ident}")
        else:
            exprs.append(ident)
    return df.selectExpr(*exprs)
