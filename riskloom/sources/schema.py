"""Column typing by name rule: the raw tables carry only a header, so the type of
each column comes from its name.  Rules are tried in order; the first match wins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Column-name prefixes typed as text (must match the raw tables).
STRING_PREFIXES = (
    "NAME_",
    "CODE_",
    "OCCUPATION_",
    "ORGANIZATION_",
    "WEEKDAY_",
    "HOUSETYPE_",
    "EMERGENCYSTATE_",
    "PRODUCT_",
    "CHANNEL_",
    "CREDIT_ACTIVE",
    "CREDIT_CURRENCY",
    "CREDIT_TYPE",
    "NAME_CONTRACT_STATUS",
    "NAME_PAYMENT_TYPE",
    "NAME_CLIENT_TYPE",
    "NAME_GOODS_CATEGORY",
    "NAME_PORTFOLIO",
    "NAME_YIELD_GROUP",
    "NAME_SELLER_INDUSTRY",
    "NAME_CASH_LOAN_PURPOSE",
    "NAME_TYPE_SUITE",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
    "NAME_HOUSING_TYPE",
    "WALLSMATERIAL_MODE",
    "FONDKAPREMONT_MODE",
    "STATUS",
)

# The ordered name rules (kind, names, type).
NAME_RULES: tuple[tuple[str, tuple[str, ...], T.DataType], ...] = (
    ("equals", ("TARGET",), T.IntegerType()),
    ("prefix", ("SK_ID_",), T.LongType()),
    ("prefix", ("FLAG_", "NFLAG_"), T.IntegerType()),
    ("prefix", ("CNT_", "NUM_", "OBS_", "DEF_"), T.IntegerType()),
    ("prefix", ("DAYS_", "MONTHS_"), T.IntegerType()),
    ("prefix", ("AMT_", "RATE_", "EXT_SOURCE_"), T.DoubleType()),
    ("prefix", ("REGION_POPULATION_RELATIVE", "TOTALAREA_MODE"), T.DoubleType()),
    ("prefix", STRING_PREFIXES, T.StringType()),
    ("equals", ("HOUR_APPR_PROCESS_START", "SELLERPLACE_AREA"), T.IntegerType()),
    ("suffix", ("_AGE",), T.IntegerType()),
)
DEFAULT_TYPE = T.DoubleType()


def infer_type(column_name: str) -> T.DataType:
    """Type of a raw column from its (case-insensitive) name."""
    name = column_name.upper()
    for kind, names, dtype in NAME_RULES:
        if kind == "equals" and name in names:
            return dtype
        if kind == "prefix" and name.startswith(names):
            return dtype
        if kind == "suffix" and name.endswith(names):
            return dtype
    return DEFAULT_TYPE


def build_schema(columns: Iterable[str]) -> T.StructType:
    """Nullable ``StructType`` for a header."""
    return T.StructType([T.StructField(c, infer_type(c), True) for c in columns])
