"""Feature registry: one documented record per published feature.

The registry itself is a small fixed table; what scales is checking it against
the data: :func:`registry_with_coverage` joins it to a one-pass null profile of
the feature tables, so every registered name is proven to exist and be filled.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    feature_name: str
    source_table: str
    granularity: str
    owner: str
    feature_type: str
    risk_potential: str
    temporal_safety: bool
    business_description: str


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("feature_name", T.StringType(), False),
        T.StructField("source_table", T.StringType(), False),
        T.StructField("granularity", T.StringType(), False),
        T.StructField("owner", T.StringType(), False),
        T.StructField("feature_type", T.StringType(), False),
        T.StructField("risk_potential", T.StringType(), False),
        T.StructField("temporal_safety", T.BooleanType(), False),
        T.StructField("business_description", T.StringType(), False),
    ]
)

OWNER = "risk_engineering"

# The published feature registry (name, source, grain, type, risk, description).
_SPECS = [
    ("bb_months_observed", "bureau_balance", "SK_ID_BUREAU", "count", "medium", "Number of observed bureau balance months"),
    ("bb_delinquency_rate", "bureau_balance", "SK_ID_BUREAU", "rate", "high", "Share of delinquent months in bureau balance history"),
    ("bb_recency_months", "bureau_balance", "SK_ID_BUREAU", "recency", "medium", "Recency of latest bureau balance observation"),
    ("bb_last_status", "bureau_balance", "SK_ID_BUREAU", "categorical", "medium", "Most recent bureau balance status"),
    ("bureau_num_loans", "bureau", "SK_ID_CURR", "count", "medium", "Count of bureau credit records per client"),
    ("bureau_active_rate", "bureau", "SK_ID_CURR", "rate", "high", "Share of active bureau credits"),
    ("bureau_overdue_rate", "bureau", "SK_ID_CURR", "rate", "high", "Share of bureau credits with overdue days"),
    ("bureau_bb_delinquency_rate_mean", "bureau_balance+bureau", "SK_ID_CURR", "behavioral", "high", "Average delinquency rate from bureau balance history"),
    ("prev_app_count", "previous_application", "SK_ID_CURR", "count", "medium", "Number of historical previous applications"),
    ("prev_app_approval_rate", "previous_application", "SK_ID_CURR", "rate", "high", "Historical approval rate"),
    ("prev_app_recency_days_mean", "previous_application", "SK_ID_CURR", "recency", "medium", "Average recency of previous applications"),
    ("prev_app_credit_ratio_mean", "previous_application", "SK_ID_CURR", "ratio", "high", "Ratio of credit to application amount in previous requests"),
    ("ip_prev_credit_count", "installments_payments", "SK_ID_CURR", "count", "high", "Number of previous installment-linked credits"),
    ("ip_on_time_rate", "installments_payments", "SK_ID_CURR", "behavioral", "high", "Average on-time payment rate across previous loans"),
    ("ip_delay_mean", "installments_payments", "SK_ID_CURR", "behavioral", "high", "Average payment delay across previous loans"),
    ("ip_payment_ratio_mean", "installments_payments", "SK_ID_CURR", "ratio", "high", "Average payment-to-installment ratio"),
    ("pc_prev_credit_count", "POS_CASH_balance", "SK_ID_CURR", "count", "high", "Number of previous POS/cash credits"),
    ("pc_dpd_rate_mean", "POS_CASH_balance", "SK_ID_CURR", "delinquency", "high", "Mean delinquency rate across POS/cash credits"),
    ("pc_remaining_ratio_mean", "POS_CASH_balance", "SK_ID_CURR", "utilization", "high", "Remaining installment ratio across POS/cash credits"),
    ("cc_prev_credit_count", "credit_card_balance", "SK_ID_CURR", "count", "high", "Number of previous credit card accounts"),
    ("cc_utilization_mean", "credit_card_balance", "SK_ID_CURR", "utilization", "high", "Average credit card utilization"),
    ("cc_payment_to_min_mean", "credit_card_balance", "SK_ID_CURR", "behavioral", "high", "Average payment to minimum due ratio"),
    ("cc_dpd_rate_mean", "credit_card_balance", "SK_ID_CURR", "delinquency", "high", "Mean delinquency rate for credit cards"),
]

FEATURE_SPECS: list[FeatureSpec] = [FeatureSpec(n, s, g, OWNER, t, r, True, d) for n, s, g, t, r, d in _SPECS]


def registry_to_dataframe(spark: SparkSession, specs=None) -> DataFrame:
    """The registry as a DataFrame with an explicit schema (column order kept)."""
    specs = FEATURE_SPECS if specs is None else specs
    return spark.createDataFrame([astuple(s) for s in specs], REGISTRY_SCHEMA)


def registry_with_coverage(registry: DataFrame, feature_tables: dict[str, DataFrame]) -> DataFrame:
    """Registry rows + ``present`` and ``non_null_rows`` measured on the feature tables.

    ``feature_tables`` maps a granularity key (``SK_ID_BUREAU``/``SK_ID_CURR``) to
    the table holding features at that grain.  One aggregate per table.
    """
    names = {r["feature_name"] for r in registry.select("feature_name").collect()}  # small, fixed
    measured = None
    for grain, table in feature_tables.items():
        cols = [c for c in table.columns if c in names]
        if not cols:
            continue
        wide = table.agg(*[F.count(F.col(c)).alias(c) for c in cols])
        entries = ", ".join(f"'{c}', `{c}`" for c in cols)
        long = wide.selectExpr(f"stack({len(cols)}, {entries}) as (feature_name, non_null_rows)").withColumn("granularity", F.lit(grain))
        measured = long if measured is None else measured.unionByName(long)
    if measured is None:
        return registry.select("*", F.lit(False).alias("present"), F.lit(None).cast("long").alias("non_null_rows"))
    joined = registry.join(F.broadcast(measured), on=["feature_name", "granularity"], how="left")
    return joined.select(
        *registry.columns,
        F.col("non_null_rows").isNotNull().alias("present"),
        F.col("non_null_rows").cast("long").alias("non_null_rows"),
    )
