"""Adapters from the shipped test tables to the credit-risk input schemas.

The engine's operators consume an applicant master table and six history tables.
The test parquet holds TPC-H-like tables; each adapter below derives one input
table from them with plain DataFrame code, so its size grows with the data.
Every adapter has a SQL twin (``ADAPTER_SQL``) used by the DuckDB oracle.

As-of date: 2002-01-01 (all order and ship dates precede it).
``days(x)`` = whole days from the as-of date to ``x`` (negative before it);
``mon(x)`` = (year(x) - 2002) * 12 + month(x) - 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2002-01-01"
DRIFT_CUTOVER = "1999-01-01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass
class TestTables:
    """Lazily opened parquet tables of one scale factor."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._cache[name]


def days(col: Column) -> Column:
    return F.datediff(F.to_date(col), F.to_date(F.lit(AS_OF))).cast("int")


def mon(col: Column) -> Column:
    return ((F.year(col) - 2002) * 12 + F.month(col) - 1).cast("int")


def _per_order_lines(t: TestTables) -> DataFrame:
    """One row per order that has lines (partial + final hash aggregate)."""
    li = t.lineitem
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).cast("int").alias("n_lines"),
        F.max(days(F.col("l_shipdate"))).alias("last_ship_days"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))).alias("open_amount"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_amount"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("tax_amount"),
        F.avg("l_extendedprice").alias("avg_price"),
        F.max((F.col("l_tax") == 0).cast("int")).alias("any_zero_tax"),
        # one-letter flags are aggregated as code points: numeric buffers keep this
        # a hash aggregate (string buffers would force a sort-based aggregate)
        F.min(F.ascii("l_returnflag")).alias("min_flag_code"),
        F.max(F.ascii("l_returnflag")).alias("max_flag_code"),
        F.min(F.ascii("l_linestatus")).alias("min_status_code"),
    ).select(
        "*",
        F.expr("chr(min_flag_code)").alias("min_flag"),
        F.expr("chr(max_flag_code)").alias("max_flag"),
        F.expr("chr(min_status_code)").alias("min_status"),
    )


def application(t: TestTables) -> DataFrame:
    """Master table: one row per customer; SPLIT = 'test' for every fifth key, else 'train'."""
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("AMT_INCOME_TOTAL"),
        F.col("c_nationkey").alias("REGION_ID"),
        F.col("c_mktsegment").alias("NAME_SEGMENT"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("test")).otherwise(F.lit("train")).alias("SPLIT"),
    )


def bureau_balance(t: TestTables) -> DataFrame:
    li = t.lineitem
    status = (
        F.when(F.col("l_returnflag") == "R", (F.lit(1) + F.col("l_linenumber") % 5).cast("string"))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit("C"))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.lit("X"))
        .when(F.col("l_returnflag") == "N", F.lit("0"))
    )
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        mon(F.col("l_shipdate")).alias("MONTHS_BALANCE"),
        status.alias("STATUS"),
    )


def _priority_amount(base: Column, low_value: Column) -> Column:
    p = F.col("o_orderpriority")
    return F.when(p == "5-LOW", low_value).when(p == "1-URGENT", F.lit(None).cast("double")).otherwise(base)


def bureau(t: TestTables) -> DataFrame:
    o = t.orders.join(_per_order_lines(t), "o_orderkey", "left")
    opened = days(F.col("o_orderdate"))
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.when(F.col("o_orderstatus") == "O", "Active")
        .when(F.col("o_orderstatus") == "F", "Closed")
        .when(F.col("o_orderstatus") == "P", "Sold")
        .alias("CREDIT_ACTIVE"),
        opened.alias("DAYS_CREDIT"),
        F.when(F.col("n_lines").isNull(), F.lit(None).cast("double"))
        .otherwise(F.greatest(F.col("last_ship_days") - opened, F.lit(0)).cast("double"))
        .alias("CREDIT_DAY_OVERDUE"),
        F.col("n_lines").alias("CNT_CREDIT_PROLONG"),
        F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
        F.col("open_amount").alias("AMT_CREDIT_SUM_DEBT"),
        _priority_amount(F.col("o_totalprice") * 2, F.lit(0.0)).alias("AMT_CREDIT_SUM_LIMIT"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
    )


def previous_application(t: TestTables) -> DataFrame:
    o = t.orders.join(_per_order_lines(t), "o_orderkey", "left")
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.when(F.col("o_orderstatus") == "F", "Approved")
        .when(F.col("o_orderstatus") == "O", "Refused")
        .when(F.col("o_orderstatus") == "P", "Canceled")
        .alias("NAME_CONTRACT_STATUS"),
        days(F.col("o_orderdate")).alias("DAYS_DECISION"),
        _priority_amount(F.col("o_totalprice"), F.lit(0.0)).alias("AMT_APPLICATION"),
        F.col("net_amount").alias("AMT_CREDIT"),
        F.col("tax_amount").alias("AMT_DOWN_PAYMENT"),
        F.col("n_lines").alias("CNT_PAYMENT"),
        F.col("avg_price").alias("AMT_ANNUITY"),
        F.col("any_zero_tax").alias("NFLAG_INSURED_ON_APPROVAL"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        F.col("min_flag").alias("NAME_CLIENT_TYPE"),
        F.concat(F.col("max_flag"), F.col("min_status")).alias("PRODUCT_COMBINATION"),
        F.col("last_ship_days").alias("DAYS_TERMINATION"),
    )


def _lines_with_orders(t: TestTables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def installments_payments(t: TestTables) -> DataFrame:
    lo = _lines_with_orders(t)
    return lo.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        (days(F.col("o_orderdate")) + 30).alias("DAYS_INSTALMENT"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("int")).otherwise(days(F.col("l_shipdate"))).alias("DAYS_ENTRY_PAYMENT"),
        F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("AMT_INSTALMENT"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount") + F.col("l_tax")))
        .alias("AMT_PAYMENT"),
    )


def pos_cash_balance(t: TestTables) -> DataFrame:
    e = t.events
    floor_value = F.floor(F.col("value")).cast("double")
    return e.select(
        F.col("user_id").alias("SK_ID_CURR"),
        (F.col("event_id") % 4).alias("SK_ID_PREV"),
        (-F.dayofmonth(F.col("ts"))).cast("int").alias("MONTHS_BALANCE"),
        (F.col("event_id") % 13).cast("int").alias("CNT_INSTALMENT"),
        (F.col("event_id") % 7).cast("int").alias("CNT_INSTALMENT_FUTURE"),
        F.when(F.col("event_type") == "error", floor_value).otherwise(F.lit(0.0)).alias("SK_DPD"),
        F.greatest(floor_value - 100, F.lit(0.0)).alias("SK_DPD_DEF"),
    )


def credit_card_balance(t: TestTables) -> DataFrame:
    lo = _lines_with_orders(t)
    lag = F.greatest(days(F.col("l_shipdate")) - days(F.col("o_orderdate")), F.lit(0)).cast("double")
    return lo.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("l_orderkey").alias("SK_ID_PREV"),
        mon(F.col("l_shipdate")).alias("MONTHS_BALANCE"),
        F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("AMT_CREDIT_LIMIT_ACTUAL"),
        (F.col("l_quantity") * 1000).alias("AMT_BALANCE"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("AMT_DRAWINGS_CURRENT"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice") * 0.05).alias("AMT_INST_MIN_REGULARITY"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("AMT_PAYMENT_TOTAL_CURRENT"),
        lag.alias("SK_DPD"),
        F.greatest(lag - 365, F.lit(0.0)).alias("SK_DPD_DEF"),
    )


def drift_frame(t: TestTables) -> DataFrame:
    """Line-level numeric frame with the order date, the drift input."""
    lo = _lines_with_orders(t)
    return lo.select(
        F.col("o_orderdate").alias("ORDER_DATE"),
        F.col("l_quantity").alias("AMT_QUANTITY"),
        F.col("l_extendedprice").alias("AMT_EXTENDED_PRICE"),
        F.col("l_discount").alias("AMT_DISCOUNT"),
        F.col("l_tax").alias("AMT_TAX"),
        F.col("o_totalprice").alias("AMT_ORDER_TOTAL"),
        days(F.col("l_shipdate")).alias("DAYS_SHIP"),
        F.col("l_linenumber").alias("CNT_LINE_NUMBER"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("AMT_PRICE_WITH_GAPS"),
        F.col("l_returnflag").alias("NAME_RETURN_FLAG"),
    )


def drift_reference(t: TestTables) -> DataFrame:
    return drift_frame(t).filter(F.col("ORDER_DATE") < F.to_timestamp(F.lit(DRIFT_CUTOVER))).drop("ORDER_DATE")


def drift_target(t: TestTables) -> DataFrame:
    return drift_frame(t).filter(F.col("ORDER_DATE") >= F.to_timestamp(F.lit(DRIFT_CUTOVER))).drop("ORDER_DATE")


def scores(t: TestTables) -> DataFrame:
    """Labelled documents with a tie-rich score: the evaluation input."""
    d = t.documents.select("doc_id", "n_chars")
    return t.labels.join(d, "doc_id", "inner").select(
        "doc_id",
        F.col("quality").alias("y"),
        ((F.col("n_chars") % 1000) / 1000.0).alias("score"),
        (((F.col("n_chars") % 1000) / 1000.0) >= 0.5).cast("int").alias("pred"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )


def categorical(t: TestTables) -> DataFrame:
    """Line-level categorical frame with the owner's TARGET."""
    lo = _lines_with_orders(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
    return lo.select(
        "l_returnflag",
        "l_linestatus",
        "o_orderpriority",
        "o_orderstatus",
        "c_mktsegment",
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
    )


# ----------------------------------------------------------------------------
# SQL twins (DuckDB), same derivations, written independently of the above.
# ----------------------------------------------------------------------------

_DAYS = "CAST(date_diff('day', DATE '2002-01-01', CAST({x} AS DATE)) AS INTEGER)"
_MON = "CAST((year({x}) - 2002) * 12 + month({x}) - 1 AS INTEGER)"


def sql_days(x: str) -> str:
    return _DAYS.format(x=x)


def sql_mon(x: str) -> str:
    return _MON.format(x=x)


_LO = f"""
SELECT l_orderkey AS o_orderkey,
       CAST(count(*) AS INTEGER) AS n_lines,
       max({sql_days('l_shipdate')}) AS last_ship_days,
       sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) AS open_amount,
       sum(l_extendedprice * (1 - l_discount)) AS net_amount,
       sum(l_extendedprice * l_tax) AS tax_amount,
       avg(l_extendedprice) AS avg_price,
       max(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS any_zero_tax,
       min(l_returnflag) AS min_flag,
       max(l_returnflag) AS max_flag,
       min(l_linestatus) AS min_status
FROM lineitem GROUP BY l_orderkey"""

ADAPTER_SQL: dict[str, str] = {
    "v_application": """
SELECT c_custkey AS SK_ID_CURR,
       CAST(c_acctbal < 0 AS INTEGER) AS TARGET,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS AMT_INCOME_TOTAL,
       c_nationkey AS REGION_ID,
       c_mktsegment AS NAME_SEGMENT,
       CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS SPLIT
FROM customer""",
    "v_bureau_balance": f"""
SELECT l_orderkey AS SK_ID_BUREAU,
       {sql_mon('l_shipdate')} AS MONTHS_BALANCE,
       CASE WHEN l_returnflag = 'R' THEN CAST(1 + l_linenumber % 5 AS VARCHAR)
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'C'
            WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'X'
            WHEN l_returnflag = 'N' THEN '0' END AS STATUS
FROM lineitem""",
    "v_lo": _LO,
    "v_bureau": f"""
SELECT o_custkey AS SK_ID_CURR,
       o.o_orderkey AS SK_ID_BUREAU,
       CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Sold' END AS CREDIT_ACTIVE,
       {sql_days('o_orderdate')} AS DAYS_CREDIT,
       CASE WHEN lo.n_lines IS NULL THEN NULL
            ELSE CAST(greatest(lo.last_ship_days - {sql_days('o_orderdate')}, 0) AS DOUBLE) END AS CREDIT_DAY_OVERDUE,
       lo.n_lines AS CNT_CREDIT_PROLONG,
       o_totalprice AS AMT_CREDIT_SUM,
       lo.open_amount AS AMT_CREDIT_SUM_DEBT,
       CASE o_orderpriority WHEN '5-LOW' THEN 0.0 WHEN '1-URGENT' THEN NULL ELSE o_totalprice * 2 END AS AMT_CREDIT_SUM_LIMIT,
       o_orderpriority AS CREDIT_TYPE
FROM orders o LEFT JOIN v_lo lo ON o.o_orderkey = lo.o_orderkey""",
    "v_previous": f"""
SELECT o_custkey AS SK_ID_CURR,
       o.o_orderkey AS SK_ID_PREV,
       CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' WHEN 'P' THEN 'Canceled' END AS NAME_CONTRACT_STATUS,
       {sql_days('o_orderdate')} AS DAYS_DECISION,
       CASE o_orderpriority WHEN '5-LOW' THEN 0.0 WHEN '1-URGENT' THEN NULL ELSE o_totalprice END AS AMT_APPLICATION,
       lo.net_amount AS AMT_CREDIT,
       lo.tax_amount AS AMT_DOWN_PAYMENT,
       lo.n_lines AS CNT_PAYMENT,
       lo.avg_price AS AMT_ANNUITY,
       lo.any_zero_tax AS NFLAG_INSURED_ON_APPROVAL,
       o_orderpriority AS NAME_CONTRACT_TYPE,
       lo.min_flag AS NAME_CLIENT_TYPE,
       lo.max_flag || lo.min_status AS PRODUCT_COMBINATION,
       lo.last_ship_days AS DAYS_TERMINATION
FROM orders o LEFT JOIN v_lo lo ON o.o_orderkey = lo.o_orderkey""",
    "v_installments": f"""
SELECT o_custkey AS SK_ID_CURR,
       l_orderkey AS SK_ID_PREV,
       l_linenumber AS NUM_INSTALMENT_NUMBER,
       {sql_days('o_orderdate')} + 30 AS DAYS_INSTALMENT,
       CASE WHEN l_tax = 0 THEN NULL ELSE {sql_days('l_shipdate')} END AS DAYS_ENTRY_PAYMENT,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice END AS AMT_INSTALMENT,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice * (1 - l_discount + l_tax) END AS AMT_PAYMENT
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_pos_cash": """
SELECT user_id AS SK_ID_CURR,
       event_id % 4 AS SK_ID_PREV,
       CAST(-day(ts) AS INTEGER) AS MONTHS_BALANCE,
       CAST(event_id % 13 AS INTEGER) AS CNT_INSTALMENT,
       CAST(event_id % 7 AS INTEGER) AS CNT_INSTALMENT_FUTURE,
       CASE WHEN event_type = 'error' THEN CAST(floor(value) AS DOUBLE) ELSE 0.0 END AS SK_DPD,
       greatest(CAST(floor(value) AS DOUBLE) - 100, 0.0) AS SK_DPD_DEF
FROM events""",
    "v_credit_card": f"""
SELECT o_custkey AS SK_ID_CURR,
       l_orderkey AS SK_ID_PREV,
       {sql_mon('l_shipdate')} AS MONTHS_BALANCE,
       CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice END AS AMT_CREDIT_LIMIT_ACTUAL,
       l_quantity * 1000 AS AMT_BALANCE,
       l_extendedprice * l_discount AS AMT_DRAWINGS_CURRENT,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice * 0.05 END AS AMT_INST_MIN_REGULARITY,
       l_extendedprice * l_tax AS AMT_PAYMENT_TOTAL_CURRENT,
       CAST(greatest({sql_days('l_shipdate')} - {sql_days('o_orderdate')}, 0) AS DOUBLE) AS SK_DPD,
       greatest(CAST(greatest({sql_days('l_shipdate')} - {sql_days('o_orderdate')}, 0) AS DOUBLE) - 365, 0.0) AS SK_DPD_DEF
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_drift_all": f"""
SELECT o_orderdate AS ORDER_DATE,
       l_quantity AS AMT_QUANTITY,
       l_extendedprice AS AMT_EXTENDED_PRICE,
       l_discount AS AMT_DISCOUNT,
       l_tax AS AMT_TAX,
       o_totalprice AS AMT_ORDER_TOTAL,
       {sql_days('l_shipdate')} AS DAYS_SHIP,
       l_linenumber AS CNT_LINE_NUMBER,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS AMT_PRICE_WITH_GAPS,
       l_returnflag AS NAME_RETURN_FLAG
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_drift_ref": "SELECT * EXCLUDE (ORDER_DATE) FROM v_drift_all WHERE ORDER_DATE < TIMESTAMP '1999-01-01'",
    "v_drift_tgt": "SELECT * EXCLUDE (ORDER_DATE) FROM v_drift_all WHERE ORDER_DATE >= TIMESTAMP '1999-01-01'",
    "v_scores": """
SELECT l.doc_id, l.quality AS y,
       (d.n_chars % 1000) / 1000.0 AS score,
       CAST((d.n_chars % 1000) / 1000.0 >= 0.5 AS INTEGER) AS pred,
       CASE WHEN l.doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "v_categorical": """
SELECT l_returnflag, l_linestatus, o_orderpriority, o_orderstatus, c_mktsegment,
       CAST(c_acctbal < 0 AS INTEGER) AS TARGET
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
}

# Which views each view depends on (so a query only pulls what it uses).
_ADAPTER_DEPS = {
    "v_bureau": ["v_lo"],
    "v_previous": ["v_lo"],
    "v_drift_ref": ["v_drift_all"],
    "v_drift_tgt": ["v_drift_all"],
}


def with_views(body: str, *views: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause of the needed adapter views (then ``extra`` CTEs), then ``body``."""
    ordered: list[str] = []

    def add(v: str) -> None:
        for dep in _ADAPTER_DEPS.get(v, []):
            add(dep)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        add(v)
    pairs = [(v, ADAPTER_SQL[v]) for v in ordered] + list(extra or [])
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in pairs)
    return f"WITH {ctes}\n{body}"
