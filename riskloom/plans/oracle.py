"""DuckDB oracle SQL for the registered queries.

Written as plain SQL from the feature definitions (not generated from the Spark
plans), so the two engines check each other.  Both sides round doubles to 6
decimals (summation order differs between engines) and use the same integer
widths: counts and sums of flags BIGINT, min/max of day offsets INTEGER.
"""

from __future__ import annotations

from ..sources.testdata import with_views

D = 6  # decimals kept on doubles by both engines


def canon(x: str) -> str:
    """SQL twin of ``canonical_double``: snap to 1e-9, then floor-round to 1e-6."""
    fine = f"(CASE WHEN abs({x}) < 1e9 THEN floor(({x}) * 1e9 + 0.5) / 1e9 ELSE ({x}) END)"
    return f"(CASE WHEN abs({fine}) < 1e12 THEN floor({fine} * 1e6 + 0.5) / 1e6 ELSE {fine} END)"


def _final(cols: list[tuple[str, str]], src: str, order: str = "") -> str:
    """``SELECT`` of typed output columns; kind 'd' is rounded double."""
    parts = []
    for name, kind in cols:
        if kind == "d":
            parts.append(f"CAST({canon(f'CAST({name} AS DOUBLE)')} AS DOUBLE) AS {name}")
        elif kind == "l":
            parts.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind == "i":
            parts.append(f"CAST({name} AS INTEGER) AS {name}")
        elif kind == "s":
            parts.append(f"CAST({name} AS VARCHAR) AS {name}")
        elif kind == "b":
            parts.append(f"CAST({name} AS BOOLEAN) AS {name}")
        else:
            parts.append(name)
    return f"SELECT {', '.join(parts)} FROM {src} {order}"


# --------------------------------------------------------------------------
# Satellite rollups as CTE bodies; column kinds for the final projection.
# --------------------------------------------------------------------------

BB_COLS = [
    ("SK_ID_BUREAU", "l"), ("bb_months_min", "i"), ("bb_months_max", "i"), ("bb_months_observed", "l"),
    ("bb_delinquent_months", "l"), ("bb_closed_months", "l"), ("bb_unknown_months", "l"),
    ("bb_delinquency_rate", "d"), ("bb_closed_rate", "d"), ("bb_unknown_rate", "d"),
    ("bb_delinquency_volatility", "d"), ("bb_last_delinquency_month", "i"), ("bb_recency_months", "i"),
    ("bb_delinquency_span", "i"), ("bb_last_status", "s"),
]

BB_SQL = """
SELECT g.*, abs(g.bb_months_max) AS bb_recency_months,
       g.bb_months_max - g.bb_months_min AS bb_delinquency_span,
       ls.bb_last_status
FROM (
  SELECT SK_ID_BUREAU,
         min(MONTHS_BALANCE) AS bb_months_min,
         max(MONTHS_BALANCE) AS bb_months_max,
         count(*) AS bb_months_observed,
         sum(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END) AS bb_delinquent_months,
         sum(CASE WHEN STATUS = 'C' THEN 1 ELSE 0 END) AS bb_closed_months,
         sum(CASE WHEN STATUS = 'X' THEN 1 ELSE 0 END) AS bb_unknown_months,
         avg(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END) AS bb_delinquency_rate,
         avg(CASE WHEN STATUS = 'C' THEN 1 ELSE 0 END) AS bb_closed_rate,
         avg(CASE WHEN STATUS = 'X' THEN 1 ELSE 0 END) AS bb_unknown_rate,
         stddev_pop(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END) AS bb_delinquency_volatility,
         max(CASE WHEN STATUS IN ('1','2','3','4','5') THEN MONTHS_BALANCE END) AS bb_last_delinquency_month
  FROM v_bureau_balance GROUP BY SK_ID_BUREAU
) g
LEFT JOIN (
  SELECT SK_ID_BUREAU, STATUS AS bb_last_status FROM (
    SELECT SK_ID_BUREAU, STATUS,
           row_number() OVER (PARTITION BY SK_ID_BUREAU
                              ORDER BY MONTHS_BALANCE DESC NULLS LAST, STATUS DESC NULLS LAST) AS rn
    FROM v_bureau_balance) WHERE rn = 1
) ls ON g.SK_ID_BUREAU = ls.SK_ID_BUREAU"""

BUREAU_COLS = [
    ("SK_ID_CURR", "l"), ("bureau_num_loans", "l"), ("bureau_active_loans", "l"), ("bureau_active_rate", "d"),
    ("bureau_loans_with_overdue", "l"), ("bureau_overdue_rate", "d"), ("bureau_recency_days_mean", "d"),
    ("bureau_recency_days_max", "i"), ("bureau_credit_sum_mean", "d"), ("bureau_credit_sum_total", "d"),
    ("bureau_debt_mean", "d"), ("bureau_debt_total", "d"), ("bureau_credit_utilization_mean", "d"),
    ("bureau_credit_utilization_max", "d"), ("bureau_debt_ratio_mean", "d"), ("bureau_max_overdue_days", "d"),
    ("bureau_credit_prolong_total", "l"), ("bureau_bb_delinquency_rate_mean", "d"),
    ("bureau_bb_delinquency_rate_max", "d"), ("bureau_bb_recency_months_mean", "d"),
    ("bureau_bb_delinquency_volatility_max", "d"), ("bureau_bb_months_observed_mean", "d"),
    ("bureau_closed_loans", "l"), ("bureau_credit_type_diversity", "l"),
]

BUREAU_SQL = """
SELECT b.SK_ID_CURR,
       count(*) AS bureau_num_loans,
       sum(CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END) AS bureau_active_loans,
       avg(CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END) AS bureau_active_rate,
       sum(CASE WHEN CREDIT_DAY_OVERDUE > 0 THEN 1 ELSE 0 END) AS bureau_loans_with_overdue,
       avg(CASE WHEN CREDIT_DAY_OVERDUE > 0 THEN 1 ELSE 0 END) AS bureau_overdue_rate,
       avg(abs(DAYS_CREDIT)) AS bureau_recency_days_mean,
       max(abs(DAYS_CREDIT)) AS bureau_recency_days_max,
       avg(AMT_CREDIT_SUM) AS bureau_credit_sum_mean,
       sum(AMT_CREDIT_SUM) AS bureau_credit_sum_total,
       avg(AMT_CREDIT_SUM_DEBT) AS bureau_debt_mean,
       sum(AMT_CREDIT_SUM_DEBT) AS bureau_debt_total,
       avg(CASE WHEN AMT_CREDIT_SUM_LIMIT IS NULL OR AMT_CREDIT_SUM_LIMIT = 0 THEN NULL
                ELSE AMT_CREDIT_SUM_DEBT / AMT_CREDIT_SUM_LIMIT END) AS bureau_credit_utilization_mean,
       max(CASE WHEN AMT_CREDIT_SUM_LIMIT IS NULL OR AMT_CREDIT_SUM_LIMIT = 0 THEN NULL
                ELSE AMT_CREDIT_SUM_DEBT / AMT_CREDIT_SUM_LIMIT END) AS bureau_credit_utilization_max,
       avg(CASE WHEN AMT_CREDIT_SUM IS NULL OR AMT_CREDIT_SUM = 0 THEN NULL
                ELSE AMT_CREDIT_SUM_DEBT / AMT_CREDIT_SUM END) AS bureau_debt_ratio_mean,
       max(CREDIT_DAY_OVERDUE) AS bureau_max_overdue_days,
       sum(CNT_CREDIT_PROLONG) AS bureau_credit_prolong_total,
       avg(bb.bb_delinquency_rate) AS bureau_bb_delinquency_rate_mean,
       max(bb.bb_delinquency_rate) AS bureau_bb_delinquency_rate_max,
       avg(bb.bb_recency_months) AS bureau_bb_recency_months_mean,
       max(bb.bb_delinquency_volatility) AS bureau_bb_delinquency_volatility_max,
       avg(bb.bb_months_observed) AS bureau_bb_months_observed_mean,
       sum(CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 1 ELSE 0 END) AS bureau_closed_loans,
       count(DISTINCT CREDIT_TYPE) AS bureau_credit_type_diversity
FROM v_bureau b LEFT JOIN f_bb bb ON b.SK_ID_BUREAU = bb.SK_ID_BUREAU
GROUP BY b.SK_ID_CURR"""

PREV_COLS = [
    ("SK_ID_CURR", "l"), ("prev_app_count", "l"), ("prev_app_approved_count", "l"), ("prev_app_refused_count", "l"),
    ("prev_app_cancelled_count", "l"), ("prev_app_approval_rate", "d"), ("prev_app_recency_days_mean", "d"),
    ("prev_app_recency_days_min", "i"), ("prev_app_recency_days_max", "i"), ("prev_app_credit_ratio_mean", "d"),
    ("prev_app_credit_ratio_max", "d"), ("prev_app_down_payment_ratio_mean", "d"), ("prev_app_approval_gap_mean", "d"),
    ("prev_app_cnt_payment_mean", "d"), ("prev_app_insured_rate", "d"), ("prev_app_contract_type_diversity", "l"),
    ("prev_app_client_type_diversity", "l"), ("prev_app_product_combination_diversity", "l"),
]

PREV_SQL = """
SELECT SK_ID_CURR,
       count(*) AS prev_app_count,
       sum(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0 END) AS prev_app_approved_count,
       sum(CASE WHEN NAME_CONTRACT_STATUS = 'Refused' THEN 1 ELSE 0 END) AS prev_app_refused_count,
       sum(CASE WHEN NAME_CONTRACT_STATUS = 'Canceled' THEN 1 ELSE 0 END) AS prev_app_cancelled_count,
       avg(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0 END) AS prev_app_approval_rate,
       avg(abs(DAYS_DECISION)) AS prev_app_recency_days_mean,
       min(abs(DAYS_DECISION)) AS prev_app_recency_days_min,
       max(abs(DAYS_DECISION)) AS prev_app_recency_days_max,
       avg(CASE WHEN AMT_APPLICATION IS NULL OR AMT_APPLICATION = 0 THEN NULL ELSE AMT_CREDIT / AMT_APPLICATION END)
           AS prev_app_credit_ratio_mean,
       max(CASE WHEN AMT_APPLICATION IS NULL OR AMT_APPLICATION = 0 THEN NULL ELSE AMT_CREDIT / AMT_APPLICATION END)
           AS prev_app_credit_ratio_max,
       avg(CASE WHEN AMT_APPLICATION IS NULL OR AMT_APPLICATION = 0 THEN NULL ELSE AMT_DOWN_PAYMENT / AMT_APPLICATION END)
           AS prev_app_down_payment_ratio_mean,
       avg(AMT_CREDIT - AMT_APPLICATION) AS prev_app_approval_gap_mean,
       avg(CNT_PAYMENT) AS prev_app_cnt_payment_mean,
       avg(NFLAG_INSURED_ON_APPROVAL) AS prev_app_insured_rate,
       count(DISTINCT NAME_CONTRACT_TYPE) AS prev_app_contract_type_diversity,
       count(DISTINCT NAME_CLIENT_TYPE) AS prev_app_client_type_diversity,
       count(DISTINCT PRODUCT_COMBINATION) AS prev_app_product_combination_diversity
FROM v_previous GROUP BY SK_ID_CURR"""

IP_COLS = [
    ("SK_ID_CURR", "l"), ("ip_prev_credit_count", "l"), ("ip_rows_per_prev_mean", "d"), ("ip_rows_total", "l"),
    ("ip_delay_mean", "d"), ("ip_delay_max", "i"), ("ip_on_time_rate", "d"), ("ip_late_rate", "d"),
    ("ip_payment_ratio_mean", "d"), ("ip_payment_ratio_vol_max", "d"), ("ip_underpayment_total", "d"),
    ("ip_recency_days_mean", "d"), ("ip_recency_days_max", "i"),
]

IP_SQL = """
SELECT SK_ID_CURR,
       count(*) AS ip_prev_credit_count,
       avg(n) AS ip_rows_per_prev_mean,
       sum(n) AS ip_rows_total,
       avg(delay_mean) AS ip_delay_mean,
       max(delay_max) AS ip_delay_max,
       avg(on_time) AS ip_on_time_rate,
       avg(late) AS ip_late_rate,
       avg(ratio_mean) AS ip_payment_ratio_mean,
       max(ratio_sd) AS ip_payment_ratio_vol_max,
       sum(under) AS ip_underpayment_total,
       avg(recency) AS ip_recency_days_mean,
       max(recency) AS ip_recency_days_max
FROM (
  SELECT SK_ID_CURR, SK_ID_PREV,
         count(*) AS n,
         avg(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS delay_mean,
         max(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS delay_max,
         avg(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT <= 0 THEN 1 ELSE 0 END) AS on_time,
         avg(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN 1 ELSE 0 END) AS late,
         avg(CASE WHEN AMT_INSTALMENT IS NULL OR AMT_INSTALMENT = 0 THEN NULL ELSE AMT_PAYMENT / AMT_INSTALMENT END) AS ratio_mean,
         stddev_pop(CASE WHEN AMT_INSTALMENT IS NULL OR AMT_INSTALMENT = 0 THEN NULL ELSE AMT_PAYMENT / AMT_INSTALMENT END) AS ratio_sd,
         sum(CASE WHEN AMT_INSTALMENT - AMT_PAYMENT > 0 THEN AMT_INSTALMENT - AMT_PAYMENT ELSE 0.0 END) AS under,
         max(abs(DAYS_INSTALMENT)) AS recency
  FROM v_installments GROUP BY SK_ID_CURR, SK_ID_PREV
) GROUP BY SK_ID_CURR"""

PC_COLS = [
    ("SK_ID_CURR", "l"), ("pc_prev_credit_count", "l"), ("pc_months_prev_mean", "d"), ("pc_months_total", "l"),
    ("pc_dpd_rate_mean", "d"), ("pc_dpd_rate_max", "d"), ("pc_dpd_def_rate_mean", "d"), ("pc_max_dpd", "d"),
    ("pc_avg_dpd", "d"), ("pc_remaining_ratio_mean", "d"), ("pc_instalment_gap_mean", "d"), ("pc_recency_mean", "d"),
]

PC_SQL = """
SELECT SK_ID_CURR,
       count(*) AS pc_prev_credit_count,
       avg(n) AS pc_months_prev_mean,
       sum(n) AS pc_months_total,
       avg(dpd_rate) AS pc_dpd_rate_mean,
       max(dpd_rate) AS pc_dpd_rate_max,
       avg(dpd_def_rate) AS pc_dpd_def_rate_mean,
       max(max_dpd) AS pc_max_dpd,
       avg(avg_dpd) AS pc_avg_dpd,
       avg(remaining) AS pc_remaining_ratio_mean,
       avg(gap) AS pc_instalment_gap_mean,
       avg(recency) AS pc_recency_mean
FROM (
  SELECT SK_ID_CURR, SK_ID_PREV,
         count(*) AS n,
         avg(CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END) AS dpd_rate,
         avg(CASE WHEN SK_DPD_DEF > 0 THEN 1 ELSE 0 END) AS dpd_def_rate,
         max(SK_DPD) AS max_dpd,
         avg(SK_DPD) AS avg_dpd,
         avg(CASE WHEN CNT_INSTALMENT IS NULL OR CNT_INSTALMENT = 0 THEN NULL
                  ELSE CNT_INSTALMENT_FUTURE / CNT_INSTALMENT END) AS remaining,
         avg(CNT_INSTALMENT - CNT_INSTALMENT_FUTURE) AS gap,
         max(abs(MONTHS_BALANCE)) AS recency
  FROM v_pos_cash GROUP BY SK_ID_CURR, SK_ID_PREV
) GROUP BY SK_ID_CURR"""

CC_COLS = [
    ("SK_ID_CURR", "l"), ("cc_prev_credit_count", "l"), ("cc_months_prev_mean", "d"), ("cc_months_total", "l"),
    ("cc_utilization_mean", "d"), ("cc_utilization_max", "d"), ("cc_payment_to_min_mean", "d"),
    ("cc_payment_to_min_max", "d"), ("cc_drawing_to_limit_mean", "d"), ("cc_dpd_rate_mean", "d"), ("cc_max_dpd", "d"),
    ("cc_balance_mean", "d"), ("cc_balance_max", "d"), ("cc_balance_vol_max", "d"), ("cc_recency_mean", "d"),
]

CC_SQL = """
SELECT SK_ID_CURR,
       count(*) AS cc_prev_credit_count,
       avg(n) AS cc_months_prev_mean,
       sum(n) AS cc_months_total,
       avg(util_mean) AS cc_utilization_mean,
       max(util_max) AS cc_utilization_max,
       avg(ptm_mean) AS cc_payment_to_min_mean,
       max(ptm_max) AS cc_payment_to_min_max,
       avg(dtl_mean) AS cc_drawing_to_limit_mean,
       avg(dpd_rate) AS cc_dpd_rate_mean,
       max(max_dpd) AS cc_max_dpd,
       avg(bal_mean) AS cc_balance_mean,
       max(bal_max) AS cc_balance_max,
       max(bal_sd) AS cc_balance_vol_max,
       avg(recency) AS cc_recency_mean
FROM (
  SELECT SK_ID_CURR, SK_ID_PREV,
         count(*) AS n,
         avg(CASE WHEN AMT_CREDIT_LIMIT_ACTUAL IS NULL OR AMT_CREDIT_LIMIT_ACTUAL = 0 THEN NULL
                  ELSE AMT_BALANCE / AMT_CREDIT_LIMIT_ACTUAL END) AS util_mean,
         max(CASE WHEN AMT_CREDIT_LIMIT_ACTUAL IS NULL OR AMT_CREDIT_LIMIT_ACTUAL = 0 THEN NULL
                  ELSE AMT_BALANCE / AMT_CREDIT_LIMIT_ACTUAL END) AS util_max,
         avg(CASE WHEN AMT_INST_MIN_REGULARITY IS NULL OR AMT_INST_MIN_REGULARITY = 0 THEN NULL
                  ELSE AMT_PAYMENT_TOTAL_CURRENT / AMT_INST_MIN_REGULARITY END) AS ptm_mean,
         max(CASE WHEN AMT_INST_MIN_REGULARITY IS NULL OR AMT_INST_MIN_REGULARITY = 0 THEN NULL
                  ELSE AMT_PAYMENT_TOTAL_CURRENT / AMT_INST_MIN_REGULARITY END) AS ptm_max,
         avg(CASE WHEN AMT_CREDIT_LIMIT_ACTUAL IS NULL OR AMT_CREDIT_LIMIT_ACTUAL = 0 THEN NULL
                  ELSE AMT_DRAWINGS_CURRENT / AMT_CREDIT_LIMIT_ACTUAL END) AS dtl_mean,
         avg(CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END) AS dpd_rate,
         max(SK_DPD) AS max_dpd,
         avg(AMT_BALANCE) AS bal_mean,
         max(AMT_BALANCE) AS bal_max,
         stddev_pop(AMT_BALANCE) AS bal_sd,
         max(abs(MONTHS_BALANCE)) AS recency
  FROM v_credit_card GROUP BY SK_ID_CURR, SK_ID_PREV
) GROUP BY SK_ID_CURR"""

APP_COLS = [
    ("SK_ID_CURR", "l"), ("TARGET", "i"), ("AMT_INCOME_TOTAL", "d"), ("REGION_ID", "i"),
    ("NAME_SEGMENT", "s"), ("SPLIT", "s"),
]


def _ctes(pairs: list[tuple[str, str]]) -> str:
    return ",\n".join(f"{name} AS ({body}\n)" for name, body in pairs)


def _sat_query(body_views: list[str], ctes: list[tuple[str, str]], cols, src: str) -> str:
    return with_views(_final(cols, src), *body_views, extra=ctes)


def feat_bureau_balance() -> str:
    return _sat_query(["v_bureau_balance"], [("f_bb", BB_SQL)], BB_COLS, "f_bb")


def feat_bureau() -> str:
    return _sat_query(["v_bureau_balance", "v_bureau"], [("f_bb", BB_SQL), ("f_bureau", BUREAU_SQL)], BUREAU_COLS, "f_bureau")


def feat_previous() -> str:
    return _sat_query(["v_previous"], [("f_prev", PREV_SQL)], PREV_COLS, "f_prev")


def feat_installments() -> str:
    return _sat_query(["v_installments"], [("f_ip", IP_SQL)], IP_COLS, "f_ip")


def feat_pos_cash() -> str:
    return _sat_query(["v_pos_cash"], [("f_pc", PC_SQL)], PC_COLS, "f_pc")


def feat_credit_card() -> str:
    return _sat_query(["v_credit_card"], [("f_cc", CC_SQL)], CC_COLS, "f_cc")


ASSEMBLED_COLS = APP_COLS + [c for cols in (BUREAU_COLS, PREV_COLS, IP_COLS, PC_COLS, CC_COLS) for c in cols[1:]]


def assembled_cte() -> list[tuple[str, str]]:
    join = """
SELECT a.*, b.* EXCLUDE (SK_ID_CURR), p.* EXCLUDE (SK_ID_CURR), i.* EXCLUDE (SK_ID_CURR),
       pc.* EXCLUDE (SK_ID_CURR), cc.* EXCLUDE (SK_ID_CURR)
FROM v_application a
LEFT JOIN f_bureau b ON a.SK_ID_CURR = b.SK_ID_CURR
LEFT JOIN f_prev p ON a.SK_ID_CURR = p.SK_ID_CURR
LEFT JOIN f_ip i ON a.SK_ID_CURR = i.SK_ID_CURR
LEFT JOIN f_pc pc ON a.SK_ID_CURR = pc.SK_ID_CURR
LEFT JOIN f_cc cc ON a.SK_ID_CURR = cc.SK_ID_CURR"""
    return [
        ("f_bb", BB_SQL), ("f_bureau", BUREAU_SQL), ("f_prev", PREV_SQL), ("f_ip", IP_SQL),
        ("f_pc", PC_SQL), ("f_cc", CC_SQL), ("f_master", join),
    ]


ALL_ADAPTERS = ["v_application", "v_bureau_balance", "v_bureau", "v_previous", "v_installments", "v_pos_cash", "v_credit_card"]


def assemble_split(split: str) -> str:
    return _sat_query(
        ALL_ADAPTERS, assembled_cte() + [("f_split", f"SELECT * FROM f_master WHERE SPLIT = '{split}'")],
        ASSEMBLED_COLS, "f_split",
    )


def with_assembled(extra: list[tuple[str, str]], final_sql: str) -> str:
    """Any query over the assembled master table (``f_master``)."""
    return with_views(final_sql, *ALL_ADAPTERS, extra=assembled_cte() + extra)


def with_adapters(views: list[str], extra: list[tuple[str, str]], final_sql: str) -> str:
    """Query over adapter views plus extra CTEs."""
    return with_views(final_sql, *views, extra=extra)


# --------------------------------------------------------------------------
# Expressions, windows, trend, checks
# --------------------------------------------------------------------------

def q_safe_ratio() -> str:
    body = """SELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, AMT_PAYMENT, AMT_INSTALMENT,
       CASE WHEN AMT_INSTALMENT IS NULL OR AMT_INSTALMENT = 0 THEN NULL ELSE AMT_PAYMENT / AMT_INSTALMENT END AS payment_ratio
FROM v_installments"""
    cols = [("SK_ID_PREV", "l"), ("NUM_INSTALMENT_NUMBER", "i"), ("AMT_PAYMENT", "d"), ("AMT_INSTALMENT", "d"), ("payment_ratio", "d")]
    return with_views(_final(cols, "r"), "v_installments", extra=[("r", body)])


def q_clip_negative() -> str:
    body = """SELECT SK_ID_CURR, AMT_INCOME_TOTAL,
       CASE WHEN AMT_INCOME_TOTAL IS NULL THEN NULL WHEN AMT_INCOME_TOTAL < 0 THEN 0.0 ELSE AMT_INCOME_TOTAL END AS income_clipped
FROM v_application"""
    return with_views(_final([("SK_ID_CURR", "l"), ("AMT_INCOME_TOTAL", "d"), ("income_clipped", "d")], "r"), "v_application", extra=[("r", body)])


def q_status_flags() -> str:
    return with_views("""SELECT SK_ID_BUREAU, MONTHS_BALANCE, STATUS,
       CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END AS is_delinquent,
       CASE WHEN STATUS = 'C' THEN 1 ELSE 0 END AS is_closed,
       CASE WHEN STATUS = 'X' THEN 1 ELSE 0 END AS is_unknown
FROM v_bureau_balance""", "v_bureau_balance")


def q_overdue_flags() -> str:
    return with_views("""SELECT SK_ID_BUREAU,
       CASE WHEN CREDIT_DAY_OVERDUE > 0 THEN 1 ELSE 0 END AS bureau_has_overdue,
       CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END AS bureau_is_active,
       abs(DAYS_CREDIT) AS bureau_recency_days
FROM v_bureau""", "v_bureau")


def q_last_status() -> str:
    return with_views("""SELECT SK_ID_BUREAU, STATUS AS bb_last_status FROM (
  SELECT SK_ID_BUREAU, STATUS, row_number() OVER (PARTITION BY SK_ID_BUREAU
         ORDER BY MONTHS_BALANCE DESC NULLS LAST, STATUS DESC NULLS LAST) AS rn
  FROM v_bureau_balance) WHERE rn = 1""", "v_bureau_balance")


def q_row_rank() -> str:
    return with_views("""SELECT SK_ID_CURR, SK_ID_BUREAU, DAYS_CREDIT,
       CAST(row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT, SK_ID_BUREAU) AS BIGINT) AS row_rank
FROM v_bureau""", "v_bureau")


def q_linear_trend() -> str:
    body = """SELECT SK_ID_CURR, SK_ID_PREV,
       CASE WHEN regr_count(AMT_BALANCE, CAST(MONTHS_BALANCE AS DOUBLE)) = 0 THEN NULL
            WHEN regr_sxx(AMT_BALANCE, CAST(MONTHS_BALANCE AS DOUBLE)) = 0 THEN 0.0
            ELSE regr_slope(AMT_BALANCE, CAST(MONTHS_BALANCE AS DOUBLE)) END AS cc_balance_trend
FROM v_credit_card GROUP BY SK_ID_CURR, SK_ID_PREV"""
    return with_views(_final([("SK_ID_CURR", "l"), ("SK_ID_PREV", "l"), ("cc_balance_trend", "d")], "r"), "v_credit_card", extra=[("r", body)])


def q_duplicate_key_groups() -> str:
    return with_views("""SELECT SK_ID_BUREAU, MONTHS_BALANCE, count(*) AS n_rows
FROM v_bureau_balance GROUP BY SK_ID_BUREAU, MONTHS_BALANCE HAVING count(*) > 1""", "v_bureau_balance")


def q_join_cardinality() -> str:
    return with_views("""SELECT l.d AS left_duplicates, r.d AS right_duplicates, (l.d = 0 AND r.d = 0) AS passed
FROM (SELECT count(*) AS d FROM (SELECT SK_ID_BUREAU FROM v_bureau_balance GROUP BY 1 HAVING count(*) > 1)) l,
     (SELECT count(*) AS d FROM (SELECT SK_ID_BUREAU FROM v_bureau GROUP BY 1 HAVING count(*) > 1)) r""",
                      "v_bureau_balance", "v_bureau")


def q_safe_left_join() -> str:
    cols = APP_COLS + BUREAU_COLS[1:]
    body = "SELECT a.*, b.* EXCLUDE (SK_ID_CURR) FROM v_application a LEFT JOIN f_bureau b ON a.SK_ID_CURR = b.SK_ID_CURR"
    return with_views(_final(cols, "r"), "v_application", "v_bureau_balance", "v_bureau",
                      extra=[("f_bb", BB_SQL), ("f_bureau", BUREAU_SQL), ("r", body)])


PREV_RAW_COLS = [
    ("SK_ID_CURR", "l"), ("SK_ID_PREV", "l"), ("NAME_CONTRACT_STATUS", "s"), ("DAYS_DECISION", "i"),
    ("AMT_APPLICATION", "d"), ("AMT_CREDIT", "d"), ("AMT_DOWN_PAYMENT", "d"), ("CNT_PAYMENT", "i"), ("AMT_ANNUITY", "d"),
    ("NFLAG_INSURED_ON_APPROVAL", "i"), ("NAME_CONTRACT_TYPE", "s"), ("NAME_CLIENT_TYPE", "s"), ("PRODUCT_COMBINATION", "s"),
]


def q_drop_leaky() -> str:
    return with_views(_final(PREV_RAW_COLS, "v_previous"), "v_previous")


def q_row_counts() -> str:
    return with_assembled([], f"""SELECT 'application_' || a.SPLIT AS table_name, a.n AS rows_before, m.n AS rows_after,
       CAST({len(ASSEMBLED_COLS)} AS INTEGER) AS n_columns, a.n = m.n AS preserved
FROM (SELECT SPLIT, count(*) AS n FROM v_application GROUP BY SPLIT) a
JOIN (SELECT SPLIT, count(*) AS n FROM f_master GROUP BY SPLIT) m ON a.SPLIT = m.SPLIT""")


# --------------------------------------------------------------------------
# Profile and registry over the (canonically rounded) assembled table
# --------------------------------------------------------------------------

_TYPE_NAMES = {"l": "LongType()", "i": "IntegerType()", "d": "DoubleType()", "s": "StringType()"}


def _rounded_master() -> tuple[str, str]:
    return ("f_master_r", _final(ASSEMBLED_COLS, "f_master"))


def q_profile_exact() -> str:
    parts = []
    for name, kind in ASSEMBLED_COLS:
        if name == "SPLIT":
            continue
        parts.append(
            f"SELECT SPLIT, '{name}' AS feature, count(*) FILTER (WHERE {name} IS NULL) * 100.0 / count(*) AS null_pct, "
            f"count(DISTINCT {name}) AS approx_cardinality, '{_TYPE_NAMES[kind]}' AS data_type FROM f_master_r GROUP BY SPLIT"
        )
    body = "\nUNION ALL\n".join(parts)
    cols = [("SPLIT", "s"), ("feature", "s"), ("null_pct", "d"), ("approx_cardinality", "l"), ("data_type", "s")]
    return with_assembled([_rounded_master(), ("prof", body)], _final(cols, "prof"))


def _null_pct_sql() -> str:
    parts = [
        f"SELECT '{name}' AS feature, count(*) FILTER (WHERE {name} IS NULL) * 100.0 / count(*) AS null_pct FROM f_master_r"
        for name, _ in ASSEMBLED_COLS
    ]
    return "\nUNION ALL\n".join(parts)


def q_high_null_columns() -> str:
    return with_assembled([_rounded_master(), ("np", _null_pct_sql()), ("hn", "SELECT * FROM np WHERE null_pct > 50")],
                          _final([("feature", "s"), ("null_pct", "d")], "hn"))


def q_null_report_top_n() -> str:
    return with_assembled([_rounded_master(), ("np", _null_pct_sql()), ("top", "SELECT * FROM np ORDER BY null_pct DESC, feature LIMIT 200")],
                          _final([("feature", "s"), ("null_pct", "d")], "top"))


def _registry_values() -> str:
    from ..operators.registry import FEATURE_SPECS

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    rows = ",\n  ".join(
        f"({q(s.feature_name)}, {q(s.source_table)}, {q(s.granularity)}, {q(s.owner)}, {q(s.feature_type)}, "
        f"{q(s.risk_potential)}, {'TRUE' if s.temporal_safety else 'FALSE'}, {q(s.business_description)})"
        for s in FEATURE_SPECS
    )
    return (f"SELECT * FROM (VALUES\n  {rows}\n) AS t(feature_name, source_table, granularity, owner, feature_type, "
            "risk_potential, temporal_safety, business_description)")


def _registry_cov_sql() -> list[tuple[str, str]]:
    from ..operators.registry import FEATURE_SPECS

    bb_names = {c for c, _ in BB_COLS}
    master_names = {c for c, _ in ASSEMBLED_COLS}
    parts = []
    for s in FEATURE_SPECS:
        if s.granularity == "SK_ID_BUREAU" and s.feature_name in bb_names:
            parts.append(f"SELECT '{s.feature_name}' AS feature_name, 'SK_ID_BUREAU' AS granularity, count({s.feature_name}) AS nn FROM f_bb")
        elif s.granularity == "SK_ID_CURR" and s.feature_name in master_names:
            parts.append(f"SELECT '{s.feature_name}' AS feature_name, 'SK_ID_CURR' AS granularity, count({s.feature_name}) AS nn FROM f_master")
    measured = "\nUNION ALL\n".join(parts)
    cov = """SELECT r.*, m.nn IS NOT NULL AS present, CAST(m.nn AS BIGINT) AS non_null_rows
FROM reg r LEFT JOIN measured m ON r.feature_name = m.feature_name AND r.granularity = m.granularity"""
    return [("reg", _registry_values()), ("measured", measured), ("cov", cov)]


def q_registry_table() -> str:
    return with_assembled(_registry_cov_sql(), "SELECT * FROM cov")


def q_registry_coverage() -> str:
    return with_assembled(_registry_cov_sql(), """SELECT source_table, count(*) AS n_features,
       count(*) FILTER (WHERE present) AS n_present, min(non_null_rows) AS min_non_null_rows
FROM cov GROUP BY source_table""")


# --------------------------------------------------------------------------
# Drift (exact quantiles: value of rank max(1, ceil(p * n)) == quantile_disc)
# --------------------------------------------------------------------------

DRIFT_COLS = ["AMT_QUANTITY", "AMT_EXTENDED_PRICE", "AMT_DISCOUNT", "AMT_TAX", "AMT_ORDER_TOTAL", "DAYS_SHIP",
              "CNT_LINE_NUMBER", "AMT_PRICE_WITH_GAPS"]


def _drift_ctes() -> list[tuple[str, str]]:
    def long(src: str) -> str:
        return "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in DRIFT_COLS)

    ps = [i / 10 for i in range(11)]
    q = "\nUNION ALL\n".join(
        f"SELECT feature, {i} AS q_index, CAST({p!r} AS DOUBLE) AS p, quantile_disc(value, {p!r}) AS value "
        f"FROM ref_long WHERE value IS NOT NULL GROUP BY feature" for i, p in enumerate(ps)
    )
    return [
        ("ref_long", long("v_drift_ref")),
        ("tgt_long", long("v_drift_tgt")),
        ("qe", q),
        ("bounds", "SELECT DISTINCT feature, value AS edge FROM qe"),
        ("nb", "SELECT feature, count(*) AS n_bounds, min(edge) AS lo, max(edge) AS hi FROM bounds GROUP BY feature"),
        ("interior", "SELECT b.feature, b.edge FROM bounds b JOIN nb ON b.feature = nb.feature WHERE nb.n_bounds >= 3 AND b.edge > nb.lo AND b.edge < nb.hi"),
        ("active", "SELECT feature FROM nb WHERE n_bounds >= 3"),
        ("bucketed", """SELECT side, x.feature,
       CASE WHEN x.value IS NULL THEN 'missing'
            ELSE 'b' || CAST((SELECT count(*) FROM interior i WHERE i.feature = x.feature AND i.edge < x.value) AS VARCHAR) END AS bucket
FROM (SELECT 0 AS side, * FROM ref_long UNION ALL SELECT 1 AS side, * FROM tgt_long) x
WHERE x.feature IN (SELECT feature FROM active)"""),
        ("cnt", """SELECT feature, bucket, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS rc, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS tc
FROM bucketed GROUP BY feature, bucket"""),
        ("tot", "SELECT feature, sum(rc) AS rt, sum(tc) AS tt FROM cnt GROUP BY feature"),
        ("terms", """SELECT c.feature, c.bucket,
       CASE WHEN t.rt > 0 THEN c.rc / t.rt END AS ref_share,
       CASE WHEN t.tt > 0 THEN c.tc / t.tt END AS tgt_share,
       CASE WHEN t.rt > 0 AND t.tt > 0 THEN
         (greatest(c.tc / t.tt, 1e-6) - greatest(c.rc / t.rt, 1e-6)) * ln(greatest(c.tc / t.tt, 1e-6) / greatest(c.rc / t.rt, 1e-6))
         ELSE 0.0 END AS psi_term
FROM cnt c JOIN tot t ON c.feature = t.feature"""),
        ("feats", "\nUNION ALL\n".join(f"SELECT '{c}' AS feature" for c in DRIFT_COLS)),
        ("psi", "SELECT f.feature, coalesce(sum(t.psi_term), 0.0) AS psi FROM feats f LEFT JOIN terms t ON f.feature = t.feature GROUP BY f.feature"),
    ]


def q_quantile_edges() -> str:
    cols = [("feature", "s"), ("q_index", "i"), ("p", "d"), ("value", "d")]
    return with_views(_final(cols, "qe"), "v_drift_ref", "v_drift_tgt", extra=_drift_ctes())


def q_psi_buckets() -> str:
    cols = [("feature", "s"), ("bucket", "s"), ("ref_share", "d"), ("tgt_share", "d"), ("psi_term", "d")]
    return with_views(_final(cols, "terms"), "v_drift_ref", "v_drift_tgt", extra=_drift_ctes())


def q_psi_drift() -> str:
    return with_views(_final([("feature", "s"), ("psi", "d")], "psi"), "v_drift_ref", "v_drift_tgt", extra=_drift_ctes())


def q_psi_status() -> str:
    st = "SELECT feature, psi, CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'warn' ELSE 'stable' END AS status FROM psi"
    return with_views(_final([("feature", "s"), ("psi", "d"), ("status", "s")], "st"), "v_drift_ref", "v_drift_tgt",
                      extra=_drift_ctes() + [("st", st)])


# --------------------------------------------------------------------------
# Sources and sinks (round trips reproduce their input)
# --------------------------------------------------------------------------

BUREAU_RAW_COLS = [
    ("SK_ID_CURR", "l"), ("SK_ID_BUREAU", "l"), ("CREDIT_ACTIVE", "s"), ("DAYS_CREDIT", "i"), ("CREDIT_DAY_OVERDUE", "d"),
    ("CNT_CREDIT_PROLONG", "i"), ("AMT_CREDIT_SUM", "d"), ("AMT_CREDIT_SUM_DEBT", "d"), ("AMT_CREDIT_SUM_LIMIT", "d"),
    ("CREDIT_TYPE", "s"),
]


def q_scan_csv_roundtrip() -> str:
    return with_views(_final(BUREAU_RAW_COLS, "v_bureau"), "v_bureau")


def q_sink_parquet_roundtrip() -> str:
    return with_views(_final(BUREAU_RAW_COLS, "v_bureau"), "v_bureau")


def q_csv_parse_loss() -> str:
    return with_views("""SELECT c AS "column", t AS data_type, CAST(lost AS BIGINT) AS lost_cells FROM (
  SELECT 'SK_ID_CURR' AS c, 'bigint' AS t, 0 AS lost, 1 AS o
  UNION ALL SELECT 'TARGET', 'int', 0, 2
  UNION ALL SELECT 'DAYS_REGION', 'int', 0, 3
  UNION ALL SELECT 'FLAG_NEGATIVE_BALANCE', 'int', (SELECT count(*) FROM v_application), 4
  UNION ALL SELECT 'NAME_SEGMENT', 'string', 0, 5)""", "v_application")


# --------------------------------------------------------------------------
# Exploratory statistics
# --------------------------------------------------------------------------

CATEGORICAL_COLS = ["l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus", "c_mktsegment"]
NUMERIC_MASTER = [c for c, k in ASSEMBLED_COLS if k in ("l", "i", "d") and c != "TARGET"]


def _train_cte() -> tuple[str, str]:
    return ("tr", "SELECT * FROM f_master WHERE SPLIT = 'train'")


def q_target_distribution() -> str:
    body = "SELECT TARGET, count(*) AS n_rows, count(*) * 100.0 / (SELECT count(*) FROM v_application) AS pct FROM v_application GROUP BY TARGET"
    return with_views(_final([("TARGET", "i"), ("n_rows", "l"), ("pct", "d")], "r"), "v_application", extra=[("r", body)])


def _corr_all() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(TARGET AS DOUBLE)) AS corr FROM tr" for c in NUMERIC_MASTER
    )


def _corr_top() -> list[tuple[str, str]]:
    return [
        _train_cte(),
        ("ca", _corr_all()),
        ("ct", "SELECT feature, corr, abs(corr) AS abs_corr FROM ca WHERE corr IS NOT NULL AND NOT isnan(corr) ORDER BY abs_corr DESC, feature LIMIT 10"),
    ]


def q_corr_with_target() -> str:
    return with_assembled(_corr_top(), _final([("feature", "s"), ("corr", "d"), ("abs_corr", "d")], "ct"))


def q_corr_matrix() -> str:
    long = "\nUNION ALL\n".join(
        f"SELECT SK_ID_CURR AS id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM tr" for c in NUMERIC_MASTER + ["TARGET"]
    )
    extra = _corr_top() + [
        ("sel", "SELECT feature FROM ct UNION ALL SELECT 'TARGET'"),
        ("lg", f"SELECT * FROM ({long}) WHERE feature IN (SELECT feature FROM sel)"),
        ("cm", """SELECT a.feature AS feature_a, b.feature AS feature_b,
       CASE WHEN a.feature = b.feature THEN 1.0 ELSE corr(a.value, b.value) END AS corr
FROM lg a JOIN lg b ON a.id = b.id GROUP BY a.feature, b.feature"""),
    ]
    return with_assembled(extra, _final([("feature_a", "s"), ("feature_b", "s"), ("corr", "d")], "cm"))


def _moments_cte() -> list[tuple[str, str]]:
    parts = []
    for c in NUMERIC_MASTER:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS feature, count({x}) AS n, "
            f"avg(power({x} - m.mu, 3)) AS m3, avg(power({x} - m.mu, 2)) AS m2, avg(power({x} - m.mu, 4)) AS m4, "
            f"min({x}) = max({x}) AS flat FROM tr, (SELECT avg({x}) AS mu FROM tr) m"
        )
    mom = "\nUNION ALL\n".join(parts)
    shaped = """SELECT feature, n,
       CASE WHEN flat IS NULL OR flat THEN NULL ELSE m3 / power(m2, 1.5) END AS skewness,
       CASE WHEN flat IS NULL OR flat THEN NULL ELSE m4 / (m2 * m2) - 3.0 END AS kurtosis
FROM mom"""
    jb = """SELECT feature, n, skewness, kurtosis,
       n / 6.0 * (skewness * skewness + kurtosis * kurtosis / 4.0) AS jarque_bera,
       exp(-(n / 6.0 * (skewness * skewness + kurtosis * kurtosis / 4.0)) / 2.0) AS jb_p_value
FROM shaped"""
    return [_train_cte(), ("mom", mom), ("shaped", shaped), ("jb", jb)]


def q_skewness() -> str:
    return with_assembled(_moments_cte(), _final([("feature", "s"), ("skewness", "d")], "jb"))


def q_jarque_bera() -> str:
    cols = [("feature", "s"), ("n", "l"), ("skewness", "d"), ("kurtosis", "d"), ("jarque_bera", "d"), ("jb_p_value", "d")]
    return with_assembled(_moments_cte(), _final(cols, "jb"))


def _cat_long() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, TARGET AS target FROM v_categorical" for c in CATEGORICAL_COLS
    )


def q_contingency_table() -> str:
    body = f"SELECT feature, value, target, count(*) AS n FROM ({_cat_long()}) WHERE value IS NOT NULL AND target IS NOT NULL GROUP BY ALL"
    return with_views(_final([("feature", "s"), ("value", "s"), ("target", "i"), ("n", "l")], "r"), "v_categorical", extra=[("r", body)])


_ERFC_COEF = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def _erfc_sql(x: str) -> str:
    t = f"(1.0 / (1.0 + 0.5 * abs({x})))"
    poly = f"{_ERFC_COEF[-1]!r}"
    for c in reversed(_ERFC_COEF[:-1]):
        poly = f"({poly} * {t} + {c!r})"
    ans = f"({t} * exp(-abs({x}) * abs({x}) + {poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def _chi2_sf_sql(x: str, dof: int) -> str:
    import math

    half = f"({x} / 2.0)"
    if dof % 2 == 0:
        terms, term = ["1.0"], "1.0"
        for i in range(1, dof // 2):
            term = f"({term} * {half} / {float(i)!r})"
            terms.append(term)
        return f"(exp(-{half}) * ({' + '.join(terms)}))"
    base = _erfc_sql(f"sqrt({half})")
    if dof == 1:
        return base
    term = f"(sqrt(2.0 * {x} / {math.pi!r}) * exp(-{half}))"
    terms = [term]
    for i in range(1, (dof - 1) // 2):
        term = f"({term} * {x} / {float(2 * i + 1)!r})"
        terms.append(term)
    return f"({base} + {' + '.join(terms)})"


def _chi2_ctes(long_sql: str, group: list[str]) -> list[tuple[str, str]]:
    g = ", ".join(group)
    on = " AND ".join(f"x.{c} = y.{c}" for c in group)
    return [
        ("cl", long_sql),
        ("cnt", f"SELECT {g}, a, b, count(*) AS n FROM cl WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL"),
        ("rw", f"SELECT {g}, a, sum(n) AS row_n FROM cnt GROUP BY ALL"),
        ("cw", f"SELECT {g}, b, sum(n) AS col_n FROM cnt GROUP BY ALL"),
        ("dims", f"""SELECT x.*, y.c FROM (SELECT {g}, count(*) AS r, sum(row_n) AS total FROM rw GROUP BY ALL) x
JOIN (SELECT {g}, count(*) AS c FROM cw GROUP BY ALL) y ON {on}"""),
        ("grid", f"""SELECT d.*, rw.a, cw.b, rw.row_n * cw.col_n / d.total AS e, coalesce(cnt.n, 0) AS o
FROM dims d JOIN rw ON {' AND '.join(f'rw.{c} = d.{c}' for c in group)}
JOIN cw ON {' AND '.join(f'cw.{c} = d.{c}' for c in group)}
LEFT JOIN cnt ON {' AND '.join(f'cnt.{c} = d.{c}' for c in group)} AND cnt.a = rw.a AND cnt.b = cw.b"""),
        ("chi", f"""SELECT {g}, any_value(total) AS n, any_value(r) AS n_rows, any_value(c) AS n_cols,
       (any_value(r) - 1) * (any_value(c) - 1) AS dof,
       sum(CASE WHEN (r - 1) * (c - 1) = 1 THEN power(greatest(abs(o - e) - 0.5, 0.0), 2) / e
                ELSE power(o - e, 2) / e END) AS chi2
FROM grid GROUP BY ALL"""),
    ]


def q_chi2_vs_target() -> str:
    long = _cat_long().replace("AS value", "AS a").replace("AS target", "AS b")
    p = "CASE " + " ".join(f"WHEN dof = {d} THEN {_chi2_sf_sql('chi2', d)}" for d in range(1, 9)) + " END"
    scored = f"""SELECT feature, n, dof, chi2, {p} AS p_value,
       (chi2 - min(chi2) OVER ()) / nullif(max(chi2) OVER () - min(chi2) OVER (), 0) AS chi2_norm FROM chi"""
    cols = [("feature", "s"), ("n", "l"), ("dof", "i"), ("chi2", "d"), ("p_value", "d"), ("chi2_norm", "d")]
    return with_views(_final(cols, "sc"), "v_categorical", extra=_chi2_ctes(long, ["feature"]) + [("sc", scored)])


def q_cramers_v() -> str:
    pairs = [(a, b) for a in CATEGORICAL_COLS for b in CATEGORICAL_COLS if a != b]
    long = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b FROM v_categorical"
        for a, b in pairs
    )
    diag = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature_a, '{c}' AS feature_b, 1.0 AS cramers_v" for c in CATEGORICAL_COLS)
    v = f"""SELECT feature_a, feature_b,
       sqrt(chi2 / nullif(n * (least(n_rows, n_cols) - 1), 0)) AS cramers_v FROM chi
UNION ALL {diag}"""
    return with_views(_final([("feature_a", "s"), ("feature_b", "s"), ("cramers_v", "d")], "v"), "v_categorical",
                      extra=_chi2_ctes(long, ["feature_a", "feature_b"]) + [("v", v)])


def q_top_categories() -> str:
    parts = [
        f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, TARGET, count(*) AS n_rows FROM v_categorical
WHERE {c} IN (SELECT {c} FROM v_categorical WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 10)
GROUP BY {c}, TARGET"""
        for c in CATEGORICAL_COLS
    ]
    return with_views("\nUNION ALL\n".join(parts), "v_categorical")


def q_histogram_50() -> str:
    parts = []
    for c in NUMERIC_MASTER:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS feature, s.lo, s.hi,
       CASE WHEN s.hi = s.lo THEN 0 ELSE CAST(least(floor(({x} - s.lo) / (s.hi - s.lo) * 50), 49) AS INTEGER) END AS bin
FROM tr, (SELECT min({x}) AS lo, max({x}) AS hi FROM tr) s WHERE {x} IS NOT NULL AND '{c}' IN (SELECT feature FROM ct)""")
    hb = "\nUNION ALL\n".join(parts)
    h = """SELECT feature, bin, lo + bin * ((hi - lo) / 50) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 50) AS bin_hi, count(*) AS n_rows
FROM hb GROUP BY feature, bin, lo, hi"""
    cols = [("feature", "s"), ("bin", "i"), ("bin_lo", "d"), ("bin_hi", "d"), ("n_rows", "l")]
    return with_assembled([*_corr_top(), ("hb", hb), ("h", h)], _final(cols, "h"))


def q_column_dictionary() -> str:
    from ..operators.registry import FEATURE_SPECS

    desc = "\nUNION ALL\n".join(
        f"SELECT '{s.feature_name}' AS feature, '{s.business_description}' AS description" for s in FEATURE_SPECS
    )
    d = "SELECT np.feature, np.null_pct, dd.description FROM np LEFT JOIN (SELECT DISTINCT * FROM dsc) dd ON np.feature = dd.feature"
    return with_assembled([_rounded_master(), ("np", _null_pct_sql()), ("dsc", desc), ("d", d)],
                          _final([("feature", "s"), ("null_pct", "d"), ("description", "s")], "d"))


def q_column_dictionary_file() -> str:
    from ..operators.registry import FEATURE_SPECS

    desc = "\nUNION ALL\n".join(
        f"SELECT '{s.feature_name}' AS feature, '{s.business_description}' AS description" for s in FEATURE_SPECS
    )
    d = """SELECT np.feature, np.null_pct, dd.description FROM np LEFT JOIN (
        SELECT feature, description FROM dsc UNION SELECT feature, replace(feature, '_', ' ') FROM dsc) dd ON np.feature = dd.feature"""
    return with_assembled([_rounded_master(), ("np", _null_pct_sql()), ("dsc", desc), ("d", d)],
                          _final([("feature", "s"), ("null_pct", "d"), ("description", "s")], "d"))


def q_hash_sample() -> str:
    body = "SELECT * FROM v_bureau ORDER BY md5(CAST(SK_ID_BUREAU AS VARCHAR) || ':42') LIMIT 5000"
    return with_views(_final(BUREAU_RAW_COLS, "hs"), "v_bureau", extra=[("hs", body)])


# --------------------------------------------------------------------------
# Model preparation (md5-ordered stratified split, exact medians) and evaluation
# --------------------------------------------------------------------------

NUMERIC_MODEL = ["bureau_num_loans", "bureau_active_rate", "bureau_debt_ratio_mean", "bureau_credit_utilization_mean",
                 "prev_app_approval_rate", "prev_app_credit_ratio_mean", "ip_on_time_rate", "ip_delay_mean",
                 "ip_payment_ratio_mean", "pc_dpd_rate_mean", "cc_utilization_mean", "cc_balance_mean"]
CATEGORICAL_MODEL = ["NAME_SEGMENT", "REGION_ID"]


def _split_ctes(shares=(("test", 0.2), ("validation", 0.2), ("train", 0.6))) -> list[tuple[str, str]]:
    cats = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CATEGORICAL_MODEL)
    base = f"SELECT SK_ID_CURR, CAST(TARGET AS INTEGER) AS TARGET, {', '.join(NUMERIC_MODEL)}, {cats} FROM f_master WHERE SPLIT = 'train'"
    ranked = """SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || ':42'), SK_ID_CURR) AS rk,
       count(*) OVER (PARTITION BY TARGET) AS cn FROM mb"""
    cum, whens = 0.0, []
    for name, share in shares[:-1]:
        cum += share
        whens.append(f"WHEN rk <= ceil(cn * CAST({cum!r} AS DOUBLE)) THEN '{name}'")
    case = f"CASE {' '.join(whens)} ELSE '{shares[-1][0]}' END"
    return [("mb", base), ("mr", ranked), ("ms", f"SELECT * EXCLUDE (rk, cn), {case} AS split FROM mr")]


def q_stratified_split_md5() -> str:
    return with_assembled(_split_ctes(), "SELECT SK_ID_CURR, TARGET, split FROM ms")


def q_stratified_subsample() -> str:
    return with_assembled(_split_ctes((("keep", 0.2), ("drop", 0.8))), "SELECT SK_ID_CURR, TARGET FROM ms WHERE split = 'keep'")


def _impute_ctes() -> list[tuple[str, str]]:
    med = ", ".join(f"quantile_disc(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in NUMERIC_MODEL)
    filled = ", ".join(f"coalesce(CAST(ms.{c} AS DOUBLE), md.{c}) AS {c}" for c in NUMERIC_MODEL)
    return _split_ctes() + [
        ("md", f"SELECT {med} FROM ms WHERE split = 'train'"),
        ("mi", f"SELECT ms.SK_ID_CURR, ms.TARGET, ms.split, {filled}, {', '.join('ms.' + c for c in CATEGORICAL_MODEL)} FROM ms, md"),
    ]


def q_impute_median() -> str:
    cols = [("SK_ID_CURR", "l"), ("split", "s")] + [(c, "d") for c in NUMERIC_MODEL]
    return with_assembled(_impute_ctes(), _final(cols, "mi"))


def _scale_ctes() -> list[tuple[str, str]]:
    stats = ", ".join(f"avg({c}) AS {c}__m, stddev_pop({c}) AS {c}__s" for c in NUMERIC_MODEL)
    scaled = ", ".join(
        f"(mi.{c} - coalesce(st.{c}__m, 0.0)) / (CASE WHEN st.{c}__s IS NULL OR st.{c}__s = 0 THEN 1.0 ELSE st.{c}__s END) AS {c}"
        for c in NUMERIC_MODEL
    )
    return _impute_ctes() + [
        ("st", f"SELECT {stats} FROM mi WHERE split = 'train'"),
        ("sc", f"SELECT mi.SK_ID_CURR, mi.TARGET, mi.split, {scaled} FROM mi, st"),
    ]


def q_standard_scale() -> str:
    cols = [("SK_ID_CURR", "l"), ("split", "s")] + [(c, "d") for c in NUMERIC_MODEL]
    return with_assembled(_scale_ctes(), _final(cols, "sc"))


def q_impute_mode() -> str:
    modes = []
    for c in CATEGORICAL_MODEL:
        modes.append(f"""(SELECT {c} FROM ms WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c}
   ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}""")
    md = "SELECT " + ", ".join(modes)
    fill = ", ".join(f"coalesce(ms.{c}, mo.{c}) AS {c}" for c in CATEGORICAL_MODEL)
    return with_assembled(_split_ctes() + [("mo", md), ("mf", f"SELECT ms.SK_ID_CURR, ms.split, {fill} FROM ms, mo")],
                          "SELECT * FROM mf")


def q_class_weights() -> str:
    body = """SELECT TARGET, count(*) AS n_rows,
       CAST((SELECT count(*) FROM ms WHERE split = 'train') AS DOUBLE)
         / (CAST((SELECT count(DISTINCT TARGET) FROM ms WHERE split = 'train') AS DOUBLE) * count(*)) AS weight
FROM ms WHERE split = 'train' GROUP BY TARGET"""
    return with_assembled(_split_ctes() + [("cw", body)], _final([("TARGET", "i"), ("n_rows", "l"), ("weight", "d")], "cw"))


def q_gaussian_nb_moments() -> str:
    long = "\nUNION ALL\n".join(
        f"SELECT TARGET AS label, '{c}' AS feature, {c} AS value FROM sc WHERE split = 'train'" for c in NUMERIC_MODEL
    )
    g = f"SELECT label, feature, count(value) AS n, avg(value) AS mean, var_pop(value) AS variance FROM ({long}) GROUP BY label, feature"
    cols = [("label", "i"), ("feature", "s"), ("n", "l"), ("mean", "d"), ("variance", "d")]
    return with_assembled(_scale_ctes() + [("g", g)], _final(cols, "g"))


def q_confusion_matrix() -> str:
    return with_views("SELECT y AS label, pred AS prediction, count(*) AS n_rows FROM v_scores GROUP BY y, pred", "v_scores")


def _report_ctes() -> list[tuple[str, str]]:
    per = """SELECT c,
       count(*) FILTER (WHERE y = c AND pred = c) AS tp,
       count(*) FILTER (WHERE y = c) AS support,
       count(*) FILTER (WHERE pred = c) AS predicted
FROM (SELECT DISTINCT y AS c FROM v_scores UNION SELECT DISTINCT pred FROM v_scores) k, v_scores GROUP BY c"""
    rep = """SELECT CAST(c AS VARCHAR) AS class_label,
       CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
       CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM per"""
    f1 = """SELECT class_label, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM rep
UNION ALL
SELECT NULL, avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END),
       avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), count(*) FROM v_scores"""
    return [("per", per), ("rep", rep), ("cr", f1)]


def q_classification_report() -> str:
    cols = [("class_label", "s"), ("precision", "d"), ("recall", "d"), ("f1", "d"), ("support", "l")]
    return with_views(_final(cols, "cr"), "v_scores", extra=_report_ctes())


def _roc_ctes() -> list[tuple[str, str]]:
    ps = """SELECT CAST(score AS DOUBLE) AS threshold, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
       CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg FROM v_scores GROUP BY 1"""
    rc = """SELECT threshold, pos, neg,
       sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
       sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
       sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM ps"""
    curve = "SELECT threshold, tp, fp, CASE WHEN N > 0 THEN fp / N END AS fpr, CASE WHEN P > 0 THEN tp / P END AS tpr FROM rc"
    return [("ps", ps), ("rc", rc), ("curve", curve)]


def q_roc_curve() -> str:
    cols = [("threshold", "d"), ("tp", "d"), ("fp", "d"), ("fpr", "d"), ("tpr", "d")]
    return with_views(_final(cols, "curve"), "v_scores", extra=_roc_ctes())


def q_roc_auc() -> str:
    auc = """SELECT sum(neg * (tp - pos + pos / 2.0)) / (any_value(P) * any_value(N)) AS auc,
       CAST(any_value(P) AS BIGINT) AS n_pos, CAST(any_value(N) AS BIGINT) AS n_neg FROM rc"""
    return with_views(_final([("auc", "d"), ("n_pos", "l"), ("n_neg", "l")], "a"), "v_scores", extra=_roc_ctes() + [("a", auc)])


def q_recall_train_test() -> str:
    body = "SELECT split, avg(CASE WHEN pred = 1 THEN 1.0 ELSE 0.0 END) AS recall FROM v_scores WHERE y = 1 GROUP BY split"
    return with_views(_final([("split", "s"), ("recall", "d")], "r"), "v_scores", extra=[("r", body)])


def q_wilcoxon_paired() -> str:
    flags = "SELECT doc_id, split, CAST(pred = 1 AND y = 1 AS INTEGER) AS tp FROM v_scores"
    pa = "SELECT row_number() OVER (ORDER BY doc_id) AS pos, tp AS fa FROM fl WHERE split = 'train'"
    pb = "SELECT row_number() OVER (ORDER BY doc_id) AS pos, tp AS fb FROM fl WHERE split = 'test'"
    cnt = "SELECT count(*) FILTER (WHERE fa - fb > 0) AS n_pos, count(*) FILTER (WHERE fa - fb < 0) AS n_neg FROM pa JOIN pb ON pa.pos = pb.pos"
    w = """SELECT n_pos, n_neg, n_pos + n_neg AS n,
       least(n_pos, n_neg) * (CAST(n_pos + n_neg AS DOUBLE) + 1) / 2.0 AS w,
       CAST(n_pos + n_neg AS DOUBLE) AS nd FROM cnt"""
    z = """SELECT n_pos, n_neg, n, w,
       CASE WHEN nd * (nd + 1) * (2 * nd + 1) / 24.0 - (nd * nd * nd - nd) / 48.0 > 0
            THEN (w - nd * (nd + 1) / 4.0) / sqrt(nd * (nd + 1) * (2 * nd + 1) / 24.0 - (nd * nd * nd - nd) / 48.0) END AS z
FROM wv"""
    cols = [("n_pos", "l"), ("n_neg", "l"), ("n", "l"), ("w", "d"), ("z", "d")]
    return with_views(_final(cols, "zz"), "v_scores",
                      extra=[("fl", flags), ("pa", pa), ("pb", pb), ("cnt", cnt), ("wv", w), ("zz", z)])


def q_evaluation_report() -> str:
    cm = "SELECT 'count_pred_' || CAST(pred AS VARCHAR) AS metric, CAST(y AS VARCHAR) AS class_label, CAST(count(*) AS DOUBLE) AS value FROM v_scores GROUP BY y, pred"
    st = """SELECT 'precision' AS metric, class_label, precision AS value FROM cr
UNION ALL SELECT 'recall', class_label, recall FROM cr
UNION ALL SELECT 'f1', class_label, f1 FROM cr
UNION ALL SELECT 'support', class_label, CAST(support AS DOUBLE) FROM cr"""
    auc = "SELECT 'auc' AS metric, NULL AS class_label, sum(neg * (tp - pos + pos / 2.0)) / (any_value(P) * any_value(N)) AS value FROM rc"
    allr = "SELECT * FROM cmx UNION ALL SELECT * FROM stx UNION ALL SELECT * FROM aucx"
    cols = [("metric", "s"), ("class_label", "s"), ("value", "d")]
    return with_views(_final(cols, "er"), "v_scores",
                      extra=_report_ctes() + _roc_ctes() + [("cmx", cm), ("stx", st), ("aucx", auc), ("er", allr)])


# ---- oversampling, distributions, folds, encoding ---------------------------------


def _published_scaled() -> list[tuple[str, str]]:
    cols = ", ".join(f"CAST({canon(f'CAST({c} AS DOUBLE)')} AS DOUBLE) AS {c}" for c in NUMERIC_MODEL)
    pub = f"SELECT SK_ID_CURR, TARGET, {cols} FROM sc WHERE split = 'train'"
    small = "SELECT TARGET AS value, count(*) AS n, (SELECT max(n) FROM (SELECT count(*) AS n FROM pub GROUP BY TARGET)) AS most FROM pub GROUP BY TARGET ORDER BY n, TARGET LIMIT 1"
    square = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in NUMERIC_MODEL)
    nb = f"""SELECT a.SK_ID_CURR, b.SK_ID_CURR AS neighbour, sqrt({square}) AS distance
FROM pub a, pub b, small WHERE a.TARGET = value AND b.TARGET = value AND a.SK_ID_CURR <> b.SK_ID_CURR"""
    nr = "SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY distance, neighbour) AS place FROM nb"
    return _scale_ctes() + [("pub", pub), ("small", small), ("nb", nb), ("nr", f"SELECT * FROM ({nr}) WHERE place <= 5")]


def q_smote_neighbours() -> str:
    cols = [("SK_ID_CURR", "l"), ("place", "i"), ("neighbour", "l"), ("distance", "d")]
    return with_assembled(_published_scaled(), _final(cols, "nr"))


def _hash_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def q_smote_rows() -> str:
    key = "CAST(SK_ID_CURR AS VARCHAR)"
    rk = f"SELECT SK_ID_CURR, row_number() OVER (ORDER BY {_hash_number(key + chr(32) + '||' + chr(39) + ':42' + chr(39))}, SK_ID_CURR) AS r FROM pub, small WHERE TARGET = value"
    dealt = "SELECT SK_ID_CURR, unnest(range(1, 1 + CAST((most - n) // n + CASE WHEN r <= (most - n) % n THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM rk, small"
    tag = f"{key} || ':' || CAST(copy AS VARCHAR) || ':42:'"
    sizes = "SELECT SK_ID_CURR, max(place) AS k FROM nr GROUP BY SK_ID_CURR"
    drawn = f"""SELECT d.SK_ID_CURR, d.copy, {_hash_number(tag.replace('SK_ID_CURR', 'd.SK_ID_CURR') + " || 'neighbour'")} % k + 1 AS place,
       {_hash_number(tag.replace('SK_ID_CURR', 'd.SK_ID_CURR') + " || 'step'")} / 4294967296.0::DOUBLE AS step
FROM dealt d JOIN sizes USING (SK_ID_CURR)"""
    moved = ", ".join(f"a.{c} + d.step * (b.{c} - a.{c}) AS {c}" for c in NUMERIC_MODEL)
    sm = f"""SELECT d.SK_ID_CURR AS base, d.copy, n.neighbour, d.step, a.TARGET, {moved}
FROM drawn d JOIN nr n USING (SK_ID_CURR, place) JOIN pub a ON a.SK_ID_CURR = d.SK_ID_CURR JOIN pub b ON b.SK_ID_CURR = n.neighbour"""
    cols = [("base", "l"), ("copy", "i"), ("neighbour", "l"), ("step", "d"), ("TARGET", "i")] + [(c, "d") for c in NUMERIC_MODEL]
    return with_assembled(_published_scaled() + [("rk", rk), ("dealt", dealt), ("sizes", sizes), ("drawn", drawn), ("sm", sm)], _final(cols, "sm"))


def q_density_curve() -> str:
    lf = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM tr WHERE {c} IS NOT NULL" for c in NUMERIC_MODEL[:6])
    st = """SELECT feature, count(*) AS n, min(v) AS lo, (max(v) - min(v)) / 199 AS step, stddev_samp(v) * power(CAST(count(*) AS DOUBLE), -0.2) AS h
FROM lf GROUP BY feature HAVING max(v) > min(v)"""
    near = "SELECT feature, least(floor((v - lo) / step), 198) AS spot, (v - lo) / step - least(floor((v - lo) / step), 198) AS part FROM lf JOIN st USING (feature)"
    ms = "SELECT feature, spot, sum(mass) AS mass FROM (SELECT feature, spot, 1 - part AS mass FROM near UNION ALL SELECT feature, spot + 1, part FROM near) GROUP BY feature, spot"
    cv = """SELECT feature, point, lo + point * step AS x,
       sum(mass * exp(-((point - spot) * step / h) * ((point - spot) * step / h) / 2)) / (n * h * sqrt(2 * pi())) AS density
FROM (SELECT *, unnest(range(200)) AS point FROM st) JOIN ms USING (feature) GROUP BY feature, point, lo, step, n, h"""
    cols = [("feature", "s"), ("point", "i"), ("x", "d"), ("density", "d")]
    return with_assembled([_train_cte(), ("lf", lf), ("st", st), ("near", near), ("ms", ms), ("cv", cv)], _final(cols, "cv"))


def q_signed_rank() -> str:
    df = "SELECT bureau_debt_ratio_mean - prev_app_credit_ratio_mean AS d FROM tr"
    sz = "SELECT abs(d) AS size, CAST(count(*) FILTER (WHERE d > 0) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS t FROM df WHERE d <> 0 GROUP BY abs(d)"
    rk = "SELECT *, sum(t) OVER (ORDER BY size) - (t - 1) / 2 AS mid FROM sz"
    sm = """SELECT sum(t) AS n, coalesce(sum(CASE WHEN t > 1 THEN t END), 0) AS n_ties, sum(mid * pos) AS w_plus, sum(mid * (t - pos)) AS w_minus,
       sum(t * t * t - t) AS tied FROM rk"""
    zz = """SELECT *, least(w_plus, w_minus) AS w, n_ties = 0 AND n <= 50 AS exact,
       (least(w_plus, w_minus) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - tied / 48) AS z FROM sm"""
    cols = [("n", "l"), ("n_ties", "l"), ("w_plus", "d"), ("w_minus", "d"), ("w", "d"), ("z", "d"), ("exact", "b")]
    return with_assembled([_train_cte(), ("df", df), ("sz", sz), ("rk", rk), ("sm", sm), ("zz", zz)], _final(cols, "zz"))


def q_stratified_folds() -> str:
    body = "SELECT SK_ID_CURR, TARGET, CAST((row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || ':42'), SK_ID_CURR) - 1) % 3 AS INTEGER) AS fold FROM tr"
    return with_assembled([_train_cte(), ("sf", body)], _final([("SK_ID_CURR", "l"), ("TARGET", "i"), ("fold", "i")], "sf"))


def q_one_hot_places() -> str:
    values = " UNION ALL ".join(f"SELECT DISTINCT {i} AS col, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM ms WHERE split = 'train' AND {c} IS NOT NULL" for i, c in enumerate(CATEGORICAL_MODEL))
    codes = f"SELECT *, row_number() OVER (ORDER BY col, value) - 1 AS idx FROM ({values})"
    rows = " UNION ALL ".join(f"SELECT SK_ID_CURR, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM ms" for c in CATEGORICAL_MODEL)
    oh = f"SELECT r.SK_ID_CURR, r.feature, c.idx AS \"index\" FROM ({rows}) r JOIN codes c USING (feature, value)"
    return with_assembled(_split_ctes() + [("codes", codes), ("oh", oh)], 'SELECT CAST(SK_ID_CURR AS BIGINT) AS SK_ID_CURR, feature, CAST("index" AS INTEGER) AS "index" FROM oh')


def q_ks_normal() -> str:
    lf = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM tr WHERE {c} IS NOT NULL AND '{c}' IN (SELECT feature FROM ct)" for c in NUMERIC_MASTER)
    ct = "SELECT feature, v, CAST(count(*) AS DOUBLE) AS t FROM lf GROUP BY feature, v"
    rk = "SELECT *, sum(t) OVER (PARTITION BY feature ORDER BY v) AS upto, sum(t) OVER (PARTITION BY feature) AS n FROM cnt"
    # The distribution function by its series around 0, each term from logarithms of factorials.
    series = "list_sum(list_transform(range(0, 120), lambda k: exp((2 * k + 1) * ln(abs(v)) - lgamma(2.0 * k + 2) + k * ln(2.0) + lgamma(k + 1.0))))"
    phi = f"CASE WHEN v = 0 THEN 0.5 WHEN abs(v) > 7 THEN CASE WHEN v > 0 THEN 1.0 ELSE 0.0 END ELSE 0.5 + sign(v) * exp(-v * v / 2) / sqrt(2 * pi()) * {series} END"
    st = f"SELECT feature, n, max(greatest(upto / n - phi, phi - (upto - t) / n)) AS statistic FROM (SELECT *, {phi} AS phi FROM rk) GROUP BY feature, n"
    size = "((sqrt(n) + 0.12 + 0.11 / sqrt(n)) * statistic)"
    rest = f"list_sum(list_transform(range(1, 41), lambda k: CASE WHEN k % 2 = 0 THEN 1.0 ELSE -1.0 END * exp(-2 * ((k + 1) * (k + 1) - 1) * {size} * {size})))"
    ks = f"""SELECT feature, n, statistic, CASE WHEN {size} < 0.2 THEN 0.0
  ELSE least(0.0, log10(2.0) - 2 * {size} * {size} / ln(10.0) + log10(greatest(1e-300, 1 + {rest}))) END AS log10_p FROM st"""
    cols = [("feature", "s"), ("n", "l"), ("statistic", "d"), ("log10_p", "d")]
    return with_assembled([*_corr_top(), ("lf", lf), ("cnt", ct), ("rk", rk), ("st", st), ("ks", ks)], _final(cols, "ks"))
