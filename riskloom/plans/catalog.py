"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus their oracle SQL.

Every query reads the given test tables (through the adapters) over whole
tables, so its work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions.expr import round_doubles
from ..operators import satellites as S
from ..sources import testdata as td
from . import assemble as A
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def raw_tables(t: td.TestTables) -> A.RawTables:
    return A.RawTables(
        application=td.application(t),
        bureau=td.bureau(t),
        bureau_balance=td.bureau_balance(t),
        previous_application=td.previous_application(t),
        installments_payments=td.installments_payments(t),
        pos_cash_balance=td.pos_cash_balance(t),
        credit_card_balance=td.credit_card_balance(t),
    )


# ---- satellites -----------------------------------------------------------


@register("feat_bureau_balance", O.feat_bureau_balance)
def feat_bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    return round_doubles(S.bureau_balance_features(td.bureau_balance(t)))


@register("feat_bureau", O.feat_bureau)
def feat_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    bb = S.bureau_balance_features(td.bureau_balance(t))
    return round_doubles(S.bureau_features(td.bureau(t), bb))


@register("feat_previous", O.feat_previous)
def feat_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    return round_doubles(S.previous_application_features(td.previous_application(t)))


@register("feat_installments", O.feat_installments)
def feat_installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    return round_doubles(S.installments_features(td.installments_payments(t)))


@register("feat_pos_cash", O.feat_pos_cash)
def feat_pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    return round_doubles(S.pos_cash_features(td.pos_cash_balance(t)))


@register("feat_credit_card", O.feat_credit_card)
def feat_credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    return round_doubles(S.credit_card_features(td.credit_card_balance(t)))


# ---- assembly ---------------------------------------------------------------


@register("assemble_train", lambda: O.assemble_split("train"))
def assemble_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    return round_doubles(A.build_master_dataset(raw_tables(t), split="train"))


@register("assemble_test", lambda: O.assemble_split("test"))
def assemble_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.TestTables(spark, sf_dir)
    return round_doubles(A.build_master_dataset(raw_tables(t), split="test"))


# ---- expressions, windows, trend --------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from ..functions import expr as X  # noqa: E402
from ..operators import checks as C  # noqa: E402
from ..operators import drift as DR  # noqa: E402
from ..operators import ordered as OR  # noqa: E402
from ..operators import profile as P  # noqa: E402
from ..operators import registry as R  # noqa: E402
from ..operators import windows as W  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..session import ensure_checkpoint_dir, scratch_table  # noqa: E402


@register("safe_ratio", O.q_safe_ratio)
def q_safe_ratio(spark, sf_dir):
    ip = td.installments_payments(td.TestTables(spark, sf_dir))
    return round_doubles(ip.select("SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "AMT_PAYMENT", "AMT_INSTALMENT",
                                   X.safe_ratio("AMT_PAYMENT", "AMT_INSTALMENT").alias("payment_ratio")))


@register("clip_negative", O.q_clip_negative)
def q_clip_negative(spark, sf_dir):
    app = td.application(td.TestTables(spark, sf_dir))
    return round_doubles(app.select("SK_ID_CURR", "AMT_INCOME_TOTAL", X.clip_negative("AMT_INCOME_TOTAL").alias("income_clipped")))


@register("status_flags", O.q_status_flags)
def q_status_flags(spark, sf_dir):
    bb = td.bureau_balance(td.TestTables(spark, sf_dir))
    return bb.select(
        "SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS",
        X.flag_in("STATUS", S.DELINQUENT_STATUSES).alias("is_delinquent"),
        X.flag_eq("STATUS", S.CLOSED_STATUS).alias("is_closed"),
        X.flag_eq("STATUS", S.UNKNOWN_STATUS).alias("is_unknown"),
    )


@register("overdue_flags", O.q_overdue_flags)
def q_overdue_flags(spark, sf_dir):
    b = td.bureau(td.TestTables(spark, sf_dir))
    return b.select(
        "SK_ID_BUREAU",
        X.flag_gt("CREDIT_DAY_OVERDUE", 0).alias("bureau_has_overdue"),
        X.flag_eq("CREDIT_ACTIVE", "Active").alias("bureau_is_active"),
        X.abs_recency("DAYS_CREDIT").alias("bureau_recency_days"),
    )


@register("last_status_per_key", O.q_last_status)
def q_last_status(spark, sf_dir):
    return W.last_status_per_key(td.bureau_balance(td.TestTables(spark, sf_dir)))


@register("row_rank", O.q_row_rank)
def q_row_rank(spark, sf_dir):
    b = td.bureau(td.TestTables(spark, sf_dir)).select("SK_ID_CURR", "SK_ID_BUREAU", "DAYS_CREDIT")
    return OR.row_rank(b, ["SK_ID_CURR"], "DAYS_CREDIT", tie_break=["SK_ID_BUREAU"])


@register("linear_trend", O.q_linear_trend)
def q_linear_trend(spark, sf_dir):
    cc = td.credit_card_balance(td.TestTables(spark, sf_dir))
    return round_doubles(W.linear_trend(cc, ["SK_ID_CURR", "SK_ID_PREV"], "MONTHS_BALANCE", "AMT_BALANCE", "cc_balance_trend"))


# ---- checks -----------------------------------------------------------------


@register("duplicate_key_groups", O.q_duplicate_key_groups)
def q_duplicate_key_groups(spark, sf_dir):
    bb = td.bureau_balance(td.TestTables(spark, sf_dir))
    return C.duplicate_key_groups(bb, ["SK_ID_BUREAU", "MONTHS_BALANCE"])


@register("join_cardinality", O.q_join_cardinality)
def q_join_cardinality(spark, sf_dir):
    t = td.TestTables(spark, sf_dir)
    return C.join_cardinality(td.bureau_balance(t), td.bureau(t), ["SK_ID_BUREAU"])


@register("safe_left_join", O.q_safe_left_join)
def q_safe_left_join(spark, sf_dir):
    t = td.TestTables(spark, sf_dir)
    bb = S.bureau_balance_features(td.bureau_balance(t))
    feats = S.bureau_features(td.bureau(t), bb)
    return round_doubles(C.safe_left_join(td.application(t), feats, ["SK_ID_CURR"], "bureau_features"))


@register("drop_leaky_columns", O.q_drop_leaky)
def q_drop_leaky(spark, sf_dir):
    return round_doubles(S.drop_leaky_columns(td.previous_application(td.TestTables(spark, sf_dir))))


@register("row_counts", O.q_row_counts)
def q_row_counts(spark, sf_dir):
    return A.cardinality_report(raw_tables(td.TestTables(spark, sf_dir)))


# ---- profile, registry -------------------------------------------------------


def _assembled(spark, sf_dir):
    return round_doubles(A.build_master_dataset(raw_tables(td.TestTables(spark, sf_dir)), check_master=False))


@register("profile_exact", O.q_profile_exact)
def q_profile_exact(spark, sf_dir):
    return round_doubles(P.basic_profile(_assembled(spark, sf_dir), exact=True, by=["SPLIT"]))


@register("profile_approx")
def q_profile_approx(spark, sf_dir):
    return round_doubles(P.basic_profile(_assembled(spark, sf_dir), exact=False, by=["SPLIT"]))


@register("high_null_columns", O.q_high_null_columns)
def q_high_null_columns(spark, sf_dir):
    return round_doubles(P.high_null_columns(_assembled(spark, sf_dir), 50.0))


@register("null_report_top_n", O.q_null_report_top_n)
def q_null_report_top_n(spark, sf_dir):
    return round_doubles(P.null_report_top_n(_assembled(spark, sf_dir), 200))


def _registry_cov(spark, sf_dir):
    t = td.TestTables(spark, sf_dir)
    raw = raw_tables(t)
    bb = S.bureau_balance_features(raw.bureau_balance)
    master = A.build_master_dataset(raw, check_master=False)
    return R.registry_with_coverage(R.registry_to_dataframe(spark), {"SK_ID_BUREAU": bb, "SK_ID_CURR": master})


@register("registry_table", O.q_registry_table)
def q_registry_table(spark, sf_dir):
    return _registry_cov(spark, sf_dir)


@register("registry_coverage", O.q_registry_coverage)
def q_registry_coverage(spark, sf_dir):
    cov = _registry_cov(spark, sf_dir)
    return cov.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("present")).alias("n_present"),
        F.min("non_null_rows").alias("min_non_null_rows"),
    )


# ---- drift -------------------------------------------------------------------


def _drift_sides(spark, sf_dir):
    t = td.TestTables(spark, sf_dir)
    return td.drift_reference(t), td.drift_target(t)


@register("quantile_edges", O.q_quantile_edges)
def q_quantile_edges(spark, sf_dir):
    ref, tgt = _drift_sides(spark, sf_dir)
    return round_doubles(DR.quantile_edges(ref, DR.drift_candidates(ref, tgt), relative_error=0.0))


@register("psi_buckets", O.q_psi_buckets)
def q_psi_buckets(spark, sf_dir):
    ref, tgt = _drift_sides(spark, sf_dir)
    return round_doubles(DR.psi_buckets(ref, tgt, relative_error=0.0))


@register("psi_drift", O.q_psi_drift)
def q_psi_drift(spark, sf_dir):
    ref, tgt = _drift_sides(spark, sf_dir)
    return round_doubles(DR.psi_report(ref, tgt, relative_error=0.0))


@register("psi_status", O.q_psi_status)
def q_psi_status(spark, sf_dir):
    ref, tgt = _drift_sides(spark, sf_dir)
    return round_doubles(DR.psi_status(DR.psi_report(ref, tgt, relative_error=0.0)))


@register("psi_drift_approx")
def q_psi_drift_approx(spark, sf_dir):
    ref, tgt = _drift_sides(spark, sf_dir)
    return round_doubles(DR.psi_report(ref, tgt))


# ---- sources and sinks ---------------------------------------------------------


def _scratch(spark, name):
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-scratch/{name}-{uuid.uuid4().hex}"


@register("scan_csv_roundtrip", O.q_scan_csv_roundtrip)
def q_scan_csv_roundtrip(spark, sf_dir):
    b = td.bureau(td.TestTables(spark, sf_dir))
    path = _scratch(spark, "bureau-csv")
    b.write.mode("overwrite").option("header", True).csv(path)
    return round_doubles(FS.read_csv_table(spark, path))


@register("csv_parse_loss", O.q_csv_parse_loss)
def q_csv_parse_loss(spark, sf_dir):
    app = td.application(td.TestTables(spark, sf_dir))
    text = app.select(
        F.col("SK_ID_CURR").cast("string").alias("SK_ID_CURR"),
        F.col("TARGET").cast("string").alias("TARGET"),
        F.format_string("%.1f", F.col("REGION_ID").cast("double")).alias("DAYS_REGION"),
        F.when(F.col("TARGET") == 1, "Y").otherwise("N").alias("FLAG_NEGATIVE_BALANCE"),
        F.col("NAME_SEGMENT"),
    )
    path = _scratch(spark, "parse-loss-csv")
    text.write.mode("overwrite").option("header", True).csv(path)
    return FS.parse_loss(FS.read_csv_raw(spark, path))


@register("sink_parquet_roundtrip", O.q_sink_parquet_roundtrip)
def q_sink_parquet_roundtrip(spark, sf_dir):
    b = td.bureau(td.TestTables(spark, sf_dir))
    path = _scratch(spark, "bureau-parquet")
    FS.write_parquet(b, path, partition_by=["CREDIT_TYPE"], repartition_by=["SK_ID_CURR"], max_records_per_file=250_000)
    return round_doubles(spark.read.parquet(path).select(*b.columns))


# ---- exploratory statistics ----------------------------------------------------

from ..operators import stats as ST  # noqa: E402

CATEGORICAL_COLS = ["l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus", "c_mktsegment"]


def _train(spark, sf_dir):
    return A.build_master_dataset(raw_tables(td.TestTables(spark, sf_dir)), split="train", check_master=False)


@register("target_distribution", O.q_target_distribution)
def q_target_distribution(spark, sf_dir):
    return round_doubles(ST.value_counts(td.application(td.TestTables(spark, sf_dir)), "TARGET"))


@register("corr_with_target", O.q_corr_with_target)
def q_corr_with_target(spark, sf_dir):
    return round_doubles(ST.corr_with_target(_train(spark, sf_dir), "TARGET", top_k=10))


def _ranked(train):
    """The ten columns that go best with the target."""
    return [r["feature"] for r in ST.corr_with_target(train, "TARGET", top_k=10).collect()]  # 10 names


@register("corr_matrix", O.q_corr_matrix)
def q_corr_matrix(spark, sf_dir):
    train = scratch_table(_train(spark, sf_dir), "train")  # read twice
    top = _ranked(train)
    return round_doubles(ST.corr_matrix(train, top + ["TARGET"]))


def _moments(spark, sf_dir):
    train = _train(spark, sf_dir)
    return ST.moments(train, ST.numeric_columns(train, exclude=["TARGET"]))


@register("skewness", O.q_skewness)
def q_skewness(spark, sf_dir):
    return round_doubles(_moments(spark, sf_dir).select("feature", "skewness"))


@register("jarque_bera", O.q_jarque_bera)
def q_jarque_bera(spark, sf_dir):
    return round_doubles(_moments(spark, sf_dir))


@register("ks_normal", O.q_ks_normal)
def q_ks_normal(spark, sf_dir):
    train = scratch_table(_train(spark, sf_dir), "train")  # read twice
    return round_doubles(DI.ks_normal(train, _ranked(train)))


@register("contingency_table", O.q_contingency_table)
def q_contingency_table(spark, sf_dir):
    return ST.contingency_long(td.categorical(td.TestTables(spark, sf_dir)), CATEGORICAL_COLS, "TARGET")


@register("chi2_vs_target", O.q_chi2_vs_target)
def q_chi2_vs_target(spark, sf_dir):
    return round_doubles(ST.chi2_vs_target(td.categorical(td.TestTables(spark, sf_dir)), CATEGORICAL_COLS, "TARGET"))


@register("cramers_v_matrix", O.q_cramers_v)
def q_cramers_v(spark, sf_dir):
    return round_doubles(ST.cramers_v_matrix(td.categorical(td.TestTables(spark, sf_dir)), CATEGORICAL_COLS))


@register("top_categories_by_target", O.q_top_categories)
def q_top_categories(spark, sf_dir):
    # Read once for the ranking and twice for each column.
    table = scratch_table(td.categorical(td.TestTables(spark, sf_dir)).select("TARGET", *CATEGORICAL_COLS), "categorical")
    best = ST.chi2_vs_target(table, CATEGORICAL_COLS, "TARGET").orderBy(F.desc("chi2"), "feature").limit(5).collect()  # 5 names
    parts = [ST.top_categories_by_target(table, r["feature"], "TARGET", 10).select(F.lit(r["feature"]).alias("feature"), F.col(r["feature"]).cast("string").alias("category"), "TARGET", "n_rows") for r in best]
    return reduce(DataFrame.unionByName, parts)


@register("histogram_50", O.q_histogram_50)
def q_histogram_50(spark, sf_dir):
    train = scratch_table(_train(spark, sf_dir), "train")  # read three times
    return round_doubles(ST.histogram(train, _ranked(train), 50))


@register("column_dictionary", O.q_column_dictionary)
def q_column_dictionary(spark, sf_dir):
    nulls = P.null_percentages(_assembled(spark, sf_dir))
    desc = R.registry_to_dataframe(spark).select(F.col("feature_name").alias("feature"), F.col("business_description").alias("description")).distinct()
    return round_doubles(nulls.join(F.broadcast(desc), "feature", "left"))


@register("column_dictionary_file", O.q_column_dictionary_file)
def q_column_dictionary_file(spark, sf_dir):
    """Null shares of the assembled columns with all descriptions of a dictionary file, which is written from the registry: its descriptions twice, and each feature's name in words."""
    from ..sources.dictionary import describe_columns, read_dictionary

    nulls = P.null_percentages(_assembled(spark, sf_dir))
    known = R.registry_to_dataframe(spark).select(F.lit("registry").alias("Table"), F.col("feature_name").alias("Row"), F.col("business_description").alias("Description"))
    words = known.select(F.lit("names").alias("Table"), "Row", F.translate("Row", "_", " ").alias("Description"))
    path = _scratch(spark, "dictionary-csv")
    known.unionByName(known.withColumn("Table", F.lit("again"))).unionByName(words).write.option("header", True).option("escape", '"').csv(path)
    return round_doubles(describe_columns(nulls, read_dictionary(spark, path)))


@register("hash_sample", O.q_hash_sample)
def q_hash_sample(spark, sf_dir):
    return round_doubles(ST.hash_sample(td.bureau(td.TestTables(spark, sf_dir)), "SK_ID_BUREAU", 5000, 42))


# ---- model preparation, models, evaluation ----------------------------------------

from ..operators import evaluation as EV  # noqa: E402
from ..operators import ml as ML  # noqa: E402

# Predictors of the model table.  AMT_INCOME_TOTAL is left out: in the test-data
# adapter it is the account balance whose sign defines TARGET (a label leak).
NUMERIC_MODEL = ["bureau_num_loans", "bureau_active_rate", "bureau_debt_ratio_mean", "bureau_credit_utilization_mean",
                 "prev_app_approval_rate", "prev_app_credit_ratio_mean", "ip_on_time_rate", "ip_delay_mean",
                 "ip_payment_ratio_mean", "pc_dpd_rate_mean", "cc_utilization_mean", "cc_balance_mean"]
CATEGORICAL_MODEL = ["NAME_SEGMENT", "REGION_ID"]


def _model_base(spark, sf_dir):
    train = _train(spark, sf_dir)
    return train.select("SK_ID_CURR", F.col("TARGET").cast("int").alias("TARGET"), *NUMERIC_MODEL,
                        *[F.col(c).cast("string").alias(c) for c in CATEGORICAL_MODEL])


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return ML.stratified_split(_model_base(spark, sf_dir).select("SK_ID_CURR", "TARGET")).select("SK_ID_CURR", "TARGET", "split")


@register("stratified_split_md5", O.q_stratified_split_md5)
def q_stratified_split_md5(spark, sf_dir):
    base = _model_base(spark, sf_dir).select("SK_ID_CURR", "TARGET")
    return ML.stratified_split(base, method="md5").select("SK_ID_CURR", "TARGET", "split")


@register("stratified_subsample", O.q_stratified_subsample)
def q_stratified_subsample(spark, sf_dir):
    base = _model_base(spark, sf_dir).select("SK_ID_CURR", "TARGET")
    return ML.stratified_subsample(base, 0.2, method="md5")


def _model_table(spark, sf_dir):
    """The model table, written once: the ordered scan of a split reads its input twice (to choose ranges, then to deal rows)."""
    return scratch_table(_model_base(spark, sf_dir), "model-table")


def _split_md5(spark, sf_dir):
    return ML.stratified_split(_model_table(spark, sf_dir), method="md5")


def _imputed(spark, sf_dir):
    split = _split_md5(spark, sf_dir)
    medians = ML.fit_medians(split.filter(F.col("split") == "train"), NUMERIC_MODEL, relative_error=0.0)
    return ML.impute_median(split, medians)


@register("impute_median", O.q_impute_median)
def q_impute_median(spark, sf_dir):
    return round_doubles(_imputed(spark, sf_dir).select("SK_ID_CURR", "split", *NUMERIC_MODEL))


def _scaled(spark, sf_dir):
    imp = _imputed(spark, sf_dir)
    params = ML.fit_scaler(imp.filter(F.col("split") == "train"), NUMERIC_MODEL)
    return ML.standard_scale(imp, params)


@register("standard_scale", O.q_standard_scale)
def q_standard_scale(spark, sf_dir):
    return round_doubles(_scaled(spark, sf_dir).select("SK_ID_CURR", "split", *NUMERIC_MODEL))


@register("impute_mode", O.q_impute_mode)
def q_impute_mode(spark, sf_dir):
    split = _split_md5(spark, sf_dir)
    modes = ML.fit_modes(split.filter(F.col("split") == "train"), CATEGORICAL_MODEL)
    return ML.impute_mode(split, modes).select("SK_ID_CURR", "split", *CATEGORICAL_MODEL)


@register("class_weights", O.q_class_weights)
def q_class_weights(spark, sf_dir):
    split = _split_md5(spark, sf_dir)
    return round_doubles(ML.class_weights(split.filter(F.col("split") == "train"), "TARGET"))


@register("gaussian_nb_moments", O.q_gaussian_nb_moments)
def q_gaussian_nb_moments(spark, sf_dir):
    sc = _scaled(spark, sf_dir).filter(F.col("split") == "train")
    return round_doubles(ML.gaussian_nb_moments(sc, NUMERIC_MODEL, "TARGET"))


def _model_frame(spark, sf_dir):
    frame, _ = ML.prepare_model_frame(_model_table(spark, sf_dir), NUMERIC_MODEL, CATEGORICAL_MODEL)
    return frame


@register("one_hot")
def q_one_hot(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    frame = _model_frame(spark, sf_dir)
    return frame.select("SK_ID_CURR", "split", vector_to_array(F.col("features")).alias("features"))


def _model_query(kind):
    def run(spark, sf_dir):
        return ML.fit_and_predict(_model_frame(spark, sf_dir), kind)

    return run


for _kind in ("logreg_l2", "logreg_l1", "gaussian_nb", "random_forest", "gbt", "linear_svc", "mlp"):
    register(f"ml_{_kind}")(_model_query(_kind))


@register("ml_grid_search")
def q_ml_grid_search(spark, sf_dir):
    model, grid = ML.grid_search(_model_frame(spark, sf_dir))
    rows = [(float(pm[list(pm)[0]]), float(m)) for pm, m in zip(grid, model.avgMetrics)]
    return spark.createDataFrame(rows, "reg_param double, mean_recall_class_1 double")


def _scores(spark, sf_dir):
    return td.scores(td.TestTables(spark, sf_dir))


@register("confusion_matrix", O.q_confusion_matrix)
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_scores(spark, sf_dir), "y", "pred")


@register("classification_report", O.q_classification_report)
def q_classification_report(spark, sf_dir):
    return round_doubles(EV.classification_report(_scores(spark, sf_dir), "y", "pred"))


@register("roc_curve", O.q_roc_curve)
def q_roc_curve(spark, sf_dir):
    return round_doubles(EV.roc_curve(_scores(spark, sf_dir), "y", "score"))


@register("roc_auc", O.q_roc_auc)
def q_roc_auc(spark, sf_dir):
    return round_doubles(EV.roc_auc(_scores(spark, sf_dir), "y", "score"))


@register("recall_train_test", O.q_recall_train_test)
def q_recall_train_test(spark, sf_dir):
    return round_doubles(EV.recall_by_split(_scores(spark, sf_dir), "split", "y", "pred"))


@register("wilcoxon_paired", O.q_wilcoxon_paired)
def q_wilcoxon_paired(spark, sf_dir):
    s = _scores(spark, sf_dir).select("doc_id", "split", ((F.col("pred") == 1) & (F.col("y") == 1)).cast("int").alias("tp"))
    return round_doubles(EV.wilcoxon_paired(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"), "doc_id", "tp"))


@register("evaluation_report", O.q_evaluation_report)
def q_evaluation_report(spark, sf_dir):
    return round_doubles(EV.evaluation_report(_scores(spark, sf_dir), "y", "pred", "score"))


# ---- oversampling, distributions, sketches ---------------------------------------

from ..operators import distribution as DI  # noqa: E402
from ..operators import modelling as MO  # noqa: E402
from ..operators import oversampling as OS  # noqa: E402
from ..operators import sketches as SK  # noqa: E402


def _scaled_train(spark, sf_dir):
    """The published scaled table (doubles as it is written) with labels, training rows only."""
    scaled = _scaled(spark, sf_dir).filter(F.col("split") == "train")
    return round_doubles(scaled.select("SK_ID_CURR", "TARGET", *NUMERIC_MODEL))


@register("smote_neighbours", O.q_smote_neighbours)
def q_smote_neighbours(spark, sf_dir):
    rows = _scaled_train(spark, sf_dir).select("SK_ID_CURR", "TARGET", F.array(*NUMERIC_MODEL).alias("x"))
    value, _, _ = OS.minority(rows, "TARGET")
    near = OS.minority_neighbours(rows, "x", value)
    out = near.select(F.col("key").alias("SK_ID_CURR"), F.posexplode("neighbours").alias("at", "n"))
    return round_doubles(out.select("SK_ID_CURR", (F.col("at") + 1).alias("place"), F.col("n.id").alias("neighbour"), F.col("n.distance").alias("distance")))


@register("smote_rows", O.q_smote_rows)
def q_smote_rows(spark, sf_dir):
    return round_doubles(OS.synthetic_rows(_scaled_train(spark, sf_dir), NUMERIC_MODEL))


@register("density_curve", O.q_density_curve)
def q_density_curve(spark, sf_dir):
    return round_doubles(DI.density_curve(_train(spark, sf_dir), NUMERIC_MODEL[:6]))


@register("shapiro_wilk")
def q_shapiro_wilk(spark, sf_dir):
    train = scratch_table(_train(spark, sf_dir), "train")  # read twice
    return round_doubles(DI.shapiro_wilk(train, _ranked(train), "SK_ID_CURR"))


@register("signed_rank", O.q_signed_rank)
def q_signed_rank(spark, sf_dir):
    out = DI.signed_rank(_train(spark, sf_dir), "bureau_debt_ratio_mean", "prev_app_credit_ratio_mean")
    return round_doubles(out.drop("log10_p"))


@register("stratified_folds", O.q_stratified_folds)
def q_stratified_folds(spark, sf_dir):
    return MO.stratified_folds(_model_base(spark, sf_dir).select("SK_ID_CURR", "TARGET"), 3)


@register("one_hot_places", O.q_one_hot_places)
def q_one_hot_places(spark, sf_dir):
    split = _split_md5(spark, sf_dir)
    codes = MO.category_codes(split.filter(F.col("split") == "train"), CATEGORICAL_MODEL)
    return MO.one_hot_entries(split, codes, CATEGORICAL_MODEL)


@register("sketch_profile")
def q_sketch_profile(spark, sf_dir):
    rows = _train(spark, sf_dir).select("SK_ID_CURR", *NUMERIC_MODEL)
    return round_doubles(SK.sketch_profile(SK.merged(SK.column_sketches(rows, NUMERIC_MODEL, F.pmod("SK_ID_CURR", F.lit(8))))))


@register("sketch_drift")
def q_sketch_drift(spark, sf_dir):
    ref, tgt = _drift_sides(spark, sf_dir)
    columns = DR.drift_candidates(ref, tgt)
    return round_doubles(SK.sketch_drift(SK.merged(SK.column_sketches(ref, columns)), SK.merged(SK.column_sketches(tgt, columns))))


# ---- models, evaluated --------------------------------------------------------------


def _prepared(spark, sf_dir):
    """All rows of the model table with split and x, prepared on training rows."""
    split = scratch_table(_split_md5(spark, sf_dir), "model-split")
    preparation = MO.fit_preparation(split.filter(F.col("split") == "train"), NUMERIC_MODEL, CATEGORICAL_MODEL)
    return scratch_table(preparation.apply(split), "model-frame")


def _report_query(kind):
    def run(spark, sf_dir):
        return round_doubles(MO.model_report(MO.predictions(_prepared(spark, sf_dir), kind)))

    return run


for _kind in MO.KINDS:
    register(f"ml_report_{_kind}")(_report_query(_kind))


def _grid_query(kind):
    """The study's grid over every row of the model table."""
    def run(spark, sf_dir):
        return round_doubles(MO.grid_scores(_model_table(spark, sf_dir), kind, MO.GRIDS[kind], NUMERIC_MODEL, CATEGORICAL_MODEL, 5 if kind == "boosted_trees" else 3))

    return run


for _kind in MO.GRIDS:
    register(f"ml_grid_{_kind}")(_grid_query(_kind))
