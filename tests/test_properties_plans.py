"""Properties on the shipped tables, skew-safe ordering, plan shape, oracle agreement."""

import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL
from riskloom.operators import drift as DR
from riskloom.operators import evaluation as EV
from riskloom.operators.ordered import ordered_scan
from riskloom.plans import assemble as A
from riskloom.plans import catalog
from riskloom.sources import testdata as td


@pytest.fixture(scope="module")
def raw(spark):
    return catalog.raw_tables(td.TestTables(spark, SMALL))


def test_assembly_preserves_master_rows(spark, raw):
    out = A.build_master_dataset(raw)
    assert out.count() == raw.application.count()
    assert out.select("SK_ID_CURR").distinct().count() == out.count()
    rep = A.cardinality_report(raw).collect()
    assert all(r["preserved"] for r in rep)


def test_rates_bounded(spark, raw):
    out = A.build_master_dataset(raw)
    rate_cols = [c for c in out.columns if c.endswith("_rate") or c.endswith("_rate_mean") or c.endswith("_rate_max")]
    bad = out.filter(F.greatest(*[F.col(c) for c in rate_cols]) > 1.0).count() + out.filter(F.least(*[F.col(c) for c in rate_cols]) < 0.0).count()
    assert bad == 0
    assert out.filter(F.col("ip_on_time_rate") + F.col("ip_late_rate") > 1.0 + 1e-12).count() == 0


def test_duplicate_master_raises(spark, raw):
    dup = raw.application.unionByName(raw.application.limit(1))
    with pytest.raises(ValueError):
        A.assemble(dup, A.build_satellites(raw))


def test_psi_self_is_zero(spark):
    ref = td.drift_reference(td.TestTables(spark, SMALL))
    psi = DR.psi_report(ref, ref, relative_error=0.0).collect()
    assert psi and all(abs(r["psi"]) < 1e-12 for r in psi)


def test_auc_perfect_and_confusion_total(spark):
    s = td.scores(td.TestTables(spark, SMALL))
    perfect = s.select("y", F.col("y").cast("double").alias("score"))
    assert EV.roc_auc(perfect, "y", "score").first()["auc"] == pytest.approx(1.0)
    cm = EV.confusion_matrix(s, "y", "pred")
    assert cm.agg(F.sum("n_rows")).first()[0] == s.count()


def test_ordered_scan_hot_key_matches_window(spark):
    random.seed(7)
    data = [("hot" if random.random() < 0.4 else f"k{random.randint(0, 30)}", i, float(random.randint(0, 3))) for i in range(5000)]
    df = spark.createDataFrame(data, "k string, o long, v double")
    got = ordered_scan(df, ["k"], ["o"], sum_cols=["v"], num_partitions=7)
    w = Window.partitionBy("k").orderBy("o")
    exp = df.select("k", "o", F.row_number().over(w).alias("er"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("es"))
    j = got.join(exp, ["k", "o"])
    assert j.count() == 5000
    assert j.filter((F.col("row_rank") != F.col("er")) | (F.abs(F.col("v_running") - F.col("es")) > 1e-9)).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "double", "string"])
def test_row_rank_with_null_and_large_keys(spark, kind):
    from riskloom.operators.ordered import row_rank

    value = {"bigint": "9007199254740993 + id % 3", "double": "if(id % 5 = 1, double('NaN'), -1.0 * (id % 3))", "string": "concat('k', id % 3)"}[kind]
    df = spark.range(60_000).selectExpr(f"if(id % 7 = 0, null, cast({value} as {kind})) AS k", "id % 11 AS o", "id", "if(id % 4 = 0, null, 9007199254740993 + id) AS payload")
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")))
    got = row_rank(df, ["k"], "o", ["id"]).withColumnRenamed("k", "k2").withColumnRenamed("payload", "p2")
    j = want.join(got.select("id", "k2", "p2", "row_rank"), "id")
    assert j.count() == 60_000
    assert j.where("want <> row_rank or not (k <=> k2) or not (payload <=> p2)").count() == 0
    with pytest.raises(ValueError):
        row_rank(df, ["k"], "o", [])


def test_ordered_scan_hot_key_spans_partitions(spark):
    df = spark.createDataFrame([("hot", i) for i in range(2000)], "k string, o long")
    got = ordered_scan(df, ["k"], ["o"], num_partitions=5)
    assert sorted(r[0] for r in got.select("row_rank").collect()) == list(range(1, 2001))


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_rollups_shuffle_only_on_keys(spark, raw):
    from riskloom.operators import satellites as S

    bb = S.bureau_balance_features(raw.bureau_balance)
    bb.collect()
    plan = bb._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan  # last status without a window or self-join
    inst = S.installments_features(raw.installments_payments)
    inst.collect()
    final = re.split(r"== Initial Plan ==", inst._jdf.queryExecution().executedPlan().toString())[0]
    # Each exchange by loan or applicant stands above a partial aggregate, so no raw row is shuffled by its key.
    assert len(re.findall(r"hashpartitioning\(SK_ID_CURR", final)) == final.count("partial_count(1)") == 2


def test_row_counts_scan_every_history(spark, monkeypatch):
    from riskloom.plans import assemble

    seen = []
    monkeypatch.setattr(assemble, "scratch_table", lambda df, name: seen.append(df) or df)
    assemble.cardinality_report(catalog.raw_tables(td.TestTables(spark, SMALL)))
    scans = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"{column}#" in scans for column in ("l_shipdate", "o_orderdate", "c_custkey"))
    report = catalog.QUERIES["row_counts"](spark, SMALL).collect()
    assert len(report) == 2 and all(r.preserved and r.n_columns > 50 for r in report)


def test_column_statistics_are_one_grouped_aggregate_over_a_long_form(spark, raw):
    from riskloom.operators import profile as P
    from riskloom.operators import stats as ST

    df = A.build_master_dataset(raw, check_master=False).select(
        "SPLIT", "TARGET", "AMT_INCOME_TOTAL", "REGION_ID", "bureau_active_rate", "ip_delay_max")
    cols = ["AMT_INCOME_TOTAL", "REGION_ID", "bureau_active_rate", "ip_delay_max"]
    plans = {
        "profile_exact": P.basic_profile(df, exact=True, by=["SPLIT"]),
        "profile_approx": P.basic_profile(df, exact=False, by=["SPLIT"]),
        "corr": ST.corr_with_target(df, "TARGET", top_k=None),
        "moments": ST.moments(df, cols),
    }
    for name, out in plans.items():
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "stack(" in plan, name  # unpivoted inside the scan's pipeline
        assert "Expand" not in plan, name  # no n-way row copies for distinct counts
        assert plan.count("FileScan parquet [c_custkey") == 1, name  # the master is read once
        assert re.search(r"keys=\[(SPLIT#\d+, )?feature#\d+", plan), name  # grouped by feature


def test_filters_and_pruning_reach_scan(spark):
    t = td.TestTables(spark, SMALL)
    ref = td.drift_reference(t).select("AMT_QUANTITY")
    plan = ref._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


ORACLE_SAMPLE = [
    "feat_bureau_balance", "feat_bureau", "feat_previous", "feat_installments", "feat_pos_cash", "feat_credit_card",
    "assemble_train", "last_status_per_key", "row_rank", "psi_drift", "chi2_vs_target", "roc_auc",
    "stratified_split_md5", "profile_exact", "registry_table",
]


def test_oracle_agreement_small(spark):
    import duckdb

    import __spark_entry__ as E

    con = duckdb.connect()
    for t in td.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()

    def norm(rows, cols):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        out = [tuple((round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i]) for i in order) for r in rows]
        return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

    for name in ORACLE_SAMPLE:
        df = qs[name](spark, SMALL)
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(dcols), name
        assert norm([tuple(r) for r in df.collect()], df.columns) == norm(res.fetchall(), dcols), name
