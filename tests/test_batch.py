"""The one-session batch run: outputs, row preservation, shuffle-free bucketed assembly."""

import uuid

from pyspark.sql import functions as F

from conftest import SMALL
from riskloom.plans import assemble as A
from riskloom.plans import batch as B
from riskloom.plans import catalog
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import testdata as td


def test_run_batch(spark):
    raw = catalog.raw_tables(td.TestTables(spark, SMALL))
    out = f"{ensure_checkpoint_dir(spark)}/batch-{uuid.uuid4().hex}"
    res = B.run_batch(spark, raw, out, buckets=4)
    train = spark.read.parquet(res["train"])
    assert train.count() == raw.application.filter(F.col("SPLIT") == "train").count()
    assert spark.read.parquet(res["drift"]).count() >= 1
    assert spark.read.parquet(f"{res['registry']}/parquet").count() == 23
    # bucketed interim tables: at scale (no broadcast) the five joins need no exchange
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        master = spark.table("riskloom_application")
        sats = [(s.name, spark.table(f"riskloom_{s.name}")) for s in B.SATELLITES if s.key == A.KEY]
        df = A.assemble(master, sats, check_master=False)
        assert df.count() == raw.application.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_killed_run_goes_on_where_it_stopped(spark, monkeypatch):
    import pytest

    from riskloom.plans.steps import StepLog

    raw = catalog.raw_tables(td.TestTables(spark, SMALL))
    out = f"{ensure_checkpoint_dir(spark)}/batch-{uuid.uuid4().hex}"
    whole = list(B.SATELLITES)

    def killed(r, done):
        raise RuntimeError("killed")

    monkeypatch.setattr(B, "SATELLITES", [*whole[:3], B.SatelliteSpec(whole[3].name, whole[3].key, killed), *whole[4:]])
    first = StepLog(spark, f"{out}/steps")
    with pytest.raises(RuntimeError):
        B.run_batch(spark, raw, out, buckets=4, steps=first)
    assert first.ran == [s.name for s in whole[:3]]
    monkeypatch.setattr(B, "SATELLITES", whole)
    for s in whole[:3]:  # another session would not know the tables
        spark.sql(f"DROP TABLE IF EXISTS riskloom_{s.name}")
    second = StepLog(spark, f"{out}/steps")
    res = B.run_batch(spark, raw, out, buckets=4, steps=second)
    assert second.skipped == first.ran and second.ran == [*(s.name for s in whole[3:]), "registry", "application", "assemble_train", "assemble_test", "drift"]
    clean = B.run_batch(spark, raw, f"{ensure_checkpoint_dir(spark)}/batch-{uuid.uuid4().hex}", buckets=4)
    for name in ("train", "test", "drift"):
        a, b = spark.read.parquet(res[name]), spark.read.parquet(clean[name])
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()
    third = StepLog(spark, f"{out}/steps")
    B.run_batch(spark, raw, out, buckets=4, steps=third)
    assert third.ran == []
    # A changed parameter or input is felt by the steps behind it only.
    fourth = StepLog(spark, f"{out}/steps")
    B.run_batch(spark, raw, out, buckets=4, drift_relative_error=0.01, steps=fourth)
    assert fourth.ran == ["drift"]
    path = f"{out}/pos"
    raw.pos_cash_balance.limit(500).write.parquet(path)
    raw.pos_cash_balance = spark.read.parquet(path)
    fifth = StepLog(spark, f"{out}/steps")
    B.run_batch(spark, raw, out, buckets=4, drift_relative_error=0.01, steps=fifth)
    assert fifth.ran == ["pos_cash_features", "assemble_train", "assemble_test", "drift"]


def test_rows_are_counted_by_the_writing_job(spark):
    import pytest

    from riskloom.operators.checks import observed_write, require_rows

    left = spark.range(100)
    right = spark.range(40).select(F.pmod("id", F.lit(20)).alias("id"), F.lit(1).alias("v"))
    path = f"{ensure_checkpoint_dir(spark)}/observed-{uuid.uuid4().hex}"
    seen = observed_write(left.join(right, "id", "left"), lambda df: df.write.parquet(path), rows=F.count(F.lit(1)), hits=F.count("v"))
    assert seen == {"rows": 120, "hits": 40} and spark.read.parquet(path).count() == 120
    require_rows(100, 100, "fine")
    require_rows(120, 100, "allowed", multiplier=1.5)
    for rows in (seen["rows"], 99):
        with pytest.raises(ValueError):
            require_rows(rows, 100, "duplicating or losing side")
