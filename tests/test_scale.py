"""Steps whose work must not grow faster than their rows."""

from conftest import SMALL
from pyspark.sql import functions as F

from riskloom.operators import satellites as S
from riskloom.plans import catalog as C


def _previous(spark):
    rows = [(1, 10, "a", "x", "p"), (1, 11, "b", "x", None), (1, 12, "a", "x", "q"), (2, 13, None, None, None), (None, 14, "a", "y", "p"), (None, 14, "a", "y", "p")]
    columns = "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_TYPE string, NAME_CLIENT_TYPE string, PRODUCT_COMBINATION string"
    more = {"NAME_CONTRACT_STATUS": F.lit("Approved"), "DAYS_DECISION": F.lit(-3), "CNT_PAYMENT": F.lit(2), "NFLAG_INSURED_ON_APPROVAL": F.lit(1)}
    amounts = {c: F.lit(5.0) for c in ("AMT_CREDIT", "AMT_APPLICATION", "AMT_DOWN_PAYMENT")}
    return spark.createDataFrame(rows, columns).withColumns(more | amounts)


def test_diversity_counts_do_not_repeat_the_rows(spark):
    out = S.previous_application_features(_previous(spark))
    found = {r["SK_ID_CURR"]: (r["prev_app_count"], *[r[f"prev_app_{c}_diversity"] for c in ("contract_type", "client_type", "product_combination")]) for r in out.collect()}
    assert found == {1: (3, 2, 1, 2), 2: (1, 0, 0, 0), None: (2, 1, 1, 1)}
    assert dict(out.dtypes)["prev_app_client_type_diversity"] == "bigint"
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_split_computes_the_model_table_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def look(value):
        seen.add(1)
        return value

    base = spark.range(400, numPartitions=4).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") % 5 == 0).cast("int").alias("TARGET"))
    watched = base.withColumn("NAME_SEGMENT", F.udf(look, "string")(F.col("SK_ID_CURR").cast("string")))
    monkeypatch.setattr(C, "_model_base", lambda spark, sf_dir: watched)
    split = C._split_md5(spark, SMALL)
    assert {(r["TARGET"], r["split"]): r["count"] for r in split.groupBy("TARGET", "split").count().collect()} == {
        (t, s): n * k // 5 for t, n in ((0, 320), (1, 80)) for s, k in (("test", 1), ("validation", 1), ("train", 3))
    }
    assert seen.value == 400
