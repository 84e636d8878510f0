"""Readers, sinks, profile, empty inputs."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import drift as DR
from riskloom.operators import profile as P
from riskloom.operators import registry as R
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import files as FS
from riskloom.sources.schema import build_schema, infer_type


def test_name_rules():
    assert isinstance(infer_type("TARGET"), T.IntegerType)
    assert isinstance(infer_type("SK_ID_CURR"), T.LongType)
    assert isinstance(infer_type("FLAG_OWN_CAR"), T.IntegerType)
    assert isinstance(infer_type("DAYS_BIRTH"), T.IntegerType)
    assert isinstance(infer_type("AMT_CREDIT"), T.DoubleType)
    assert isinstance(infer_type("NAME_CONTRACT_TYPE"), T.StringType)
    assert isinstance(infer_type("STATUS"), T.StringType)
    assert isinstance(infer_type("HOUR_APPR_PROCESS_START"), T.IntegerType)
    assert isinstance(infer_type("OWN_CAR_AGE"), T.IntegerType)
    assert isinstance(infer_type("EXT_SOURCE_1"), T.DoubleType)
    assert isinstance(infer_type("SOMETHING_ELSE"), T.DoubleType)
    assert [f.name for f in build_schema(["a", "b"]).fields] == ["a", "b"]


def _path(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/test-{name}-{uuid.uuid4().hex}"


def test_csv_parse_loss_counts_not_vanish(spark):
    path = _path(spark, "csv")
    raw = spark.createDataFrame([("1", "-1180.0", "Y"), ("2", "7", "N"), ("3", "", "1")], "SK_ID_CURR string, DAYS_X string, FLAG_Y string")
    raw.coalesce(1).write.option("header", True).csv(path)
    typed = {r.SK_ID_CURR: r for r in FS.read_csv_table(spark, path).collect()}
    assert typed[1].DAYS_X == -1180 and typed[2].DAYS_X == 7 and typed[3].DAYS_X is None
    assert typed[1].FLAG_Y is None and typed[3].FLAG_Y == 1
    loss = {r["column"]: r["lost_cells"] for r in FS.parse_loss(FS.read_csv_raw(spark, path)).collect()}
    assert loss == {"SK_ID_CURR": 0, "DAYS_X": 0, "FLAG_Y": 2}


def test_parquet_sink_roundtrip(spark):
    path = _path(spark, "pq")
    df = spark.createDataFrame([(1, "a", 1.5), (2, "b", None)], "k long, part string, v double")
    FS.write_parquet(df, path, partition_by=["part"], repartition_by=["k"], max_records_per_file=1)
    back = spark.read.parquet(path).select("k", "part", "v")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_profile_single_pass_and_empty(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 2.0, None), (3, 2.0, "y")], "a long, b double, c string")
    prof = {r["feature"]: r for r in P.basic_profile(df, exact=True).collect()}
    assert prof["b"]["null_pct"] == 100.0 / 3 and prof["b"]["approx_cardinality"] == 1
    assert prof["a"]["data_type"] == "LongType()" and prof["c"]["data_type"] == "StringType()"
    plan = P.basic_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1  # one scan for all columns
    empty = spark.createDataFrame([], "a long, b double")
    rows = P.basic_profile(empty).collect()
    assert len(rows) == 2 and all(r["null_pct"] is None for r in rows)
    assert P.basic_profile(spark.createDataFrame([], T.StructType([]))).count() == 0


def test_drift_empty_side(spark):
    ref = spark.createDataFrame([], "AMT_X double")
    tgt = spark.createDataFrame([(1.0,)], "AMT_X double")
    assert [tuple(r) for r in DR.psi_report(ref, tgt, ["AMT_X"]).collect()] == [("AMT_X", 0.0)]


def test_registry_schema(spark):
    reg = R.registry_to_dataframe(spark)
    assert reg.columns == [f.name for f in R.REGISTRY_SCHEMA.fields] and reg.count() == 23
    assert reg.filter(F.col("temporal_safety")).count() == 23


def test_dictionary_file_keeps_every_description(spark, tmp_path):
    from riskloom.sources.dictionary import describe_columns, read_dictionary

    lines = ["Table,Row,Description", 'a.csv,X,"one, ""quoted"""', 'b.csv,X,"two\nlines"', 'c.csv,X,"one, ""quoted"""', "a.csv,Y,café", "a.csv,,nobody", "a.csv,Z,"]
    columns = spark.createDataFrame([("X", 1), ("Y", 2), ("Z", 3), ("W", 4)], "feature string, at int")
    for encoding in ("utf-8", "latin-1"):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes("\n".join(lines).encode(encoding))
        dictionary = read_dictionary(spark, f"file://{path}")
        got = sorted((r["feature"], r["at"], r["description"] or "") for r in describe_columns(columns, dictionary).collect())
        assert got == [("W", 4, ""), ("X", 1, 'one, "quoted"'), ("X", 1, "two\nlines"), ("Y", 2, "café"), ("Z", 3, "")]
    assert describe_columns(columns.limit(0), dictionary).count() == 0
    assert describe_columns(columns, dictionary.limit(0)).count() == 4
