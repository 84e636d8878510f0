"""CSV source with name-rule typing and a parse-loss report; Parquet/CSV sinks.

The CSV reader reads the header through Spark (``spark.read.text``), so any
Hadoop-compatible path works and nothing is opened on the driver's local disk.
Cells are first read as text; typed columns are produced with ``try_cast`` so a
cell that does not parse becomes null *and is counted* instead of vanishing.
Integral columns written with a decimal point (``-1180.0``) are recovered by a
cast through double when the value is integral.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import build_schema

ENCODINGS = ("UTF-8", "ISO-8859-1")


def read_header(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "UTF-8") -> list[str]:
    """Column names from the first line of a delimited text file."""
    first = spark.read.option("encoding", encoding).text(path).limit(1).collect()
    if not first:
        return []
    line = first[0][0].lstrip("﻿")
    return next(csv.reader(io.StringIO(line), delimiter=delimiter))


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every line of the file is valid UTF-8, else ISO-8859-1; one distributed pass over the raw bytes of all lines."""
    broken = spark.read.text(path).where(~F.is_valid_utf8("value"))
    return ENCODINGS[0] if broken.isEmpty() else ENCODINGS[1]


def _typed(raw: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        direct = raw.try_cast(dtype.simpleString())
        as_double = raw.try_cast("double")
        integral = as_double.isNotNull() & (as_double == F.floor(as_double))
        return F.coalesce(direct, F.when(integral, as_double.try_cast(dtype.simpleString())))
    return raw.try_cast(dtype.simpleString())


def read_csv_raw(spark: SparkSession, path: str, delimiter: str = ",", encoding: str | None = None) -> DataFrame:
    """All columns as text (header kept as names)."""
    enc = encoding or detect_encoding(spark, path)
    columns = read_header(spark, path, delimiter, enc)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return (
        spark.read.option("header", True)
        .option("delimiter", delimiter)
        .option("encoding", enc)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )


def type_columns(raw: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Apply the name-rule schema to an all-text frame."""
    schema = schema or build_schema(raw.columns)
    return raw.select(*[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def read_csv_table(spark: SparkSession, path: str, delimiter: str = ",", encoding: str | None = None) -> DataFrame:
    """Typed table from a headed CSV (the S1 reader)."""
    return type_columns(read_csv_raw(spark, path, delimiter, encoding))


def parse_loss(raw: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Per column: cells non-null as text but null after typing; one aggregate, one scan."""
    schema = schema or build_schema(raw.columns)
    aggs = []
    for f in schema.fields:
        text = F.col(f.name)
        lost = F.count_if(text.isNotNull() & (F.trim(text) != F.lit("")) & _typed(text, f.dataType).isNull())
        aggs.append(lost.alias(f.name))
    if not aggs:
        return raw.sparkSession.createDataFrame([], "column string, data_type string, lost_cells bigint")
    wide = raw.agg(*aggs)
    stack = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', `{f.name}`" for f in schema.fields)
    return wide.selectExpr(f"stack({len(schema.fields)}, {stack}) as (column, data_type, lost_cells)")


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    repartition_by: list[str] | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Parquet sink; optionally clustered by key and partitioned on disk."""
    if repartition_by:
        # Clusters rows by key like repartition, but adaptive execution may split a hot key's partition.
        df = df.hint("rebalance", *repartition_by)
    writer = df.write.mode(mode).format("parquet")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_csv_and_parquet(df: DataFrame, path: str) -> None:
    """The same (small) table as headed CSV under ``path/csv`` and Parquet under ``path/parquet``."""
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    df.write.mode("overwrite").parquet(f"{path}/parquet")

