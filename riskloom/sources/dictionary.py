"""Column dictionaries in files: descriptions of columns, joined to the columns of a table.

A dictionary file is a headed CSV with a column of names and a column of descriptions (RFC 4180 quoting: doubled
quotes, line ends inside quotes).  It may describe a name several times, as one that several source tables have; every
different description is kept, so a described column has one row for each.  Equal (name, description) pairs count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import detect_encoding


def read_dictionary(spark: SparkSession, path: str, name: str = "Row", description: str = "Description", encoding: str | None = None) -> DataFrame:
    """Distinct (feature, description) of a dictionary file; UTF-8 or, where it is not, ISO-8859-1; rows without a name go."""
    enc = encoding or detect_encoding(spark, path)
    raw = spark.read.option("header", True).option("encoding", enc).option("escape", '"').option("multiLine", True).csv(path)
    return raw.select(F.col(f"`{name}`").alias("feature"), F.col(f"`{description}`").alias("description")).where("feature is not null").distinct()


def describe_columns(columns: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``columns`` (feature, ...) with the descriptions of each; null where the dictionary has none.

    A name described several times comes once per description; Spark chooses the join by the sides' sizes.
    """
    return columns.join(dictionary.select("feature", "description"), "feature", "left")
