"""Synthetic minority oversampling: new rows on the segments between minority rows and their nearest neighbours.

The neighbours are exact (``neighbours.nearest_neighbours``) and taken within the minority class.  The new rows make both
classes equal in number.  They are dealt evenly: every minority row gives ``new div n`` of them, and the rows that come
first by a hash give one more.  Which neighbour a new row leans to and how far follow from hashes of
(key, copy, seed), so another run gives the same rows whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from .neighbours import nearest_neighbours
from .ordered import ordered_scan

SEED = 42


def hash_number(*parts: Column) -> Column:
    """A number of 32 bits from the parts, the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def minority(df: DataFrame, label: str) -> tuple[object, int, int] | None:
    """(label value, rows, rows of the largest class) of the smallest class; equal sizes go to the smaller label."""
    sizes = sorted((r["count"], r[label]) for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect())  # one row per class
    return (sizes[0][1], sizes[0][0], sizes[-1][0]) if len(sizes) > 1 else None


def minority_neighbours(df: DataFrame, vector: str, value: object, label: str = "TARGET", key: str = "SK_ID_CURR", k: int = 5) -> DataFrame:
    """(key, neighbours) of the rows of class ``value``, within that class; ``vector`` is an array of doubles."""
    rows = df.where(F.col(label) == F.lit(value)).select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))
    return nearest_neighbours(rows, "key", "vector", k)


def synthetic_vectors(df: DataFrame, vector: str, label: str = "TARGET", key: str = "SK_ID_CURR", k: int = 5, seed: int = SEED) -> DataFrame:
    """(base, copy, neighbour, step, label, vector): the new rows of the minority class.

    Rows with a null or non-finite component give none and are no neighbours; a minority row without any
    neighbour is repeated.  No rows where there is one class only or the classes are equal.
    """
    small = minority(df, label)
    value, new = (small[0], small[2] - small[1]) if small else (None, 0)
    near = scratch_table(minority_neighbours(df, vector, value, label, key, k), "near")
    n = near.count()
    ranked = ordered_scan(near.withColumn("_h", hash_number(F.col("key"), F.lit(seed))), [], [F.col("_h"), F.col("key")], rank_col="_r")
    share, rest = (new // n, new % n) if n else (0, 0)
    copies = (F.lit(share) + F.when(F.col("_r") <= rest, 1).otherwise(0)).cast("int")
    dealt = ranked.withColumn("copies", copies).where("copies > 0").select("key", "neighbours", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    size = F.size("neighbours")
    pick = F.when(size > 0, F.pmod(hash_number(F.col("key"), F.col("copy"), F.lit(seed), F.lit("neighbour")), size)).cast("int")
    step = hash_number(F.col("key"), F.col("copy"), F.lit(seed), F.lit("step")) / F.lit(float(1 << 32))
    drawn = dealt.select("key", "copy", F.coalesce(F.get(F.col("neighbours"), pick)["id"], F.col("key")).alias("neighbour"), step.alias("step"))
    rows = df.where(F.col(label) == F.lit(value)).select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))
    vectors = scratch_table(rows.join(near.select("key"), "key"), "vectors")
    pair = drawn.join(vectors, "key").join(vectors.select(F.col("key").alias("neighbour"), F.col("vector").alias("towards")), "neighbour")
    moved = F.zip_with("vector", "towards", lambda a, b: a + F.col("step") * (b - a))
    return pair.select(F.col("key").alias("base"), "copy", "neighbour", "step", F.lit(value).cast(df.schema[label].dataType).alias(label), moved.alias("vector"))


def synthetic_rows(df: DataFrame, features: Sequence[str], label: str = "TARGET", key: str = "SK_ID_CURR", k: int = 5, seed: int = SEED) -> DataFrame:
    """(base, copy, neighbour, step, label, features): ``synthetic_vectors`` of numeric columns."""
    vector = F.array(*[F.col(c).cast("double") for c in features])
    new = synthetic_vectors(df.select(key, label, vector.alias("_x")), "_x", label, key, k, seed)
    return new.select("base", "copy", "neighbour", "step", label, *[F.col("vector")[i].alias(c) for i, c in enumerate(features)])


def oversample(df: DataFrame, features: Sequence[str], label: str = "TARGET", key: str = "SK_ID_CURR", k: int = 5, seed: int = SEED, flag: str = "synthetic") -> DataFrame:
    """``df`` and the new rows, told apart by ``flag``; new rows are null in columns other than features and label."""
    new = synthetic_rows(df, features, label, key, k, seed)
    same = [F.col(c).cast(df.schema[c].dataType).alias(c) if c in (*features, label) else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    return df.withColumn(flag, F.lit(False)).unionByName(new.select(*same, F.lit(True).alias(flag)))
