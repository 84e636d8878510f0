"""Helpers shared by the operators: scratch tables, hot-key joins, word splitting.

A *word* is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``.  On UTF-8 bytes that is what
``bytes.split()`` gives, so Python workers split bytes and never decode whole texts for it.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder, which all executors see."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_hot(left: DataFrame, right: DataFrame, on: list[str], spread_by: Column, salts: int = 16, how: str = "left") -> DataFrame:
    """Join with ``right`` (unique on ``on``) where one key may hold a third of ``left``.

    Every key of ``left`` is dealt to ``salts`` parts by a hash of ``spread_by``; ``right`` is
    repeated once per part, so its size grows by that constant and no key meets in one task.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(spread, [*on, "_salt"], how).drop("_salt")


def process_cache(name: str, make: Callable[[], Any]) -> Any:
    """A value kept for the life of the Python worker; pickled functions have no globals that outlive a task."""
    store = sys.modules.setdefault("riskloom_process_cache", types.ModuleType("riskloom_process_cache")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small slices of Arrow batches, so that a worker holds few long texts as Python objects at once.

    What is free after a batch goes back to the system: workers outlive their tasks, and several share an executor.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        give_back_memory()


def give_back_memory() -> None:
    """Return the free memory of Arrow's pool and of the C library, where it can."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def word_hash(word: bytes) -> int:
    """64-bit hash of a word as a signed integer."""
    import xxhash

    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


class WordHashes(dict):
    """word -> 64-bit hash, remembered for words seen before; at most ``limit`` of them (a cache, not a cap)."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = word_hash(word)
        if len(self) < self.limit and len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64) on unsigned integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
