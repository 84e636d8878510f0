"""Continuous PSI monitoring: each micro-batch of arriving rows is scored against a
reference profile computed once.

* The reference profile (edges + bucket counts, at most features x (buckets + 2)
  rows) is computed once and held as a small DataFrame, so batches never rescan
  the reference.
* ``foreachBatch`` writes each batch's report to ``<output>/batch_id=<id>`` with
  overwrite: a batch replayed after a failure rewrites the same folder, so the
  sink is idempotent and the query restarts from its checkpoint location.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.drift import DEFAULT_RELATIVE_ERROR, PSI_BUCKETS, psi_from_profile, psi_status, reference_profile


def start_drift_monitor(
    spark: SparkSession,
    reference: DataFrame,
    source_dir: str,
    schema: T.StructType,
    output_dir: str,
    checkpoint_location: str,
    cols: Sequence[str],
    buckets: int = PSI_BUCKETS,
    relative_error: float = DEFAULT_RELATIVE_ERROR,
    available_now: bool = True,
):
    """Start the monitor over Parquet files arriving in ``source_dir``; returns the StreamingQuery."""
    profile = reference_profile(reference, list(cols), buckets, relative_error)
    # pin the small reference counts once, as a literal table, so every batch reuses them
    frozen = spark.createDataFrame(profile.counts.collect(), "feature string, bucket string, ref_count bigint")
    profile.counts = frozen

    def score(batch: DataFrame, batch_id: int) -> None:
        # two actions on one micro-batch: keep it (memory, spilling to disk) instead of re-reading its files
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = batch.count()
            report = psi_status(psi_from_profile(profile, batch)).withColumn("rows_in_batch", F.lit(n).cast("long"))
            report.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
