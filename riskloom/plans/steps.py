"""Steps that remember what they have done: a commit record per step, with a fingerprint of inputs and parameters.

A step's record is written after its output, so a run that is killed leaves no record of the step it was in.  The next
run skips every step whose record holds the same fingerprint and goes on from there.  A step's fingerprint covers its name,
its parameters and those of the steps or files before it, so a change is felt by all that follow and by nothing else.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("riskloom.steps")


def files_fingerprint(df: DataFrame) -> str:
    """Of the schema, and of path, length and time of the files a frame reads; their content is not read."""
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    total, number = 0, len(files)
    if files:
        listed = spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
        total = listed.agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()[0]
    return hashlib.sha256(f"{df.schema.json()} {number} {total}".encode()).hexdigest()


class StepLog:
    """Commit records below ``path``, one folder of one row per step."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ran: list[str] = []
        self.skipped: list[str] = []

    def _record(self, name: str) -> dict | None:
        try:
            row = self.spark.read.schema("fingerprint string, result string").json(f"{self.path}/{name}").first()
        except AnalysisException:  # never committed
            return None
        return None if row is None else row.asDict()

    def run(self, name: str, inputs: list[str], params: dict[str, Any], work: Callable[[], dict | None]) -> tuple[str, dict]:
        """(fingerprint, result) of a step: ``work`` runs unless the step is recorded with this fingerprint.

        The result is a small dictionary (counts, paths) that is kept in the record.
        """
        fingerprint = hashlib.sha256(json.dumps([name, inputs, params], sort_keys=True).encode()).hexdigest()
        known = self._record(name)
        if known is not None and known["fingerprint"] == fingerprint:
            log.info("step %s is done, skipped", name)
            self.skipped.append(name)
            return fingerprint, json.loads(known["result"])
        result = work() or {}
        row = self.spark.createDataFrame([(fingerprint, json.dumps(result))], "fingerprint string, result string")
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/{name}")
        log.info("step %s committed", name)
        self.ran.append(name)
        return fingerprint, result
