"""The whole batch run in one session: satellites -> registry -> assembly -> quality -> drift.

Differences from running one process per step:

* every satellite is built **once** and written as an interim table; the
  assembly reads them back, so train and test never recompute a rollup and
  the long lineage is cut (a lost executor only recomputes from the interim
  files);
* interim tables are bucketed (and sorted) by ``SK_ID_CURR`` into the same
  number of buckets as the master, so the five left joins of the assembly are
  bucket-to-bucket sort-merge joins with **no shuffle** at all;
* profiles are one aggregate per table and drift is one pass for all columns;
* row counts are observed by the writing jobs, so no table is scanned again to count it;
* any failed check raises and stops the run (nothing downstream is written), and the next run goes on from the first step
  that is not committed with the same inputs and parameters (``steps``).

Outputs go under ``out_dir`` (a shared file system path on a cluster).
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import satellites as S
from ..operators.checks import observed_write, require_rows, require_unique_keys
from ..operators.drift import drift_candidates, psi_report, psi_status
from ..operators.profile import basic_profile
from ..operators.registry import registry_to_dataframe
from ..sources.files import write_csv_and_parquet
from .assemble import KEY, RawTables, assemble
from .steps import StepLog, files_fingerprint

log = logging.getLogger("riskloom.batch")


@dataclass(frozen=True)
class SatelliteSpec:
    name: str
    key: str
    build: Callable[[RawTables, dict[str, DataFrame]], DataFrame]


SATELLITES: list[SatelliteSpec] = [
    SatelliteSpec("bureau_balance_features", "SK_ID_BUREAU", lambda r, done: S.bureau_balance_features(r.bureau_balance)),
    SatelliteSpec("bureau_features", KEY, lambda r, done: S.bureau_features(r.bureau, done["bureau_balance_features"])),
    SatelliteSpec("previous_application_features", KEY, lambda r, done: S.previous_application_features(r.previous_application)),
    SatelliteSpec("installments_features", KEY, lambda r, done: S.installments_features(r.installments_payments)),
    SatelliteSpec("pos_cash_features", KEY, lambda r, done: S.pos_cash_features(r.pos_cash_balance)),
    SatelliteSpec("credit_card_features", KEY, lambda r, done: S.credit_card_features(r.credit_card_balance)),
]


def _write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    (
        df.write.mode("overwrite").format("parquet")
        .bucketBy(buckets, key).sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )


def _bucketed_table(spark: SparkSession, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """The table of an interim step; a session that did not write it is told of its buckets anew."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def run_satellite(raw: RawTables, spec: SatelliteSpec, done: dict[str, DataFrame], out_dir: str, buckets: int) -> DataFrame:
    """Read -> build -> unique-key check -> write (bucketed by key) -> read back."""
    feats = spec.build(raw, done)
    require_unique_keys(feats, [spec.key], spec.name)
    name, path = f"riskloom_{spec.name}", f"{out_dir}/interim/{spec.name}"
    _write_bucketed(feats, name, path, spec.key, buckets)
    log.info("built %s", spec.name)
    return _bucketed_table(feats.sparkSession, name, path, spec.key, buckets)


#: Raw tables, and the rollup, that each rollup reads.
READS = {
    "bureau_balance_features": ("bureau_balance",), "bureau_features": ("bureau", "bureau_balance_features"), "previous_application_features": ("previous_application",),
    "installments_features": ("installments_payments",), "pos_cash_features": ("pos_cash_balance",), "credit_card_features": ("credit_card_balance",),
}


def run_batch(spark: SparkSession, raw: RawTables, out_dir: str, buckets: int | None = None,
              drift_relative_error: float = 0.001, steps: StepLog | None = None) -> dict[str, str]:
    """Run every step in order, or those that are not committed yet; returns the output locations."""
    out_dir = out_dir.rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = steps or StepLog(spark, f"{out_dir}/steps")
    marks = {name: files_fingerprint(df) for name, df in vars(raw).items()}
    done: dict[str, DataFrame] = {}
    for spec in SATELLITES:
        marks[spec.name], _ = steps.run(spec.name, [marks[t] for t in READS[spec.name]], {"buckets": buckets}, lambda spec=spec: run_satellite(raw, spec, done, out_dir, buckets) and None)
        done[spec.name] = _bucketed_table(spark, f"riskloom_{spec.name}", f"{out_dir}/interim/{spec.name}", spec.key, buckets)

    steps.run("registry", [], {}, lambda: write_csv_and_parquet(registry_to_dataframe(spark), f"{out_dir}/registry"))

    splits = ("train", "test")

    def write_application() -> dict:
        require_unique_keys(raw.application, [KEY], "application")
        counts = {s: F.count_if(F.col("SPLIT") == s) for s in splits}
        return observed_write(raw.application, lambda df: _write_bucketed(df, "riskloom_application", f"{out_dir}/interim/application", KEY, buckets), **counts)

    own, base = steps.run("application", [marks["application"]], {"buckets": buckets}, write_application)
    master = _bucketed_table(spark, "riskloom_application", f"{out_dir}/interim/application", KEY, buckets)
    sats = [(s.name, done[s.name]) for s in SATELLITES if s.key == KEY]
    assembled = assemble(master, sats, check_master=False)
    outputs = {split: f"{out_dir}/processed/{split}_final" for split in splits}

    def write_split(split: str) -> dict:
        part = assembled.filter(F.col("SPLIT") == split)
        seen = observed_write(part, lambda df: df.write.mode("overwrite").option("maxRecordsPerFile", 250_000).parquet(outputs[split]), rows=F.count(F.lit(1)))
        require_rows(seen["rows"], base[split], f"{split} after assembly")
        basic_profile(spark.read.parquet(outputs[split])).write.mode("overwrite").parquet(f"{out_dir}/checks/{split}_profile.parquet")
        return seen

    written = [steps.run(f"assemble_{split}", [own, *(marks[name] for name, _ in sats)], {}, lambda split=split: write_split(split))[0] for split in splits]

    def write_drift() -> None:
        train, test = (spark.read.parquet(outputs[s]) for s in splits)
        drift = psi_status(psi_report(train, test, drift_candidates(train, test), relative_error=drift_relative_error))
        drift.write.mode("overwrite").parquet(f"{out_dir}/checks/application_drift_psi.parquet")

    steps.run("drift", written, {"relative_error": drift_relative_error}, write_drift)
    return outputs | {"drift": f"{out_dir}/checks/application_drift_psi.parquet", "registry": f"{out_dir}/registry"}
