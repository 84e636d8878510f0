"""Master-table assembly: applicant rows + the five applicant-level rollups.

Satellites are built once and joined to the master holding *both* splits (a
``SPLIT`` column), so one plan serves train and test; each split is a filter
that Catalyst pushes below the left joins onto the master scan.

Plan shape: every rollup ends in a hash aggregate on ``SK_ID_CURR`` and is
therefore already hash-partitioned on the join key; the master is shuffled once
and the five sort-merge joins chain without further exchanges (AQE may swap in a
broadcast for a rollup that turns out small at run time, never by a fixed hint).
Left joins against key-unique rollups cannot change the row count; the runtime
checks are (a) one aggregate proving the master key unique and (b) an optional
before/after count in a single job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import satellites as S
from ..operators.checks import require_unique_keys, row_count_report
from ..session import scratch_table

KEY = "SK_ID_CURR"


@dataclass
class RawTables:
    """The seven input tables of the engine (any source: CSV, Parquet, adapters)."""

    application: DataFrame
    bureau: DataFrame
    bureau_balance: DataFrame
    previous_application: DataFrame
    installments_payments: DataFrame
    pos_cash_balance: DataFrame
    credit_card_balance: DataFrame


def build_satellites(raw: RawTables) -> list[tuple[str, DataFrame]]:
    """The five applicant-level rollups, in join order."""
    bb = S.bureau_balance_features(raw.bureau_balance)
    return [
        ("bureau_features", S.bureau_features(raw.bureau, bb)),
        ("previous_application_features", S.previous_application_features(raw.previous_application)),
        ("installments_features", S.installments_features(raw.installments_payments)),
        ("pos_cash_features", S.pos_cash_features(raw.pos_cash_balance)),
        ("credit_card_features", S.credit_card_features(raw.credit_card_balance)),
    ]


def assemble(master: DataFrame, satellites: list[tuple[str, DataFrame]], check_master: bool = True) -> DataFrame:
    """Left-join every rollup to the master.  Rollups are key-unique by construction."""
    if check_master:
        require_unique_keys(master, [KEY], "application")
    out = master
    for _, feats in satellites:
        out = out.join(feats, on=KEY, how="left")
    return out


def build_master_dataset(raw: RawTables, split: str | None = None, check_master: bool = True) -> DataFrame:
    """Assembled table; ``split`` filters the master's ``SPLIT`` column when given."""
    master = raw.application
    out = assemble(master, build_satellites(raw), check_master=check_master)
    if split is not None:
        out = out.filter(F.col("SPLIT") == split)
    return out


def cardinality_report(raw: RawTables) -> DataFrame:
    """Rows before and after assembly and columns after it, per split, counted on the written table.

    The assembled table is written whole: counting a plan would let the optimiser drop the joins it is to check.
    """
    out = scratch_table(assemble(raw.application, build_satellites(raw), check_master=False), "assembled")
    return row_count_report(raw.application, out, "SPLIT", "application")
