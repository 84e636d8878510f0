"""riskloom: a Spark-native feature engine for applicant-level credit-risk data.

One master table (one row per applicant) and several history tables are rolled up
to the applicant with DataFrame aggregations, left-joined without changing the
number of master rows, profiled, checked for drift, and fed to ``pyspark.ml``.

Sub-packages:
  sources    -- readers, writers, name-rule schemas, test-data adapters
  functions  -- scalar Column expressions (safe ratios, flags, buckets, ...)
  operators  -- satellite rollups, checks, profile, drift, statistics, models
  plans      -- whole jobs: assembly of the master table, the batch run
  streaming  -- micro-batch drift monitoring on top of the drift operator
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers need no install."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older pyspark: ship with --py-files instead
        pass


_ship_by_value()
