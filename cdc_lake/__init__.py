"""cdc_lake: change-data-capture to lakehouse analytics, expressed as Spark DataFrame plans.

Layout
------
sources/    driver tables, derived change feeds, change messages, lake table handle
functions/  column expressions: envelope build/parse, decimals, epoch conversions
operators/  DataFrame -> DataFrame operators: dedupe, SCD1, SCD2, rules, ledger, metrics
plans/      the query catalogue (``queries()``) and its SQL oracles
streaming/  Structured Streaming wiring: change-log sink, per-table streams, taps, serving
"""

from cdc_lake.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
