"""gildhall — star-schema warehouse operators on PySpark DataFrames.

Layout:
  sources/    scans, generated spines, seeds, code-table loader, contracts, sinks
  functions/  Column-level helpers (fiscal calendar, text decode, rule tables)
  operators/  DataFrame operators (key resolution, dedup, SCD2, CDC, trees,
              quality profile, run-log fold, skew-safe ordinal numbering)
  plans/      demo queries on the test tables and the reporting views
  streaming/  the optional availableNow/foreachBatch form of the CDC refresh
"""

from gildhall.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
