"""Demo queries on the test tables and reporting views.

Importing this package registers every query module.
"""

from gildhall.plans import q_slice  # noqa: F401
from gildhall.plans.registry import ORACLE, QUERIES, runner

for _m in ("q_sources", "q_scalar", "q_joins", "q_aggs", "q_windows", "q_tree", "q_cdc", "q_domain",
           "q_payments", "q_dims", "q_audit", "q_quality", "q_views", "q_gold_views"):
    try:
        __import__(f"gildhall.plans.{_m}")
    except ModuleNotFoundError as e:  # module not written yet
        if e.name != f"gildhall.plans.{_m}":
            raise

__all__ = ["ORACLE", "QUERIES", "runner"]
