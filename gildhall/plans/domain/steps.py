"""Steps within a builder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialised(gold) -> bool:
    """Whether the Gold tables of ``gold`` are written as they are built (``LazyGold`` with ``materialise``)."""
    return getattr(gold, "step", None) is not None


def step(gold, df: DataFrame) -> DataFrame:
    """``df`` stored where the tables of ``gold`` are, else the plan as it is.

    A large builder is cut where rows are dealt anew, so that the shuffle files of one step end before the next begins and
    the disk holds its largest step, not all of them.
    """
    return gold.step(df) if materialised(gold) else df
