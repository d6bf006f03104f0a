"""Dimension joins.

No hint: the planner broadcasts a side by its own bound, and AQE again by the
size it has measured; beyond it the shuffle join with skew splitting is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Enrich facts with dimension attributes."""
    return fact.join(dim, on, how)
