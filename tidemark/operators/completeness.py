"""Planned against landed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away


def missing_tasks(tasks: DataFrame, landed: DataFrame, keys: Sequence[str] = ("symbol", "month")) -> DataFrame:
    """Planned pairs with nothing landed (left anti join on the pair)."""
    k = list(keys)
    return tasks.select(*k).join(landed.select(*k).distinct(), k, "left_anti")


def completeness(tasks: DataFrame, landed: DataFrame, keys: Sequence[str] = ("symbol", "month"),
                 by: str = "symbol", bars: DataFrame | None = None) -> DataFrame:
    """Per symbol, expected / present / missing months and the ratio.

    With ``bars`` (rows carrying the same keys), a landed month without any
    bar is also counted as ``empty`` — an accepted payload with no series
    (Q12) is landed but yields nothing.
    """
    k = list(keys)
    flagged = tasks.select(*k).join(landed.select(*k).distinct().withColumn("_present", F.lit(True)),
                                    k, "left")
    aggs = [F.count(F.lit(1)).alias("expected"),
            F.count_if(F.col("_present").isNotNull()).alias("present")]
    if bars is not None:
        flagged = flagged.join(bars.select(*k).distinct().withColumn("_bars", F.lit(True)), k, "left")
        aggs.append(F.count_if(F.col("_present").isNotNull() & F.col("_bars").isNull()).alias("empty"))
    return (flagged.groupBy(by).agg(*aggs)
            .withColumn("missing", F.col("expected") - F.col("present"))
            .withColumn("completeness", round_half_away(F.col("present") / F.col("expected"), 6)))
