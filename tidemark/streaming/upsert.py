"""X2 with keyed state: the newest delivery of each bar, upserted into Silver.

``recompute_stream`` rereads a period's Bronze for every batch that touches it.  Here the
stream keeps the newest version of each (symbol, time) as state, under a watermark as long
as deliveries may overlap, and each batch emits only the bars whose newest version has
changed.  Silver's touched months are then rewritten from what they hold and those bars;
Bronze isn't read again.  A bar that comes later than the watermark allows is not taken,
and counted.

An upsert goes through a staging folder, since a month can't be overwritten while it is
read; replaying a batch writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.silver import write_monthly
from tidemark.streaming.ingest import run_available_now
from tidemark.streaming.live import watched

#: Two months and a day: the longest default ingest window.
OVERLAP = "62 days"


def newest_versions(stream: DataFrame, keys: Sequence[str], version: str, ts_col: str = "event_ts",
                    overlap: str = OVERLAP) -> DataFrame:
    """Per key (``ts_col`` among them) the columns of the row with the greatest ``version``;
    equal versions are ordered by their other columns.  In update mode: rows whose newest
    version has changed."""
    if ts_col not in keys:
        raise ValueError("the event time must be a key, or state would never end")
    rest = [c for c in stream.columns if c not in keys and c != version]
    best = F.max(F.struct(version, *rest)).alias("_best")
    return stream.withWatermark(ts_col, overlap).groupBy(*keys).agg(best) \
        .select(*keys, *[F.col("_best")[c].alias(c) for c in (version, *rest)])


def upsert_months(changed: DataFrame, path: str, staging: str, keys: Sequence[str], ts_col: str = "ts",
                  symbol_col: str = "symbol") -> None:
    """Rows of ``changed`` (with ``month``) in place of the rows of the same key in their
    months; a month's other rows stay."""
    spark = changed.sparkSession
    months = [r.month for r in changed.select("month").distinct().collect()]  # one row per touched month
    if not months:
        return
    try:
        held = spark.read.schema(changed.schema).parquet(path).where(F.col("month").isin(months))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        held = changed.limit(0)
    merged = held.join(changed.select(*keys), list(keys), "left_anti").select(*changed.columns).unionByName(changed)
    merged.write.mode("overwrite").parquet(staging)
    write_monthly(spark.read.schema(changed.schema).parquet(staging), path, ts_col, symbol_col)


def upsert_stream(stream: DataFrame, root: str, version: str, keys: Sequence[str] = ("symbol", "event_ts"),
                  ts_col: str = "event_ts", overlap: str = OVERLAP) -> int:
    """Run ``stream`` (validated bars with ``month``) over all that is available, upserting
    below ``{root}/silver``; returns how many rows came too late to be taken."""
    spark = stream.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        # written, as the batch is read three times and its state is updated once
        batch.write.mode("overwrite").parquet(f"{root}/changed")
        changed = spark.read.schema(batch.schema).parquet(f"{root}/changed")
        upsert_months(changed, f"{root}/silver", f"{root}/staging", keys, ts_col, keys[0])

    with watched(spark) as progress:
        run_available_now(newest_versions(stream, keys, version, ts_col, overlap), "upsert", root, foreach_batch=step,
                          output_mode="update")
    return sum(s.numRowsDroppedByWatermark for p in progress() for s in p.stateOperators)
