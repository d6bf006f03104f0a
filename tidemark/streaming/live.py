"""S11 of a running ingest: the counts of the run summary come from metrics that the stream
observes while it lands its batches, so no second pass over the landed rows is needed.

The metrics of each batch are one small row, kept below the run's folder; a restarted run
adds its batches to those of the run before, and a batch that is replayed replaces its row.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.streaming.ingest import run_available_now

METRICS = "ingest"
_ROW = "batch_id bigint, total_requests bigint, success_requests bigint, error_requests bigint, " \
       "first_us bigint, last_us bigint"


class _Watch(StreamingQueryListener):
    """The progress of every batch of the queries that start while it listens."""

    def __init__(self):
        self.progress, self.open, self.changed = [], set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.open.add(event.runId)

    def onQueryProgress(self, event) -> None:
        with self.changed:
            if event.progress.runId in self.open:
                self.progress.append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.open.discard(event.runId)
            self.changed.notify_all()


@contextmanager
def watched(spark: SparkSession) -> Iterator[Callable[[], list]]:
    """Gathers the progress of the queries that run inside the block: the value is to be
    called after it.  Events arrive in order, so a query's end comes behind its batches."""
    watch = _Watch()
    spark.streams.addListener(watch)
    try:
        yield lambda: watch.progress
        with watch.changed:
            watch.changed.wait_for(lambda: not watch.open, timeout=60)
    finally:
        spark.streams.removeListener(watch)


def land_observed(classified: DataFrame, root: str, ts_col: str = "ts") -> None:
    """Land a classified stream below ``{root}/out`` (partitions ``ok``), observing its counts;
    one row per batch goes to ``{root}/metrics``."""
    spark = classified.sparkSession
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    observed = classified.observe(
        METRICS, F.count(F.lit(1)).alias("total_requests"), F.count_if("ok").alias("success_requests"),
        F.count_if(~F.col("ok")).alias("error_requests"), F.min(us).alias("first_us"), F.max(us).alias("last_us"))
    with watched(spark) as progress:
        run_available_now(observed, "observed", root, partition_cols=["ok"])
    rows = [(p.batchId, *(p.observedMetrics[METRICS][c] for c in ("total_requests", "success_requests", "error_requests",
                                                                  "first_us", "last_us")))
            for p in progress() if METRICS in p.observedMetrics]
    if rows:  # one per batch
        spark.createDataFrame(rows, _ROW).write.mode("append").parquet(f"{root}/metrics")


def live_summary(spark: SparkSession, root: str) -> DataFrame:
    """The additive part of the run summary, from the observed metrics alone."""
    by_batch = spark.read.schema(_ROW).parquet(f"{root}/metrics").groupBy("batch_id") \
        .agg(F.max(F.struct(*[c for c in ("total_requests", "success_requests", "error_requests", "first_us", "last_us")]))
             .alias("m")).select("m.*")
    total = by_batch.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                           for c in ("total_requests", "success_requests", "error_requests")],
                         F.coalesce((F.max("last_us") - F.min("first_us")) / F.lit(1e6), F.lit(0.0)).alias("duration_seconds"))
    n, seconds = F.col("total_requests"), F.col("duration_seconds")
    return total.select("*", F.when(seconds > 0, n / seconds * 60).otherwise(F.lit(0.0)).alias("requests_per_minute"),
                        F.when(n > 0, F.col("error_requests") / n).otherwise(F.lit(0.0)).alias("failed_fraction"))
