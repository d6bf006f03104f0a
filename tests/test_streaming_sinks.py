"""The keyed upsert, the two-target sink with its log, and the observed summary."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import classify as C
from tidemark.plans import recast as R
from tidemark.session import shared_dir
from tidemark.sources import bronze
from tidemark.streaming import ingest, live, sink, upsert

BARS = "symbol string, event_ts timestamp, version int, close double, month string"


def bar(symbol, day, version, close):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=day)
    return symbol, at, version, close, f"{at:%Y-%m}"


def test_upsert_takes_the_newest_version_and_counts_late_rows(spark):
    ingest.use_rocksdb(spark)
    src, root = shared_dir(spark, "t-upsert-src"), shared_dir(spark, "t-upsert")

    def deliver(*rows):
        spark.createDataFrame(list(rows), BARS).coalesce(1).write.mode("append").parquet(src)
        return upsert.upsert_stream(spark.readStream.schema(BARS).parquet(src), root, "version")

    def held():
        return {(r.symbol, (r.event_ts - dt.datetime(2024, 1, 1)).days): r.close
                for r in spark.read.parquet(f"{root}/silver").collect()}

    assert deliver(bar("a", 0, 1, 1.0), bar("a", 1, 1, 2.0), bar("b", 40, 1, 3.0)) == 0
    # an overlap: a newer version wins, an older one doesn't, other bars of the month stay
    assert deliver(bar("a", 1, 2, 2.5), bar("b", 40, 0, 9.0)) == 0
    assert held() == {("a", 0): 1.0, ("a", 1): 2.5, ("b", 40): 3.0}
    deliver(bar("c", 200, 1, 7.0))  # the watermark moves on
    assert deliver(bar("a", 0, 3, 8.0), bar("c", 199, 1, 6.0)) == 1
    assert held() == {("a", 0): 1.0, ("a", 1): 2.5, ("b", 40): 3.0, ("c", 200): 7.0, ("c", 199): 6.0}
    with pytest.raises(ValueError):
        upsert.newest_versions(spark.readStream.schema(BARS).parquet(src), ["symbol"], "version")


def test_a_failed_target_is_written_again_alone(spark, smoke_dir):
    root = shared_dir(spark, "t-save")
    good, bad = f"{root}/good", "nosuch://bucket/x"
    docs = R.docs_from_events(ingest.table_stream(spark, smoke_dir, "events")) \
        .withColumn("day", F.date_format("ts", "yyyy-MM-dd")).drop("ts")
    n = spark.read.parquet(f"{smoke_dir}/events.parquet").count()
    log = {r.target: r for r in sink.save_stream(docs, {"a": good, "b": bad}, root).collect()}
    assert log["a"].ok and not log["b"].ok and "nosuch" in log["b"].error
    assert bronze.read_bronze(spark, good).count() == n
    files = sorted(os.listdir(good))
    # still unreachable: the log says so; the other target isn't touched
    assert sink.retry_failed(spark, {"a": good, "b": bad}, root) == 1
    targets = {"a": good, "b": f"{root}/b"}
    assert sink.save_stream(docs, targets, root).where("NOT ok").count() == 0  # nothing new, but the retry
    assert bronze.read_bronze(spark, f"{root}/b").count() == n and sorted(os.listdir(good)) == files
    assert sink.retry_failed(spark, targets, root) == 0 and sink.save_log(spark, root).count() == 2


def test_a_batch_that_no_target_takes_stops_the_stream_and_is_replayed(spark, smoke_dir):
    root = shared_dir(spark, "t-save-none")
    docs = R.docs_from_events(ingest.table_stream(spark, smoke_dir, "events")) \
        .withColumn("day", F.date_format("ts", "yyyy-MM-dd")).drop("ts")
    with pytest.raises(Exception, match="no target took batch 0"):
        sink.save_stream(docs, {"a": "nosuch://a/x", "b": "nosuch://b/x"}, root)
    log = sink.save_stream(docs, {"a": f"{root}/a", "b": f"{root}/b"}, root).collect()
    assert [r.ok for r in log] == [True, True]
    assert bronze.read_bronze(spark, f"{root}/a").count() == bronze.read_bronze(spark, f"{root}/b").count() > 0


def test_live_summary_equals_the_landed_rows_and_adds_up_over_runs(spark, smoke_dir):
    src, root = shared_dir(spark, "t-live-src"), shared_dir(spark, "t-live")
    responses = R.responses_from_events(spark.read.parquet(f"{smoke_dir}/events.parquet"))
    for part in (0, 1):
        responses.where(F.col("response_id") % 2 == part).write.mode("append").parquet(src)
        stream = spark.readStream.schema(responses.schema).parquet(src)
        live.land_observed(C.classify(stream, C.INTRADAY, diagnostics=False), root)
        landed = spark.read.parquet(f"{root}/out")
        got = live.live_summary(spark, root).first()
        ok = F.col("ok").cast("string") == "true"
        want = landed.agg(F.count("*").alias("n"), F.count_if(ok).alias("ok"),
                          (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp")))
                          .alias("us")).first()
        assert (got.total_requests, got.success_requests) == (want.n, want.ok)
        assert got.error_requests == want.n - want.ok and got.duration_seconds == pytest.approx(want.us / 1e6)
    assert got.total_requests == responses.count()


def test_save_status_is_checked(spark):
    df = spark.createDataFrame([("a", "2024-01", "x")], "symbol string, month string, body string")
    status = bronze.save_bronze(df, {"local": shared_dir(spark, "t-saved"), "s3": "nosuch://b/x"})
    with pytest.raises(RuntimeError, match="s3 save failed"):
        bronze.require_saved(status)
    bronze.require_saved(bronze.save_bronze(df, {"local": shared_dir(spark, "t-saved")}))
