"""Streaming landing: restart from the checkpoint, and replay of an epoch."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators import classify as C
from tidemark.plans import recast as R
from tidemark.session import shared_dir
from tidemark.streaming import ingest as S


def _classify(b):
    return C.classify(b, C.INTRADAY, diagnostics=False)


def test_restart_processes_only_new_files_and_replay_is_idempotent(spark, smoke_dir):
    src = shared_dir(spark, "t-stream-src")
    os.makedirs(src, exist_ok=True)
    shutil.copy(os.path.join(smoke_dir, "events.parquet"), os.path.join(src, "events.parquet"))
    root = shared_dir(spark, "t-stream-land")

    def stream():
        s = S.table_stream(spark, src, "events")
        s = spark.readStream.schema(s.schema).parquet(src)  # every file of the folder
        return R.responses_from_events(s).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))

    S.land_stream(stream(), _classify, root)
    n1 = spark.read.parquet(f"{root}/bronze").count() + spark.read.parquet(f"{root}/rejects").count()
    shutil.copy(os.path.join(smoke_dir, "events.parquet"), os.path.join(src, "events-2.parquet"))
    S.land_stream(stream(), _classify, root)  # same checkpoint: only the new file
    bronze = spark.read.parquet(f"{root}/bronze")
    n2 = bronze.count() + spark.read.parquet(f"{root}/rejects").count()
    assert n1 > 0 and n2 == 2 * n1
    assert {r.batch_id for r in bronze.select("batch_id").distinct().collect()} == {"0", "1"}  # text partitions

    # replaying epoch 1 with the same rows leaves the landed data unchanged
    before = sorted(map(tuple, bronze.select("response_id", "batch_id").collect()))
    batch = R.responses_from_events(spark.read.parquet(os.path.join(src, "events-2.parquet"))) \
        .withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    S.land_batch(batch, 1, _classify, root)
    again = spark.read.parquet(f"{root}/bronze")
    assert sorted(map(tuple, again.select("response_id", "batch_id").collect())) == before


def test_recompute_stream_monthly(spark, smoke_dir):
    from tidemark.operators import silver
    root = shared_dir(spark, "t-stream-monthly")
    src = S.table_stream(spark, smoke_dir, "events")

    def to_docs(b):
        return R.docs_from_events(b).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))

    def to_silver(landed):
        return silver.normalize_bars(landed, keep=["event_id"]).drop("month", "year")

    S.recompute_stream(src, root, to_docs, to_silver, period="month")
    out = spark.read.parquet(f"{root}/silver")
    assert out.count() == spark.read.parquet(f"{smoke_dir}/events.parquet").count()
    assert {r.month for r in out.select("month").distinct().collect()} == {"2024-01"}


def test_recompute_stream_takes_the_newest_valid_bar(spark, tmp_path):
    """Twelve overlapping deliveries, one a batch: batch 11 wins over 9, an invalid bar over none."""
    from datetime import datetime

    from tidemark.operators import silver
    src, root = tmp_path / "src", shared_dir(spark, "t-stream-overlap")
    ts = datetime(2024, 1, 31, 23, 59)
    for k in range(12):
        rows = [("A", ts, float(k + 1)), (f"S{k}", ts, 5.0)] + [("A", ts, -1.0)] * (k in (3, 11))
        spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double").coalesce(1) \
            .write.mode("append").parquet(str(src))

    def to_docs(b):
        p = F.col("price")
        return b.select("symbol", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"),
                        silver.bar_document(F.col("ts"), p, p, p, p, F.lit(1)).alias("body"))

    def to_silver(landed):  # the vendor's zone is an hour behind UTC: stored as 1 February, traded in January
        return silver.normalize_bars(landed, keep=["batch_id"], source_tz="-01:00")

    stream = spark.readStream.schema("symbol string, ts timestamp_ntz, price double") \
        .option("maxFilesPerTrigger", 1).parquet(str(src))
    S.recompute_stream(stream, root, to_docs, to_silver, period="month")
    got = {r.symbol: (float(r.open), r.month) for r in spark.read.parquet(f"{root}/silver").collect()}
    assert spark.read.parquet(f"{root}/silver").count() == 13
    assert got == {"A": (12.0, "2024-01")} | {f"S{k}": (5.0, "2024-01") for k in range(12)}
    bad = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted((r.batch_id, tuple(r.violations)) for r in bad) == [("11", ("bad_price",)), ("3", ("bad_price",))]

    with pytest.raises(Exception, match="batch_id"):  # which one is the newest?
        S.recompute_stream(stream, shared_dir(spark, "t-stream-refused"), to_docs,
                           lambda b: to_silver(b).drop("batch_id"), period="month")


def test_streams_read_folder_tables(spark, smoke_dir, tmp_path):
    """Every registered stream over a table in a folder of several files equals the single-file result."""
    import __spark_entry__ as E
    events = spark.read.parquet(f"{smoke_dir}/events.parquet")
    for name in os.listdir(smoke_dir):
        if name != "events.parquet":
            (tmp_path / name).symlink_to(f"{smoke_dir}/{name}")
    events.repartition(5, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_ingest", "stream_silver"):
        q = E.queries()[name]
        assert sorted(map(str, q(spark, str(tmp_path)).collect())) == sorted(map(str, q(spark, smoke_dir).collect())), name
    empty = tmp_path / "none"
    (empty / "events.parquet").mkdir(parents=True)
    with pytest.raises(Exception):
        S.table_stream(spark, str(empty), "events")


@pytest.mark.parametrize("shift, times", [(0, 1), (1, 2)])
def test_recompute_stream_parses_the_documents_of_a_period_once(spark, tmp_path, shift, times):
    """Two deliveries: each trigger asks once for the bars of its periods, its own among them; only where
    documents land in another month than their bars (``shift`` days on) it parses again, and fully."""
    from datetime import datetime

    from tidemark.operators import silver
    src, root = tmp_path / "src", shared_dir(spark, "t-stream-once")
    day = datetime(2024, 1, 31, 12)
    for k in range(2):
        rows = [("A", day, float(k + 1)), (f"S{k}", day, 5.0), ("Z", day, -1.0)]
        spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double").coalesce(1) \
            .write.mode("append").parquet(str(src))
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(body):
        parsed.add(1)
        return body

    def to_docs(b):
        p = F.col("price")
        return b.select("symbol", F.date_format(F.date_add("ts", shift), "yyyy-MM-dd").alias("day"),
                        silver.bar_document(F.col("ts"), p, p, p, p, F.lit(1)).alias("body"))

    def to_silver(landed):
        return silver.normalize_bars(landed.withColumn("body", counted("body")), keep=["batch_id"])

    stream = spark.readStream.schema("symbol string, ts timestamp_ntz, price double") \
        .option("maxFilesPerTrigger", 1).parquet(str(src))
    S.recompute_stream(stream, root, to_docs, to_silver, period="month")
    got = sorted((r.symbol, float(r.open), r.month) for r in spark.read.parquet(f"{root}/silver").collect())
    assert got == [("A", 2.0, "2024-01"), ("S0", 5.0, "2024-01"), ("S1", 5.0, "2024-01")]
    bad = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted((r.batch_id, r.symbol, tuple(r.violations)) for r in bad) == [("0", "Z", ("bad_price",)), ("1", "Z", ("bad_price",))]
    assert parsed.value == (3 + 6) * times
