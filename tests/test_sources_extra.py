"""Landed raw files (S7), file order (T4), bars from finer bars, session bars."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import gold, intraday
from tidemark.operators.ordering import with_file_order
from tidemark.operators.silver import dedup_latest
from tidemark.session import shared_dir
from tidemark.sources.landing import land_raw, read_landed
from tidemark.sources.tables import load, table_path


def test_landed_raw_documents_round_trip(spark, smoke_dir):
    e = load(spark, smoke_dir, "events").select(
        F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM").alias("month"),
        F.concat(F.lit('{\n  "doc": '), F.col("props"), F.lit("\n}")).alias("body"), "event_id")
    one_per_key = dedup_latest(e, ["symbol", "month"], ["event_id"])  # one document per key
    path = shared_dir(spark, "t-landed")
    land_raw(one_per_key, path)
    back = read_landed(spark, path)
    got = sorted((r.symbol, r.month, r.body) for r in back.collect())
    want = sorted((r.symbol, r.month, r.body) for r in one_per_key.collect())
    assert got == want and "\n" in got[0][2]
    assert back.where(F.col("ingested_at").isNull()).count() == 0


def test_file_order_index(spark, smoke_dir):
    part = spark.read.parquet(table_path(smoke_dir, "part"))
    idx = with_file_order(part, "pos").select("p_partkey", "pos").collect()
    file_order = [r.p_partkey for r in part.collect()]
    assert [k for k, _ in sorted((r.p_partkey, r.pos) for r in idx)] == sorted(file_order)
    assert [r.p_partkey for r in sorted(idx, key=lambda r: r.pos)] == file_order


def test_coarse_bars_from_fine_equal_base(spark, smoke_dir):
    bars = load(spark, smoke_dir, "events").select(
        F.col("user_id").alias("symbol"), "ts", F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"))
    base = gold.ohlcv(bars, "day")
    rolled = gold.rollup_bars(gold.ohlcv(bars, "minute"), "hour")
    rolled = gold.rollup_bars(rolled, "day")
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, rolled.select(*base.columns).collect()))


def test_session_bars(spark):
    t = [datetime(2025, 1, 1, 9, 0), datetime(2025, 1, 1, 9, 20), datetime(2025, 1, 1, 9, 50),
         datetime(2025, 1, 1, 10, 30)]
    df = spark.createDataFrame([("A", x, float(i + 1), 1) for i, x in enumerate(t)],
                               "symbol string, ts timestamp, price double, volume int")
    s = sorted(intraday.session_bars(df, 1800, "symbol", "ts", "price", "volume", F.to_date("ts")).collect(),
               key=lambda r: r.session_start)
    assert [(r.n_trades, r.open, r.close) for r in s] == [(3, 1.0, 3.0), (1, 4.0, 4.0)]
    assert s[0].session_end == datetime(2025, 1, 1, 10, 20)
