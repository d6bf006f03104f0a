"""SURVEY §3.4 end to end: landed responses -> classify -> Bronze -> normalise
-> validate -> Silver (dedup, yearly) -> Gold, with the counts conserved."""

from pyspark.sql import functions as F

from tidemark.operators import classify as C
from tidemark.operators import gold, silver
from tidemark.plans import recast as R
from tidemark.session import shared_dir
from tidemark.sources import bronze
from tidemark.sources import silver as silver_sink


def test_landing_to_gold(spark, smoke_dir):
    root = shared_dir(spark, "t-lifecycle")
    docs = R.event_docs(spark, smoke_dir).withColumn("month", F.date_format("ts", "yyyy-MM"))
    responses = docs.select("symbol", "month", "event_id", F.lit(200).alias("status_code"),
                            F.lit("application/json").alias("content_type"), "body")
    # a replayed landing of every tenth event: duplicates for Silver to remove
    replay = responses.where(F.col("event_id") % 10 == 0)
    landed = C.classify(responses.unionByName(replay), C.INTRADAY, diagnostics=False)
    assert landed.where(~F.col("ok")).count() == 0
    bronze.write_bronze(landed.select("symbol", "month", "event_id", "body"), f"{root}/bronze")

    raw = bronze.read_bronze(spark, f"{root}/bronze")
    bars = silver.normalize_bars(raw, keep=["event_id"]).withColumn("month", F.date_format("ts", "yyyy-MM"))
    checked = silver.validate_bars(bars)
    good, quarantine = silver.split_valid(checked)
    assert good.count() + quarantine.count() == raw.count()
    unique = silver.dedup_latest(good, ["symbol", "ts"], ["event_id"])
    events = spark.read.parquet(f"{smoke_dir}/events.parquet")
    assert unique.count() == events.where(F.col("value") > 0).where(
        F.get_json_object("props", "$.k").cast("bigint") >= 0).count()

    silver_sink.write_yearly(unique.drop("year"), f"{root}/silver")
    silver_rows = spark.read.parquet(f"{root}/silver")
    daily = gold.daily_bars(silver_rows.withColumn("price", F.col("close").cast("double")))
    silver_sink.write_gold(daily.withColumn("ts", F.col("trade_date").cast("timestamp")),
                           f"{root}/gold/daily", "ts")
    gold_rows = spark.read.parquet(f"{root}/gold/daily")
    assert gold_rows.count() == silver_rows.select("symbol", F.to_date("ts")).distinct().count()
