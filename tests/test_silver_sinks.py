"""Bronze/Silver sinks and Silver operators: idempotent reruns, status records,
snapshots, normalisation, validation split, dedup (S3-S6, S13, F21, O2, P17, W8)."""

import os
from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.operators import silver
from tidemark.session import shared_dir
import pytest
from tidemark.sources import bronze, dimension
from tidemark.sources import silver as silver_sink
from tidemark.sources.tables import load


def _events(spark, smoke_dir):
    return load(spark, smoke_dir, "events").select(
        F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM").alias("month"),
        "event_id", F.col("props").alias("body"))


def test_bronze_rerun_is_idempotent(spark, smoke_dir):
    docs = _events(spark, smoke_dir)
    path = shared_dir(spark, "t-bronze")
    bronze.write_bronze(docs, path)
    first = sorted(tuple(r) for r in bronze.read_bronze(spark, path).select("event_id", "symbol", "month").collect())
    bronze.write_bronze(docs, path)
    again = sorted(tuple(r) for r in bronze.read_bronze(spark, path).select("event_id", "symbol", "month").collect())
    assert first == again and len(first) == docs.count()
    # partition values come back as text, not numbers
    assert dict(bronze.read_bronze(spark, path).dtypes)["month"] == "string"


def test_save_bronze_status_reports_failed_target(spark, smoke_dir):
    docs = _events(spark, smoke_dir)
    good = shared_dir(spark, "t-good")
    blocker = shared_dir(spark, "t-blocked")
    os.makedirs(os.path.dirname(blocker), exist_ok=True)
    with open(blocker, "w") as fh:  # a file where a folder is needed: the write fails
        fh.write("x")
    status = bronze.save_bronze(docs, {"local": good, "s3": blocker + "/sub"})
    rows = status.collect()
    assert rows and all(not r.ok for r in rows)
    assert all(r.error.startswith("s3 save failed:") for r in rows)
    assert all(r.local_uri == good and r.s3_uri is None for r in rows)
    ok = bronze.save_bronze(docs, {"local": shared_dir(spark, "t-ok")}).collect()
    assert all(r.ok and r.error is None for r in ok)


def test_snapshots_append(spark):
    path = shared_dir(spark, "t-snap")
    df = spark.createDataFrame([("ibm", "{}")], "keywords string, body string")
    bronze.append_snapshots(df, path, "keywords", F.lit(datetime(2025, 1, 1)))
    bronze.append_snapshots(df, path, "keywords", F.lit(datetime(2025, 1, 2)))
    back = bronze.read_bronze(spark, path)
    latest = silver.dedup_latest(back, ["keywords"], ["ingested_at"]).first()
    assert back.count() == 2 and latest.ingested_at == datetime(2025, 1, 2)


def test_silver_rewrite_replaces_whole_years(spark):
    rows = [("S1", datetime(2024, m, 1), 1) for m in range(1, 13)] + [("S1", datetime(2025, 1, 1), 1)]
    src = spark.createDataFrame(rows, "symbol string, ts timestamp, v int")
    path = shared_dir(spark, "t-silver")
    silver_sink.write_yearly(src, path)
    years = silver_sink.rewrite_years(src, lambda d: d.withColumn("v", F.lit(2)), path,
                                      date(2024, 3, 1), date(2024, 5, 1))
    back = spark.read.parquet(path)
    assert years == [2024]
    assert back.count() == 13  # Q21: the months outside the rerun window survive
    assert {(r.year, r.v) for r in back.select("year", "v").distinct().collect()} == {("2024", 2), ("2025", 1)}


def test_normalize_multi_bar_document(spark):
    doc = ('{"Time Series (1min)": {'
           '"2025-01-02 09:30:00": {"1. open": "1.5", "2. high": "2", "3. low": "1", "4. close": "1.75", '
           '"5. volume": "10"}, '
           '"2025-01-02 09:31:00": {"1. open": "x", "2. high": "2", "3. low": "1", "4. close": "1", '
           '"5. volume": "-3"}}}')
    bars = silver.normalize_bars(spark.createDataFrame([("AAA", doc)], "symbol string, body string"))
    got = {r.ts.minute: r for r in bars.collect()}
    assert len(got) == 2 and float(got[30].close) == 1.75 and got[30].volume == 10
    assert got[31].open is None and got[30].month == "2025-01"
    v = silver.validate_bars(bars)
    good, quarantine = silver.split_valid(v)
    assert good.count() + quarantine.count() == 2
    bad = quarantine.first()
    assert bad.violations == ["bad_price", "bad_volume"]


def test_dedup_newest_wins_and_union(spark):
    old = spark.createDataFrame([("A", 1, 10, datetime(2025, 1, 1)), ("B", 1, 5, datetime(2025, 1, 1))],
                                "symbol string, t int, v int, ingested_at timestamp")
    new = spark.createDataFrame([("A", 1, 11, datetime(2025, 2, 1))],
                                "symbol string, t int, v int, ingested_at timestamp")
    out = silver.dedup_latest(silver.union_reingested(old, new), ["symbol", "t"], ["ingested_at"])
    assert sorted((r.symbol, r.v) for r in out.collect()) == [("A", 11), ("B", 5)]


def test_dimension_csv_with_doubled_quotes(spark, smoke_dir):
    """A dimension file written by Spark from the customer table, read back
    through the all-text schema: quotes, JSON tag arrays, padded symbols, NA."""
    cust = load(spark, smoke_dir, "customer")
    dim = cust.select(
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("symbol"),
        F.col("c_name").alias("name"), F.lit("equity").alias("asset_type"), F.lit("US").alias("market"),
        F.col("c_mktsegment").alias("category"), F.lit("mid_beta").alias("risk_group"),
        F.lit("high").alias("liquidity_class"), F.lit("single_name").alias("systemic_role"),
        F.lit("leader").alias("narrative_role"), F.lit("[]").alias("bubble_history"),
        F.lit('["ai-cycle"]').alias("narrative_exposure"), F.lit("2").alias("data_priority"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("NA")).otherwise(F.lit("1999-01")).alias("start_date"),
        F.lit('["gfc-2008", "covid-crash"]').alias("shock_history"))
    path = shared_dir(spark, "t-dim")
    dim.coalesce(1).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    back = dimension.read_dimension(spark, path)
    r = back.where(F.col("symbol") == "Customer#000000001").first()
    assert r.shock_history == ["gfc-2008", "covid-crash"] and r.narrative_exposure == ["ai-cycle"]
    assert r.data_priority == 2 and r.first_month == date(1999, 1, 1)
    assert back.where(F.col("first_month").isNull()).count() == cust.where(F.col("c_custkey") % 10 == 0).count()
    tags = dimension.explode_tags(back, "shock_history")
    assert tags.count() == 2 * cust.count()


def test_dimension_columns_are_found_by_name(spark):
    path = shared_dir(spark, "t-dim-names")
    rows = spark.createDataFrame([("2001-01", "x", "007"), ("2020-05", "y", "B")], "start_date string, other string, symbol string")
    rows.coalesce(1).write.option("header", True).csv(path)
    back = dimension.read_dimension(spark, path)
    assert sorted((r.symbol, str(r.first_month), r.other) for r in back.collect()) == \
        [("007", "2001-01-01", "x"), ("B", "2020-05-01", "y")]
    path = shared_dir(spark, "t-dim-short")
    rows.select("symbol", "other").coalesce(1).write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="start_date"):
        dimension.read_dimension(spark, path)


def test_rewrite_in_another_time_zone_keeps_other_years(spark):
    from datetime import datetime, timedelta

    from tidemark.sources import silver as sink
    start = datetime(2024, 12, 31, 12)
    stamps = [start + timedelta(hours=3 * k) for k in range(14)]  # UTC; New York's year begins five hours later
    raw = spark.createDataFrame([("A", t, k) for k, t in enumerate(stamps)], "symbol string, ts timestamp, k int")

    def local(df):
        day = F.to_date(F.from_utc_timestamp("ts", "America/New_York"))
        return df.withColumn("trade_date", day).withColumn("year", F.year(day))

    for layout in ("year", "month"):
        path = shared_dir(spark, "t-zone")
        if layout == "year":
            sink.write_yearly(local(raw), path)
            sink.rewrite_years(raw, local, path, years=[2025])
        else:
            sink.write_monthly(local(raw).withColumn("month", F.date_format("trade_date", "yyyy-MM")), path)
            sink.rewrite_months(raw, local, path, ["2025-01"])
        assert sorted(r.k for r in spark.read.parquet(path).collect()) == list(range(14)), layout


def test_silver_files_are_sorted(spark, smoke_dir):
    import pyarrow.parquet as pq

    from tidemark.sources import silver as sink
    li = load(spark, smoke_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("symbol"),
                                                   F.col("l_shipdate").alias("ts"))
    path = shared_dir(spark, "t-sorted")
    sink.write_yearly(li, path)
    import glob
    files = glob.glob(path.removeprefix("file:") + "/year=*/*.parquet")
    assert files
    for name in files:
        rows = pq.ParquetFile(name).read().to_pydict()
        keys = list(zip(rows["symbol"], rows["ts"]))
        assert keys == sorted(keys), name


def test_normalize_in_exchange_time_zone(spark):
    doc = ('{"Time Series (1min)": {"2025-01-02 19:30:00": {"1. open": "1", "2. high": "1", "3. low": "1", '
           '"4. close": "1", "5. volume": "1"}}}')
    bars = silver.normalize_bars(spark.createDataFrame([("AAA", doc)], "symbol string, body string"),
                                 source_tz="America/New_York").first()
    assert bars.ts == datetime(2025, 1, 3, 0, 30)          # stored in UTC (session zone)
    assert bars.trade_date == date(2025, 1, 2) and bars.month == "2025-01"


def test_beta_to_benchmark_symbols(spark):
    from tidemark.operators import gold
    days = [date(2025, 1, d) for d in range(1, 8)]
    bench = [0.01, -0.02, 0.015, 0.0, 0.03, -0.01, 0.02]
    rows = [("SPY", d, r) for d, r in zip(days, bench)] + [("X", d, 2 * r) for d, r in zip(days, bench)]
    daily = spark.createDataFrame(rows, "symbol string, trade_date date, ret double")
    dim = spark.createDataFrame([("SPY", "benchmark"), ("X", "single_name")], "symbol string, systemic_role string")
    series = gold.benchmark_from_symbols(daily, dim.where(F.col("systemic_role") == "benchmark"))
    out = {r.symbol: (r.correlation, r.beta) for r in gold.benchmark_beta(daily, series).collect()}
    assert out["X"] == (1.0, 2.0) and out["SPY"] == (1.0, 1.0)


def test_silver_rerun_is_idempotent(spark, smoke_dir):
    bars = load(spark, smoke_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber")
    path = shared_dir(spark, "t-silver-rerun")
    silver_sink.write_yearly(bars, path)
    first = sorted(map(tuple, spark.read.parquet(path).select("l_orderkey", "l_linenumber", "year").collect()))
    silver_sink.rewrite_years(bars, lambda d: d, path, years=[1995, 1996, 1997, 1998, 1999, 2000, 2001])
    again = sorted(map(tuple, spark.read.parquet(path).select("l_orderkey", "l_linenumber", "year").collect()))
    assert first == again and len(first) == bars.count()


def test_monthly_rewrite_replaces_only_touched_months(spark):
    rows = [("S1", datetime(2024, m, 1), 1) for m in range(1, 13)]
    src = spark.createDataFrame(rows, "symbol string, ts timestamp, v int")
    path = shared_dir(spark, "t-silver-monthly")
    silver_sink.write_monthly(src, path)
    silver_sink.rewrite_months(src, lambda d: d.withColumn("v", F.lit(2)), path, ["2024-03", "2024-04"])
    back = {(r.month, r.v) for r in spark.read.parquet(path).select("month", "v").collect()}
    assert len(back) == 12 and ("2024-03", 2) in back and ("2024-05", 1) in back


def test_completeness_reports_landed_but_empty(spark):
    from tidemark.operators.completeness import completeness
    tasks = spark.createDataFrame([("A", "2025-01"), ("A", "2025-02"), ("A", "2025-03")], "symbol string, month string")
    landed = spark.createDataFrame([("A", "2025-01"), ("A", "2025-02")], "symbol string, month string")
    bars = spark.createDataFrame([("A", "2025-01", 1.0)], "symbol string, month string, close double")
    r = completeness(tasks, landed, bars=bars).first()
    assert (r.expected, r.present, r.missing, r.empty) == (3, 2, 1, 1)


def test_cube_matches_direct_cube_with_nulls(spark):
    from tidemark.operators import gold
    rows = [("a", "x", 1.0), ("a", "y", None), ("b", "x", 2.5), ("b", "x", None), ("c", "z", None)]
    df = spark.createDataFrame(rows, "d1 string, d2 string, v double")
    got = sorted(map(tuple, gold.metrics_cube(df, ["d1", "d2"], "v").collect()), key=str)
    direct = (df.cube("d1", "d2").agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n_rows"),
                                      F.round(F.sum("v"), 6).alias("sum_value"),
                                      F.round(F.avg("v"), 9).alias("avg_value")))
    assert got == sorted(map(tuple, direct.collect()), key=str)
