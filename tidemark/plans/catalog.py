"""Registered queries: one callable ``(spark, data_dir) -> DataFrame`` per key.

Every query reads the whole of the given tables (no subsets, no row caps);
limits appear only where the limit is the feature (``subset_limit``,
``top_movers``).  Column names match the SQL oracles in ``oracle.py``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import keys as K
from tidemark.functions import months as M
from tidemark.operators import classify as classify_op
from tidemark.operators import completeness as completeness_op
from tidemark.operators import earliest as earliest_op
from tidemark.operators import distribution, gold, intraday, outcomes, planner, worker
from tidemark.operators import search as search_op
from tidemark.operators import silver as silver_op
from tidemark.operators.ordering import with_file_order
from tidemark.plans import recast as R
from tidemark.session import shared_dir
from tidemark.sources import bronze, buckets, dimension, landing
from tidemark.sources import silver as silver_sink
from tidemark.sources.tables import load
from tidemark.streaming import ingest as streaming
from tidemark.streaming import live, sink, upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def days_as_timestamps(df: DataFrame) -> DataFrame:
    """Query boundary: calendar days leave as TIMESTAMP_NTZ at midnight, the
    convention of the given tables (``o_orderdate``, ``l_shipdate``); the
    library itself works with DATE."""
    if not any(isinstance(f.dataType, T.DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.DateType) else F.col(f.name) for f in df.schema.fields])


def register(name: str):
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def query(spark: SparkSession, d: str) -> DataFrame:
            return days_as_timestamps(fn(spark, d))
        QUERIES[name] = query
        return fn
    return deco


# ------------------------------------------------------------------ planner

@register("year_month_valid")
def year_month_valid(spark: SparkSession, d: str) -> DataFrame:
    """P1/F14 over month texts degraded in eight ways (one per key residue)."""
    o = load(spark, d, "orders")
    ym = M.month_key("o_orderdate")
    yr = F.date_format("o_orderdate", "yyyy")
    mm = F.date_format("o_orderdate", "MM")
    text = (F.when(F.col("o_orderkey") % 8 == 0, ym)
            .when(F.col("o_orderkey") % 8 == 1, F.concat(F.lit(" "), ym, F.lit("  ")))
            .when(F.col("o_orderkey") % 8 == 2, F.concat(yr, F.lit("-"), F.month("o_orderdate").cast("string")))
            .when(F.col("o_orderkey") % 8 == 3, F.concat(yr, F.lit("-13")))
            .when(F.col("o_orderkey") % 8 == 4, F.concat(yr, F.lit("-00")))
            .when(F.col("o_orderkey") % 8 == 5, F.concat(F.lit("0000-"), mm))
            .when(F.col("o_orderkey") % 8 == 6, F.concat(yr, F.lit("5-"), mm))
            .otherwise(F.concat(ym, F.lit("2"))))
    t = o.select("o_orderkey", text.alias("ym_text"))
    return t.select("o_orderkey", "ym_text",
                    M.is_valid_year_month("ym_text").alias("is_valid"),
                    M.month_key(M.month_start("ym_text")).alias("month_key"))


PLAN_AS_OF = "2000-06-15 12:00:00"


@register("plan_window")
def plan_window(spark: SparkSession, d: str) -> DataFrame:
    """F1-F6, P2, P3, P8 over one request per order (event time = order date)."""
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    iso = M.utc_stamp("o_orderdate")
    ym = M.month_key("o_orderdate")
    r = F.col("o_orderkey") % 4
    prio = F.col("o_orderpriority")
    time = (F.when((r == 0) & (prio == "1-URGENT"), F.substring(iso, 1, 7))
            .when(prio == "5-LOW", F.lit("")).otherwise(iso))
    start = (F.when(r == 0, F.lit(""))
             .when((r == 1) & (prio == "2-HIGH"), F.concat(ym, F.lit("3")))
             .when(r == 1, M.month_key(F.add_months("o_orderdate", -14)))
             .otherwise(ym))
    end = (F.when(r == 0, F.lit(""))
           .when(r == 1, ym)
           .when(r == 2, M.month_key(F.add_months("o_orderdate", -1)))
           .otherwise(F.lit("")))
    req = o.select("o_orderkey", time.alias("time"), start.alias("year_month_start"),
                   end.alias("year_month_end"))
    out = planner.plan_window(req, as_of=F.to_timestamp(F.lit(PLAN_AS_OF)))
    return out.select("o_orderkey", "status", "ingest_start", "ingest_end", "glue_start", "glue_end",
                      "gold_year_start", "gold_year_end", "planned_at_utc")


@register("plan_batches")
def plan_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 50 part names in key order."""
    part = load(spark, d, "part").select(F.col("p_name").alias("symbol"), "p_partkey")
    b = planner.plan_batches(part, ["p_partkey"], R.BATCH_SIZE)
    return b.select("batch_id", "batch_size", F.col("n_symbols").cast("bigint").alias("n_symbols"),
                    "first_symbol", "last_symbol", F.array_join("symbols", ",").alias("symbols_csv"))


@register("plan_tasks")
def plan_tasks(spark: SparkSession, d: str) -> DataFrame:
    """The (symbol, month) fetch tasks of the customer dimension."""
    dim = R.dimension(spark, d)
    t = planner.plan_tasks(dim, *R.TASK_WINDOW, as_of=R.TASK_AS_OF)
    return t.select("symbol", "month")


@register("skip_reasons")
def skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    dim = R.dimension(spark, d)
    return planner.skip_reasons(dim, *R.TASK_WINDOW, as_of=R.TASK_AS_OF)


@register("subset_limit")
def subset_limit(spark: SparkSession, d: str) -> DataFrame:
    """J1 then T1: parts of returned lines, first 100 in key order."""
    part = load(spark, d, "part").select(F.col("p_partkey"), F.col("p_name"))
    subset = (load(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
              .select(F.col("l_partkey").alias("p_partkey")))
    return planner.subset_limit(part, subset, ["p_partkey"], R.SUBSET_LIMIT, key="p_partkey")


# ------------------------------------------------------------------ landing

def _classified(spark, d, endpoint):
    r = classify_op.classify(R.responses(spark, d), endpoint)
    return r.select("source", "response_id", "status_code", "error_class", "ok", "error",
                    "retriable", "body_head")


@register("classify_intraday")
def classify_intraday(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d, classify_op.INTRADAY)


@register("classify_search")
def classify_search(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d, classify_op.SEARCH)


@register("classify_monthly")
def classify_monthly(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d, classify_op.MONTHLY)


# The registered search keywords.
SEARCH_KEYWORDS = ("brand#1", "ring", "red", "bolt")


@register("symbol_search")
def symbol_search(spark: SparkSession, d: str) -> DataFrame:
    """S9 over our own dimension: symbol prefix or name substring, per keyword."""
    part = load(spark, d, "part").select("p_partkey", "p_name", F.col("p_brand").alias("symbol"))
    return search_op.symbol_search(part, SEARCH_KEYWORDS, symbol_col="symbol", name_col="p_name")


@register("retry_outcome")
def retry_outcome(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.retry_outcome(R.attempts(spark, d), ["user_id", "day"])


@register("last_outcome")
def last_outcome(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.last_outcome(R.requests(spark, d), ["symbol", "day"], "seq")


@register("unresolved_pairs")
def unresolved_pairs(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.unresolved_pairs(R.requests(spark, d), ["symbol", "day"], "seq")


@register("run_summary")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.run_summary(R.requests(spark, d), ["symbol", "day"], "seq")


@register("error_symbols")
def error_symbols(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.error_symbols(R.requests(spark, d))


@register("earliest_month")
def earliest_month(spark: SparkSession, d: str) -> DataFrame:
    return earliest_op.earliest_month(R.monthly_responses(spark, d))


@register("bronze_keys")
def bronze_keys(spark: SparkSession, d: str) -> DataFrame:
    """F9-F12, F16, F17 over one landed document per order."""
    o = load(spark, d, "orders")
    symbol = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    month = M.month_key("o_orderdate")
    bucket = F.concat(F.lit("bronze-"), F.lower("o_orderstatus"))
    key = K.bronze_key(symbol, month, "data/bronze")
    uri = K.object_uri(bucket, key)
    local_err = F.when(F.col("o_orderstatus") == "F", F.lit("local save failed: disk full"))
    s3_err = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("s3 save failed: access denied"))
    return o.select(
        "o_orderkey",
        key.alias("bronze_key"),
        uri.alias("bronze_uri"),
        K.uri_bucket(uri).alias("parsed_bucket"),
        K.uri_key(uri).alias("parsed_key"),
        K.snapshot_file(F.col("o_orderdate").cast("timestamp")).alias("snapshot_file"),
        K.join_errors(local_err, s3_err).alias("save_error"),
        F.to_json(F.struct(symbol.alias("symbol"), month.alias("month"),
                           F.col("o_orderstatus").alias("status"))).alias("doc_json"))


# ------------------------------------------------------------ bronze/silver

# The overlapping reruns of the rewrite queries.
FIRST_RUN_LAST_DAY = "2024-01-20"
SECOND_RUN_FIRST_DAY = "2024-01-15"
SILVER_RERUN = ("1998-03", "1998-05")
GOLD_RERUN_YEAR = 1997
BENCHMARK_SYMBOL = 1


@register("bronze_rewrite")
def bronze_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Two overlapping landings; the second replaces the partitions
    it touches, the rest of the first stays."""
    docs = (R.event_docs(spark, d)
            .select("event_id", "body", F.col("event_type").alias("symbol"),
                    F.date_format("ts", "yyyy-MM-dd").alias("day")))
    root = shared_dir(spark, "bronze_rewrite")
    # the two sinks of the reference: a local copy and the object store
    targets = {"local": f"{root}/local", "s3": f"{root}/s3"}
    keys = ("symbol", "day")
    for run, rows in ((1, docs.where(F.col("day") <= FIRST_RUN_LAST_DAY)),
                      (2, docs.where(F.col("day") >= SECOND_RUN_FIRST_DAY))):
        bronze.require_saved(bronze.save_bronze(rows.withColumn("run", F.lit(run)), targets, keys))
    return bronze.read_bronze(spark, targets["s3"]).select("event_id", "symbol", "day", "run")


@register("latest_snapshot")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Two appends of snapshots, newest per symbol wins."""
    e = load(spark, d, "events").select(
        "user_id", "event_id", "value", F.col("event_type").alias("keywords"),
        F.col("ts").alias("ingested_at"))
    path = shared_dir(spark, "snapshots")
    day = F.date_format("ingested_at", "yyyy-MM-dd")
    bronze.append_snapshots(e.where(day <= SECOND_RUN_FIRST_DAY), path, "keywords")
    bronze.append_snapshots(e.where(day > SECOND_RUN_FIRST_DAY), path, "keywords")
    snaps = bronze.read_bronze(spark, path)
    latest = silver_op.dedup_latest(snaps, ["user_id"], ["ingested_at", "event_id"])
    return latest.select("user_id", F.col("event_id").alias("latest_event_id"),
                         F.col("ingested_at").alias("latest_ts"), F.col("value").alias("latest_value"),
                         F.col("keywords").alias("latest_keywords"))


@register("dim_tags")
def dim_tags(spark: SparkSession, d: str) -> DataFrame:
    """JSON tag arrays (empty, one tag, two tags with varying spacing)."""
    part = load(spark, d, "part")
    t = F.lower("p_type")
    first_word = F.split("p_name", " ")[0]
    tags = (F.when(F.col("p_size") % 3 == 0, F.lit("[]"))
            .when(F.col("p_size") % 3 == 1, F.concat(F.lit('["'), t, F.lit('"]')))
            .when(F.col("p_size") % 6 == 5, F.concat(F.lit('["'), t, F.lit('","'), first_word, F.lit('"]')))
            .otherwise(F.concat(F.lit('["'), t, F.lit('", "'), first_word, F.lit('"]'))))
    dim = part.select("p_partkey", tags.alias("tags"))
    return dimension.explode_tags(dim, "tags", "p_partkey")


@register("normalize_bars")
def normalize_bars(spark: SparkSession, d: str) -> DataFrame:
    """Documents -> typed bars."""
    bars = silver_op.normalize_bars(R.event_docs(spark, d), keep=["event_id"])
    return bars.select(
        "event_id", "symbol", F.col("ts").cast("timestamp_ntz").alias("ts"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        "volume", "trade_date", "month")


@register("validate_bars")
def validate_bars(spark: SparkSession, d: str) -> DataFrame:
    v = silver_op.validate_bars(R.lineitem_bars(spark, d))
    return v.select("l_orderkey", "l_linenumber", "is_valid",
                    F.array_join("violations", ",").alias("violations"))


@register("dedup_bars")
def dedup_bars(spark: SparkSession, d: str) -> DataFrame:
    """Newest ship date per (order, line); other columns break ties."""
    li = load(spark, d, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
    return silver_op.dedup_latest(li, ["l_orderkey", "l_linenumber"], order)


@register("silver_rewrite")
def silver_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Yearly Silver; a rerun of three months rewrites their whole year."""
    bars = R.lineitem_bars(spark, d).select("l_orderkey", "l_linenumber", "symbol", "ts")
    path = shared_dir(spark, "silver")
    silver_sink.write_yearly(bars.withColumn("run", F.lit(1)), path)
    start, end = M.require_window(*SILVER_RERUN)
    silver_sink.rewrite_years(bars, lambda df: df.withColumn("run", F.lit(2)), path, start, end)
    back = spark.read.parquet(path)
    return back.select("l_orderkey", "l_linenumber", "symbol", F.col("year").cast("int").alias("year"),
                       "run")


@register("missing_tasks")
def missing_tasks(spark: SparkSession, d: str) -> DataFrame:
    tasks = planner.plan_tasks(R.dimension(spark, d), *R.TASK_WINDOW, as_of=R.TASK_AS_OF)
    return completeness_op.missing_tasks(tasks, R.landed_months(spark, d))


@register("completeness")
def completeness(spark: SparkSession, d: str) -> DataFrame:
    tasks = planner.plan_tasks(R.dimension(spark, d), *R.TASK_WINDOW, as_of=R.TASK_AS_OF)
    return completeness_op.completeness(tasks, R.landed_months(spark, d))


# --------------------------------------------------------------------- gold

def _daily(spark, d):
    return gold.daily_bars(R.bars(spark, d), tiebreak="event_id")


def _daily_ret(spark, d):
    return gold.returns(_daily(spark, d))


@register("ohlcv_hourly")
def ohlcv_hourly(spark: SparkSession, d: str) -> DataFrame:
    return gold.ohlcv(R.bars(spark, d), "hour", tiebreak="event_id")


@register("ohlcv_daily")
def ohlcv_daily(spark: SparkSession, d: str) -> DataFrame:
    return gold.ohlcv(R.bars(spark, d), "day", tiebreak="event_id")


@register("vwap_daily")
def vwap_daily(spark: SparkSession, d: str) -> DataFrame:
    return gold.vwap(R.bars(spark, d), "day")


@register("returns")
def returns(spark: SparkSession, d: str) -> DataFrame:
    return _daily_ret(spark, d)


@register("rolling_stats")
def rolling_stats(spark: SparkSession, d: str) -> DataFrame:
    return gold.rolling_stats(_daily(spark, d), 5)


@register("rolling_range")
def rolling_range(spark: SparkSession, d: str) -> DataFrame:
    return gold.rolling_range(_daily(spark, d), 7)


@register("drawdown")
def drawdown(spark: SparkSession, d: str) -> DataFrame:
    return gold.drawdown(_daily(spark, d))


@register("zscore")
def zscore(spark: SparkSession, d: str) -> DataFrame:
    return gold.zscore(_daily(spark, d), 5)


@register("vol_regime")
def vol_regime(spark: SparkSession, d: str) -> DataFrame:
    return gold.vol_regime(_daily(spark, d), 3, 10)


@register("cross_rank")
def cross_rank(spark: SparkSession, d: str) -> DataFrame:
    ranked = gold.enrich(_daily_ret(spark, d), R.categories(spark, d).select("symbol", "category"),
                         "symbol", "left")
    return gold.cross_rank(ranked, "category")


@register("top_movers")
def top_movers(spark: SparkSession, d: str) -> DataFrame:
    return gold.top_movers(_daily_ret(spark, d), 3)


@register("dist_features")
def dist_features(spark: SparkSession, d: str) -> DataFrame:
    return gold.dist_features(R.bars(spark, d))


@register("dist_monthly")
def dist_monthly(spark: SparkSession, d: str) -> DataFrame:
    """G12 by period: exact features and percentiles per (symbol, month)."""
    return gold.period_features(R.bars(spark, d), "month").withColumnRenamed("period", "month")


def _sketch_months(spark, d):
    days = distribution.day_sketches(R.bars(spark, d))
    return distribution.merge_sketches(days, ["symbol", F.to_date(F.date_trunc("month", "trade_date")).alias("month")])


@register("dist_sketches")
def dist_sketches(spark: SparkSession, d: str) -> DataFrame:
    """G12 by period from mergeable sketches: day sketches merged to months, each held
    against the exact values of its (symbol, month): whether percentiles and distinct
    counts keep to the stated errors."""
    sketches = _sketch_months(spark, d)
    features = distribution.sketch_features(sketches)
    bars = R.bars(spark, d).select("symbol", F.to_date(F.date_trunc("month", "ts")).alias("month"), "price")
    return distribution.sketch_errors(bars, features, ["symbol", "month"], "price")


@register("dist_sketches_yearly")
def dist_sketches_yearly(spark: SparkSession, d: str) -> DataFrame:
    """The month sketches merged once more, to years: counts add up as the bars do."""
    years = distribution.merge_sketches(_sketch_months(spark, d),
                                        ["symbol", F.year("month").cast("bigint").alias("year")])
    features = distribution.sketch_features(years, {"p00": 0, "p100": 100})
    return features.select("symbol", "year", "n", F.col("p00").alias("min_value"), F.col("p100").alias("max_value"))


@register("benchmark_beta")
def benchmark_beta(spark: SparkSession, d: str) -> DataFrame:
    """One row per symbol, with returns or without."""
    r = _daily_ret(spark, d)
    return gold.benchmark_beta(r, gold.market_index(r))


@register("benchmark_beta_periods")
def benchmark_beta_periods(spark: SparkSession, d: str) -> DataFrame:
    """G13 by period: monthly co-moment states, and the years and all time merged from them."""
    r = _daily_ret(spark, d)
    states = gold.comoments(r, gold.market_index(r), "month")
    monthly = gold.co_features(states, ["symbol", "period"]).withColumn("grain", F.lit("month"))
    yearly = gold.merge_comoments(states, ["symbol", F.to_date(F.date_trunc("year", "period")).alias("period")])
    yearly = gold.co_features(yearly, ["symbol", "period"]).withColumn("grain", F.lit("year"))
    ever = gold.co_features(gold.merge_comoments(states, ["symbol"]), ["symbol"]) \
        .withColumn("period", F.lit(None).cast("date")).withColumn("grain", F.lit("all"))
    return monthly.unionByName(yearly).unionByName(ever).select("symbol", "grain", "period", "n_days", "correlation",
                                                                "beta")


@register("enriched_bars")
def enriched_bars(spark: SparkSession, d: str) -> DataFrame:
    e = gold.enrich(R.bars(spark, d), R.categories(spark, d), "symbol", "left")
    return e.select("event_id", "symbol", "ts", "price", "volume", "category", "nation")


def _bucketed_bars(spark, d):
    return buckets.save_bucketed(buckets.with_month(R.bars(spark, d)), "bars", sort_cols=("ts",))


@register("ohlcv_bucketed")
def ohlcv_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """G10 over bars laid out by symbol and month: hourly bars without another exchange."""
    return gold.ohlcv(_bucketed_bars(spark, d), "hour", tiebreak="event_id", layout=["month"]).drop("month")


@register("enriched_bucketed")
def enriched_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """J5 over bars laid out by symbol and month: joined bucket by bucket."""
    bars = _bucketed_bars(spark, d)
    dim = buckets.dimension_by_month(bars, R.categories(spark, d))
    e = gold.enrich(bars, dim.hint("merge"), ["symbol", "month"], "left")
    return e.select("event_id", "symbol", "ts", "price", "volume", "category", "nation")


@register("metrics_cube")
def metrics_cube(spark: SparkSession, d: str) -> DataFrame:
    e = gold.enrich(R.bars(spark, d), R.categories(spark, d), "symbol", "left")
    return gold.metrics_cube(e, ["category", "event_type", "nation"], "price")


@register("bars_against_benchmark")
def bars_against_benchmark(spark: SparkSession, d: str) -> DataFrame:
    """Hourly bars beside the bars of the benchmark symbol at the same hour."""
    hourly = gold.ohlcv(R.bars(spark, d), "hour", tiebreak="event_id")
    return gold.against_benchmark(hourly, hourly.where(F.col("symbol") == BENCHMARK_SYMBOL))


@register("dim_csv")
def dim_csv(spark: SparkSession, d: str) -> DataFrame:
    """The dimension written as CSV with its columns in another order, found
    again by their header names, and planned."""
    path = shared_dir(spark, "dim-csv")
    R.dimension(spark, d).select("start_date", F.lit("x").alias("note"), "symbol") \
        .write.option("header", True).option("escape", '"').csv(path)
    dim = dimension.read_dimension(spark, path)
    return planner.plan_tasks(dim, *R.TASK_WINDOW, as_of=R.TASK_AS_OF).select("symbol", "month")


@register("file_order")
def file_order(spark: SparkSession, d: str) -> DataFrame:
    """T4: position of each row of the part table in file order."""
    return with_file_order(load(spark, d, "part"), "pos").select("p_partkey", "pos")


@register("bronze_status")
def bronze_status(spark: SparkSession, d: str) -> DataFrame:
    """The status of each key after a save to two targets, and what each target holds."""
    docs = R.event_docs(spark, d).select("event_id", "body", F.col("event_type").alias("symbol"),
                                         F.date_format("ts", "yyyy-MM-dd").alias("day"))
    root = shared_dir(spark, "bronze-status")
    targets = {"local": f"{root}/local", "s3": f"{root}/s3"}
    out = bronze.save_bronze(docs, targets, ("symbol", "day")).select("symbol", "day", "ok")
    for name, path in targets.items():
        held = bronze.read_bronze(spark, path).groupBy("symbol", "day").agg(F.count("*").alias(f"n_{name}"))
        out = out.join(held, ["symbol", "day"], "left")
    return out


@register("monthly_snapshots")
def monthly_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Two appends under ``symbol=``; how many snapshots each symbol has, and the newest."""
    e = load(spark, d, "events").select(F.col("event_type").alias("symbol"), "event_id", "value",
                                        F.col("ts").alias("ingested_at"))
    path = shared_dir(spark, "monthly-snapshots")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        bronze.append_snapshots(e.where(part), path, "symbol")
    snaps = bronze.read_bronze(spark, path)
    newest = silver_op.dedup_latest(snaps, ["symbol"], ["ingested_at", "event_id"])
    counts = snaps.groupBy("symbol").agg(F.count("*").alias("n_snapshots"))
    return newest.join(counts, "symbol").select("symbol", "n_snapshots", F.col("event_id").alias("latest_event_id"),
                                                F.col("value").alias("latest_value"))


#: Lines that one task gathers and sorts.  Shuffled lines are so short that tasks of Spark's
#: advisory size would hold millions of them.
LINES_PER_TASK = 500_000


@register("dedup_reingested")
def dedup_reingested(spark: SparkSession, d: str) -> DataFrame:
    """Lines and their re-ingested form (returned lines, a later run) in one union,
    the later run wins.  Lines meet by their key once, in as many tasks as their number needs."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    n_tasks = lines.count() // LINES_PER_TASK + 1
    li = lines.repartition(n_tasks, "l_orderkey", "l_linenumber").distinct()
    again = li.where(F.col("l_returnflag") == "R").withColumn("l_quantity", -F.col("l_quantity"))
    both = silver_op.union_reingested(li.withColumn("run", F.lit(1)), again.withColumn("run", F.lit(2)))
    return silver_op.dedup_latest(both, ["l_orderkey", "l_linenumber"], ["run", "l_quantity", "l_returnflag"])


@register("gold_rewrite")
def gold_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Yearly order totals per customer written as Gold, one year written again."""
    o = load(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("symbol"),
                                         F.col("o_orderdate").alias("ts")).agg(F.count("*").alias("n_orders"))
    path = shared_dir(spark, "gold")
    silver_sink.write_gold(o.withColumn("run", F.lit(1)), path, "ts")
    silver_sink.write_gold(o.where(F.year("ts") == GOLD_RERUN_YEAR).withColumn("run", F.lit(2)), path, "ts")
    return spark.read.parquet(path).select("symbol", "ts", "n_orders", "run")


# ---------------------------------------------------------------- streaming

STREAM_DELAY = "1 hour"


@register("stream_ingest")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events through a file stream, classified, landed per trigger."""
    streaming.use_rocksdb(spark)
    src = streaming.table_stream(spark, d, "events")
    resp = R.responses_from_events(src).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    root = shared_dir(spark, "stream-ingest")
    streaming.land_stream(resp, lambda b: classify_op.classify(b, classify_op.INTRADAY, diagnostics=False),
                          root)
    cols = ["response_id", "error_class", "ok", "error"]
    return (spark.read.parquet(f"{root}/bronze").select(*cols)
            .unionByName(spark.read.parquet(f"{root}/rejects").select(*cols)))


@register("stream_dedup")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The event file replayed by two sources; each event kept once."""
    streaming.use_rocksdb(spark)
    a = streaming.event_time(streaming.table_stream(spark, d, "events"))
    b = streaming.event_time(streaming.table_stream(spark, d, "events"))
    out = streaming.dedup_stream(a.unionByName(b), ["event_id"], delay=STREAM_DELAY)
    root = streaming.run_available_now(out.drop("event_ts"), "dedup")
    return spark.read.parquet(f"{root}/out").select("event_id", "user_id", "ts", "value")


@register("stream_ohlcv")
def stream_ohlcv(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars per symbol, closed windows only (append mode)."""
    streaming.use_rocksdb(spark)
    src = streaming.event_time(streaming.table_stream(spark, d, "events"))
    bars = src.select("event_id", F.col("user_id").alias("symbol"), "event_ts", F.col("value").alias("price"),
                      F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"))
    agg = streaming.bars_stream(bars, "1 day", delay=STREAM_DELAY, tiebreak="event_id")
    out = agg.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     "open", "high", "low", "close", "volume", "n_trades")
    root = streaming.run_available_now(out, "ohlcv")
    return spark.read.parquet(f"{root}/out")


# ------------------------------------------------------------ more planner

# The planner event of the registered plan document.
PLAN_EVENT_TIME = "2025-12-17T10:00:00Z"
DIM_URI = "s3://example-bucket/meta/dim_symbol/v1/dim_symbol.csv"


@register("plan_document")
def plan_document(spark: SparkSession, d: str) -> DataFrame:
    """The plan, one row per batch with the worker event as JSON."""
    part = load(spark, d, "part").select(F.col("p_name").alias("symbol"), "p_partkey")
    params = planner.plan_parameters(spark, PLAN_EVENT_TIME)
    batches = planner.plan_batches(part, ["p_partkey"], R.BATCH_SIZE)
    return planner.plan_document(batches, params, part.count(), DIM_URI)


@register("batch_tasks")
def batch_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Batches of the customer dimension expanded to tasks in one job."""
    dim = R.dimension(spark, d)
    batches = planner.plan_batches(dim.select("symbol", "c_custkey"), ["c_custkey"], R.BATCH_SIZE)
    return planner.batch_tasks(dim, batches, *R.TASK_WINDOW, as_of=R.TASK_AS_OF).select(
        "batch_id", "symbol", "month")


@register("plan_summary")
def plan_summary(spark: SparkSession, d: str) -> DataFrame:
    """Symbols total / skipped / processed and planned requests."""
    return planner.plan_counts(R.dimension(spark, d), *R.TASK_WINDOW, as_of=R.TASK_AS_OF)


@register("ohlcv_rollup")
def ohlcv_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars built from hourly bars (must equal daily from base)."""
    return gold.rollup_bars(gold.ohlcv(R.bars(spark, d), "hour", tiebreak="event_id"), "day")


SESSION_GAP = "30 minutes"
SESSION_GAP_SECONDS = 1800


@register("ohlcv_sessions")
def ohlcv_sessions(spark: SparkSession, d: str) -> DataFrame:
    """X4 (batch form of session windows): bars per 30-minute activity session,
    numbered exactly over row-balanced buckets."""
    return intraday.in_row_buckets(R.bars(spark, d), lambda b, bucket: intraday.session_bars(
        b, SESSION_GAP_SECONDS, "symbol", "ts", "price", "volume", bucket, "event_id"))


def _late():
    """Events that are first delivered with a provisional price, and then again."""
    return F.dayofmonth("ts") > 15


def _broken(events):
    """Bars that are delivered once more with an invalid price."""
    return events.where(F.col("event_id") % 50 == 0) \
        .withColumn("value", (-F.abs("value") - 1).cast(events.schema["value"].dataType))


def _first_delivery(spark, d, events):
    value = F.when(_late(), F.col("value") + 1).otherwise(F.col("value"))
    return streaming.table_stream(spark, d, "events").withColumn("value", value.cast(events.schema["value"].dataType))


def _silver_columns(df):
    return df.select("event_id", "symbol", "ts", *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                     "volume", "trade_date", "month")


@register("stream_silver")
def stream_silver(spark: SparkSession, d: str) -> DataFrame:
    """Stream -> Bronze per batch -> recompute the touched Silver months.

    The first run delivers all events, those of a month's second half with a
    provisional price.  The second run delivers that half again, as it is, and
    repeats some bars with an invalid price.  Silver holds each bar once."""
    streaming.use_rocksdb(spark)
    root, again = shared_dir(spark, "stream-silver"), shared_dir(spark, "stream-silver-again")
    events = load(spark, d, "events")
    events.limit(0).write.parquet(again)

    def deliveries():
        return _first_delivery(spark, d, events).unionByName(spark.readStream.schema(events.schema).parquet(again))

    def to_docs(b):
        return R.docs_from_events(b).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))

    def to_silver(landed):
        return silver_op.normalize_bars(landed, keep=["event_id", "batch_id"]).withColumn(
            "ts", F.col("ts").cast("timestamp_ntz"))

    streaming.recompute_stream(deliveries(), root, to_docs, to_silver, period="month")
    events.where(_late()).unionByName(_broken(events)).write.mode("append").parquet(again)
    streaming.recompute_stream(deliveries(), root, to_docs, to_silver, period="month")
    return _silver_columns(spark.read.parquet(f"{root}/silver"))


@register("stream_upsert")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """X2 with keyed state: three overlapping deliveries, the newest valid version of each bar
    upserted into Silver; equal to the recomputed form."""
    streaming.use_rocksdb(spark)
    root, again = shared_dir(spark, "stream-upsert"), shared_dir(spark, "stream-upsert-again")
    events = load(spark, d, "events")
    later = events.withColumn("version", F.lit(2))
    later.limit(0).write.parquet(again)

    def bars():
        raw = _first_delivery(spark, d, events).withColumn("version", F.lit(1)) \
            .unionByName(spark.readStream.schema(later.schema).parquet(again))
        docs = R.docs_from_events(raw, keep=["version"])
        valid, _ = silver_op.split_valid(silver_op.validate_bars(
            silver_op.normalize_bars(docs, keep=["event_id", "version"]), day="trade_date"))
        return valid.withColumnRenamed("ts", "event_ts").drop("year")

    upsert.upsert_stream(bars(), root, "version")
    for version, rows in ((2, events.where(_late())), (3, _broken(events))):
        rows.withColumn("version", F.lit(version)).write.mode("append").parquet(again)
        upsert.upsert_stream(bars(), root, "version")
    out = spark.read.parquet(f"{root}/silver")
    return _silver_columns(out.withColumn("ts", F.col("event_ts").cast("timestamp_ntz")))


@register("stream_summary")
def stream_summary(spark: SparkSession, d: str) -> DataFrame:
    """S11 live: the summary of a streaming ingest from its observed metrics."""
    streaming.use_rocksdb(spark)
    responses = R.responses_from_events(streaming.table_stream(spark, d, "events"))
    root = shared_dir(spark, "stream-summary")
    live.land_observed(classify_op.classify(responses, classify_op.INTRADAY, diagnostics=False), root)
    return live.live_summary(spark, root)


#: A target that no file system serves.
UNREACHABLE = "nosuch://bucket/bronze"


@register("stream_save_log")
def stream_save_log(spark: SparkSession, d: str) -> DataFrame:
    """S4 as a streaming sink: the log while one of two targets can't be reached, and after
    what it missed has been written to it alone; with the rows that each target holds."""
    streaming.use_rocksdb(spark)
    root = shared_dir(spark, "stream-save")
    docs = R.docs_from_events(streaming.table_stream(spark, d, "events")) \
        .withColumn("day", F.date_format("ts", "yyyy-MM-dd")).drop("ts")
    targets = {"local": f"{root}/local", "s3": UNREACHABLE}

    def state(phase, targets):
        held = None
        for name, path in targets.items():
            if path != UNREACHABLE:
                rows = bronze.read_bronze(spark, path).select(F.lit(name).alias("target"))
                held = rows if held is None else held.unionByName(rows)
        counts = held.groupBy("target").agg(F.count(F.lit(1)).alias("n_rows"))
        log = sink.save_log(spark, root).groupBy("target").agg(F.bool_and("ok").alias("ok"))
        return spark.createDataFrame(log.join(counts, "target", "left").select(  # two rows
            F.lit(phase).alias("phase"), "target", "ok", F.coalesce("n_rows", F.lit(0)).alias("n_rows")).collect(),
            "phase string, target string, ok boolean, n_rows bigint")

    sink.save_stream(docs, targets, root)
    before = state("run", targets)
    targets["s3"] = f"{root}/s3"
    sink.retry_failed(spark, targets, root)
    return before.unionByName(state("retry", targets))


@register("bronze_status_failed")
def bronze_status_failed(spark: SparkSession, d: str) -> DataFrame:
    """S4, the failing branch: one of two targets can't be reached; every key's status says
    so, and the other target holds its documents."""
    docs = R.event_docs(spark, d).select("event_id", "body", F.col("event_type").alias("symbol"),
                                         F.date_format("ts", "yyyy-MM-dd").alias("day"))
    local = f"{shared_dir(spark, 'bronze-status-failed')}/local"
    out = bronze.save_bronze(docs, {"local": local, "s3": UNREACHABLE}, ("symbol", "day"))
    held = bronze.read_bronze(spark, local).groupBy("symbol", "day").agg(F.count("*").alias("n_local"))
    return out.join(held, ["symbol", "day"], "left").select(
        "symbol", "day", "ok", F.substring_index("error", ":", 1).alias("error"), F.col("local_uri").isNotNull().alias("in_local"),
        F.col("s3_uri").isNotNull().alias("in_s3"), "n_local")


@register("stream_sessions")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """X4 (session form): activity-session bars, emitted once a session closes."""
    streaming.use_rocksdb(spark)
    src = streaming.event_time(streaming.table_stream(spark, d, "events"))
    bars = src.select("event_id", F.col("user_id").alias("symbol"), "event_ts", F.col("value").alias("price"),
                      F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"))
    agg = streaming.bars_stream(bars, session_gap=SESSION_GAP, delay=STREAM_DELAY, tiebreak="event_id")
    out = agg.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("session_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("session_end"),
                     "open", "high", "low", "close", "volume", "n_trades")
    root = streaming.run_available_now(out, "sessions")
    return spark.read.parquet(f"{root}/out")


# ------------------------------------------------------------------- worker

def _worker_run(spark, d):
    return worker.ingest_run(R.dimension(spark, d), R.order_attempts(spark, d), *R.TASK_WINDOW,
                             as_of=R.TASK_AS_OF)


@register("worker_tasks")
def worker_tasks(spark: SparkSession, d: str) -> DataFrame:
    """O4 + G9 + P10: every planned task with the outcome of its last attempt."""
    return _worker_run(spark, d).tasks


@register("worker_summary")
def worker_summary(spark: SparkSession, d: str) -> DataFrame:
    """S11 of a whole worker run: plan totals and request outcomes."""
    return _worker_run(spark, d).summary


# ---------------------------------------------------------------- intraday

ROLL_BARS = 5
SPAN_SECONDS = 3600


def _trades(spark, d):
    return R.bars(spark, d).select("event_id", "symbol", "ts", "price")


@register("rolling_intraday")
def rolling_intraday(spark: SparkSession, d: str) -> DataFrame:
    """W2 over raw bars: last 5 bars per symbol, in row-balanced buckets."""
    return intraday.in_row_buckets(_trades(spark, d), lambda b, bucket: intraday.rolling_rows(
        b, ROLL_BARS, "symbol", "ts", "price", bucket, "event_id"))


@register("span_intraday")
def span_intraday(spark: SparkSession, d: str) -> DataFrame:
    """W3 over raw bars: mean of the last hour per symbol, (symbol, day) partitions."""
    return intraday.rolling_span(_trades(spark, d), SPAN_SECONDS, "symbol", "ts", "price", 86400)


@register("returns_intraday")
def returns_intraday(spark: SparkSession, d: str) -> DataFrame:
    """W1 over raw bars, row-balanced buckets with a one-bar halo."""
    return intraday.in_row_buckets(_trades(spark, d), lambda b, bucket: intraday.returns(
        b, "symbol", "ts", "price", bucket, "event_id"))


@register("drawdown_intraday")
def drawdown_intraday(spark: SparkSession, d: str) -> DataFrame:
    """W4 over raw bars: running peak by a two-level scan over row-balanced buckets."""
    return intraday.in_row_buckets(_trades(spark, d), lambda b, bucket: intraday.drawdown(
        b, "symbol", "ts", "price", bucket, "event_id"))


@register("zscore_intraday")
def zscore_intraday(spark: SparkSession, d: str) -> DataFrame:
    """W5 over raw bars: z-score to the last 5 bars, in row-balanced buckets."""
    return intraday.in_row_buckets(_trades(spark, d), lambda b, bucket: intraday.zscore(
        b, ROLL_BARS, "symbol", "ts", "price", bucket, "event_id"))


@register("vol_regime_intraday")
def vol_regime_intraday(spark: SparkSession, d: str) -> DataFrame:
    """W7 over raw bars: 3-bar against 10-bar volatility of bar returns."""
    return intraday.in_row_buckets(_trades(spark, d), lambda b, bucket: intraday.vol_regime(
        b, 3, 10, "symbol", "ts", "price", bucket, "event_id"))


@register("stream_sliding")
def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    """X4 (sliding form): 1-day bars sliding every 12 hours, closed windows only."""
    streaming.use_rocksdb(spark)
    src = streaming.event_time(streaming.table_stream(spark, d, "events"))
    bars = src.select("event_id", F.col("user_id").alias("symbol"), "event_ts", F.col("value").alias("price"),
                      F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"))
    agg = streaming.bars_stream(bars, "1 day", "12 hours", delay=STREAM_DELAY, tiebreak="event_id")
    out = agg.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     "open", "high", "low", "close", "volume", "n_trades")
    root = streaming.run_available_now(out, "sliding")
    return spark.read.parquet(f"{root}/out")


@register("duplicate_symbols")
def duplicate_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Q7: repeated symbols of a dimension (part names repeat)."""
    part = load(spark, d, "part").select(F.col("p_name").alias("symbol"))
    return planner.duplicate_symbols(part)


@register("landed_raw_bars")
def landed_raw_bars(spark: SparkSession, d: str) -> DataFrame:
    """S7/S12 through files: the latest document per (symbol, day) key lands as
    one raw JSON file (overwrite semantics), is read back whole and normalised."""
    docs = (R.event_docs(spark, d)
            .select(F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
                    "event_id", "body"))
    latest = silver_op.dedup_latest(docs, ["symbol", "day"], ["event_id"])
    path = shared_dir(spark, "landed-raw")
    landing.land_raw(latest, path, ("symbol", "day"))
    bars = silver_op.normalize_bars(landing.read_landed(spark, path), keep=["day"])
    return bars.select("symbol", "day", F.col("ts").cast("timestamp_ntz").alias("ts"),
                       F.col("close").cast("double").alias("close"), "volume")
