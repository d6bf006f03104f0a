"""The given tables recast into the model's inputs.

The test tables hold no market data, so columns are mapped:

* dimension  — ``customer`` (symbol = ``c_name``) with ``start_date`` = first
  order month (``NA`` when the customer has no order);
* bars       — ``events`` (symbol = ``user_id``, price = ``value``, volume =
  ``k`` of ``props``);
* landed     — (customer, month) pairs with orders;
* requests / attempts — ``events`` (a logical request or HTTP attempt per
  event, pair = user x day, sequence = ``event_id``, ``event_type = 'error'``
  fails); for the worker run, ``orders`` as attempts per (customer, month);
* responses  — ``events`` shaped to reach every branch of the acceptance chain,
  plus ``pages`` (HTML bodies under a JSON content type);
* monthly payloads — each customer's orders packed by month into a dated series;
* documents  — one vendor-shaped intraday document per event;
* bars for validation — ``lineitem`` (unit price, tax and discount shape the
  prices so that every rule fires somewhere);
* duplicates — ``lineitem`` keyed by (``l_orderkey``, ``l_linenumber``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import months as M
from tidemark.sources.tables import load

# The parameters of the registered planning queries.
TASK_WINDOW = ("1997-01", "1998-12")
TASK_AS_OF = "1998-06-15"
BATCH_SIZE = 50
SUBSET_LIMIT = 100


def dimension(spark: SparkSession, data_dir: str) -> DataFrame:
    """``symbol, start_date`` (+ segment, nation) from customer and orders."""
    customer = load(spark, data_dir, "customer")
    first = (load(spark, data_dir, "orders")
             .groupBy("o_custkey").agg(F.min("o_orderdate").alias("_first")))
    return (customer.join(first, customer.c_custkey == first.o_custkey, "left")
            .select(F.col("c_custkey"),
                    F.col("c_name").alias("symbol"),
                    F.coalesce(M.month_key("_first"), F.lit("NA")).alias("start_date"),
                    F.col("c_mktsegment").alias("category"),
                    F.col("c_nationkey")))


def landed_months(spark: SparkSession, data_dir: str) -> DataFrame:
    """Distinct (symbol, month) present, one per customer-month with orders."""
    customer = load(spark, data_dir, "customer").select("c_custkey", "c_name")
    om = (load(spark, data_dir, "orders")
          .select("o_custkey", M.month_key("o_orderdate").alias("month"))
          .distinct())
    return (om.join(customer, om.o_custkey == customer.c_custkey)
            .select(F.col("c_name").alias("symbol"), "month"))


def responses_from_events(e: DataFrame) -> DataFrame:
    """One landed response per event, covering every class of the chain."""
    et, eid, uid = F.col("event_type"), F.col("event_id"), F.col("user_id").cast("string")
    status = (F.when(et == "error",
                     F.when(eid % 3 == 0, F.lit(None)).when(eid % 3 == 1, F.lit(503)).otherwise(F.lit(404)))
              .otherwise(F.lit(200))).cast("int")
    ctype = (F.when((et == "view") & (eid % 5 == 0), F.lit("text/html; charset=utf-8"))
             .when(eid % 2 == 0, F.lit("Application/JSON; charset=utf-8"))
             .otherwise(F.lit("application/json")))
    body = (F.when(et == "signup", F.concat(F.lit('{"Note": "Thank you for using the API, '), uid, F.lit('"}')))
            .when((et == "purchase") & (eid % 4 == 0),
                  F.concat(F.lit('{"Note": "n'), uid, F.lit('", "Error Message": "e'), uid, F.lit('"}')))
            .when(et == "purchase", F.concat(F.lit('{"Error Message": "Invalid API call '), uid, F.lit('"}')))
            .when((et == "view") & (eid % 7 == 0), F.concat(F.lit("["), uid, F.lit("]")))
            .when((et == "click") & (eid % 11 == 0), F.lit('{"Note": null}'))
            .otherwise(F.col("props")))
    return e.select(F.lit("events").alias("source"), eid.alias("response_id"),
                    status.alias("status_code"), ctype.alias("content_type"), body.alias("body"),
                    F.col("ts"))


def responses(spark: SparkSession, data_dir: str) -> DataFrame:
    """Landed vendor responses: one per event and one per page (HTML bodies
    under a JSON content type)."""
    from_events = responses_from_events(load(spark, data_dir, "events")).drop("ts")
    from_pages = load(spark, data_dir, "pages").select(
        F.lit("pages").alias("source"), F.col("page_id").alias("response_id"),
        F.lit(200).alias("status_code"), F.lit("application/json").alias("content_type"),
        F.col("html").alias("body"))
    return from_events.unionByName(from_pages)


def attempts(spark: SparkSession, data_dir: str) -> DataFrame:
    """HTTP attempts: pair = (user, day), sequence = event id."""
    e = load(spark, data_dir, "events")
    status = (F.when(F.col("event_type") == "error",
                     F.when(F.col("event_id") % 2 == 0, F.lit(503)).otherwise(F.lit(404)))
              .otherwise(F.lit(200))).cast("int")
    return e.select("user_id", F.to_date("ts").alias("day"), F.col("event_id").alias("attempt_seq"),
                    status.alias("status_code"))


def requests(spark: SparkSession, data_dir: str) -> DataFrame:
    """Logical requests: one per event, failed when ``event_type = 'error'``."""
    e = load(spark, data_dir, "events")
    return e.select(F.col("user_id").alias("symbol"), F.to_date("ts").alias("day"),
                    F.col("event_id").alias("seq"), F.col("ts"),
                    (F.col("event_type") != "error").alias("ok"))


def monthly_responses(spark: SparkSession, data_dir: str) -> DataFrame:
    """Monthly-adjusted payloads per customer: a dated series of month-end
    keys from its orders (pre-aggregated per month, so a document holds one
    entry per month); customers without orders get an empty series or an
    error payload."""
    per_month = (load(spark, data_dir, "orders")
                 .groupBy("o_custkey", F.last_day("o_orderdate").alias("_d"))
                 .agg(F.round(F.sum("o_totalprice"), 2).alias("close")))
    series_key = "Monthly Adjusted Time Series"
    docs = (per_month.groupBy("o_custkey")
            .agg(F.map_from_entries(F.collect_list(F.struct(
                F.date_format("_d", "yyyy-MM-dd"), F.struct(F.col("close").alias("4. close")))))
                .alias("_series"))
            .select("o_custkey", F.to_json(F.struct(F.col("_series").alias(series_key))).alias("_doc")))
    customer = load(spark, data_dir, "customer").select("c_custkey", "c_name")
    missing = F.when(F.col("c_custkey") % 2 == 0,
                     F.concat(F.lit('{"Error Message": "Invalid API call for C'),
                              F.col("c_custkey").cast("string"), F.lit('"}'))) \
        .otherwise(F.lit('{"' + series_key + '": {}}'))
    return (customer.join(docs, customer.c_custkey == docs.o_custkey, "left")
            .select(F.col("c_name").alias("symbol"), F.lit(200).alias("status_code"),
                    F.lit("application/json").alias("content_type"),
                    F.coalesce(F.col("_doc"), missing).alias("body")))


def event_docs(spark: SparkSession, data_dir: str) -> DataFrame:
    """One vendor-shaped intraday document per event (price = value, volume =
    ``k`` of ``props``): documents are never packed, so none grows with a hot
    symbol."""
    return docs_from_events(load(spark, data_dir, "events"))


def docs_from_events(e: DataFrame, keep=()) -> DataFrame:
    from tidemark.operators.silver import bar_document
    price = F.col("value")
    volume = F.get_json_object("props", "$.k").try_cast("bigint")
    return e.select(F.col("user_id").alias("symbol"), "event_id", "event_type", "ts", *keep,
                    bar_document(F.col("ts"), price, price, price, price, volume).alias("body"))


def lineitem_bars(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bars from line items, built so that every validation rule fires somewhere."""
    li = load(spark, data_dir, "lineitem")
    o = F.when(F.col("l_quantity") != 0, F.col("l_extendedprice") / F.col("l_quantity"))
    tax, disc = F.col("l_tax"), F.col("l_discount")
    part_month = F.when(F.col("l_linenumber") == 7, M.month_key(F.add_months("l_shipdate", 1))) \
        .otherwise(M.month_key("l_shipdate"))
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").alias("ts"),
        o.alias("open"),
        (o * (F.lit(1) + tax - disc / 2)).alias("high"),
        (o * (F.lit(1) - disc)).alias("low"),
        (o * (F.lit(1) + tax - disc * 2)).alias("close"),
        (F.col("l_quantity").cast("bigint") - 10).alias("volume"),
        part_month.alias("month"))


def bars(spark: SparkSession, data_dir: str) -> DataFrame:
    """Trades as bars: symbol = user, price = value, volume = ``k`` of ``props``."""
    e = load(spark, data_dir, "events")
    return e.select("event_id", F.col("user_id").alias("symbol"), "ts", "event_type",
                    F.col("value").alias("price"),
                    F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"))


def categories(spark: SparkSession, data_dir: str) -> DataFrame:
    """Symbol -> category (market segment) and nation, from customer."""
    return load(spark, data_dir, "customer").select(
        F.col("c_custkey").alias("symbol"), F.col("c_mktsegment").alias("category"),
        F.col("c_nationkey").alias("nation"))


def order_attempts(spark: SparkSession, data_dir: str) -> DataFrame:
    """HTTP attempts per (customer, month): one per order, sequence = order key;
    open orders got 503, pending ones a rate-limit note, the rest a series."""
    o = load(spark, data_dir, "orders")
    c = load(spark, data_dir, "customer").select("c_custkey", "c_name")
    st = F.col("o_orderstatus")
    body = F.when(st == "P", F.lit('{"Note": "rate limited"}')).otherwise(F.lit('{"Time Series (1min)": {}}'))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("c_name").alias("symbol"), M.month_key("o_orderdate").alias("month"),
                    F.col("o_orderkey").alias("attempt_seq"),
                    F.when(st == "O", F.lit(503)).otherwise(F.lit(200)).cast("int").alias("status_code"),
                    F.lit("application/json").alias("content_type"), body.alias("body"),
                    F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate"))
                    .alias("requested_at")))
