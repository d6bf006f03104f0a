"""Job entry points taking the reference's event shapes.

* ``plan_job(spark, event)`` — planner event ``{symbols_s3_uri, batch_size=50,
  time?, year_month_start?, year_month_end?}`` -> the plan document, one row per
  batch (S10); raises ``ValueError`` where the planner refuses the event.
* ``worker_job(spark, event, attempts)`` — worker event ``{symbols_s3_uri,
  year_month_start, year_month_end, symbols_subset?, limit?}`` plus the landed
  attempts -> per-task status, Bronze landing and the run summary.
* ``search_job`` / ``monthly_job`` — symbol-search and monthly-adjusted
  responses classified, snapshots appended, earliest month per symbol.

The dimension URI is read with Spark's file systems (``s3a://``, ``hdfs://``,
local paths); file order is kept as (file path, position within the file).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import months as M
from tidemark.operators import planner
from tidemark.operators.classify import DOCUMENT, MONTHLY, SEARCH, classify
from tidemark.operators.earliest import earliest_columns
from tidemark.operators.worker import RunResult, ingest_run
from tidemark.sources.bronze import append_snapshots
from tidemark.sources.dimension import check_required, read_dimension_text, typed_dimension

ORDER = ["_file", "_pos"]


def _dimension_in_file_order(spark: SparkSession, uri: str) -> DataFrame:
    """The dimension with a file-order key; ids are taken right at the scan,
    where split order follows file offsets."""
    raw = read_dimension_text(spark, uri)
    return typed_dimension(raw.withColumn("_file", F.col("_metadata.file_path"))
                           .withColumn("_pos", F.monotonically_increasing_id()))


def plan_job(spark: SparkSession, event: Mapping, as_of=None) -> DataFrame:
    uri = event["symbols_s3_uri"]
    batch_size = int(event.get("batch_size", planner.DEFAULT_BATCH_SIZE))
    params = planner.plan_parameters(spark, event.get("time"), event.get("year_month_start"),
                                     event.get("year_month_end"), as_of=as_of)
    dim = _dimension_in_file_order(spark, uri)
    batches = planner.plan_batches(dim.select("symbol", *ORDER), ORDER, batch_size)
    return planner.plan_document(batches, params, dim.count(), uri)


def worker_job(spark: SparkSession, event: Mapping, attempts: DataFrame, bronze_path: str | None = None,
               as_of=None) -> RunResult:
    start, end = event["year_month_start"], event["year_month_end"]
    M.require_window(start, end)
    dim = _dimension_in_file_order(spark, event["symbols_s3_uri"])
    check_required(dim)
    subset = event.get("symbols_subset")
    subset_df = None
    if subset is not None:
        # the batch's symbol list travels in the event: bounded by the batch size;
        # stripped like the dimension's symbols (Q3)
        subset_df = spark.createDataFrame([(str(s).strip(),) for s in subset], "symbol string")
    limit = event.get("limit")
    dim = planner.subset_limit(dim, subset_df, ORDER, None if limit is None else int(limit))
    return ingest_run(dim.drop(*ORDER), attempts, start, end, as_of, bronze_path)


def search_job(responses: DataFrame, snapshot_path: str | None = None) -> DataFrame:
    """Symbol-search responses ``(keywords, status_code, content_type, body,
    requested_at)``: classified (search chain); accepted payloads appended as
    snapshots under ``keywords=`` when a path is given (S5, S9)."""
    out = classify(responses, SEARCH)
    if snapshot_path:
        append_snapshots(out.where(F.col("ok")).select("keywords", "body", F.col("requested_at")
                                                       .alias("ingested_at")), snapshot_path, "keywords")
    return out


def monthly_job(responses: DataFrame, snapshot_path: str | None = None) -> DataFrame:
    """Monthly-adjusted responses ``(symbol, status_code, content_type, body,
    requested_at)``: classified (``Error Message`` before ``Note``); accepted
    payloads appended under ``symbol=`` (S6, S8) and the earliest month of each
    response (G6) alongside, computed on the same rows (no join)."""
    out = classify(responses, MONTHLY, keep_document=True)
    if snapshot_path:
        append_snapshots(out.where(F.col("ok")).select("symbol", "body", F.col("requested_at")
                                                       .alias("ingested_at")), snapshot_path, "symbol")
    month, _, error = earliest_columns()
    return out.withColumn("earliest_month", month).withColumn("earliest_error", error).drop(DOCUMENT)
