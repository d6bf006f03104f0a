"""Planner and task expansion.

* ``plan_window``   — request rows -> ingest / recompute / gold ranges + status
* ``plan_batches``  — dimension -> fixed-size batches in file order
* ``plan_tasks``    — dimension x window -> one row per (symbol, month)
* ``skip_reasons``  — why symbols produced no tasks, counted
* ``subset_limit``  — batch restriction (semi join) then the first n in order
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import months as M
from tidemark.operators.ordering import with_row_index

# Planner defaults.
DEFAULT_BATCH_SIZE = 50
DEFAULT_MONTHS_BACK = 2

SKIP_INVALID_START = "invalid_start_date"
SKIP_STARTS_AFTER_END = "starts_after_end"


def _lit_date(d: date | str | None) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, str):
        return F.to_date(F.lit(d))
    return F.lit(d)


# ---------------------------------------------------------------- plan_window

def plan_window(requests: DataFrame, time_col: str = "time", start_col: str = "year_month_start",
                end_col: str = "year_month_end", as_of: Column | None = None,
                months_back: int = DEFAULT_MONTHS_BACK) -> DataFrame:
    """Ranges of a plan for each request row.

    Adds ``ingest_start, ingest_end, glue_start, glue_end, gold_year_start,
    gold_year_end, planned_at_utc, status``.  ``status`` is ``ok`` or the
    reason the reference would refuse the request (``invalid_event_time``,
    ``invalid_format``, ``end_before_start``, ``not_covered``); outputs are NULL
    unless ``ok``.  One blank bound discards the other (Q6).
    """
    as_of = as_of if as_of is not None else F.current_timestamp()
    # Staged columns: each regex / parse runs once per row (Catalyst does not
    # collapse projections that would duplicate non-cheap expressions).
    staged = (requests
              .withColumn("_now", M.parse_event_time(time_col, as_of))
              .withColumn("_blank", M.c_is_blank(start_col) | M.c_is_blank(end_col))
              .withColumn("_s_given", M.month_start(start_col))
              .withColumn("_e_given", M.month_start(end_col)))
    cur = F.trunc(F.col("_now"), "MM")
    staged = (staged
              .withColumn("_start", F.when(F.col("_blank"), F.add_months(cur, -(months_back - 1)))
                          .otherwise(F.col("_s_given")))
              .withColumn("_end", F.when(F.col("_blank"), cur).otherwise(F.col("_e_given"))))
    start, end = F.col("_start"), F.col("_end")
    staged = staged.withColumn("_glue", F.make_date(F.year(end) - 1, F.lit(1), F.lit(1)))
    glue = F.col("_glue")
    # the recompute window ends at the ingest end, so only its start can fail
    covered = glue <= start
    staged = staged.withColumn(
        "status",
        F.when(F.col("_now").isNull(), F.lit("invalid_event_time"))
        .when(start.isNull() | end.isNull(), F.lit("invalid_format"))
        .when(end < start, F.lit("end_before_start"))
        .when(~covered, F.lit("not_covered"))
        .otherwise(F.lit("ok")))
    ok = F.col("status") == "ok"
    return (staged
            .withColumn("ingest_start", F.when(ok, M.month_key(start)))
            .withColumn("ingest_end", F.when(ok, M.month_key(end)))
            .withColumn("glue_start", F.when(ok, M.month_key(glue)))
            .withColumn("glue_end", F.when(ok, M.month_key(end)))
            .withColumn("gold_year_start", F.when(ok, F.date_format(glue, "yyyy")))
            .withColumn("gold_year_end", F.when(ok, F.date_format(end, "yyyy")))
            .withColumn("planned_at_utc", F.when(ok, M.utc_stamp("_now")))
            .drop("_now", "_blank", "_s_given", "_e_given", "_start", "_end", "_glue"))


# --------------------------------------------------------------- plan_batches

def plan_batches(dim: DataFrame, order_by: Sequence[str], batch_size: int = DEFAULT_BATCH_SIZE,
                 symbol_col: str = "symbol") -> DataFrame:
    """Consecutive chunks of ``batch_size`` symbols, ids from 0, order kept.

    Returns ``batch_id, batch_size, n_symbols, first_symbol, last_symbol,
    symbols`` (array in order).  Each group holds at most ``batch_size`` rows.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    idx = with_row_index(dim.select(symbol_col, *[c for c in order_by if c != symbol_col]),
                         list(order_by), "_idx")
    return (idx.withColumn("batch_id", F.expr(f"_idx div {int(batch_size)}").cast("bigint"))
            .groupBy("batch_id")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_idx"), F.col(symbol_col).alias("s"))))
                 .alias("_items"))
            .select("batch_id",
                    F.lit(batch_size).alias("batch_size"),
                    F.size("_items").alias("n_symbols"),
                    F.col("_items")[0]["s"].alias("first_symbol"),
                    F.element_at("_items", -1)["s"].alias("last_symbol"),
                    F.transform("_items", lambda x: x["s"]).alias("symbols")))


# ----------------------------------------------------------------- plan_tasks

def annotate_symbols(dim: DataFrame, start: str | date, end: str | date, as_of=None,
                     symbol_col: str = "symbol", start_date_col: str = "start_date") -> DataFrame:
    """P6, P7, F7, F8 per symbol: ``first_month, eff_start, eff_end, skip_reason``."""
    if isinstance(start, str) or isinstance(end, str):
        start, end = M.require_window(str(start), str(end))
    clamp = F.least(F.lit(end), F.trunc(_lit_date(as_of), "MM"))
    first = F.col("first_month")
    skip = (F.when(first.isNull(), F.lit(SKIP_INVALID_START))
            .when(first > clamp, F.lit(SKIP_STARTS_AFTER_END)))
    return (dim.withColumn(symbol_col, M.strip(symbol_col))
            .withColumn("first_month", M.month_start(start_date_col))
            .withColumn("skip_reason", skip)
            .withColumn("eff_start", F.greatest(F.lit(start), F.col("first_month")))
            .withColumn("eff_end", clamp))


def plan_tasks(dim: DataFrame, start: str | date, end: str | date, as_of=None,
               symbol_col: str = "symbol", start_date_col: str = "start_date",
               keep: Sequence[str] = ()) -> DataFrame:
    """One row ``(symbol, month)`` per month in ``[eff_start, eff_end]``.

    The bounded range join is a per-row generator: no shuffle, no cross join.
    A symbol whose effective start lies after the clamp gets no task but is
    not skipped (Q8).
    """
    ann = annotate_symbols(dim, start, end, as_of, symbol_col, start_date_col)
    return (ann.where(F.col("skip_reason").isNull())
            .select(symbol_col, *keep,
                    F.explode(M.month_spine("eff_start", "eff_end")).alias("month_start"))
            .select(symbol_col, *keep, M.month_key("month_start").alias("month"), "month_start"))


def skip_reasons(dim: DataFrame, start, end, as_of=None, symbol_col: str = "symbol",
                 start_date_col: str = "start_date") -> DataFrame:
    """Symbols per outcome (``processed`` or the skip reason)."""
    ann = annotate_symbols(dim, start, end, as_of, symbol_col, start_date_col)
    return (ann.groupBy(F.coalesce("skip_reason", F.lit("processed")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_symbols")))


def plan_counts(dim: DataFrame, start, end, as_of=None, symbol_col: str = "symbol",
                start_date_col: str = "start_date") -> DataFrame:
    """One row: total / skipped / processed symbols and planned requests."""
    ann = annotate_symbols(dim, start, end, as_of, symbol_col, start_date_col)
    n_months = F.when(F.col("skip_reason").isNull() & (F.col("eff_start") <= F.col("eff_end")),
                      F.months_between("eff_end", "eff_start").cast("int") + 1).otherwise(0)
    return ann.agg(F.count(F.lit(1)).alias("total_symbols"),
                   F.count_if(F.col("skip_reason").isNotNull()).alias("skipped_symbols"),
                   F.count_if(F.col("skip_reason").isNull()).alias("processed_symbols"),
                   F.sum(n_months).cast("bigint").alias("total_requests"))


# --------------------------------------------------------------- subset_limit

def subset_limit(dim: DataFrame, subset: DataFrame | None, order_by: Sequence[str],
                 limit: int | None = None, key: str = "symbol") -> DataFrame:
    """P5/J1 then T1: keep the batch's symbols, then the first ``limit`` in order.

    The subset is applied first (left-semi join; AQE broadcasts it when its
    measured size is small), the limit after it, as in the reference.
    """
    out = dim if subset is None else dim.join(subset.select(key).distinct(), key, "left_semi")
    if limit is not None:
        if limit < 0:
            raise ValueError("limit must be >= 0")
        out = out.orderBy(*order_by).limit(limit)
    return out


# ------------------------------------------------------- plan document / J4

def plan_parameters(spark, time: str | None = None, year_month_start: str | None = None,
                    year_month_end: str | None = None, as_of=None,
                    months_back: int = DEFAULT_MONTHS_BACK) -> dict:
    """The ranges of one planner event (a job parameter, one row).

    Raises ``ValueError`` where the reference raises; returns the window
    fields of the plan document otherwise.
    """
    req = spark.createDataFrame([(time, year_month_start, year_month_end)],
                                "time string, year_month_start string, year_month_end string")
    as_of_col = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of
    r = plan_window(req, as_of=as_of_col, months_back=months_back).first()
    if r.status != "ok":
        raise ValueError(f"planner event refused: {r.status}")
    return {"glue_year_month_start": r.glue_start, "glue_year_month_end": r.glue_end,
            "gold_year_start": r.gold_year_start, "gold_year_end": r.gold_year_end,
            "ingest_year_month_start": r.ingest_start, "ingest_year_month_end": r.ingest_end,
            "planned_at_utc": r.planned_at_utc}


def plan_document(batches: DataFrame, params: dict, total_symbols: int, symbols_uri: str) -> DataFrame:
    """S10 in normalised form: one row per batch carrying the plan fields and
    the worker event of the batch as JSON text (no global collect)."""
    event = F.to_json(F.struct(
        F.col("batch_id"), F.col("symbols").alias("symbols_subset"),
        F.lit(symbols_uri).alias("symbols_s3_uri"),
        F.lit(params["ingest_year_month_start"]).alias("year_month_start"),
        F.lit(params["ingest_year_month_end"]).alias("year_month_end")))
    return batches.select("batch_id", F.col("n_symbols").cast("bigint").alias("n_symbols"),
                          event.alias("event_json"),
                          F.lit(total_symbols).cast("bigint").alias("total_symbols"),
                          *[F.lit(v).alias(k) for k, v in params.items()])


def batch_tasks(dim: DataFrame, batches: DataFrame, start, end, as_of=None, symbol_col: str = "symbol",
                start_date_col: str = "start_date") -> DataFrame:
    """Every batch's symbols expanded to tasks in one job (instead of one
    worker per batch re-reading the dimension).  A symbol repeated in the
    dimension yields its tasks once per row (Q7)."""
    members = batches.select("batch_id", F.explode("symbols").alias(symbol_col)).distinct()
    joined = dim.join(members, symbol_col)
    return plan_tasks(joined, start, end, as_of, symbol_col, start_date_col, keep=["batch_id"])


def duplicate_symbols(dim: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """Q7 report: symbols listed more than once (after stripping) with their
    count; they are kept in planning (each row plans its tasks) and the last
    outcome of a pair wins in accounting."""
    return (dim.groupBy(M.strip(symbol_col).alias(symbol_col))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))
