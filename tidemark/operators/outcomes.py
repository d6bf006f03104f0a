"""Attempt and outcome accounting.

Logical requests are rows with a pair key (symbol, month), a sequence that
orders them, and an ``ok`` flag.  The reference keeps a set of failed pairs:
a failure adds the pair, a later success removes it — so the pair's *last*
outcome decides.  That is ``max_by(ok, seq)`` per pair: a partial aggregate,
so a hot pair collapses map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payloads as P

MAX_ATTEMPTS = 4  # one try and three retries


def retry_outcome(attempts: DataFrame, keys: Sequence[str], seq: str = "attempt_seq",
                  status: str = "status_code") -> DataFrame:
    """Per logical request, the response that stands and the try count."""
    s = F.col(status)
    agg = (attempts.groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("n_attempts"),
                F.max_by(s, F.col(seq)).alias("final_status"),
                F.count_if(P.is_retriable(s)).alias("n_retriable")))
    fs = F.col("final_status")
    return (agg.withColumn("final_ok", F.coalesce(P.is_success_status(fs), F.lit(False)))
            .withColumn("over_budget", F.col("n_attempts") > MAX_ATTEMPTS)
            .withColumn("stopped_early",
                        P.is_retriable(fs) & (F.col("n_attempts") < MAX_ATTEMPTS)))


def last_outcome(requests: DataFrame, keys: Sequence[str], seq: str, ok: str = "ok",
                 ts: str | None = None, ts_end: str | None = None) -> DataFrame:
    """Per pair, the counts and whether the last request failed."""
    o = F.col(ok)
    aggs = [F.count(F.lit(1)).alias("n_requests"),
            F.count_if(o).alias("n_ok"),
            F.count_if(~o).alias("n_error"),
            F.max_by(o, F.col(seq)).alias("last_ok"),
            F.max(F.col(seq)).alias("last_seq")]
    if ts:
        aggs += [F.min(ts).alias("first_ts"), F.max(ts_end or ts).alias("last_ts")]
    return requests.groupBy(*keys).agg(*aggs)


def unresolved_pairs(requests: DataFrame, keys: Sequence[str], seq: str, ok: str = "ok") -> DataFrame:
    """Pairs whose last outcome is an error (a failure after success counts)."""
    return (last_outcome(requests, keys, seq, ok)
            .where(~F.col("last_ok"))
            .select(*keys, "n_error", "last_seq"))


def error_symbols(requests: DataFrame, symbol: str = "symbol", ok: str = "ok") -> DataFrame:
    """Distinct symbols with any failed request, sorted (a table, not
    an array: the list grows with the dimension)."""
    return (requests.where(~F.col(ok)).select(symbol).distinct().orderBy(symbol))


def run_summary(requests: DataFrame, pair_keys: Sequence[str], seq: str, ok: str = "ok",
                ts: str = "ts", symbol: str = "symbol", total_symbols: DataFrame | None = None,
                ts_end: str | None = None) -> DataFrame:
    """One-row run summary from the per-pair table (one pass, partial aggs).

    ``duration_seconds`` is the span between the first and the last request;
    ``requests_per_minute`` is 0 when that span is 0 (P16).  Top-level ``ok`` is
    always true as in the reference (Q9); ``failed_fraction`` is added.
    ``total_symbols`` may be a one-row DataFrame ``(total_symbols, skipped_symbols)``
    from the plan; otherwise symbols seen in the requests count.  ``ts_end``
    names a column with the end of each request when it differs from ``ts``.
    """
    pairs = last_outcome(requests, pair_keys, seq, ok, ts, ts_end)
    s = (pairs.agg(F.count_distinct(symbol).alias("seen_symbols"),
                   F.sum("n_requests").alias("total_requests"),
                   F.sum("n_ok").alias("success_requests"),
                   F.sum("n_error").alias("error_requests"),
                   F.count_if(~F.col("last_ok")).alias("unresolved_error_requests"),
                   F.count_distinct(F.when(F.col("n_error") > 0, F.col(symbol)))
                   .alias("n_symbols_with_errors"),
                   F.min("first_ts").alias("_t0"), F.max("last_ts").alias("_t1")))
    if total_symbols is not None:
        # two one-row tables merged by a union and one aggregate (no join)
        cols = s.columns + [c for c in total_symbols.columns if c not in s.columns]
        s = (s.unionByName(total_symbols, allowMissingColumns=True)
             .agg(*[F.max(c).alias(c) for c in cols]))
    else:
        s = (s.withColumn("total_symbols", F.col("seen_symbols"))
             .withColumn("skipped_symbols", F.lit(0).cast("bigint")))
    dur = ((F.unix_micros(F.col("_t1").cast("timestamp")) - F.unix_micros(F.col("_t0").cast("timestamp")))
           / F.lit(1e6))
    return (s.withColumn("duration_seconds", F.coalesce(dur, F.lit(0.0)))
            .select(F.lit(True).alias("ok"),
                    F.lit("Data fetching and storing completed.").alias("message"),
                    "total_symbols",
                    (F.col("total_symbols") - F.col("skipped_symbols")).alias("processed_symbols"),
                    "skipped_symbols", "total_requests", "success_requests", "error_requests",
                    "unresolved_error_requests", "n_symbols_with_errors", "duration_seconds",
                    F.when(F.col("duration_seconds") > 0,
                           F.col("total_requests") / F.col("duration_seconds") * 60)
                    .otherwise(F.lit(0.0)).alias("requests_per_minute"),
                    F.when(F.col("total_requests") > 0,
                           F.col("error_requests") / F.col("total_requests"))
                    .otherwise(F.lit(0.0)).alias("failed_fraction")))
