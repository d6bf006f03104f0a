"""The worker run as one Spark job graph.

plan tasks -> final landed response of each task (last attempt) -> classify
-> land accepted bodies in Bronze -> per-task status and the run summary.
Vendor calls are not made here: responses arrive as data (one row per HTTP
attempt), and a planned task without any landed response counts as a
transport failure.

The last attempt is chosen without its body: what is aggregated by (symbol, month) are
the attempts' numbers, statuses and times, of the planned months alone, so that a landing
table partitioned by month is pruned.  Bodies are fetched for those last attempts that a
body decides, the accepted JSON responses.  When the run lands its payloads, the
classified tasks are written once, and Bronze, the status and the summary are read from
that copy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import payloads as P
from tidemark.operators import classify as C
from tidemark.operators import outcomes, planner
from tidemark.session import shared_dir
from tidemark.sources.bronze import write_bronze


@dataclass
class RunResult:
    tasks: DataFrame      # symbol, month, error_class, ok, error, n_attempts, first/last attempt time
    summary: DataFrame    # one row (S11)
    landed: dict = field(default_factory=dict)  # live counts observed while landing (when written)


def _decided_by_body() -> Column:
    """Only an accepted JSON response is classified by what its body holds."""
    return P.is_success_status("status_code") & P.is_json_content_type("content_type")


def last_attempts(attempts: DataFrame, tasks: DataFrame, start: str, end: str, seq: str = "attempt_seq",
                  ts: str = "requested_at") -> DataFrame:
    """Per planned (symbol, month): ``n_attempts``, the first attempt's time and, of the last
    attempt (by ``seq``, then time), its number, status, content type, time and body.  The
    body is NULL where it doesn't decide the outcome."""
    pair = ["symbol", "month"]
    planned = attempts.where(F.col("month").between(start, end))
    final = (planned.select(*pair, seq, "status_code", "content_type", ts).join(tasks, pair, "left_semi").groupBy(*pair)
             .agg(F.max(F.struct(seq, ts, "status_code", "content_type")).alias("_last"),
                  F.count(F.lit(1)).alias("n_attempts"), F.min(ts).alias("_first_ts"))
             .select(*pair, "n_attempts", "_first_ts", "_last.*"))
    bodies = planned.where(_decided_by_body()).select(*pair, F.col(seq).alias("_seq"), "body")
    wanted = final.where(_decided_by_body()).select(*pair, F.col(seq).alias("_seq"))
    # an attempt's number is its key; were it repeated, one body would still be taken
    body = bodies.join(wanted, [*pair, "_seq"], "left_semi").groupBy(*pair).agg(F.max("body").alias("body"))
    return final.join(body, pair, "left")


def ingest_run(dim: DataFrame, attempts: DataFrame, start: str, end: str, as_of=None,
               bronze_path: str | None = None, endpoint: str = C.INTRADAY,
               seq: str = "attempt_seq", ts: str = "requested_at") -> RunResult:
    """``attempts``: symbol, month, attempt_seq, status_code, content_type, body, requested_at."""
    spark = dim.sparkSession
    tasks = planner.plan_tasks(dim, start, end, as_of).select("symbol", "month")
    per_task = tasks.join(last_attempts(attempts, tasks, start, end, seq, ts), ["symbol", "month"], "left")
    classified = C.classify(per_task, endpoint, diagnostics=False) \
        .select("symbol", "month", "error_class", "ok", "error", F.coalesce("n_attempts", F.lit(0)).alias("n_attempts"),
                F.col("_first_ts").alias("first_attempt_at"), F.col(ts).alias("last_attempt_at"),
                F.when(F.col("ok"), F.col("body")).alias("body"))
    landed = {}
    if bronze_path:
        # live form of the summary: counted while the write runs, no second pass
        obs, copy = Observation("ingest_run"), shared_dir(spark, "ingest-run")
        classified.observe(obs, F.count(F.lit(1)).alias("total_requests"),
                           F.count_if(F.col("ok")).alias("success_requests"),
                           F.count_if(~F.col("ok")).alias("error_requests")).write.parquet(copy)
        landed = dict(obs.get)
        classified = spark.read.schema(classified.schema).parquet(copy)
        write_bronze(classified.where("ok").select("symbol", "month", "body", F.col("last_attempt_at").alias(ts)),
                     bronze_path)
    status = classified.drop("body")
    counts = planner.plan_counts(dim, start, end, as_of).select("total_symbols", "skipped_symbols")
    # one logical request per task: its sequence is irrelevant (a single row per pair)
    summary = outcomes.run_summary(status.withColumn("_seq", F.lit(0)), ["symbol", "month"], "_seq",
                                   ts="first_attempt_at", ts_end="last_attempt_at", total_symbols=counts)
    return RunResult(status, summary, landed)
