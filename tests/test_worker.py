"""The worker flow end to end on the FIXTURES task table."""

from datetime import datetime

from tidemark.operators.worker import ingest_run, last_attempts
from tidemark.session import shared_dir
from tidemark.sources.bronze import read_bronze


def test_ingest_run(spark):
    dim = spark.createDataFrame([("AAA", "1999-01"), ("BBB", "2025-03"), ("CCC", "2025-04"), ("DDD", "NA")],
                                "symbol string, start_date string")
    ok_body = '{"Time Series (1min)": {}}'
    attempts = spark.createDataFrame([
        ("AAA", "2025-01", 1, 503, "application/json", "{}", datetime(2025, 3, 1, 0, 0, 0)),
        ("AAA", "2025-01", 2, 200, "application/json", ok_body, datetime(2025, 3, 1, 0, 0, 1)),
        ("AAA", "2025-02", 1, 200, "application/json", '{"Note": "slow down"}', datetime(2025, 3, 1, 0, 0, 2)),
        ("BBB", "2025-03", 1, 200, "application/json", ok_body, datetime(2025, 3, 1, 0, 1, 2)),
        ("ZZZ", "2025-03", 1, 200, "application/json", ok_body, datetime(2025, 3, 1, 0, 1, 3)),
    ], "symbol string, month string, attempt_seq int, status_code int, content_type string, body string, "
       "requested_at timestamp")
    path = shared_dir(spark, "t-worker")
    run = ingest_run(dim, attempts, "2025-01", "2025-04", "2025-03-10", bronze_path=path)
    status = {(r.symbol, r.month): (r.error_class, r.n_attempts) for r in run.tasks.collect()}
    assert status == {("AAA", "2025-01"): ("ok", 2), ("AAA", "2025-02"): ("note", 1),
                      ("AAA", "2025-03"): ("transport", 0), ("BBB", "2025-03"): ("ok", 1)}
    s = run.summary.first()
    assert (s.total_symbols, s.skipped_symbols, s.processed_symbols) == (4, 2, 2)
    assert (s.total_requests, s.success_requests, s.error_requests, s.unresolved_error_requests) == (4, 2, 2, 2)
    assert s.n_symbols_with_errors == 1 and s.duration_seconds == 62.0
    landed = sorted((r.symbol, r.month) for r in read_bronze(spark, path).collect())
    assert landed == [("AAA", "2025-01"), ("BBB", "2025-03")]  # ZZZ was not planned
    assert run.landed == {"total_requests": 4, "success_requests": 2, "error_requests": 2}


def test_last_attempts_shuffle_no_body_that_decides_nothing(spark):
    path = shared_dir(spark, "t-attempts")
    rows = [("AAA", f"2025-0{m}", k, 200 if k == 3 else 503, "application/json", f"body {m} {k}", datetime(2025, m, k))
            for m in range(1, 6) for k in (1, 2, 3)] + [("AAA", "2025-02", 4, 404, "text/html", "late page", datetime(2025, 2, 9))]
    spark.createDataFrame(rows, "symbol string, month string, attempt_seq int, status_code int, content_type string, "
                          "body string, requested_at timestamp").write.partitionBy("month").parquet(path)
    attempts = spark.read.parquet(path)
    tasks = spark.createDataFrame([("AAA", "2025-02"), ("AAA", "2025-03")], "symbol string, month string")
    final = last_attempts(attempts, tasks, "2025-02", "2025-04")
    got = {r.month: (r.attempt_seq, r.status_code, r.body, r.n_attempts) for r in final.collect()}
    assert got == {"2025-02": (4, 404, None, 4), "2025-03": (3, 200, "body 3 3", 3)}
    again = last_attempts(attempts, tasks, "2025-02", "2025-04")
    plan = again._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in again._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert all("PartitionFilters: [isnotnull(month" in line and "2025-02" in line for line in scans), scans
    assert sum("body" in line for line in scans) == 1  # and that one reads accepted responses alone
    assert all("status_code" in line.split("PushedFilters")[1] for line in scans if "body" in line)
    packed = [line for line in plan.splitlines() if "max(struct" in line]
    assert packed and not any("body" in line for line in packed)
