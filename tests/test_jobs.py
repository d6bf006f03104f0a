"""Planner and worker events end to end over a dimension file."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.jobs import plan_job, worker_job
from tidemark.session import shared_dir
from tidemark.sources.tables import load


@pytest.fixture(scope="module")
def dim_uri(spark, smoke_dir):
    cust = load(spark, smoke_dir, "customer").orderBy("c_custkey")
    dim = cust.select(F.col("c_name").alias("symbol"), F.col("c_name").alias("name"),
                      *[F.lit("x").alias(c) for c in ("asset_type", "market", "category", "risk_group",
                                                     "liquidity_class", "systemic_role", "narrative_role")],
                      F.lit("[]").alias("bubble_history"), F.lit("[]").alias("narrative_exposure"),
                      F.lit("1").alias("data_priority"),
                      F.when(F.col("c_custkey") % 7 == 0, F.lit("2025-03")).otherwise(F.lit("1999-01"))
                      .alias("start_date"),
                      F.lit("[]").alias("shock_history"))
    path = shared_dir(spark, "t-dimfile")
    dim.coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    return path, [r.c_name for r in cust.collect()]


def test_plan_job(spark, dim_uri):
    uri, names = dim_uri
    plan = plan_job(spark, {"symbols_s3_uri": uri, "batch_size": 40, "time": "2025-12-17T10:00:00Z"})
    rows = sorted(plan.collect(), key=lambda r: r.batch_id)
    assert len(rows) == math.ceil(len(names) / 40)
    assert rows[0].total_symbols == len(names) and rows[0].ingest_year_month_start == "2025-11"
    import json
    events = [json.loads(r.event_json) for r in rows]
    assert [s for e in events for s in e["symbols_subset"]] == names  # file order kept
    assert events[0]["year_month_end"] == "2025-12"
    with pytest.raises(ValueError):
        plan_job(spark, {"symbols_s3_uri": uri, "year_month_start": "2025-06", "year_month_end": "2025-05"})


def test_worker_job_subset_then_limit(spark, dim_uri):
    uri, names = dim_uri
    subset = [f" {n} " for n in names[5:60]]  # padded: stripped like the dimension (Q3)
    attempts = spark.createDataFrame(
        [(names[6], "2025-01", 1, 200, "application/json", '{"Time Series (1min)": {}}', datetime(2025, 3, 1))],
        "symbol string, month string, attempt_seq int, status_code int, content_type string, body string, "
        "requested_at timestamp")
    event = {"symbols_s3_uri": uri, "year_month_start": "2025-01", "year_month_end": "2025-04",
             "symbols_subset": subset, "limit": 3}
    run = worker_job(spark, event, attempts, as_of="2025-03-10")
    s = run.summary.first()
    assert s.total_symbols == 3
    planned = {r.symbol for r in run.tasks.collect()}
    assert planned <= set(names[5:8]) and names[6] in planned
    with pytest.raises(ValueError):
        worker_job(spark, {**event, "year_month_start": "2025-13"}, attempts)


def test_search_and_monthly_jobs(spark):
    from tidemark.jobs import monthly_job, search_job
    from tidemark.sources.bronze import read_bronze
    t = datetime(2025, 1, 1)
    search = spark.createDataFrame([("ibm", 200, "application/json", '{"bestMatches": []}', t),
                                    ("ba", 200, "application/json", '{"Note": "n"}', t)],
                                   "keywords string, status_code int, content_type string, body string, "
                                   "requested_at timestamp")
    path = shared_dir(spark, "t-search")
    out = {r.keywords: r.error_class for r in search_job(search, path).collect()}
    assert out == {"ibm": "ok", "ba": "note"}
    assert [r.keywords for r in read_bronze(spark, path).collect()] == ["ibm"]
    monthly = spark.createDataFrame(
        [("IBM", 200, "application/json", '{"Monthly Adjusted Time Series": {"2001-03-31": {}, "1999-11-30": {}}}', t),
         ("XX", 200, "application/json", '{"Error Message": "bad", "Note": "n"}', t)],
        "symbol string, status_code int, content_type string, body string, requested_at timestamp")
    got = {r.symbol: (r.error_class, r.earliest_month, r.earliest_error) for r in monthly_job(monthly).collect()}
    assert got == {"IBM": ("ok", "1999-11", None), "XX": ("error_message", None, "bad")}


def test_cli_plan_and_worker(spark, dim_uri, tmp_path_factory):
    import json as _json

    from tidemark.__main__ import main
    uri, names = dim_uri
    folder = shared_dir(spark, "t-cli")
    event_path = tmp_path_factory.mktemp("events") / "plan.json"
    event_path.write_text(_json.dumps({"symbols_s3_uri": uri, "batch_size": 100, "time": "2025-12-17T10:00:00Z"}))
    main(["plan", "--event", str(event_path), "--out", f"{folder}/plan"])
    assert spark.read.json(f"{folder}/plan").count() == math.ceil(len(names) / 100)
    attempts = spark.createDataFrame(
        [(names[0], "2025-11", 1, 200, "application/json", '{"Time Series (1min)": {}}', datetime(2025, 12, 1))],
        "symbol string, month string, attempt_seq int, status_code int, content_type string, body string, "
        "requested_at timestamp")
    attempts.write.parquet(f"{folder}/attempts")
    worker_event = tmp_path_factory.mktemp("events") / "worker.json"
    worker_event.write_text(_json.dumps({"symbols_s3_uri": uri, "year_month_start": "2025-11",
                                         "year_month_end": "2025-12", "symbols_subset": names[:2]}))
    main(["worker", "--event", str(worker_event), "--attempts", f"{folder}/attempts",
          "--bronze", f"{folder}/bronze", "--out", f"{folder}/run", "--as-of", "2025-12-17"])
    summary = spark.read.json(f"{folder}/run/summary").first()
    assert summary.total_symbols == 2 and summary.success_requests == 1
    assert spark.read.parquet(f"{folder}/bronze").count() == 1


def test_clean_up_takes_the_blocks_folders_alone(spark):
    import os
    from tidemark.session import cleaned_up
    before = shared_dir(spark, "t-before")
    spark.range(3).write.parquet(before)
    with pytest.raises(KeyError), cleaned_up(spark):
        inside = shared_dir(spark, "t-inside")
        spark.range(3).write.parquet(inside)
        raise KeyError
    assert not os.path.exists(inside) and spark.read.parquet(before).count() == 3
