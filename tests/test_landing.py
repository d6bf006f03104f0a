"""Classification (P10-P14), outcomes (G3-G5, G9), earliest month (G6), keys."""

from datetime import datetime

import pytest

from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.operators import classify as C
from tidemark.operators import outcomes
from tidemark.operators.earliest import earliest_month
from tidemark.session import shared_dir

BOTH = '{"Note": "n", "Error Message": "e"}'
CLASS_CASES = [
    # status, content type, body, intraday/search class, monthly class
    (None, None, None, "transport", "transport"),
    (503, "application/json", "{}", "http_status", "http_status"),
    (404, "application/json", "{}", "http_status", "http_status"),
    (200, "text/html", "{}", "content_type", "content_type"),
    (200, "Application/JSON; charset=utf-8", "{}", "ok", "ok"),
    (200, "application/json", "<html>", "invalid_json", "invalid_json"),
    (200, "application/json", '{"Note":"n"}', "note", "note"),
    (200, "application/json", '{"Error Message":"e"}', "error_message", "error_message"),
    (200, "application/json", BOTH, "note", "error_message"),
    (200, "application/json", '{"Note":null}', "note", "note"),
    (200, "application/json", "{'a':1}", "invalid_json", "invalid_json"),
    (200, "application/json", '{"a":1} trailing', "invalid_json", "invalid_json"),
    (200, "application/json", '{"a":NaN}', "invalid_json", "invalid_json"),
    (200, "application/json", "", "invalid_json", "invalid_json"),
    (200, "application/json", "[1]", "not_object", "not_object"),
]


def _responses(spark):
    return spark.createDataFrame([(i, s, c, b) for i, (s, c, b, _, _) in enumerate(CLASS_CASES)],
                                 "id int, status_code int, content_type string, body string")


def test_classification_rule_table(spark):
    df = _responses(spark)
    for endpoint, col in ((C.INTRADAY, 3), (C.SEARCH, 3), (C.MONTHLY, 4)):
        got = {r.id: r for r in C.classify(df, endpoint).collect()}
        for i, case in enumerate(CLASS_CASES):
            assert got[i].error_class == case[col], (endpoint, case)
            assert got[i].ok == (case[col] == "ok")


def test_error_texts_and_retriable(spark):
    got = {r.id: r for r in C.classify(_responses(spark), C.INTRADAY).collect()}
    assert got[0].error == "Failed to fetch data from Alpha Vantage API." and got[0].retriable
    assert got[1].error == "Alpha Vantage API returned HTTP 503." and got[1].retriable
    assert got[2].error == "Alpha Vantage API returned HTTP 404." and not got[2].retriable
    assert got[6].error == "n" and got[9].error is None
    assert got[5].body_head == "<html>" and got[4].body_head is None
    search = {r.id: r for r in C.classify(_responses(spark), C.SEARCH).collect()}
    assert search[0].error == "Network error during symbol search." and search[1].error == "HTTP 503"
    monthly = {r.id: r for r in C.classify(_responses(spark), C.MONTHLY).collect()}
    assert monthly[0].error == "Failed to fetch monthly adjusted data." and monthly[8].error == "e"


OUTCOME_CASES = [
    # attempts (symbol, month, seq, ok) -> total, success, error, unresolved, symbols with errors
    ([("A", "m1", 1, False), ("A", "m1", 2, True)], (2, 1, 1, 0, 1)),
    ([("A", "m1", 1, True), ("A", "m1", 2, False)], (2, 1, 1, 1, 1)),
    ([("A", "m1", 1, True), ("B", "m1", 2, False)], (2, 1, 1, 1, 1)),
]


def test_outcome_rule_table(spark):
    for reqs, expected in OUTCOME_CASES:
        df = spark.createDataFrame([(s, m, q, ok, datetime(2025, 1, 1, 0, 0, q)) for s, m, q, ok in reqs],
                                   "symbol string, month string, seq int, ok boolean, ts timestamp")
        s = outcomes.run_summary(df, ["symbol", "month"], "seq").first()
        got = (s.total_requests, s.success_requests, s.error_requests, s.unresolved_error_requests,
               s.n_symbols_with_errors)
        assert got == expected, reqs
        assert s.success_requests + s.error_requests == s.total_requests
        assert s.unresolved_error_requests <= s.error_requests
        assert s.duration_seconds == len(reqs) - 1
        assert s.requests_per_minute == (s.total_requests / s.duration_seconds * 60)
    bad = [r.symbol for r in outcomes.error_symbols(df).collect()]
    assert bad == ["B"]


def test_zero_duration_rate_is_zero(spark):
    df = spark.createDataFrame([("A", "m", 1, True, datetime(2025, 1, 1))],
                               "symbol string, month string, seq int, ok boolean, ts timestamp")
    s = outcomes.run_summary(df, ["symbol", "month"], "seq").first()
    assert s.duration_seconds == 0.0 and s.requests_per_minute == 0.0 and s.ok


def test_retry_outcome(spark):
    df = spark.createDataFrame([("A", 1, 503), ("A", 2, 503), ("A", 3, 200), ("B", 1, 404), ("C", 1, None),
                                ("D", 1, 503), ("D", 2, 503), ("D", 3, 503), ("D", 4, 503)],
                               "symbol string, attempt_seq int, status_code int")
    got = {r.symbol: r for r in outcomes.retry_outcome(df, ["symbol"]).collect()}
    assert (got["A"].n_attempts, got["A"].final_status, got["A"].final_ok) == (3, 200, True)
    assert got["B"].final_ok is False and not got["B"].stopped_early
    assert got["C"].final_status is None and got["C"].stopped_early
    assert got["D"].n_attempts == 4 and not got["D"].over_budget and not got["D"].stopped_early


def test_earliest_month(spark):
    df = spark.createDataFrame([
        ("X", 200, "application/json",
         '{"Monthly Adjusted Time Series": {"2001-03-31": {"4. close": "1"}, "2000-12-29": {"4. close": "2"}}}'),
        ("Y", 200, "application/json", '{"Monthly Adjusted Time Series": {}}'),
        ("Z", 200, "application/json", '{"Meta": {}}'),
        ("W", 200, "application/json", '{"Error Message": "Invalid API call"}'),
        ("V", 500, "application/json", "{}")],
        "symbol string, status_code int, content_type string, body string")
    got = {r.symbol: r for r in earliest_month(df).collect()}
    assert (got["X"].earliest_month, got["X"].ok, got["X"].error) == ("2000-12", True, None)
    assert (got["Y"].earliest_month, got["Y"].ok, got["Y"].error) == (None, False, "No time series")
    assert got["Z"].error == "No time series"
    assert got["W"].error == "Invalid API call"
    assert got["V"].error == "HTTP 500"


def test_keys(spark):
    r = spark.range(1).select(
        K.bronze_key(F.lit("AAA"), F.lit("2025-12"), "data/bronze").alias("k"),
        K.uri_bucket(F.lit("s3://b/k1/k2.csv")).alias("b"), K.uri_key(F.lit("s3://b/k1/k2.csv")).alias("key"),
        K.uri_bucket(F.lit("http://x/y")).alias("nb"),
        K.file_stamp(F.lit(datetime(2025, 12, 17, 10, 0, 0, 123456))).alias("fs"),
        K.file_stamp(F.lit(datetime(2025, 12, 17, 10, 0, 0))).alias("fs0"),
        K.join_errors(F.lit("a"), F.lit(None).cast("string")).alias("e1"),
        K.join_errors(F.lit("a"), F.lit("b")).alias("e2"),
        K.join_errors(F.lit(None).cast("string")).alias("e0")).first()
    assert r.k == "data/bronze/alpha_vantage/intraday_1min/symbol=AAA/month=2025-12/raw.json"
    assert (r.b, r.key, r.nb) == ("b", "k1/k2.csv", None)
    assert r.fs == "2025-12-17T10-00-00.123456+00-00" and r.fs0 == "2025-12-17T10-00-00+00-00"
    assert (r.e1, r.e2, r.e0) == ("a", "a | b", None)


def test_a_body_is_parsed_once(spark, smoke_dir):
    import __spark_entry__ as E
    from tidemark.plans import recast as R
    from tidemark.operators import classify as C
    one = R.responses_from_events(spark.read.parquet(f"{smoke_dir}/events.parquet"))
    for endpoint in (C.INTRADAY, C.SEARCH, C.MONTHLY):
        plan = C.classify(one, endpoint)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1 and "from_json" not in plan
    plan = E.queries()["earliest_month"](spark, smoke_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_landing_refuses_two_documents_of_a_key(spark):
    from tidemark.sources import landing
    docs = spark.createDataFrame([("a", "2024-01", "{}"), ("a", "2024-01", "[]")], "symbol string, month string, body string")
    with pytest.raises(ValueError, match="one document per key"):
        landing.land_raw(docs, shared_dir(spark, "t-twice"))
