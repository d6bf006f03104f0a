"""Planner window, tasks, skips and chunks (FIXTURES §10: F3-F5, P2, P8, O1, O3, O4, T1)."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import planner

WINDOW_CASES = [
    # time, start, end, status, ingest, glue, gold
    ("2025-12-17T10:00:00Z", "", "", "ok", ("2025-11", "2025-12"), ("2024-01", "2025-12"), ("2024", "2025")),
    ("2026-01-05T00:00:00Z", "", "", "ok", ("2025-12", "2026-01"), ("2025-01", "2026-01"), ("2025", "2026")),
    ("2025-12-17T10:00:00Z", "2024-03", "", "ok", ("2025-11", "2025-12"), ("2024-01", "2025-12"), ("2024", "2025")),
    ("2025-12-17T10:00:00Z", "2024-01", "2025-06", "ok", ("2024-01", "2025-06"), ("2024-01", "2025-06"),
     ("2024", "2025")),
    ("2025-12-17T10:00:00Z", "2023-12", "2025-06", "not_covered", (None, None), (None, None), (None, None)),
    ("2025-12-17T10:00:00Z", "2025-06", "2025-05", "end_before_start", (None, None), (None, None), (None, None)),
    ("2025-12-17T10:00:00Z", "2025-13", "2025-06", "invalid_format", (None, None), (None, None), (None, None)),
    ("2025-12", "", "", "invalid_event_time", (None, None), (None, None), (None, None)),
    # lenient month text is canonicalised at the edge
    ("2025-12-17T10:00:00Z", " 2024-3", "2025-6 ", "ok", ("2024-03", "2025-06"), ("2024-01", "2025-06"),
     ("2024", "2025")),
    # Q2: months compare as dates, so 2025-9 precedes 2025-10 (text order would refuse it)
    ("2025-12-17T10:00:00Z", "2025-9", "2025-10", "ok", ("2025-09", "2025-10"), ("2024-01", "2025-10"),
     ("2024", "2025")),
]


def test_plan_window_rule_table(spark):
    req = spark.createDataFrame([(i, t, s, e) for i, (t, s, e, *_) in enumerate(WINDOW_CASES)],
                                "id int, time string, year_month_start string, year_month_end string")
    out = {r.id: r for r in planner.plan_window(req).collect()}
    for i, (_, _, _, status, ingest, glue, gold) in enumerate(WINDOW_CASES):
        r = out[i]
        assert r.status == status, (i, r)
        assert (r.ingest_start, r.ingest_end) == ingest
        assert (r.glue_start, r.glue_end) == glue
        assert (r.gold_year_start, r.gold_year_end) == gold
    assert out[0].planned_at_utc == "2025-12-17T10:00:00Z"
    # The recompute window always starts in January
    assert all(r.glue_start.endswith("-01") for r in out.values() if r.status == "ok")


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([("AAA", "1999-01"), ("BBB", "2025-03"), ("CCC", "2025-04"), ("DDD", "NA")],
                                 "symbol string, start_date string")


def test_tasks_fixture(spark, dim):
    tasks = planner.plan_tasks(dim, "2025-01", "2025-04", as_of="2025-03-10")
    got = sorted((r.symbol, r.month) for r in tasks.collect())
    assert got == [("AAA", "2025-01"), ("AAA", "2025-02"), ("AAA", "2025-03"), ("BBB", "2025-03")]
    reasons = {r.outcome: r.n_symbols for r in planner.skip_reasons(dim, "2025-01", "2025-04", "2025-03-10").collect()}
    assert reasons == {"processed": 2, "invalid_start_date": 1, "starts_after_end": 1}
    c = planner.plan_counts(dim, "2025-01", "2025-04", "2025-03-10").first()
    assert (c.total_symbols, c.skipped_symbols, c.processed_symbols, c.total_requests) == (4, 2, 2, 4)


def test_future_window_counts_processed_without_tasks(spark, dim):
    """Q8: window after the clamp -> no task, yet processed."""
    assert planner.plan_tasks(dim, "2025-04", "2025-06", as_of="2025-03-10").count() == 0
    c = planner.plan_counts(dim, "2025-04", "2025-06", "2025-03-10").first()
    assert (c.processed_symbols, c.total_requests) == (2, 0)


def test_tasks_are_gapless_and_inside_window(spark, dim):
    tasks = planner.plan_tasks(dim, "2024-02", "2025-04", as_of="2025-03-10")
    per = tasks.groupBy("symbol").agg(F.count("*").alias("n"), F.min("month_start").alias("lo"),
                                      F.max("month_start").alias("hi"))
    for r in per.collect():
        assert r.n == (r.hi.year - r.lo.year) * 12 + r.hi.month - r.lo.month + 1
        assert str(r.lo) >= "2024-02-01" and str(r.hi) <= "2025-03-01"


def test_chunks(spark):
    syms = spark.createDataFrame([(f"S{i}", i) for i in range(7)], "symbol string, pos int")
    b = planner.plan_batches(syms, ["pos"], 3).orderBy("batch_id").collect()
    assert [r.batch_id for r in b] == [0, 1, 2]
    assert [r.symbols for r in b] == [["S0", "S1", "S2"], ["S3", "S4", "S5"], ["S6"]]
    empty = spark.createDataFrame([], "symbol string, pos int")
    assert planner.plan_batches(empty, ["pos"], 3).count() == 0
    with pytest.raises(ValueError):
        planner.plan_batches(syms, ["pos"], 0)


def test_row_index_is_dense_over_many_partitions(spark):
    from tidemark.operators.ordering import with_row_index
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5003).repartition(13)
    idx = with_row_index(df, ["k"], "i").collect()
    pairs = sorted((r.k, r.i) for r in idx)
    assert [i for _, i in pairs] == list(range(5000))


def test_subset_then_limit(spark):
    dim = spark.createDataFrame([(s, i) for i, s in enumerate("ABCDEFG")], "symbol string, pos int")
    subset = spark.createDataFrame([("G",), ("B",), ("D",), ("Z",)], "symbol string")
    out = planner.subset_limit(dim, subset, ["pos"], 2)
    assert [r.symbol for r in out.collect()] == ["B", "D"]
    assert planner.subset_limit(dim, None, ["pos"], 0).count() == 0
