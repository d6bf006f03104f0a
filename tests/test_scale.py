"""Skew: a key holding a third of all rows.  Results against brute force on a
small fixture, and the plan properties that keep the hot key off one task."""

import datetime as dt
import math
import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark.operators import gold, intraday, outcomes, silver


def half_up(x, digits):
    """The library's output rounding: sign(x) * round-half-away(|x| * 10^d) / 10^d
    in double arithmetic."""
    scale = float(10 ** digits)
    v = abs(x) * scale
    r = math.floor(v) + (1.0 if v - math.floor(v) >= 0.5 else 0.0)
    return math.copysign(1.0, x) * r / scale if x != 0 else 0.0 * x


def _skewed(spark, n=3000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        sym = "HOT" if i % 3 == 0 else f"S{rnd.randrange(200)}"
        rows.append((sym, f"2025-0{1 + i % 3}", i, rnd.random() < 0.3,
                     datetime(2025, 1, 1) + timedelta(seconds=i), rnd.randrange(5)))
    return rows, spark.createDataFrame(rows, "symbol string, month string, seq int, ok boolean, ts timestamp, v int")


def test_last_outcome_on_hot_key_matches_brute_force(spark):
    rows, df = _skewed(spark)
    got = {(r.symbol, r.month): (r.n_requests, r.last_ok) for r in
           outcomes.last_outcome(df, ["symbol", "month"], "seq").collect()}
    pdf = pd.DataFrame(rows, columns=["symbol", "month", "seq", "ok", "ts", "v"]).sort_values("seq")
    want = {k: (len(g), bool(g["ok"].iloc[-1])) for k, g in pdf.groupby(["symbol", "month"])}
    assert got == want


def test_dedup_on_hot_key_matches_brute_force(spark):
    rows, df = _skewed(spark)
    got = {(r.symbol, r.v): r.seq for r in silver.dedup_latest(df, ["symbol", "v"], ["ts", "seq"]).collect()}
    pdf = pd.DataFrame(rows, columns=["symbol", "month", "seq", "ok", "ts", "v"])
    want = {k: int(g.sort_values(["ts", "seq"])["seq"].iloc[-1]) for k, g in pdf.groupby(["symbol", "v"])}
    assert got == want


def _plan(spark, smoke_dir, name):
    df = E.queries()[name](spark, smoke_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_paths_aggregate_before_the_shuffle(spark, smoke_dir):
    assert "partial_max(struct(" in _plan(spark, smoke_dir, "dedup_bars")
    assert "partial_max_by" in _plan(spark, smoke_dir, "last_outcome")
    assert "partial_max_by" in _plan(spark, smoke_dir, "returns")  # daily bars before the symbol window
    top = _plan(spark, smoke_dir, "top_movers")
    assert "WindowGroupLimit" in top and "Partial" in top


def test_bucketed_rolling_windows_match_brute_force(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import intraday
    rnd = random.Random(11)
    rows, t = [], datetime(2025, 1, 1)
    for i in range(2500):
        # HOT trades densely; others sparsely, leaving empty and one-row buckets
        sym = "HOT" if i % 3 else f"S{rnd.randrange(6)}"
        t += timedelta(seconds=rnd.choice([1, 30, 600, 5000, 40000]))
        rows.append((i, sym, t, float(rnd.randrange(1, 500))))
    df = spark.createDataFrame(rows, "id int, symbol string, ts timestamp, price double")
    got = {r.id: (r.roll_mean, r.roll_min, r.roll_max) for r in
           intraday.rolling_rows(df, 5, "symbol", "ts", "price", F.date_trunc("hour", "ts")).collect()}
    span = {r.id: (r.span_mean, r.span_n) for r in
            intraday.rolling_span(df, 3600, "symbol", "ts", "price", 7200).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "symbol", "ts", "price"]).sort_values("ts")
    for _, g in pdf.groupby("symbol"):
        roll = g["price"].rolling(5)
        for i, m, lo, hi in zip(g["id"], roll.mean(), roll.min(), roll.max()):
            want = (None, None, None) if pd.isna(m) else (half_up(m, 9), lo, hi)
            assert got[i] == want
        ts = list(g["ts"])
        prices = list(g["price"])
        for k, i in enumerate(g["id"]):
            inside = [p for t2, p in zip(ts, prices) if ts[k] - timedelta(hours=1) <= t2 <= ts[k]]
            assert span[i] == (half_up(sum(inside) / len(inside), 9), len(inside))


def test_bucketed_returns_and_running_match_brute_force(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import intraday
    rnd = random.Random(23)
    rows, t = [], datetime(2025, 1, 1)
    for i in range(1500):
        sym = "HOT" if i % 4 else f"S{rnd.randrange(5)}"
        t += timedelta(seconds=rnd.choice([1, 60, 4000, 30000]))
        rows.append((i, sym, t, float(rnd.randrange(1, 300))))
    df = spark.createDataFrame(rows, "id int, symbol string, ts timestamp, price double")
    bucket = F.date_trunc("hour", "ts")
    ret = {r.id: r.ret for r in intraday.returns(df, "symbol", "ts", "price", bucket).collect()}
    run = {how: {r.id: r[f"running_{how}"] for r in
                 intraday.running(df, "symbol", "ts", "price", bucket, how).collect()}
           for how in ("max", "min", "sum")}
    pdf = pd.DataFrame(rows, columns=["id", "symbol", "ts", "price"]).sort_values("ts")
    for _, g in pdf.groupby("symbol"):
        prev = g["price"].shift(1)
        for i, c, p in zip(g["id"], g["price"], prev):
            assert ret[i] == (None if pd.isna(p) else half_up(c / p - 1, 6))
        for how, series in (("max", g["price"].cummax()), ("min", g["price"].cummin()),
                            ("sum", g["price"].cumsum())):
            for i, v in zip(g["id"], series):
                assert abs(run[how][i] - v) < 1e-9


def test_exact_sessions_equal_session_window(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import intraday
    rnd = random.Random(31)
    rows, t = [], datetime(2025, 1, 1)
    for i in range(1200):
        sym = "HOT" if i % 3 else f"S{rnd.randrange(4)}"
        t += timedelta(seconds=rnd.choice([1, 600, 1800, 1800, 1801, 7200]))  # exact-gap boundaries
        rows.append((sym, t, float(rnd.randrange(1, 100)), rnd.randrange(5)))
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, price double, volume int")
    exact = intraday.session_bars(df, 1800, "symbol", "ts", "price", "volume", F.date_trunc("hour", "ts"))
    builtin = (df.groupBy("symbol", F.session_window("ts", "30 minutes").alias("s"))
               .agg(F.min_by("price", "ts").alias("open"), F.max("price").alias("high"),
                    F.min("price").alias("low"), F.max_by("price", "ts").alias("close"),
                    F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n_trades"))
               .select("symbol", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                       "open", "high", "low", "close", "volume", "n_trades"))
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, builtin.collect()))


def test_scans_and_dimension_joins_carry_no_hint(spark, smoke_dir):
    from pyspark.sql import functions as F

    from tidemark.operators.joins import join_dimension
    from tidemark.sources.tables import load
    part = load(spark, smoke_dir, "part")
    joined = join_dimension(spark.range(10).withColumn("p_partkey", F.col("id")), part, "p_partkey")
    for df in (part, joined):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionBy" not in plan and "Repartition " not in plan and "strategy=" not in plan


def test_bucketed_windows_with_repeated_timestamps(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import intraday
    rnd = random.Random(41)
    rows, t = [], datetime(2025, 1, 1)
    for i in range(1200):
        sym = "HOT" if i % 3 else "S1"
        t += timedelta(seconds=rnd.choice([0, 0, 1, 900, 4000]))  # many equal timestamps
        rows.append((i, sym, t, float(rnd.randrange(1, 100))))
    df = spark.createDataFrame(rows, "seq int, symbol string, ts timestamp, price double")
    bucket = F.date_trunc("hour", "ts")
    got = {r.seq: (r.roll_mean, r.roll_max) for r in
           intraday.rolling_rows(df, 4, "symbol", "ts", "price", bucket, tiebreak="seq").collect()}
    run = {r.seq: r.running_sum for r in
           intraday.running(df, "symbol", "ts", "price", bucket, "sum", tiebreak="seq").collect()}
    pdf = pd.DataFrame(rows, columns=["seq", "symbol", "ts", "price"]).sort_values(["ts", "seq"])
    for _, g in pdf.groupby("symbol"):
        roll = g["price"].rolling(4)
        for i, m, hi, cs in zip(g["seq"], roll.mean(), roll.max(), g["price"].cumsum()):
            assert got[i] == ((None, None) if pd.isna(m) else (half_up(m, 9), hi))
            assert abs(run[i] - cs) < 1e-9


def test_row_buckets_spread_a_hot_symbol(spark):
    rows = [(i, "HOT" if i % 3 else f"s{i % 50}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=20 * i), float(i % 97))
            for i in range(3000)] + [(-1, None, None, 1.0), (-2, "HOT", None, 2.0), (-3, None, dt.datetime(2024, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "event_id int, symbol string, ts timestamp_ntz, price double")
    bucketed = intraday.with_row_buckets(df, rows=100)
    sizes = bucketed.groupBy("symbol", intraday.BUCKET).count().collect()
    slot = df.groupBy("symbol", F.date_trunc("minute", "ts")).count().agg({"count": "max"}).first()[0]
    assert max(r["count"] for r in sizes) < 100 + slot
    assert sum(r.symbol == "HOT" for r in sizes) >= 2000 // (100 + slot)
    assert sorted(map(str, bucketed.drop(intraday.BUCKET).collect())) == sorted(map(str, df.collect()))
    # buckets follow one another in time
    spans = bucketed.where("symbol = 'HOT' AND ts IS NOT NULL").groupBy(intraday.BUCKET) \
        .agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy(intraday.BUCKET).collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))
    # the windows don't depend on the bucket size
    def rolled(n):
        out = intraday.in_row_buckets(df, lambda b, bucket: intraday.rolling_rows(
            b, 4, "symbol", "ts", "price", bucket, "event_id"), rows=n)
        return sorted(map(str, out.collect()))
    assert rolled(7) == rolled(250) == rolled(10 ** 6)


def test_open_and_close_do_not_depend_on_partitioning(spark):
    at = dt.datetime(2024, 1, 1, 10)
    rows = [(k, "S", at, float(p), 1) for k, p in ((3, 9), (1, 5), (2, 7))] + [(9, "S", at, 6.0, 1)]
    seen = set()
    for n in (1, 2, 3, 4):
        df = spark.createDataFrame(rows, "event_id int, symbol string, ts timestamp_ntz, price double, volume bigint") \
            .repartition(n, "price" if n % 2 else "event_id")
        for tiebreak in ("event_id", None):
            bar, = gold.ohlcv(df, "hour", tiebreak=tiebreak).collect()
            day, = gold.daily_bars(df, tiebreak=tiebreak).collect()
            session, = intraday.session_bars(df, 60, "symbol", "ts", "price", "volume", F.date_trunc("hour", "ts"),
                                             tiebreak).collect()
            seen.add((tiebreak, bar.open, bar.close, day.close, session.open, session.close))
    assert seen == {("event_id", 5.0, 6.0, 6.0, 5.0, 6.0), (None, 5.0, 9.0, 9.0, 5.0, 9.0)}


def test_bucketed_windows_keep_null_keys(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidemark.operators import intraday
    rnd = random.Random(43)
    rows = [(rnd.choice(["A", "B", None]), datetime(2025, 1, 1) + timedelta(minutes=k) if rnd.random() < 0.95 else None,
             k, float(rnd.randrange(1, 99))) for k in range(300)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, event_id int, price double")
    w = Window.partitionBy("symbol").orderBy("ts", "event_id")
    bucket = F.date_trunc("hour", "ts")
    got = intraday.returns(df, "symbol", "ts", "price", bucket, "event_id").select("event_id", "ret").collect()
    plain = df.withColumn("p", F.lag("price").over(w)).select("event_id", F.round(F.col("price") / F.col("p") - 1, 6))
    key = lambda r: r[0]
    assert [(r[0], None if r[1] is None else round(r[1], 5)) for r in sorted(got, key=key)] == \
        [(r[0], None if r[1] is None else round(r[1], 5)) for r in sorted(plain.collect(), key=key)]
    peak = {r.event_id: r.running_peak for r in intraday.drawdown(df, "symbol", "ts", "price", bucket, "event_id").collect()}
    full = w.rowsBetween(Window.unboundedPreceding, 0)
    assert peak == {r.event_id: r.m for r in df.withColumn("m", F.max("price").over(full)).collect()}


def test_bucketed_bars_are_not_exchanged_again(spark, smoke_dir):
    for name in ("ohlcv_bucketed", "enriched_bucketed"):
        plan = E.queries()[name](spark, smoke_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan, name


def test_reingested_lines_meet_once_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    from tidemark.plans import catalog
    rnd = random.Random(5)
    lines = [(rnd.choice([None, *range(40)]), rnd.choice([None, 1, 2]), rnd.choice([None, 1.0, 2.0, -3.0]),
              rnd.choice([None, "A", "R"])) for _ in range(600)]
    lines += [(7, 1, 5.0, "R")] * 400  # a line that comes again and again
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(catalog, "LINES_PER_TASK", 100)
    out = catalog.dedup_reingested(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the lines, and those returned
    assert plan.count("hashpartitioning(l_orderkey") == 2 and plan.count(", 11), REPARTITION_BY_NUM") == 2

    def null_last(values):
        return [(v is not None, v if v is not None else 0) for v in values[:2]] + [(values[2] is not None, values[2] or "")]

    best = {}
    for key, n, q, flag in {*lines}:
        for row in [(1, q, flag)] + [(2, None if q is None else -q, flag)] * (flag == "R"):
            if (key, n) not in best or null_last(best[key, n]) < null_last(row):
                best[key, n] = row
    got = {(r.l_orderkey, r.l_linenumber): (r.run, r.l_quantity, r.l_returnflag) for r in out.collect()}
    assert out.count() == len(best) and got == best
