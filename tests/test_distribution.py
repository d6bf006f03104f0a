"""Distribution features: exact ones against plain Python, sketches within their errors,
hot symbols spread; co-moment states that add up."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from tidemark.operators import distribution, gold

DAY = dt.date(2024, 1, 1)


def lower(values, percent):
    values = sorted(values)
    return values[max(-(-percent * len(values) // 100), 1) - 1]


def moments(values):
    n, mean = len(values), math.fsum(values) / len(values)
    m2, m3, m4 = (math.fsum((v - mean) ** k for v in values) / n for k in (2, 3, 4))
    return mean, m2, (m3 / m2 ** 1.5 if m2 else None), (m4 / m2 ** 2 - 3 if m2 else None)


def test_exact_features_match_plain_python(spark):
    rnd = random.Random(1)
    groups = {"HOT": [round(rnd.lognormvariate(4, 1), 2) for _ in range(4000)], "one": [7.25], "flat": [3.5] * 9,
              "far": [1e6 + k / 64 for k in range(100)], "signs": [-5.0, -0.0, 0.0, 5.0, -5.5, 1e-9, -1e-9],
              "ties": [1.0] * 50 + [2.0] * 50 + [3.0], None: [4.0, 6.0, 8.0]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("HOT", None), ("none", None)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "symbol string, price double").repartition(6)
    got = {r.symbol: r for r in distribution.distribution(df, ["symbol"], percents=distribution.PERCENTILES).collect()}
    assert set(got) == {*groups, "none"}
    assert got["none"].n == 0 and got["none"].mean is None and got["none"].p50 is None and got["none"].n_distinct == 0
    for g, values in groups.items():
        r, (mean, m2, skew, kurt) = got[g], moments(values)
        assert (r.n, r.min_value, r.max_value, r.n_distinct) == (len(values), min(values), max(values), len(set(values)))
        assert [r[p] for p in distribution.PERCENTILES] == [lower(values, q) for q in distribution.PERCENTILES.values()]
        assert r["mean"] == pytest.approx(mean, abs=1e-8)
        if len(values) == 1:
            assert r.stddev is None
        else:
            assert r.stddev == pytest.approx(statistics.stdev(values), abs=2e-6)
        if len(set(values)) == 1:
            assert r.skewness is None and r.kurtosis is None
        else:
            assert r.skewness == pytest.approx(skew, abs=2e-6) and r.kurtosis == pytest.approx(kurt, abs=2e-6)


def test_a_hot_symbol_is_ranked_range_by_range(spark):
    df = spark.range(40_000).select(F.lit("HOT").alias("symbol"), ((F.col("id") % 20_000) / 100 + 50).alias("price"))
    histogram = distribution._histogram(df, ["symbol"], "price", distribution.RANGES)
    per_range = histogram.groupBy("_range").count()
    assert per_range.agg({"count": "max"}).first()[0] < 400  # of 20,000 distinct values
    ordered = [r._range for r in histogram.orderBy("_v").collect()]
    assert ordered == sorted(ordered)
    plan = gold.dist_features(df)._jdf.queryExecution().executedPlan().toString()
    by_value = [line for line in plan.splitlines() if "Window [" in line and "_v" in line.split("], [")[-1]]
    assert by_value and all("_range" in line for line in by_value)


def test_sketches_merge_within_their_errors(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("symbol"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 90 as int))").alias("ts"),
        F.when(F.col("id") % 101 > 0, F.round(F.pow(F.rand(3) + 0.1, 3) * 1000, 2)).alias("price"))
    rows.cache()
    days = distribution.day_sketches(rows)
    assert days.count() == rows.select("symbol", F.to_date("ts")).distinct().count()
    month = F.to_date(F.date_trunc("month", "trade_date")).alias("month")
    months = distribution.merge_sketches(days, ["symbol", month])
    bars = rows.withColumn("month", F.to_date(F.date_trunc("month", "ts")))
    checked = distribution.sketch_errors(bars, distribution.sketch_features(months), ["symbol", "month"], "price").collect()
    assert len(checked) == 8 * 3 and all(r.ranks_ok and r.distinct_ok for r in checked)
    assert sum(r.n for r in checked) == rows.where("price IS NOT NULL").count()
    # merging in two steps or in one gives groups of the same size, within the same errors
    years = distribution.merge_sketches(months, ["symbol"])
    checked = distribution.sketch_errors(rows, distribution.sketch_features(years), ["symbol"], "price").collect()
    assert len(checked) == 8 and all(r.ranks_ok and r.distinct_ok for r in checked)


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), None)], "symbol string, ts timestamp_ntz, price double")
    merged = distribution.merge_sketches(distribution.day_sketches(df), ["symbol"])
    row, = distribution.sketch_features(merged).collect()
    assert (row.n, row.p50, row.approx_distinct) == (0, None, 0)
    assert distribution.distribution(df.limit(0), ["symbol"]).count() == 0


def test_beta_keeps_every_symbol_and_periods_add_up(spark):
    rnd = random.Random(5)
    days = [DAY + dt.timedelta(days=k) for k in range(70)]
    index = {d: round(rnd.gauss(0, 0.01), 6) for d in days}
    rows = [("A", d, round(2 * index[d] + rnd.gauss(0, 0.002), 6)) for d in days[1:]] + [("A", days[0], None)]
    rows += [("once", days[3], None), ("flat", days[1], 0.01), ("flat", days[2], 0.01), ("flat", days[4], 0.01),
             ("off", dt.date(2030, 1, 1), 0.5)]
    ret = spark.createDataFrame(rows, "symbol string, trade_date date, ret double").repartition(3)
    mkt = spark.createDataFrame(list(index.items()), "trade_date date, mkt_ret double")
    got = {r.symbol: r for r in gold.benchmark_beta(ret, mkt).collect()}
    assert set(got) == {"A", "once", "flat", "off"}
    x, y = zip(*[(r, index[d]) for s, d, r in rows if s == "A" and r is not None])
    assert got["A"].n_days == 69 and got["A"].beta == pytest.approx(statistics.covariance(x, y) / statistics.variance(y), abs=1e-6)
    assert got["A"].correlation == pytest.approx(statistics.correlation(x, y), abs=1e-6)
    assert (got["once"].n_days, got["once"].beta) == (0, None) and got["off"].n_days == 0
    assert got["flat"].correlation is None and got["flat"].beta == 0.0
    states = gold.comoments(ret, mkt, "month")
    merged = {r.symbol: r for r in gold.co_features(gold.merge_comoments(states, ["symbol"]), ["symbol"]).collect()}
    assert merged == got
    months = gold.co_features(states, ["symbol", "period"]).where("symbol = 'A'").collect()
    assert sum(r.n_days for r in months) == 69 and len(months) == 3
