"""Gold: bars at coarser grain, VWAP, per-symbol window features, regime
signals, cross-sectional ranks, distribution features, beta, cubes
(G10-G14, W1-W7, T5, J6).

Layout: raw bars are first reduced to (symbol, period) bars by partial
aggregation (a hot symbol is split across periods and pre-aggregated
map-side); symbol windows then run on those bars, which are bounded per
symbol by the calendar, all sharing one ``symbol`` partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away
from tidemark.operators.distribution import PERCENTILES, distribution, value_range
from tidemark.operators.joins import join_dimension

# Outputs are rounded so that engines agreeing up to summation order agree
# exactly.  Averages keep 9 decimals: a mean of cent prices is a fraction with
# factors 2 and 5 below it and sits on a rounding tie at 6 decimals far more
# often than at 9.
ROUND = 6
ROUND_MEAN = 9


def _r(c: Column) -> Column:
    return round_half_away(c, ROUND)


def _rm(c: Column) -> Column:
    return round_half_away(c, ROUND_MEAN)


# --------------------------------------------------------------------- bars

def trade_order(ts: str, price: str, tiebreak: str | None = None) -> Column:
    """What open and close are the first and last of: time, then the trade's own number.
    Without one, trades of one time are ordered by price, so that the result never depends
    on how the rows are partitioned."""
    return F.struct(ts, *([tiebreak] if tiebreak else []), price)


def ohlcv(bars: DataFrame, grain: str, symbol: str = "symbol", ts: str = "ts", price: str = "price",
          volume: str = "volume", tiebreak: str | None = None, layout: Sequence[str] = ()) -> DataFrame:
    """OHLCV per (symbol, bar_start) at ``grain`` ('minute', 'hour', 'day', 'month', ...);
    open and close in ``trade_order``.  ``layout`` names further columns that a table of bars
    is bucketed by; they have to follow from symbol and period, and stay in the result."""
    start = F.date_trunc(grain, F.col(ts)).cast(bars.schema[ts].dataType)
    order = trade_order(ts, price, tiebreak)
    return (bars.groupBy(symbol, *layout, start.alias("bar_start"))
            .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"),
                 F.min(price).alias("low"), F.max_by(price, order).alias("close"),
                 F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("n_trades")))


def vwap(bars: DataFrame, grain: str = "day", symbol: str = "symbol", ts: str = "ts",
         price: str = "price", volume: str = "volume") -> DataFrame:
    """Volume-weighted average price; NULL when the period's volume is 0."""
    start = F.date_trunc(grain, F.col(ts)).cast(bars.schema[ts].dataType)
    # sums in DECIMAL don't depend on the order of addition
    exact = F.col(price).cast("decimal(18,6)") * F.col(volume).cast("decimal(18,0)")
    return (bars.groupBy(symbol, start.alias("bar_start"))
            .agg(F.sum(exact).cast("double").alias("_pv"), F.sum(volume).alias("volume"))
            .select(symbol, "bar_start", "volume",
                    F.when(F.col("volume") != 0, _rm(F.col("_pv") / F.col("volume"))).alias("vwap")))


def daily_bars(bars: DataFrame, symbol: str = "symbol", ts: str = "ts", price: str = "price",
               volume: str = "volume", tiebreak: str | None = None) -> DataFrame:
    """Daily close / volume per symbol and trade date (base of the windows)."""
    return (bars.groupBy(symbol, F.to_date(ts).alias("trade_date"))
            .agg(F.max_by(price, trade_order(ts, price, tiebreak)).alias("close"), F.sum(volume).alias("volume")))


def _w(symbol: str) -> Window:
    return Window.partitionBy(symbol).orderBy("trade_date")


# ------------------------------------------------------------------ windows

def returns(daily: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Simple and log return against the previous bar (first row NULL)."""
    prev = F.lag("close").over(_w(symbol))
    c, p = F.col("close"), F.col("prev_close")
    return (daily.withColumn("prev_close", prev)
            .withColumn("ret", F.when(p > 0, _r(c / p - 1)))
            .withColumn("log_ret", F.when((p > 0) & (c > 0), _r(F.log(c / p))))
            .drop("prev_close"))


def _rows(symbol: str, n: int) -> Window:
    return _w(symbol).rowsBetween(-(n - 1), 0)


def rolling_stats(daily: DataFrame, n: int = 5, symbol: str = "symbol", col: str = "close") -> DataFrame:
    """Mean / stddev / min / max over the last ``n`` bars; NULL until ``n`` bars."""
    w = _rows(symbol, n)
    full = F.count(col).over(w) == n
    return daily.select(
        symbol, "trade_date", col,
        F.when(full, _rm(F.avg(col).over(w))).alias("roll_mean"),
        F.when(full, _r(F.stddev_samp(col).over(w))).alias("roll_std"),
        F.when(full, F.min(col).over(w)).alias("roll_min"),
        F.when(full, F.max(col).over(w)).alias("roll_max"))


def rolling_range(daily: DataFrame, days: int = 7, symbol: str = "symbol", col: str = "close") -> DataFrame:
    """Mean over a calendar span (RANGE frame on the day number)."""
    w = (Window.partitionBy(symbol).orderBy(F.unix_date("trade_date"))
         .rangeBetween(-(days - 1), 0))
    return daily.select(symbol, "trade_date", col,
                        _rm(F.avg(col).over(w)).alias("span_mean"),
                        F.count(col).over(w).alias("span_n"))


def drawdown(daily: DataFrame, symbol: str = "symbol", col: str = "close") -> DataFrame:
    """Distance from the running peak."""
    w = _w(symbol).rowsBetween(Window.unboundedPreceding, 0)
    peak = F.max(col).over(w)
    return daily.select(symbol, "trade_date", col, peak.alias("running_peak"),
                        F.when(peak > 0, _r(F.col(col) / peak - 1)).alias("drawdown"))


def zscore(daily: DataFrame, n: int = 5, symbol: str = "symbol", col: str = "close") -> DataFrame:
    """(value - trailing mean) / trailing stddev; NULL when the stddev is 0."""
    w = _rows(symbol, n)
    mean, sd, cnt = F.avg(col).over(w), F.stddev_samp(col).over(w), F.count(col).over(w)
    return daily.select(symbol, "trade_date", col,
                        F.when((cnt == n) & (sd > 0), _r((F.col(col) - mean) / sd)).alias("zscore"))


def vol_regime(daily: DataFrame, short: int = 3, long: int = 10, symbol: str = "symbol") -> DataFrame:
    """Short against long volatility of returns; equal consecutive states
    share a ``regime_id`` (running count of state changes)."""
    r = returns(daily, symbol)
    ws, wl = _rows(symbol, short), _rows(symbol, long)
    sv = F.when(F.count("ret").over(ws) == short, F.stddev_samp("ret").over(ws))
    lv = F.when(F.count("ret").over(wl) == long, F.stddev_samp("ret").over(wl))
    r = (r.withColumn("short_vol", _r(sv)).withColumn("long_vol", _r(lv))
         .withColumn("state", F.when(F.col("short_vol").isNotNull() & F.col("long_vol").isNotNull(),
                                     F.when(F.col("short_vol") > F.col("long_vol"), F.lit("high"))
                                     .otherwise(F.lit("normal")))))
    prev = F.lag("state").over(_w(symbol))
    changed = (F.when(F.col("state").isNull(), 0).when(prev.isNull(), 1)
               .when(F.col("state") != prev, 1).otherwise(0))
    r = r.withColumn("_chg", changed)
    run = F.sum("_chg").over(_w(symbol).rowsBetween(Window.unboundedPreceding, 0))
    return (r.withColumn("regime_id", F.when(F.col("state").isNotNull(), run))
            .select(symbol, "trade_date", "ret", "short_vol", "long_vol", "state", "regime_id"))


# ------------------------------------------------------- cross-sectional

def cross_rank(daily_ret: DataFrame, group: str = "category", symbol: str = "symbol",
               col: str = "ret", buckets: int = 4) -> DataFrame:
    """Rank of each symbol's value within its (day, group), equal values
    with equal ranks; the quartile breaks ties by symbol.

    Ranks are counted in two levels: how many values of the (day, group) lie in each value
    range, summed up over the ranges, and the rank inside the range.  A group of any size is
    spread over as many tasks as its values have ranges."""
    keys = ["trade_date", group]
    base = daily_ret.where(F.col(col).isNotNull()).select("trade_date", group, symbol, col,
                                                         value_range(F.col(col)).alias("_range"))
    counts = base.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_own")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*[f"_{k}" for k in keys])
    above = whole.orderBy(F.col("_own").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bounds = counts.select(*[f"_{k}" for k in keys], "_own", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"),
                           F.sum("_n").over(whole).alias("_all"))
    same = F.col("_range") == F.col("_own")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy(*keys, "_range")
    by_value = inside.orderBy(F.col(col).desc())
    placed = base.join(bounds, same).select(
        "*", (F.col("_above") + F.rank().over(by_value)).cast("int").alias("rnk"),
        (F.col("_above") + F.row_number().over(inside.orderBy(F.col(col).desc(), F.col(symbol))) - 1).alias("_place"))
    # tiles: the first (all % buckets) hold one row more than the others
    each, more = F.floor(F.col("_all") / buckets), F.col("_all") % buckets
    large = more * (each + 1)
    tile = F.when(F.col("_place") < large, F.floor(F.col("_place") / (each + 1))) \
        .otherwise(more + F.floor((F.col("_place") - large) / F.greatest(each, F.lit(1))))
    percent = F.when(F.col("_all") > 1, (F.col("rnk") - 1) / (F.col("_all") - 1)).otherwise(F.lit(0.0))
    return placed.select("trade_date", group, symbol, col, "rnk", _r(percent).alias("pct_rank"),
                         (tile + 1).cast("int").alias("quartile"))


def top_movers(daily_ret: DataFrame, k: int = 3, symbol: str = "symbol", col: str = "ret") -> DataFrame:
    """T5: the k largest absolute moves per day (Catalyst inserts a per-partition
    group limit before the shuffle)."""
    w = Window.partitionBy("trade_date").orderBy(F.abs(F.col(col)).desc(), F.col(symbol))
    return (daily_ret.where(F.col(col).isNotNull())
            .withColumn("mover_rank", F.row_number().over(w))
            .where(F.col("mover_rank") <= k)
            .select("trade_date", "mover_rank", symbol, col))


# ---------------------------------------------------------- distributions

def dist_features(bars: DataFrame, symbol: str = "symbol", col: str = "price") -> DataFrame:
    """G12 over all time, one row per symbol: see ``distribution``."""
    return distribution(bars, [symbol], col)


def period_features(bars: DataFrame, grain: str = "month", symbol: str = "symbol", ts: str = "ts",
                    col: str = "price") -> DataFrame:
    """G12 by period: the exact features and percentiles per (symbol, period)."""
    period = F.to_date(F.date_trunc(grain, F.col(ts))).alias("period")
    return distribution(bars.select(symbol, period, col), [symbol, "period"], col, PERCENTILES)


def market_index(daily_ret: DataFrame, col: str = "ret") -> DataFrame:
    """Equal-weight market return per day (one row per day)."""
    return daily_ret.where(F.col(col).isNotNull()).groupBy("trade_date").agg(F.avg(col).alias("mkt_ret"))


def benchmark_from_symbols(daily_ret: DataFrame, benchmarks: DataFrame, symbol: str = "symbol",
                           col: str = "ret") -> DataFrame:
    """Benchmark series from the dimension's benchmark-role symbols (e.g.
    ``systemic_role = 'benchmark'``): their average return per day."""
    return (daily_ret.join(benchmarks.select(symbol), symbol, "left_semi")
            .where(F.col(col).isNotNull()).groupBy("trade_date").agg(F.avg(col).alias("mkt_ret")))


def benchmark_beta(daily_ret: DataFrame, benchmark: DataFrame, symbol: str = "symbol",
                   col: str = "ret", min_days: int = 3) -> DataFrame:
    """Correlation and beta of each symbol to a benchmark series on equal trade
    dates.  Every symbol has a row: with fewer than ``min_days`` such dates both are NULL,
    and without spread in the returns so is what would divide by it."""
    return co_features(comoments(daily_ret, benchmark, None, symbol, col), [symbol], min_days)


#: Decimal digits of returns in co-moment sums, which makes them exact in any order.
STATE_DIGITS = 9


def comoments(daily_ret: DataFrame, benchmark: DataFrame, grain: str | None = "month", symbol: str = "symbol",
              col: str = "ret") -> DataFrame:
    """G13 states per symbol (and period): the number of days on which both series have a
    return, their sums, squares, products and extremes.  States add up: any months make a
    year and any years a range, without another pass over the days."""
    digits = f"decimal(18,{STATE_DIGITS})"
    both = F.col(col).isNotNull() & F.col("mkt_ret").isNotNull()
    x = F.when(both, F.col(col).cast(digits))
    y = F.when(both, round_half_away(F.col("mkt_ret"), STATE_DIGITS).cast(digits))
    period = [] if grain is None else [F.to_date(F.date_trunc(grain, "trade_date")).alias("period")]
    return (daily_ret.join(benchmark.select("trade_date", "mkt_ret"), "trade_date", "left")
            .select(symbol, *period, x.alias("_x"), y.alias("_y"))
            .groupBy(symbol, *["period"] * len(period))
            .agg(F.count("_x").alias("n"), F.sum("_x").alias("sx"), F.sum("_y").alias("sy"),
                 *[F.sum((F.col(a) * F.col(b)).cast("decimal(38,18)")).alias(name)
                   for a, b, name in (("_x", "_x", "sxx"), ("_y", "_y", "syy"), ("_x", "_y", "sxy"))],
                 F.min("_x").alias("x_low"), F.max("_x").alias("x_high"),
                 F.min("_y").alias("y_low"), F.max("_y").alias("y_high")))


def merge_comoments(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Co-moment states of coarser groups."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")],
                                     *[F.min(c).alias(c) for c in ("x_low", "y_low")],
                                     *[F.max(c).alias(c) for c in ("x_high", "y_high")])


def co_features(states: DataFrame, keys: Sequence[str], min_days: int = 3) -> DataFrame:
    """``n_days``, ``correlation`` and ``beta`` of co-moment states."""
    n, sx, sy, sxx, syy, sxy = (F.col(c).cast("double") for c in ("n", "sx", "sy", "sxx", "syy", "sxy"))
    cov, var_x, var_y = n * sxy - sx * sy, n * sxx - sx * sx, n * syy - sy * sy
    beta = (F.col("n") >= min_days) & (F.col("y_low") < F.col("y_high"))
    correlation = beta & (F.col("x_low") < F.col("x_high"))
    return states.select(*keys, F.col("n").alias("n_days"),
                         F.when(correlation, _r(cov / F.sqrt(var_x) / F.sqrt(var_y))).alias("correlation"),
                         F.when(beta, _r(cov / var_y)).alias("beta"))


def against_benchmark(bars: DataFrame, benchmark: DataFrame, symbol: str = "symbol", ts: str = "bar_start",
                      price: str = "close") -> DataFrame:
    """J6 at bar level: every bar beside the benchmark's bar at the same ``ts`` (NULL
    where the benchmark has none) and the ratio of the two prices."""
    other = benchmark.select(F.col(ts).alias("_ts"), F.col(price).alias("benchmark_price"))
    joined = bars.select(symbol, ts, price).join(other, F.col(ts) == F.col("_ts"), "left").drop("_ts")
    return joined.withColumn("ratio", F.when(F.col("benchmark_price") != 0,
                                             _rm(F.col(price) / F.col("benchmark_price"))))


# ------------------------------------------------------------- metrics cube

def metrics_cube(facts: DataFrame, dims: Sequence[str], value: str) -> DataFrame:
    """Subtotals over every subset of ``dims`` with ``grouping_id``.

    The facts are first aggregated at the finest grain (partial aggregation,
    one row per dimension combination); the cube's 2^k expansion then runs on
    that small table instead of on every fact row."""
    fine = facts.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"),
                                    F.count(value).alias("_nv"))
    return (fine.cube(*dims)
            .agg(F.grouping_id().alias("gid"), F.sum("_n").alias("n_rows"),
                 _r(F.sum("_s")).alias("sum_value"),
                 F.when(F.sum("_nv") > 0, _rm(F.sum("_s") / F.sum("_nv"))).alias("avg_value")))


def enrich(facts: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Facts with dimension attributes."""
    return join_dimension(facts, dim, on, how)


def rollup_bars(bars: DataFrame, grain: str, symbol: str = "symbol", start: str = "bar_start") -> DataFrame:
    """OHLCV bars to a coarser grain from finer bars (equal to building the
    coarse bars from the base rows)."""
    coarse = F.date_trunc(grain, F.col(start)).cast(bars.schema[start].dataType)
    return (bars.groupBy(symbol, coarse.alias("bar_start"))
            .agg(F.min_by("open", start).alias("open"), F.max("high").alias("high"),
                 F.min("low").alias("low"), F.max_by("close", start).alias("close"),
                 F.sum("volume").alias("volume"), F.sum("n_trades").alias("n_trades")))
