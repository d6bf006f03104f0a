"""Exact windows over raw (intraday) bars without per-symbol partitions
(W1-W5, W7 and sessions at bar level).

A window partitioned by symbol alone puts a symbol's whole history in one
task.  Here windows are partitioned by (symbol, time bucket); each bucket is
given a *halo* — copies of the rows that precede it and fall inside the frame
— so every frame is complete, and halo rows are dropped after the window.

* rows frame of ``n`` bars: the halo of bucket ``i`` is the last ``n - 1`` rows
  before it.  Each bucket's last ``n - 1`` rows are gathered into an array, a
  window over this small table (one row per bucket) hands each bucket the arrays
  before it, and their last ``n - 1`` rows are added to the bucket: two scans,
  no join, and rows with a NULL symbol or time stay (a NULL time sorts first).
* time-span frame: with buckets at least as long as the span, the halo of a
  bucket is the rows of the preceding bucket within ``span`` of its start.

``with_row_buckets`` cuts every symbol into buckets of about equally many rows, from
counts per time slot, so window partitions hold a bounded number of rows plus a bounded
halo, whatever the symbol's share of the data; any ascending function of the time may
serve as well.  Row order is (ts, ``tiebreak``): pass a tie-breaker (a trade sequence)
when timestamps repeat within a symbol.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away
from tidemark.operators.gold import trade_order

ROUND_MEAN = 9
ROUND = 6


#: Rows of a bucket: a window partition that sorts in memory.
BUCKET_ROWS = 50_000
BUCKET = "_rows_bucket"


def with_row_buckets(df: DataFrame, symbol: str = "symbol", ts: str = "ts", rows: int = BUCKET_ROWS,
                     slot: str = "minute") -> DataFrame:
    """``df`` with ``_rows_bucket``: consecutive time slots of a symbol, ``rows`` rows in all and
    less than one slot's rows beyond that.  The slots' counts are a partial aggregate, and
    their prefix sums a window over one row per slot; rows find their bucket by
    (symbol, slot), so that no key of the join holds more than a slot.  A NULL time is a
    slot of its own, before all others."""
    if rows < 1:
        raise ValueError("rows must be >= 1")
    slotted = df.withColumn("_slot", F.date_trunc(slot, F.col(ts)))
    counts = slotted.groupBy(F.col(symbol).alias("_symbol"), F.col("_slot").alias("_at")) \
        .agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("_symbol").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    bounds = counts.select("_symbol", "_at",
                           F.floor(F.coalesce(F.sum("_c").over(before), F.lit(0)) / rows).cast("bigint").alias(BUCKET))
    same = F.col(symbol).eqNullSafe(F.col("_symbol")) & F.col("_slot").eqNullSafe(F.col("_at"))
    return slotted.join(bounds, same).select(*df.columns, BUCKET)


def in_row_buckets(df: DataFrame, run: Callable[[DataFrame, Column], DataFrame], symbol: str = "symbol", ts: str = "ts",
                   rows: int = BUCKET_ROWS, slot: str = "minute") -> DataFrame:
    """``run(df, bucket)`` over row-balanced buckets, without the bucket column in its result."""
    return run(with_row_buckets(df, symbol, ts, rows, slot), F.col(BUCKET)).drop(BUCKET)


def _order(ts: str, tiebreak: str | None, desc: bool = False) -> list[Column]:
    cols = [ts] + ([tiebreak] if tiebreak else [])
    return [F.col(c).desc() if desc else F.col(c) for c in cols]


def _stats(value: str, w, n: int | None) -> list[Column]:
    full = F.count(value).over(w) == n if n else F.lit(True)
    return [F.when(full, round_half_away(F.avg(value).over(w), ROUND_MEAN)).alias("roll_mean"),
            F.when(full, round_half_away(F.stddev_samp(value).over(w), ROUND)).alias("roll_std"),
            F.when(full, F.min(value).over(w)).alias("roll_min"),
            F.when(full, F.max(value).over(w)).alias("roll_max")]


def with_row_halo(df: DataFrame, n: int, symbol: str, ts: str, bucket: Column,
                  tiebreak: str | None = None) -> DataFrame:
    """``df`` plus, for every (symbol, bucket), copies of the last ``n - 1`` rows
    that precede the bucket; adds ``_b`` (bucket) and ``_halo`` (copy flag)."""
    base = df.withColumn("_b", bucket)
    if n <= 1:
        return base.withColumn("_halo", F.lit(False))
    # each bucket's last rows as one bounded array (the row limit is taken before the shuffle)
    latest = Window.partitionBy(symbol, "_b").orderBy(*_order(ts, tiebreak, True))
    tails = (base.withColumn("_rd", F.row_number().over(latest)).where(F.col("_rd") <= n - 1)
             .groupBy(symbol, "_b")
             .agg(F.sort_array(F.collect_list(F.struct((-F.col("_rd")).alias("k"), F.struct(*df.columns).alias("r"))))
                  .alias("_tail")))
    # the rows before a bucket: every bucket holds one at least, so n - 1 buckets reach far enough
    before = Window.partitionBy(symbol).orderBy("_b").rowsBetween(-(n - 1), -1)
    reach = F.flatten(F.collect_list("_tail").over(before))
    halo = (tails.select("_b", reach.alias("_reach"))
            .select("_b", F.explode(F.slice("_reach", F.greatest(F.size("_reach") - n + 2, F.lit(1)), n - 1)).alias("_x"))
            .select(*[F.col("_x.r")[c].alias(c) for c in df.columns], "_b", F.lit(True).alias("_halo")))
    return base.withColumn("_halo", F.lit(False)).unionByName(halo)


def over_last_rows(df: DataFrame, n: int, symbol: str, ts: str, bucket: Column,
                   exprs: Callable[[Window], list[Column]], frame: bool = True,
                   tiebreak: str | None = None) -> DataFrame:
    """Any window expressions reaching at most ``n - 1`` bars back, in
    (symbol, bucket) partitions.  ``exprs`` receives the frame of the last ``n``
    bars, or (``frame=False``) the ordered partition spec to build its own
    frames / offsets no wider than that."""
    if n < 1:
        raise ValueError("n must be >= 1")
    rows = with_row_halo(df, n, symbol, ts, bucket, tiebreak)
    spec = Window.partitionBy(symbol, "_b").orderBy(*_order(ts, tiebreak))
    w = spec.rowsBetween(-(n - 1), 0) if frame else spec
    return (rows.select(*df.columns, "_halo", *exprs(w))
            .where(~F.col("_halo")).drop("_halo"))


def rolling_rows(df: DataFrame, n: int, symbol: str, ts: str, value: str, bucket: Column,
                 tiebreak: str | None = None) -> DataFrame:
    """Mean / stddev / min / max over the last ``n`` bars of each symbol (NULL
    until ``n`` bars), computed in (symbol, bucket) partitions."""
    return over_last_rows(df, n, symbol, ts, bucket, lambda w: _stats(value, w, n), tiebreak=tiebreak)


def zscore(df: DataFrame, n: int, symbol: str, ts: str, value: str, bucket: Column,
           tiebreak: str | None = None) -> DataFrame:
    """W5 at bar level: (value - mean of the last n bars) / their stddev; NULL
    until n bars or when the stddev is 0."""
    def exprs(w):
        mean, sd, cnt = F.avg(value).over(w), F.stddev_samp(value).over(w), F.count(value).over(w)
        return [F.when((cnt == n) & (sd > 0), round_half_away((F.col(value) - mean) / sd, ROUND)).alias("zscore")]
    return over_last_rows(df, n, symbol, ts, bucket, exprs, tiebreak=tiebreak)


def returns(df: DataFrame, symbol: str, ts: str, value: str, bucket: Column,
            tiebreak: str | None = None) -> DataFrame:
    """W1 at bar level: simple and log return against the previous bar (a
    one-row halo carries the previous bucket's last bar)."""
    rows = with_row_halo(df, 2, symbol, ts, bucket, tiebreak)
    prev = F.lag(value).over(Window.partitionBy(symbol, "_b").orderBy(*_order(ts, tiebreak)))
    c, p = F.col(value), F.col("_prev")
    return (rows.withColumn("_prev", prev).where(~F.col("_halo"))
            .select(*df.columns,
                    F.when(p > 0, round_half_away(c / p - 1, ROUND)).alias("ret"),
                    F.when((p > 0) & (c > 0), round_half_away(F.log(c / p), ROUND)).alias("log_ret")))


def running(df: DataFrame, symbol: str, ts: str, value: str, bucket: Column, how: str = "max",
            tiebreak: str | None = None) -> DataFrame:
    """Running aggregate from the first bar (``max``, ``min`` or ``sum``) as a
    two-level scan: per-bucket aggregates, their prefix over the per-symbol
    bucket table (bounded by the calendar), then the running value inside each
    bucket.  Returns ``df`` with column ``running_<how>``."""
    agg = {"max": F.max, "min": F.min, "sum": F.sum}[how]
    base = df.withColumn("_b", bucket)
    per_bucket = base.groupBy(symbol, "_b").agg(agg(value).alias("_bv"))
    prior = per_bucket.select(
        symbol, "_b",
        agg("_bv").over(Window.partitionBy(symbol).orderBy("_b")
                        .rowsBetween(Window.unboundedPreceding, -1)).alias("_prior"))
    inside = agg(value).over(Window.partitionBy(symbol, "_b").orderBy(*_order(ts, tiebreak))
                             .rowsBetween(Window.unboundedPreceding, 0))
    if how == "max":
        combined = F.greatest(F.col("_prior"), F.col("_in"))
    elif how == "min":
        combined = F.least(F.col("_prior"), F.col("_in"))
    else:
        combined = F.coalesce(F.col("_prior"), F.lit(0)) + F.col("_in")
    prior = prior.withColumnsRenamed({symbol: "_symbol", "_b": "_bucket"})
    same = F.col(symbol).eqNullSafe(F.col("_symbol")) & F.col("_b").eqNullSafe(F.col("_bucket"))
    return (base.withColumn("_in", inside).join(prior, same, "left")
            .select(*df.columns, combined.alias(f"running_{how}")))


def drawdown(df: DataFrame, symbol: str, ts: str, value: str, bucket: Column,
             tiebreak: str | None = None) -> DataFrame:
    """W4 at bar level: distance of each bar from the running peak."""
    r = running(df, symbol, ts, value, bucket, "max", tiebreak)
    peak = F.col("running_max")
    return r.select(*df.columns, peak.alias("running_peak"),
                    F.when(peak > 0, round_half_away(F.col(value) / peak - 1, ROUND)).alias("drawdown"))


def rolling_span(df: DataFrame, span_seconds: int, symbol: str, ts: str, value: str,
                 bucket_seconds: int = 86400) -> DataFrame:
    """Mean / count over ``[ts - span, ts]`` (a RANGE frame), computed in
    (symbol, bucket) partitions."""
    if bucket_seconds < span_seconds:
        raise ValueError("buckets must be at least as long as the span")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    b = F.floor(micros / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
    base = df.withColumn("_us", micros).withColumn("_b", b).withColumn("_halo", F.lit(False))
    next_start = (F.col("_b") + 1) * F.lit(bucket_seconds * 1_000_000)
    halo = (base.where(F.col("_us") >= next_start - F.lit(span_seconds * 1_000_000))
            .withColumn("_b", F.col("_b") + 1).withColumn("_halo", F.lit(True)))
    w = Window.partitionBy(symbol, "_b").orderBy("_us").rangeBetween(-span_seconds * 1_000_000, 0)
    return (base.unionByName(halo)
            .select(*df.columns, "_halo", round_half_away(F.avg(value).over(w), ROUND_MEAN).alias("span_mean"),
                    F.count(value).over(w).alias("span_n"))
            .where(~F.col("_halo")).drop("_halo"))


def vol_regime(df: DataFrame, short: int, long: int, symbol: str, ts: str, value: str,
               bucket: Column, tiebreak: str | None = None) -> DataFrame:
    """W7 at bar level: short against long volatility of bar returns, and a
    ``regime_id`` counting state changes from the first bar.

    One halo serves the whole chain: a bar's state change looks back at the
    previous bar's state, whose volatility frame reaches ``long`` returns back,
    the oldest of which needs one more price — ``long + 1`` preceding bars.
    Every window runs in the same (symbol, bucket) partitions; the running
    count is a two-level scan.  Halo rows only feed frames and are dropped.
    """
    depth = max(short, long) + 1
    rows = with_row_halo(df, depth + 1, symbol, ts, bucket, tiebreak)
    spec = Window.partitionBy(symbol, "_b").orderBy(*_order(ts, tiebreak))
    ws, wl = spec.rowsBetween(-(short - 1), 0), spec.rowsBetween(-(long - 1), 0)
    prev = F.lag(value).over(spec)
    r = rows.withColumn("_prev", prev).withColumn(
        "ret", F.when(F.col("_prev") > 0, round_half_away(F.col(value) / F.col("_prev") - 1, ROUND)))
    r = (r.withColumn("short_vol", F.when(F.count("ret").over(ws) == short,
                                          round_half_away(F.stddev_samp("ret").over(ws), ROUND)))
         .withColumn("long_vol", F.when(F.count("ret").over(wl) == long,
                                        round_half_away(F.stddev_samp("ret").over(wl), ROUND)))
         .withColumn("state", F.when(F.col("short_vol").isNotNull() & F.col("long_vol").isNotNull(),
                                     F.when(F.col("short_vol") > F.col("long_vol"), F.lit("high"))
                                     .otherwise(F.lit("normal")))))
    prev_state = F.lag("state").over(spec)
    r = r.withColumn("_chg", F.when(F.col("state").isNull(), 0).when(prev_state.isNull(), 1)
                     .when(F.col("state") != prev_state, 1).otherwise(0))
    cols = [*df.columns, "ret", "short_vol", "long_vol", "state", "_chg"]
    c = r.where(~F.col("_halo")).select(*cols)
    out = running(c, symbol, ts, "_chg", bucket, "sum", tiebreak)
    return (out.withColumn("regime_id", F.when(F.col("state").isNotNull(), F.col("running_sum")))
            .drop("_chg", "running_sum"))


def session_bars(df: DataFrame, gap_seconds: int, symbol: str, ts: str, price: str, volume: str,
                 bucket: Column, tiebreak: str | None = None) -> DataFrame:
    """OHLCV per activity session: a session starts at a symbol's first trade
    and after every pause longer than ``gap_seconds`` (a trade exactly one gap
    after the previous one continues the session, as ``session_window`` does).

    Exact and hot-key safe: session starts are flagged with a one-trade halo in
    (symbol, bucket) partitions, numbered by a two-level running count, and the
    sessions are aggregated with a partial step before the shuffle (a long
    session of a hot symbol is a single group key, collapsed map-side)."""
    rows = with_row_halo(df, 2, symbol, ts, bucket, tiebreak)
    prev = F.lag(ts).over(Window.partitionBy(symbol, "_b").orderBy(*_order(ts, tiebreak)))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = F.lit(gap_seconds * 1_000_000)
    flagged = (rows.withColumn("_new", F.when(prev.isNull() | (us - F.unix_micros(prev.cast("timestamp")) > gap),
                                              1).otherwise(0))
               .where(~F.col("_halo")).select(*df.columns, "_new"))
    numbered = running(flagged, symbol, ts, "_new", bucket, "sum", tiebreak)
    order = trade_order(ts, price, tiebreak)
    return (numbered.groupBy(symbol, F.col("running_sum").alias("_session"))
            .agg(F.min(ts).alias("session_start"),
                 (F.max(ts) + F.expr(f"INTERVAL {int(gap_seconds)} SECONDS")).alias("session_end"),
                 F.min_by(price, order).alias("open"), F.max(price).alias("high"),
                 F.min(price).alias("low"), F.max_by(price, order).alias("close"),
                 F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("n_trades"))
            .drop("_session"))
