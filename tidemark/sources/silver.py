"""Silver / Gold sinks (S13, S14): yearly partitions, symbol hash buckets.

Files are laid out by ``year`` and, inside a year, by a hash bucket of the
symbol; every file is sorted by (symbol, ts), so symbol-window jobs read
contiguous runs.  Rewrites replace whole periods (dynamic overwrite);
``rewrite_years`` therefore recomputes every year a window touches from *all* of
that year's rows (Q21).  The period is derived once, by the transform: rows are
chosen by the transformed rows' own period, so a bar whose local year differs
from its UTC year neither moves into a period that isn't rewritten nor replaces
one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 8


def _write_period(out: DataFrame, path: str, period_col: str, ts_col: str, symbol_col: str,
                  buckets: int, sort_cols: Sequence[str] | None) -> None:
    out = out.withColumn("_bucket", F.pmod(F.xxhash64(symbol_col), F.lit(buckets)))
    sort_cols = list(sort_cols) if sort_cols else [symbol_col, ts_col]
    # rebalance: AQE splits a (period, bucket) holding a hot symbol over several tasks; the
    # sort begins with the period, as the writer needs it, else it would sort anew
    (out.hint("rebalance", period_col, "_bucket").sortWithinPartitions(period_col, *sort_cols).drop("_bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(period_col).parquet(path))


def write_yearly(df: DataFrame, path: str, ts_col: str = "ts", symbol_col: str = "symbol",
                 buckets: int = DEFAULT_BUCKETS, sort_cols: Sequence[str] | None = None) -> None:
    """Year partitions (an existing ``year`` column is used as is)."""
    out = df if "year" in df.columns else df.withColumn("year", F.year(ts_col))
    _write_period(out, path, "year", ts_col, symbol_col, buckets, sort_cols)


def write_monthly(df: DataFrame, path: str, ts_col: str = "ts", symbol_col: str = "symbol",
                  buckets: int = DEFAULT_BUCKETS, sort_cols: Sequence[str] | None = None) -> None:
    """``month`` (``yyyy-MM``) partitions, for layouts rewritten a month at a time."""
    out = df if "month" in df.columns else df.withColumn("month", F.date_format(ts_col, "yyyy-MM"))
    _write_period(out, path, "month", ts_col, symbol_col, buckets, sort_cols)


def touched_years(start: date, end: date) -> list[int]:
    return list(range(start.year, end.year + 1))


def rewrite_years(source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str,
                  start: date | None = None, end: date | None = None, ts_col: str = "ts",
                  symbol_col: str = "symbol", buckets: int = DEFAULT_BUCKETS,
                  years: Sequence[int] | None = None) -> list[int]:
    """Recompute and overwrite every year in [start, end] (or ``years``) from
    all source rows of those years.  The source is pruned to these years and a
    day around them (time zones); the rows written are those whose own ``year``
    is in the list."""
    years = sorted(set(years)) if years is not None else touched_years(start, end)
    if not years:
        return []
    out = transform(source.where(_around(ts_col, [(date(y, 1, 1), date(y, 12, 31)) for y in years])))
    out = out if "year" in out.columns else out.withColumn("year", F.year(ts_col))
    write_yearly(out.where(F.col("year").isin(years)), path, ts_col, symbol_col, buckets)
    return years


def _around(ts_col: str, spans: Sequence[tuple[date, date]]):
    """Rows inside one of the spans or within a day of it."""
    near = F.lit(False)
    for first, last in spans:
        near = near | F.col(ts_col).between(F.lit(first - timedelta(days=1)).cast("timestamp"),
                                            F.lit(last + timedelta(days=2)).cast("timestamp"))
    return near


def write_gold(df: DataFrame, path: str, ts_col: str, symbol_col: str = "symbol",
               buckets: int = DEFAULT_BUCKETS) -> None:
    """A Gold data set, laid out as Silver (year partitions, symbol buckets)."""
    write_yearly(df, path, ts_col, symbol_col, buckets, sort_cols=[symbol_col, ts_col])


def rewrite_months(source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str,
                   months: Sequence[str], ts_col: str = "ts", symbol_col: str = "symbol",
                   buckets: int = DEFAULT_BUCKETS) -> list[str]:
    """Recompute and overwrite the given ``yyyy-MM`` partitions from all source
    rows of those months."""
    months = sorted(set(months))
    if not months:
        return []
    firsts = [date(int(m[:4]), int(m[5:7]), 1) for m in months]
    out = transform(source.where(_around(ts_col, [(f, f + timedelta(days=30)) for f in firsts])))
    if "month" not in out.columns or "month" in source.columns:
        day = "trade_date" if "trade_date" in out.columns else ts_col
        out = out.withColumn("month", F.date_format(day, "yyyy-MM"))
    write_monthly(out.where(F.col("month").isin(months)), path, ts_col, symbol_col, buckets)
    return months
