"""Silver: normalise payloads into typed bars, validate, deduplicate
(F21, O2, P17, W8, W9, U4).

Deduplication is a keyed ``max`` over a struct whose leading fields are the
ordering (newest first) — an aggregate with a map-side partial step, so a key
holding a third of all rows is collapsed before the shuffle instead of being
sorted in one task as a ``row_number`` window would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import months as M

# Fixed values (assumed vendor layout; parameters of normalize_bars): the key
# of the dated series and the field names inside each bar.
SERIES_KEY = "Time Series (1min)"
FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close",
          "volume": "5. volume"}
PRICE_TYPE = "decimal(18,6)"

VIOLATIONS = ("null_key", "bad_price", "low_above_min", "high_below_max", "bad_volume",
              "month_mismatch")


def bar_document(ts: Column, open_: Column, high: Column, low: Column, close: Column,
                 volume: Column, series_key: str = SERIES_KEY, fields=None) -> Column:
    """Vendor-shaped JSON text of bars: ``{series: {"ts": {"1. open": "..", ...}}}``."""
    f = fields or FIELDS
    bar = F.struct(open_.cast("string").alias(f["open"]), high.cast("string").alias(f["high"]),
                   low.cast("string").alias(f["low"]), close.cast("string").alias(f["close"]),
                   volume.cast("string").alias(f["volume"]))
    key = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.to_json(F.struct(F.create_map(key, bar).alias(series_key)))


def normalize_bars(docs: DataFrame, symbol_col: str = "symbol", body_col: str = "body",
                   series_key: str = SERIES_KEY, fields=None, price_type: str = PRICE_TYPE,
                   keep: Sequence[str] = (), source_tz: str = "UTC") -> DataFrame:
    """Explode the dated series of each document into typed bars.

    Text that does not convert becomes NULL (``try_cast``), for validation to
    quarantine.  Bar times are wall-clock times in ``source_tz`` (the vendor's
    zone is a parameter); ``ts`` is stored in UTC and ``trade_date`` is the
    local trading date.
    """
    f = fields or FIELDS
    bar_t = ", ".join(f"`{v}`: string" for v in f.values())
    parsed = F.from_json(F.col(body_col), f"struct<`{series_key}`: map<string, struct<{bar_t}>>>",
                         {"allowSingleQuotes": "false"})
    exploded = docs.select(symbol_col, *keep, F.explode(parsed[series_key]).alias("_ts", "_bar"))
    wall = F.try_to_timestamp(F.col("_ts"))
    ts = wall if source_tz == "UTC" else F.to_utc_timestamp(wall, source_tz)
    out = exploded.select(
        symbol_col, *keep, ts.alias("ts"),
        *[F.col("_bar")[f[k]].try_cast(price_type).alias(k) for k in ("open", "high", "low", "close")],
        F.col("_bar")[f["volume"]].try_cast("bigint").alias("volume"))
    local = F.col("ts") if source_tz == "UTC" else F.from_utc_timestamp(F.col("ts"), source_tz)
    return (out.withColumn("trade_date", F.to_date(local))
            .withColumn("year", F.year(local))
            .withColumn("month", M.month_key(local)))


def violations(symbol: str = "symbol", ts: str = "ts", part_month: str | None = "month",
               day: str | None = None) -> Column:
    """Array of rule names a bar breaks (empty when valid).  ``day`` is the local
    trading date, where the partition month is a local one and ``ts`` is UTC."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    rules = [
        (F.col(symbol).isNull() | F.col(ts).isNull(), "null_key"),
        (~F.coalesce((o > 0) & (h > 0) & (lo > 0) & (c > 0), F.lit(False)), "bad_price"),
        (F.coalesce(lo > F.least(o, c), F.lit(False)), "low_above_min"),
        (F.coalesce(h < F.greatest(o, c), F.lit(False)), "high_below_max"),
        (~F.coalesce(F.col("volume") >= 0, F.lit(False)), "bad_volume"),
    ]
    if part_month:
        rules.append((F.coalesce(M.month_key(day or ts) != F.col(part_month), F.lit(False)), "month_mismatch"))
    arr = F.array(*[F.when(cond, F.lit(name)) for cond, name in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def validate_bars(bars: DataFrame, symbol: str = "symbol", ts: str = "ts",
                  part_month: str | None = "month", day: str | None = None) -> DataFrame:
    return (bars.withColumn("violations", violations(symbol, ts, part_month, day))
            .withColumn("is_valid", F.size("violations") == 0))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and the quarantine (good + quarantine = input)."""
    return (validated.where(F.col("is_valid")).drop("violations", "is_valid"),
            validated.where(~F.col("is_valid")))


def dedup_latest(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_desc`` (newest wins;
    later columns break ties).  NULLs lose to values."""
    keys = list(keys)
    order = list(order_desc)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_best")
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return agg.select(*keys, *[F.col("_best")[c].alias(c) for c in order + rest]).select(*df.columns)


def union_reingested(old: DataFrame, new: DataFrame) -> DataFrame:
    """U4: old and re-ingested rows before deduplication."""
    return old.unionByName(new, allowMissingColumns=True)
