"""Distribution features (G12) for any grouping: a symbol, or a symbol and a period.

Exact form.  One scan gives the histogram (keys, value) -> count; all else comes from it.
Values are put into narrow value ranges, a fixed monotone function of the value, and each
(keys, range) becomes one row: its count and its sum about a pivot inside it.  Prefix sums
of the counts over the ranges say how many values lie before a range, so values are ranked
range by range; the sums give the mean, about which the moments are taken.  So no task
holds a symbol's rows or its distinct values, whatever the symbol's share of the table.

Sketch form.  Per (symbol, day) a quantile sketch (KLL) and a distinct-count sketch (HLL),
small and mergeable: months and years are merged from the day table without another scan
of the bars.  Ranks are off by ``RANK_ERROR`` at most with high probability, distinct
counts by ``DISTINCT_ERROR``; groups of few values are exact.

NULL values count in no feature; a group without values has ``n`` 0 and NULL features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away

#: Value ranges per e-fold: a range spans a thousandth of its values.
RANGES = 1024
#: Sketch sizes, and the errors they keep to (over 99 % of groups).
KLL_K = 400
HLL_LG_K = 12
RANK_ERROR = 0.02
DISTINCT_ERROR = 0.05
#: The percentiles of the registered queries.
PERCENTILES = {"p05": 5, "p25": 25, "p50": 50, "p75": 75, "p95": 95}


def value_range(value: Column, ranges: int = RANGES) -> Column:
    """The range of a value: ascending in the value, about ``1 / ranges`` wide in proportion
    to it, NaN (the greatest value) last."""
    size = F.floor(F.log1p(F.least(F.abs(value), F.lit(1e300)) * 1e6) * ranges).cast("bigint")
    return (F.when(F.isnan(value), F.lit(1 << 40)).when(value < 0, -1 - size).otherwise(size))


def _pivot(number: Column, ranges: int) -> Column:
    """A value inside the range, or close to it."""
    size = F.when(number < 0, -1 - number).otherwise(number)
    edge = F.expm1(size / F.lit(float(ranges))) / 1e6
    return F.when(number < 0, -edge).otherwise(edge)


def _histogram(rows: DataFrame, keys: Sequence[str], col: str, ranges: int) -> DataFrame:
    x = F.col(col).cast("double")
    counts = rows.select(*keys, x.alias("_v")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return counts.withColumn("_range", value_range(F.col("_v"), ranges))


def _bounds(histogram: DataFrame, keys: Sequence[str], ranges: int) -> DataFrame:
    """Per (keys, range): the values before it, and the count and the mean of the whole group."""
    pivot, c = _pivot(F.col("_range"), ranges), F.col("_c")
    held = F.col("_v").isNotNull()
    per_range = histogram.groupBy(*keys, "_range").agg(F.sum(F.when(held, c).otherwise(0)).alias("_n"),
                                                       F.sum(c * (F.col("_v") - pivot)).alias("_s"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.when(F.col("_n") > 0, pivot * F.col("_n") + F.col("_s"))).over(whole)
    return per_range.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_range").alias("_own"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                            F.sum("_n").over(whole).alias("_all"),
                            (total / F.nullif(F.sum("_n").over(whole), F.lit(0))).alias("_mean"))


def distribution(rows: DataFrame, keys: Sequence[str], col: str = "price",
                 percents: Mapping[str, int] | None = None, ranges: int = RANGES) -> DataFrame:
    """G12 per ``keys``: ``n``, ``mean``, ``stddev``, population ``skewness`` and excess
    ``kurtosis`` (NULL without spread), ``min_value``, ``max_value``, ``n_distinct`` and a
    column per entry of ``percents`` (name -> whole percent; discrete, lower), all exact."""
    percents = {"median": 50} if percents is None else percents
    histogram = _histogram(rows, keys, col, ranges)
    same = F.col("_range").eqNullSafe(F.col("_own"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_range").orderBy("_v"))
    placed = histogram.join(_bounds(histogram, keys, ranges), same).withColumn("_upto", upto)
    v, d = F.col("_v"), F.col("_v") - F.col("_mean")
    # the rank of a percentile, rounded up
    rank = {name: F.greatest(F.floor((F.col("_all") * p + 99) / 100), F.lit(1)) for name, p in percents.items()}
    out = placed.groupBy(*keys).agg(
        F.max("_all").alias("n"), F.max("_mean").alias("_mean"),
        *[F.sum(F.col("_c") * F.pow(d, F.lit(float(k)))).alias(f"_m{k}") for k in (2, 3, 4)],
        F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.count(v).alias("n_distinct"),
        *[F.min(F.when(v.isNotNull() & (F.col("_upto") >= rank[name]), v)).alias(name) for name in percents])
    spread = (F.col("min_value") < F.col("max_value")) & (F.col("_m2") > 0)
    n, m2 = F.nullif(F.col("n"), F.lit(0)), F.col("_m2")
    var = m2 / n
    return out.select(
        *keys, "n", round_half_away(F.col("_mean"), 9).alias("mean"),
        F.when(n > 1, F.when(spread, round_half_away(F.sqrt(m2 / (n - 1)), 6)).otherwise(F.lit(0.0))).alias("stddev"),
        F.when(spread, round_half_away(F.col("_m3") / n / F.pow(var, F.lit(1.5)), 6)).alias("skewness"),
        F.when(spread, round_half_away(F.col("_m4") / n / (var * var) - 3, 6)).alias("kurtosis"),
        "min_value", "max_value", *percents, "n_distinct")


# ------------------------------------------------------------------ sketches

def day_sketches(bars: DataFrame, symbol: str = "symbol", ts: str = "ts", col: str = "price",
                 k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """One row per (symbol, trade_date): ``n``, the quantile sketch and the distinct sketch
    of the day's values (NULL sketches where the day has none).  Partially aggregated
    before the shuffle, so what travels per hot symbol is one sketch a task and day."""
    x = F.col(col).cast("double")
    return bars.groupBy(symbol, F.to_date(ts).alias("trade_date")).agg(
        F.count(x).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("quantiles"),
        # a sketch hashes text: equal values are equal text
        F.hll_sketch_agg(x.cast("string"), lg_k).alias("distincts"))


def merge_sketches(days: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Day (or coarser) sketches merged to any grouping of them."""
    held = F.col("n") > 0
    return days.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double(F.when(held, F.col("quantiles"))).alias("quantiles"),
        F.hll_union_agg(F.when(held, F.col("distincts"))).alias("distincts"))


def sketch_features(sketches: DataFrame, percents: Mapping[str, int] | None = None) -> DataFrame:
    """Percentiles and the approximate distinct count of sketch rows, in place of the
    sketches; NULL and 0 for a group without values."""
    percents = PERCENTILES if percents is None else percents
    keys = [c for c in sketches.columns if c not in ("n", "quantiles", "distincts")]
    held = F.col("n") > 0
    return sketches.select(*keys, "n", *[
        F.when(held, F.kll_sketch_get_quantile_double("quantiles", F.lit(p / 100.0))).alias(name)
        for name, p in percents.items()],
        F.when(held, F.hll_sketch_estimate("distincts")).otherwise(F.lit(0)).alias("approx_distinct"))


def sketch_errors(rows: DataFrame, features: DataFrame, keys: Sequence[str], col: str,
                  percents: Mapping[str, int] | None = None, rank_error: float = RANK_ERROR,
                  distinct_error: float = DISTINCT_ERROR) -> DataFrame:
    """Per group of ``features``: ``n``, and whether every percentile's rank among the exact
    values (``ranks_ok``) and the distinct count (``distinct_ok``) keep to the errors."""
    percents = PERCENTILES if percents is None else percents
    x = F.col(col).cast("double")
    # per distinct value, so that one pass serves ranks and distinct counts
    counts = rows.where(F.col(col).isNotNull()).groupBy(*keys, x.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    names = {k: f"_f_{k}" for k in keys}
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(names[k]))
    joined = features.withColumnsRenamed(names).join(counts, same, "left")
    held = joined.groupBy(*names.values(), "n", "approx_distinct").agg(
        F.count("_v").alias("_distinct"),
        *[F.coalesce(F.sum(F.when(side, F.col("_c"))), F.lit(0)).alias(name + p) for p in percents
          for side, name in ((F.col("_v") < F.col(p), "_below_"), (F.col("_v") <= F.col(p), "_upto_"))])
    ok = F.lit(True)
    for p, percent in percents.items():
        n, share = F.col("n"), percent / 100
        ok = ok & (F.col(f"_below_{p}") <= (share + rank_error) * n) & (F.col(f"_upto_{p}") >= (share - rank_error) * n)
    off = F.abs(F.col("approx_distinct") - F.col("_distinct"))
    return held.select(*[F.col(n).alias(k) for k, n in names.items()], "n", ok.alias("ranks_ok"),
                       (off <= distinct_error * F.col("_distinct")).alias("distinct_ok"))
