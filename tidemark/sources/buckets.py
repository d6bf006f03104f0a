"""Bars laid out for work by symbol (J5, G10): tables bucketed by symbol and month.

Rollups group by symbol and period, and enrichment joins on the symbol; on a table that is
bucketed by (symbol, month) neither moves a bar again, however often it runs: the rows of a
key lie in one bucket, sorted.  The month keeps a symbol with a third of all bars in as many
buckets as it has months.  What is joined to the bars is laid out in the same way, one row
per symbol and month that the bars have, so that both sides meet bucket by bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_dir

KEYS = ("symbol", "month")
BUCKETS = 8


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str] = KEYS, buckets: int = BUCKETS,
                  sort_cols: Sequence[str] = ()) -> DataFrame:
    """``df`` written once as a bucketed table below the shared folder, and read from there.
    ``buckets`` belongs to the size of the data: some hundred MB a bucket."""
    spark = df.sparkSession
    table = f"tidemark_{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, *sort_cols) \
        .option("path", shared_dir(spark, table)).format("parquet").saveAsTable(table)
    return spark.table(table)


def with_month(bars: DataFrame, ts: str = "ts") -> DataFrame:
    return bars.withColumn("month", F.date_format(ts, "yyyy-MM"))


def dimension_by_month(bars: DataFrame, dim: DataFrame, symbol: str = "symbol", buckets: int = BUCKETS) -> DataFrame:
    """The dimension once per (symbol, month) of bucketed ``bars``, bucketed like them."""
    months = bars.select(symbol, "month").distinct()
    return save_bucketed(months.join(dim, symbol), "dimension", (symbol, "month"), buckets)
