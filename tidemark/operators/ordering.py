"""Exact dense row positions without a global window over rows (used by O3 / T1 / T4).

``row_number() OVER (ORDER BY k)`` without a partition moves every row into one
task.  Instead the rows are range-partitioned and sorted, and written once below
the shared folder, which freezes their order: file k of the copy holds the k-th
range.  A row's position is then its index in its file (the scan's own metadata)
plus the rows of all files before, a running sum over one row per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir


def _positions(scan: DataFrame, index_col: str, file_order: Column) -> DataFrame:
    keyed = scan.withColumn("_file", F.col("_metadata.file_path")).withColumn("_row", F.col("_metadata.row_index"))
    sizes = keyed.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    before = Window.orderBy(file_order, "_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (keyed.join(offsets, "_file")
            .withColumn(index_col, (F.col("_offset") + F.col("_row")).cast("bigint"))
            .drop("_file", "_row", "_offset"))


def with_row_index(df: DataFrame, order_by: Sequence[str], index_col: str = "row_idx") -> DataFrame:
    """Add ``index_col`` = 0-based position of each row in ``order_by`` order.

    ``order_by`` must be a total order (append tie-breakers if the key repeats).
    """
    spark = df.sparkSession
    cols = [F.col(c) for c in order_by]
    path = shared_dir(spark, "ordered")
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.parquet(path)
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("bigint")
    return _positions(spark.read.schema(df.schema).parquet(path), index_col, number)


def with_file_order(df: DataFrame, index_col: str = "file_idx") -> DataFrame:
    """Position in file order (T4) for a Parquet scan that nothing has been filtered
    from: files by path, rows by their index within the file."""
    return _positions(df, index_col, F.col("_file"))
