"""Bronze sinks and readers.

Raw bodies are stored unchanged (Q15) in Parquet, partitioned Hive-style by
the document key.  A rerun replaces exactly the partitions it writes (dynamic
partition overwrite), so landing is idempotent; snapshot sinks only append,
stamped with ``ingested_at``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import join_errors


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      mode: str = "overwrite") -> None:
    """Rows of a partition key are brought together (few files per folder);
    the ``rebalance`` hint lets AQE split a skewed key over several writer
    tasks and merge small ones.  ``overwrite`` replaces only the partitions
    present in ``df``."""
    cols = list(partition_cols)
    (df.hint("rebalance", *cols).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(path))


def write_bronze(df: DataFrame, path: str, partition_cols: Sequence[str] = ("symbol", "month")) -> None:
    """S3: land documents, overwriting the touched (symbol, month) partitions."""
    write_partitioned(df, path, partition_cols, "overwrite")


def failure_text(error: Exception) -> str:
    """The first line that tells what went wrong (the bridge to the JVM puts one of its own before)."""
    lines = [line.lstrip(": ") for line in str(error).splitlines() if line.strip()]
    return next((x for x in lines if not x.startswith("An error occurred while calling")), type(error).__name__)[:200]


def save_bronze(df: DataFrame, targets: Mapping[str, str],
                partition_cols: Sequence[str] = ("symbol", "month")) -> DataFrame:
    """Write to every target, catching each failure; return the status of
    each document key: ``ok`` only when every target was written (Q1 fixed),
    ``error`` joining the failure texts with `` | ``."""
    keys = df.select(*partition_cols).distinct()
    errors = {}
    many = len(targets) > 1
    if many:  # computed once for all targets (spills to disk; recomputed from lineage if lost)
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, path in targets.items():
            try:
                write_bronze(df, path, partition_cols)
                errors[name] = None
            except Exception as exc:  # noqa: BLE001 - reported as data, like the reference
                errors[name] = f"{name} save failed: {failure_text(exc)}"
    finally:
        if many:
            df.unpersist()
    msgs = [F.lit(e).cast("string") for e in errors.values()]
    status = keys
    for name, path in targets.items():
        status = status.withColumn(f"{name}_uri", F.lit(None if errors[name] else path).cast("string"))
    return (status.withColumn("error", join_errors(*msgs))
            .withColumn("ok", F.col("error").isNull()))


def require_saved(status: DataFrame) -> None:
    """Raise if the status of ``save_bronze`` names a failure."""
    failed = status.where(~F.col("ok")).select("error").first()
    if failed is not None:
        raise RuntimeError(failed.error)


def append_snapshots(df: DataFrame, path: str, partition_col: str,
                     ingested_at=None) -> None:
    """Append-only snapshots, partitioned by the request key."""
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    out = df if "ingested_at" in df.columns else df.withColumn("ingested_at", stamp)
    write_partitioned(out, path, [partition_col], "append")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Partition columns come back as text (type inference is off)."""
    return spark.read.option("basePath", path).parquet(path)
