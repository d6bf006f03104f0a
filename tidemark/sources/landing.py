"""Landed raw vendor documents (S7-S9 re-aimed): one file per request key.

The reference stores each response as ``.../symbol=<s>/month=<m>/raw.json``.
Reading the folder with ``wholetext`` gives one row per file (the whole
document, newlines included), the key from the Hive-style path, and the file
modification time as ``ingested_at``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def land_raw(docs: DataFrame, path: str, partition_cols: Sequence[str] = ("symbol", "month"),
             body_col: str = "body") -> None:
    """Write one raw document per key (dynamic overwrite of the touched keys).

    Each key must carry exactly one document, as a vendor response does: a key with several
    is refused before anything is written.  The text writer ends the file with one line
    separator.
    """
    cols = list(partition_cols)
    twice = docs.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
    if twice is not None:
        raise ValueError(f"{twice['_n']} documents for {[twice[c] for c in cols]}: one document per key")
    (docs.select(*cols, body_col).repartition(*cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*cols).text(path))


def read_landed(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``<partition columns>, body, file_path, ingested_at`` — one row per file."""
    df = spark.read.option("pathGlobFilter", glob).option("basePath", path).text(path, wholetext=True)
    # files landed by ``land_raw`` end with the text writer's line separator
    return (df.withColumn("body", F.regexp_replace("value", "\n$", "")).drop("value")
            .withColumn("file_path", F.col("_metadata.file_path"))
            .withColumn("ingested_at", F.col("_metadata.file_modification_time")))
