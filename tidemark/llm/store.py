"""Intermediate tables in the folder that all executors share
(``spark.checkpoint.dir``), and the package itself for the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark
from tidemark.session import shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, and read from there:
    cuts the lineage, and a lost executor costs a read, not a recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key with more than this part of all rows is hot.
SHARES = 1024


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], total: int) -> DataFrame:
    """The ``rows`` (``total`` of them) that ``table`` has a row for, beside its columns.
    ``table`` has one row per key, and in ``rows`` the number of rows that hold it.  Hot keys,
    fewer than ``SHARES`` by their definition, are looked up where the rows lie; any other key
    of the join holds less than one part in ``SHARES`` of the rows."""
    hot = table.where(F.col("rows") * SHARES > total).drop("rows")
    found = rows.join(F.broadcast(hot), keys)
    cold = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    return cold.join(table.where(F.col("rows") * SHARES <= total).drop("rows"), keys).unionByName(found)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, wherever the
    driver runs from.  A package that already comes from an archive is left alone."""
    sc = spark.sparkContext
    root = Path(tidemark.__file__).parent
    if getattr(sc, "_tidemark_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, Path(root.name) / source.relative_to(root))
    sc.addPyFile(str(archive))
    sc._tidemark_shipped = True
