"""Symbol dimension reader.

The file is a header CSV with doubled quotes inside quoted fields.  Columns are
found by their header names, in whatever order and whatever others there are;
every column is read as text (no inference: ``yyyy-MM`` would become a timestamp)
and then projected to types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import months as M

# The dimension's columns, in file order.
DIM_COLUMNS = ("symbol", "name", "asset_type", "market", "category", "risk_group", "liquidity_class",
               "systemic_role", "narrative_role", "bubble_history", "narrative_exposure",
               "data_priority", "start_date", "shock_history")
TAG_COLUMNS = ("bubble_history", "narrative_exposure", "shock_history")
REQUIRED = ("symbol", "start_date")


def read_dimension_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the header as text; files whose headers differ are refused
    by the reader (``enforceSchema`` off checks every file against the first)."""
    return (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
            .option("escape", '"').option("multiLine", False).option("mode", "PERMISSIVE").csv(path))


def check_required(df: DataFrame, required: Sequence[str] = REQUIRED) -> None:
    """A schema check, no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"dimension must contain columns {list(required)}; missing {missing}")


def parse_tags(c) -> "F.Column":
    """JSON array text -> array<string> (NULL on bad text)."""
    return F.from_json(M.col_of(c), "array<string>")


def typed_dimension(df: DataFrame) -> DataFrame:
    """Projection to types: stripped symbol, tag arrays, int priority, month date."""
    check_required(df)
    out = df.withColumn("symbol", M.strip("symbol"))
    for c in TAG_COLUMNS:
        if c in df.columns:
            out = out.withColumn(c, parse_tags(c))
    if "data_priority" in df.columns:
        out = out.withColumn("data_priority", M.strip("data_priority").try_cast("int"))
    return out.withColumn("first_month", M.month_start("start_date"))


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return typed_dimension(read_dimension_text(spark, path))


def explode_tags(dim: DataFrame, tag_col: str, key_col: str = "symbol") -> DataFrame:
    """One row per (key, position, tag); a key with no tag keeps one NULL row."""
    arr = dim[tag_col] if isinstance(dim.schema[tag_col].dataType, T.ArrayType) else parse_tags(tag_col)
    return dim.select(key_col, F.posexplode_outer(arr).alias("tag_pos", "tag"))
