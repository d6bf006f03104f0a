"""Symbol search over the dimension.

The vendor search is re-aimed at our own dimension: a symbol whose lower-case
text starts with the keyword, or whose name contains it.  Keywords are a
bounded parameter list; each row is tested against each keyword in place (a
per-row generator, no join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def symbol_search(dim: DataFrame, keywords: Sequence[str], symbol_col: str = "symbol",
                  name_col: str = "name") -> DataFrame:
    kws = [k.strip().lower() for k in keywords if k and k.strip()]
    if not kws:
        raise ValueError("at least one keyword is required")
    sym, name = F.lower(F.col(symbol_col)), F.lower(F.col(name_col))
    k = F.col("keywords")
    return (dim.withColumn("keywords", F.explode(F.array(*[F.lit(x) for x in kws])))
            .where(sym.startswith(k) | name.contains(k))
            .withColumn("match", F.when(sym.startswith(k), F.lit("symbol_prefix"))
                        .otherwise(F.lit("name_contains"))))
