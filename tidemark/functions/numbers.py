"""Output rounding that engines reproduce exactly.

``round_half_away(x, d)`` is ``sign(x) * round(|x| * 10^d) / 10^d`` evaluated
in double arithmetic: nearest value, ties away from zero, on the scaled double
— the definition SQL engines commonly implement for DOUBLE (including the
sign of a zero).  Spark's own ``round`` applies HALF_UP to the exact binary
expansion of ``x`` instead, which disagrees on values a hair from a tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c: Column, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    return F.signum(c) * F.round(F.abs(c) * scale, 0) / scale
