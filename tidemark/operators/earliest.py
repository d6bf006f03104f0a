"""Earliest month per symbol from monthly-adjusted payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payloads as P
from tidemark.operators.classify import DOCUMENT, MONTHLY, classify

NO_SERIES = "No time series"


def earliest_month(responses: DataFrame, symbol: str = "symbol", status_col: str = "status_code",
                   content_type_col: str = "content_type", body_col: str = "body") -> DataFrame:
    """``symbol, earliest_month, ok, error`` — one shuffle-free pass.

    A failed response passes its error through; an accepted one without a
    non-empty series gives ``No time series``; otherwise the smallest date key
    cut to ``yyyy-MM`` (``array_min`` of the keys, no sort).
    """
    c = classify(responses, MONTHLY, status_col, content_type_col, body_col, diagnostics=False, keep_document=True)
    month, ok, error = earliest_columns()
    return c.select(symbol, month.alias("earliest_month"), ok.alias("ok"), error.alias("error"))


def earliest_columns(document_col: str = DOCUMENT, ok_col: str = "ok", error_col: str = "error"):
    """(earliest month, ok, error) for rows classified as monthly, with their documents."""
    dates = P.key_names(document_col, P.MONTHLY_SERIES_KEY)
    empty = dates.isNull() | (F.size(dates) == 0)
    ok = F.col(ok_col) & ~empty
    error = F.when(~F.col(ok_col), F.col(error_col)).when(empty, F.lit(NO_SERIES))
    return F.when(ok, F.substring(F.array_min(dates), 1, 7)), ok, error
