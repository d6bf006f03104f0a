"""Storage keys, URIs and diagnostic text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.months import col_of

# The Bronze layout below the prefix, and the raw file name.
BRONZE_SOURCE = "alpha_vantage"
INTRADAY_DATASET = "intraday_1min"
RAW_FILE = "raw.json"
URI_PATTERN = r"^s3://([^/]*)/(.*)$"
# Diagnostic clips of a response body.
CLIP_LONG = 300


def bronze_key(symbol, month, prefix="data") -> Column:
    """``<prefix>/<source>/intraday_1min/symbol=<s>/month=<m>/raw.json``."""
    return F.concat_ws(
        "/",
        F.regexp_replace(col_of(prefix) if not isinstance(prefix, str) else F.lit(prefix), "/+$", ""),
        F.lit(BRONZE_SOURCE),
        F.lit(INTRADAY_DATASET),
        F.concat(F.lit("symbol="), col_of(symbol)),
        F.concat(F.lit("month="), col_of(month)),
        F.lit(RAW_FILE),
    )


def object_uri(bucket, key) -> Column:
    """``s3://bucket/key``."""
    return F.concat(F.lit("s3://"), col_of(bucket), F.lit("/"), col_of(key))


def uri_bucket(uri) -> Column:
    """bucket part; NULL when the text is not an ``s3://b/k`` URI."""
    u = col_of(uri)
    return F.when(u.rlike(URI_PATTERN), F.regexp_extract(u, URI_PATTERN, 1))


def uri_key(uri) -> Column:
    """key part (everything after the first ``/`` behind the bucket)."""
    u = col_of(uri)
    return F.when(u.rlike(URI_PATTERN), F.regexp_extract(u, URI_PATTERN, 2))


def file_stamp(ts) -> Column:
    """F16: ISO-8601 UTC text of ``ts`` with ``:`` replaced by ``-``.

    Microseconds are printed only when non-zero, as an ISO formatter does.
    """
    t = col_of(ts)
    micros = F.date_format(t, "SSSSSS")
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    iso = F.concat(base, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")),
                   F.lit("+00:00"))
    return F.replace(iso, F.lit(":"), F.lit("-"))


def snapshot_file(ts) -> Column:
    """S5/S6 file name ``raw_<stamp>.json``."""
    return F.concat(F.lit("raw_"), file_stamp(ts), F.lit(".json"))


def join_errors(*errors) -> Column:
    """non-NULL messages joined with `` | `` (NULL when all are NULL)."""
    joined = F.concat_ws(" | ", *[col_of(e) for e in errors])
    return F.when(joined != "", joined)


def clip(body, n: int = CLIP_LONG) -> Column:
    """first ``n`` characters of a body."""
    return F.substring(col_of(body), 1, n)
