"""Response acceptance chain (P10-P14, F13, F18) over landed responses.

The reference decides per HTTP response, first match wins:
transport failure -> non-2xx -> content type without ``application/json`` ->
invalid JSON -> ``Note`` -> ``Error Message`` -> ok.  The monthly endpoint
tests ``Error Message`` before ``Note`` (Q10).  JSON that is valid but not an
object gets its own class ``not_object`` (Q11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payloads as P
from tidemark.functions.keys import clip
from tidemark.functions.months import col_of

INTRADAY, SEARCH, MONTHLY = "intraday", "search", "monthly"

# The error texts of each endpoint (transport, HTTP status
# prefix and suffix, content type, JSON).
MESSAGES = {
    INTRADAY: {
        "transport": "Failed to fetch data from Alpha Vantage API.",
        "http_prefix": "Alpha Vantage API returned HTTP ",
        "http_suffix": ".",
        "content_type": "Unexpected response format.",
        "invalid_json": "Invalid JSON from Alpha Vantage API.",
    },
    SEARCH: {
        "transport": "Network error during symbol search.",
        "http_prefix": "HTTP ",
        "http_suffix": "",
        "content_type": "Unexpected response format.",
        "invalid_json": "Invalid JSON from Alpha Vantage API.",
    },
    MONTHLY: {
        "transport": "Failed to fetch monthly adjusted data.",
        "http_prefix": "HTTP ",
        "http_suffix": "",
        "content_type": "Unexpected response format.",
        "invalid_json": "Invalid JSON from Alpha Vantage API.",
    },
}
NOT_OBJECT_MESSAGE = "Response is not a JSON object."

CLASSES = ("transport", "http_status", "content_type", "invalid_json", "not_object",
           "note", "error_message", "ok")


DOCUMENT = "_document"


def _chain(endpoint: str, status: Column, ctype: Column, kind: Column, doc: Column):
    msg = MESSAGES[endpoint]
    note, err = P.has_key(doc, P.NOTE_KEY), P.has_key(doc, P.ERROR_KEY)
    first, second = ((err, "error_message"), (note, "note")) \
        if endpoint == MONTHLY else ((note, "note"), (err, "error_message"))
    cls = (F.when(status.isNull(), F.lit("transport"))
           .when(~P.is_success_status(status), F.lit("http_status"))
           .when(~P.is_json_content_type(ctype), F.lit("content_type"))
           .when(kind.isNull(), F.lit("invalid_json"))
           .when(kind != "object", F.lit("not_object"))
           .when(first[0], F.lit(first[1]))
           .when(second[0], F.lit(second[1]))
           .otherwise(F.lit("ok")))
    text = {
        "transport": F.lit(msg["transport"]),
        "http_status": F.concat(F.lit(msg["http_prefix"]), status.cast("string"), F.lit(msg["http_suffix"])),
        "content_type": F.lit(msg["content_type"]),
        "invalid_json": F.lit(msg["invalid_json"]),
        "not_object": F.lit(NOT_OBJECT_MESSAGE),
        "note": P.key_text(doc, P.NOTE_KEY),
        "error_message": P.key_text(doc, P.ERROR_KEY),
    }
    return cls, text


def classify(df: DataFrame, endpoint: str, status_col: str = "status_code",
             content_type_col: str = "content_type", body_col: str = "body",
             diagnostics: bool = True, keep_document: bool = False) -> DataFrame:
    """Add ``error_class, ok, error, retriable`` (and ``body_head`` for failures).
    ``keep_document`` keeps the parsed body, a VARIANT column ``_document``, for readers of
    its other members."""
    if endpoint not in MESSAGES:
        raise ValueError(f"unknown endpoint {endpoint!r}")
    status, ctype, body = col_of(status_col), col_of(content_type_col), col_of(body_col)
    # each body is parsed once (only 2xx JSON responses are parsed at all)
    parse = P.is_success_status(status) & P.is_json_content_type(ctype)
    staged = (df.withColumn(DOCUMENT, F.when(parse, P.document(body)))
              .withColumn("_kind", P.json_kind(DOCUMENT, body)))
    cls, text = _chain(endpoint, status, ctype, F.col("_kind"), F.col(DOCUMENT))
    out = staged.withColumn("error_class", cls)
    c = F.col("error_class")
    err = F.lit(None).cast("string")
    for name, t in text.items():
        err = F.when(c == name, t).otherwise(err)
    out = (out.withColumn("ok", c == "ok")
           .withColumn("error", err)
           .withColumn("retriable", P.is_retriable(status)))
    if diagnostics:
        out = out.withColumn("body_head", F.when(c != "ok", clip(body)))
    return out.drop("_kind") if keep_document else out.drop("_kind", DOCUMENT)
