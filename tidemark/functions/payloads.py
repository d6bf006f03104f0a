"""Vendor payload checks on landed bodies.

A body is parsed once, into a VARIANT (``document``); its kind, keys and series are read
from that column.  Validity is strict JSON: single quotes, NaN and repeated keys are
refused.  The parser stops after the first value, so the body is parsed as a member of an
object with a second member behind it: text after the value breaks that object or gives
it other keys.  Key presence is key presence: ``{"Note": null}`` has the key ``Note``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.months import col_of

# The payload keys the classification reads.
NOTE_KEY = "Note"
ERROR_KEY = "Error Message"
MONTHLY_SERIES_KEY = "Monthly Adjusted Time Series"
# HTTP statuses that are retried.
RETRIABLE_STATUS = (429, 500, 502, 503, 504)
JSON_CONTENT_TYPE = "application/json"


def document(body) -> Column:
    """The parsed body as the member ``v`` of a VARIANT object; NULL if it isn't one JSON value."""
    return F.try_parse_json(F.concat(F.lit('{"v":'), col_of(body), F.lit(',"end":0}')))


def json_kind(doc, body) -> Column:
    """'object' / 'array' / 'scalar' for a parsed body, NULL for invalid text."""
    members = F.map_keys(F.try_variant_get(col_of(doc), "$", "map<string,variant>"))
    first = F.substring(F.ltrim(col_of(body), F.lit(" \t\r\n")), 1, 1)
    return F.when(F.size(members) == 2, F.when(first == "{", F.lit("object")).when(first == "[", F.lit("array"))
                  .otherwise(F.lit("scalar")))


def _path(key: str) -> str:
    return f"$.v['{key}']"


def has_key(doc, key: str) -> Column:
    return F.try_variant_get(col_of(doc), _path(key), "variant").isNotNull()


def key_text(doc, key: str) -> Column:
    """The member as text (nested values as JSON text); NULL for a JSON null."""
    return F.try_variant_get(col_of(doc), _path(key), "string")


def key_names(doc, key: str) -> Column:
    """The keys of a member that is an object; NULL for any other."""
    return F.map_keys(F.try_variant_get(col_of(doc), _path(key), "map<string,variant>"))


def is_success_status(status) -> Column:
    s = col_of(status)
    return (s >= 200) & (s < 300)


def is_retriable(status) -> Column:
    """Transport failures (NULL status) and the retriable status set."""
    s = col_of(status)
    return s.isNull() | s.isin(*RETRIABLE_STATUS)


def is_json_content_type(content_type) -> Column:
    return F.coalesce(F.lower(col_of(content_type)).contains(JSON_CONTENT_TYPE), F.lit(False))
