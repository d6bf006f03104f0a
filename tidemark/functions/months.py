"""Year-month keys, window arithmetic and event times.

Month keys travel as ``yyyy-MM`` text at the edges and as first-of-month
``DATE`` values inside, so that comparisons never run on text (``2025-9`` sorts
after ``2025-10`` as text).
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted year-month shape. Four digits, a dash, and a
# month of one or two digits (01-12 or 1-9); year 0000 is not a year.
YEAR_MONTH_PATTERN = r"^[0-9]{4}-(1[0-2]|0[1-9]|[1-9])$"
YEAR_MONTH_PATTERN_STRICT = r"^(?!0000)[0-9]{4}-(1[0-2]|0[1-9]|[1-9])$"
# A full calendar date prefix is required before an event time is parsed, so
# that a bare month or year is refused rather than read as a timestamp.
EVENT_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"
# The characters a Python ``str.strip()`` removes (ASCII
# whitespace, the file/group/record/unit separators and Unicode spaces).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003"
              "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Whitespace strip on both ends (``trim`` removes spaces only)."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def is_valid_year_month(c) -> Column:
    """NULL and anything not shaped like ``yyyy-M[M]`` is false.

    One regex test on the stripped text: the pattern refuses year 0000 itself.
    """
    return F.coalesce(strip(c).rlike(YEAR_MONTH_PATTERN_STRICT), F.lit(False))


def month_start(c) -> Column:
    """First-of-month DATE for a valid year-month text, NULL otherwise.

    Built from the year and month digits under the shape test (a date parser
    would refuse ``2025-1`` and accept ``0000-01``).
    """
    s = strip(c)
    return F.when(s.rlike(YEAR_MONTH_PATTERN_STRICT),
                  F.make_date(F.substring(s, 1, 4).cast("int"),
                              F.substring_index(s, "-", -1).cast("int"), F.lit(1)))


def month_key(d) -> Column:
    """zero-padded ``yyyy-MM`` text of a date or timestamp."""
    return F.date_format(col_of(d), "yyyy-MM")


def prev_month(d) -> Column:
    """first day of the previous calendar month (year wraps)."""
    return F.add_months(F.trunc(col_of(d), "MM"), -1)


def _extended(s: Column) -> Column:
    """ISO basic form (``20251217T100000Z``) in extended form; any other text as it is."""
    day, zone = r"^(\d{4})(\d{2})(\d{2})", r"(Z|[+-]\d{2}:?\d{2})?$"
    out = F.regexp_replace(s, day + "$", "$1-$2-$3")
    out = F.regexp_replace(out, day + r"[T ](\d{2})(\d{2})" + zone, "$1-$2-$3T$4:$5:00$6")
    out = F.regexp_replace(out, day + r"[T ](\d{2})(\d{2})(\d{2})(\.\d{1,6})?" + zone, "$1-$2-$3T$4:$5:$6$7$8")
    return F.regexp_replace(out, r"(T[\d:.]+[+-]\d{2})(\d{2})$", "$1:$2")


def parse_event_time(c, as_of) -> Column:
    """blank or missing -> ``as_of``; a full ISO date(-time), in extended or basic form
    -> UTC timestamp.

    Text that is not blank but does not parse gives NULL, which callers route
    to a rejects status instead of silently using ``as_of``.
    """
    s = _extended(strip(c))
    parsed = F.when(s.rlike(EVENT_TIME_PATTERN), s.try_cast("timestamp"))  # 'Z' is a zone id
    return F.when(F.coalesce(s == F.lit(""), F.lit(True)), col_of(as_of)).otherwise(parsed)


def c_is_blank(c) -> Column:
    return F.coalesce(strip(c) == F.lit(""), F.lit(True))


def utc_stamp(ts) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` text of a UTC timestamp."""
    return F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def month_spine(start, end) -> Column:
    """O1: array of first-of-month dates from ``start`` to ``end`` inclusive.

    Empty (NULL) when start > end: ``sequence`` itself would throw.
    """
    s, e = col_of(start), col_of(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 MONTH")))


# ---- driver-side parameter checks (job parameters, not data) --------------

_YM = re.compile(YEAR_MONTH_PATTERN)


def parse_year_month_param(value: str | None) -> date | None:
    """P1 for a job parameter: returns the first-of-month date or None."""
    if not isinstance(value, str):
        return None
    s = value.strip()
    if not _YM.match(s) or s[:4] == "0000":
        return None
    year, month = s.split("-")
    return date(int(year), int(month), 1)


def require_window(start: str, end: str) -> tuple[date, date]:
    """P2/P3 for job parameters: both valid, end not before start."""
    s, e = parse_year_month_param(start), parse_year_month_param(end)
    if s is None:
        raise ValueError(f"start year-month is invalid: {start!r}")
    if e is None:
        raise ValueError(f"end year-month is invalid: {end!r}")
    if e < s:
        raise ValueError(f"end year-month {end} is earlier than start {start}")
    return s, e
