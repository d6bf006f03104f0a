"""P1, F1-F3, F6, F19, O1 rule tables (FIXTURES §10)."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import months as M

YM_CASES = [
    ("2025-12", True, "2025-12"), (" 2025-12 ", True, "2025-12"), ("2025-1", True, "2025-01"),
    ("\t2025-07\n", True, "2025-07"), ("2025-13", False, None), ("2025-00", False, None),
    ("0000-01", False, None), ("20255-01", False, None), ("2025-012", False, None),
    ("NA", False, None), ("", False, None), (None, False, None), ("2025/12", False, None),
]


def test_year_month_rule_table(spark):
    df = spark.createDataFrame([(x,) for x, _, _ in YM_CASES], "t string")
    out = df.select("t", M.is_valid_year_month("t").alias("v"),
                    M.month_key(M.month_start("t")).alias("k")).collect()
    got = {r.t: (r.v, r.k) for r in out}
    for text, valid, key in YM_CASES:
        assert got[text] == (valid, key), text


def test_year_month_param_matches_column_rule():
    for text, valid, key in YM_CASES:
        d = M.parse_year_month_param(text)
        assert (d is not None) == valid
        if valid:
            assert d.strftime("%Y-%m") == key


def test_require_window_errors():
    assert M.require_window("2025-01", "2025-03") == (date(2025, 1, 1), date(2025, 3, 1))
    with pytest.raises(ValueError):
        M.require_window("2025-13", "2025-06")
    with pytest.raises(ValueError):
        M.require_window("2025-06", "2025-05")


def test_event_time_and_prev_month(spark):
    as_of = datetime(2026, 1, 5, 0, 0, 0)
    df = spark.createDataFrame(
        [("2025-12-17T10:00:00Z",), ("2026-01-05T00:00:00+00:00",), ("",), (None,), ("2025-12",),
         ("2025-12-17T11:00:00+01:00",), ("garbage",)], "t string")
    out = df.select("t", M.parse_event_time("t", F.lit(as_of)).alias("ts")).collect()
    got = {r.t: r.ts for r in out}
    assert got["2025-12-17T10:00:00Z"] == datetime(2025, 12, 17, 10, 0)
    assert got["2025-12-17T11:00:00+01:00"] == datetime(2025, 12, 17, 10, 0)
    assert got[""] == as_of and got[None] == as_of
    assert got["2025-12"] is None and got["garbage"] is None
    pm = spark.range(1).select(M.prev_month(F.lit(date(2026, 1, 5))).alias("p")).first().p
    assert pm == date(2025, 12, 1)
    stamp = spark.range(1).select(M.utc_stamp(F.lit(datetime(2025, 12, 17, 10, 0, 0))).alias("s")).first().s
    assert stamp == "2025-12-17T10:00:00Z"


def test_month_spine_inclusive_and_empty(spark):
    df = spark.createDataFrame([(date(2024, 11, 1), date(2025, 2, 1)), (date(2025, 3, 1), date(2025, 2, 1))],
                               "s date, e date")
    out = df.select(F.size(F.coalesce(M.month_spine("s", "e"), F.array())).alias("n")).collect()
    assert [r.n for r in out] == [4, 0]


def test_event_time_in_basic_form(spark):
    same = {"20251217T100000Z": (10, 0, 0), "20251217T1000Z": (10, 0, 0), "20251217": (0, 0, 0), "20251217T100001": (10, 0, 1),
            "20251217T110000+0100": (10, 0, 0), "20251217T110000+01:00": (10, 0, 0), "2025-12-17T11:00:00+0100": (10, 0, 0),
            " 20251217T100000.5Z ": (10, 0, 0, 500000)}
    refused = ["20251317T100000Z", "20251217T1000000Z", "2025121", "20251217T10Z0"]
    df = spark.createDataFrame([(t,) for t in [*same, *refused]], "t string")
    got = {r.t: r.ts for r in df.select("t", M.parse_event_time("t", F.lit(datetime(2000, 1, 1))).alias("ts")).collect()}
    assert got == {t: datetime(2025, 12, 17, *at) for t, at in same.items()} | dict.fromkeys(refused)
