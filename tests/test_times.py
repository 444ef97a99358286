from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evenfall.operators import times as T

CRAWLED = int(datetime(2026, 1, 20, 12, tzinfo=timezone.utc).timestamp())


@pytest.mark.parametrize(
    ("text", "zone", "expected"),
    [
        ("2026-03-28T13:30:00-05:00", None, "2026-03-28T18:30:00Z"),
        ("20260325T194500", "Europe/Berlin", "2026-03-25T18:45:00Z"),
        ("TZID=America/Chicago:20260108T173000", "UTC", "2026-01-08T23:30:00Z"),
        ("2026-07-27T20:00-07:00[America/Los_Angeles]", None, "2026-07-28T03:00:00Z"),
        ("1788717600", None, "2026-09-06T18:00:00Z"),
        ("1787864400000", None, "2026-08-27T21:00:00Z"),
        ("Sat Jul 25 2026 11:30:00 GMT-0400", None, "2026-07-25T15:30:00Z"),
        ("Sat, 14 Nov 2026 12:30:00 -0800", None, "2026-11-14T20:30:00Z"),
        ("05/09/2026 23:00", "Europe/Madrid", "2026-09-05T21:00:00Z"),
        ("05/09/2026 23:00", "America/New_York", "2026-05-10T03:00:00Z"),
        ("28-02-2026 20.45 h", "Europe/Madrid", "2026-02-28T19:45:00Z"),
        ("23.07.2026, 22:45 Uhr", "Europe/Berlin", "2026-07-23T20:45:00Z"),
        ("18 de abril de 2026, 15:00 h", "Europe/Madrid", "2026-04-18T13:00:00Z"),
        ("Sa., 28. März 2026, 09.00 Uhr", "Europe/Berlin", "2026-03-28T08:00:00Z"),
        ("May 13, 2026 2:45 p.m. EDT", None, "2026-05-13T18:45:00Z"),
        ("Sat, Mar 7, 3pm", "Eastern Time", "2026-03-07T20:00:00Z"),
        ("Jan 5", "UTC", "2027-01-05"),
        ("Thu, Feb 12th 2026", "America/New York", "2026-02-12"),
        ("2026-11-01T01:30:00", "America/New_York", "2026-11-01T05:30:00Z"),  # the first pass of a repeated hour
        ("2026-03-08T02:30:00", "America/New_York", "2026-03-08T07:30:00Z"),  # a skipped hour, the offset before
        ("2026-05-03", None, "2026-05-03"),
        (" 2026-05-03T14:30:00\n", "US\\/Eastern", "2026-05-03T18:30:00Z"),
        ("2026-13-45T25:00", "UTC", None),
        ("0000-00-00 00:00:00", "UTC", None),
        ("2026-02-30", "UTC", None),
        ("Summer 2026", "UTC", None),
        ("every Friday night", "UTC", None),
        ("", "UTC", None),
        (None, "UTC", None),
    ],
)
def test_values(text, zone, expected):
    assert T.utc_value(text, zone, None, CRAWLED) == expected


def test_zone_order():
    assert T.utc_value("2026-07-01 12:00", None, "America/Denver", CRAWLED) == "2026-07-01T18:00:00Z"
    assert T.utc_value("2026-07-01 12:00", "America/Denver", "Europe/Berlin", CRAWLED) == "2026-07-01T18:00:00Z"
    assert T.utc_value("2026-07-01 12:00", None, None, CRAWLED) == "2026-07-01T12:00:00Z"


@settings(max_examples=150, deadline=None)
@given(st.datetimes(datetime(1990, 1, 1), datetime(2035, 1, 1)), st.sampled_from(["America/New_York", "Europe/Berlin", "Australia/Adelaide", "Pacific/Fiji", "America/Phoenix"]))
def test_walls_agree_with_the_standard_library(wall, zone):
    secs = T.days_from_civil(wall.year, wall.month, wall.day) * 86400 + wall.hour * 3600 + wall.minute * 60 + wall.second
    assert T.to_utc(secs, zone) == int(wall.replace(microsecond=0, tzinfo=ZoneInfo(zone)).timestamp())


@given(st.integers(-700_000, 700_000))
def test_days_and_dates_are_inverse(n):
    assert T.days_from_civil(*T.civil_from_days(n)) == n


def test_found_with_nulls_and_empty_tables(spark):
    e = spark.createDataFrame(
        [(1, "2026-05-03T14:30:00", None, None, "s", None), (2, None, "TBA", "UTC", None, None), (3, "May 3", None, "UTC", "?", datetime(2026, 1, 1))],
        "event_id long, start_datetime string, end_datetime string, timezone string, source_id string, crawled_at timestamp_ntz",
    )
    s = spark.createDataFrame([("s", ("America/New_York",))], "source_id string, context struct<timezone:string>")
    got = {tuple(r) for r in T.found(e, s).collect()}
    assert got == {(1, "start_datetime", "2026-05-03T18:30:00Z"), (3, "start_datetime", "2026-05-03")}
    assert T.found(e.limit(0), s).count() == 0
    assert T.found(e, s.limit(0)).count() == 2
