from datetime import datetime

import pytest
from pyspark.sql import functions as F

from evenfall.operators import runs


def one(spark, column, **values):
    kinds = {str: "string", list: "array<string>", datetime: "timestamp_ntz", type(None): "string"}
    d = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return d.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2026-03-20T19:00:00-05:00", "2026-03-20T19:00:00-04:00"),  # winter's offset, twelve days into summer
        ("2026-03-01T19:00:00-04:00", "2026-03-01T19:00:00-05:00"),
        ("2026-07-20T19:00:00-05:00", "2026-07-20T19:00:00-05:00"),  # no change of the clocks near
        ("2026-03-20T19:00:00-07:00", "2026-03-20T19:00:00-07:00"),
        ("2026-03-20T19:00:00Z", "2026-03-20T19:00:00Z"),
        ("soon", "soon"),
        (None, None),
    ],
)
def test_stale_offset(spark, value, expected):
    assert one(spark, runs.without_stale_offset(F.col("v"), F.col("z")), v=value, z="America/New_York") == expected
    assert one(spark, runs.without_stale_offset(F.col("v"), F.col("z")), v=value, z=None) == value


@pytest.mark.parametrize(
    ("start", "evidence", "expected"),
    [
        ("2026-05-09T20:00", "Songs of the sea", None), ("2026-06-01", "Songs of the sea", None), ("2026-06-01T20:00", "Songs of the sea", "2026-06-01T20:00"), ("2026-05-09", "Songs on Friday", "2026-05-09"), ("2026-05-09", "", "2026-05-09"), ("2026-05-09", None, "2026-05-09"),
        ("2026-05-09", "open 5/9", "2026-05-09"), (None, "Songs", None),
    ],
)
def test_checked_date(spark, start, evidence, expected):
    assert one(spark, runs.checked_date(F.col("s"), F.col("e"), F.col("c")), s=start, e=evidence, c=datetime(2026, 5, 9, 12)) == expected


def test_listing_day(spark):
    day = lambda s, l, d: one(spark, runs.listing_day(F.col("s"), F.col("l"), F.col("d")), s=s, l=l, d=d)
    assert day("2026-05-09", "2026-05-10", ["2026-05-10", "2026-05-10"]) == "2026-05-10"
    assert day("2026-05-09", "2026-05-10", ["2026-05-10", "2026-05-11"]) == "2026-05-09" and day("2026-05-09", "2026-05-10", []) == "2026-05-09" and day("2026-05-09", None, ["2026-05-10"]) == "2026-05-09"


def test_corrected_records(spark):
    c = spark.createDataFrame([(1, "p", "f1", "x"), (2, "p", "f9", "Songs of the sea!"), (3, "p", None, "Other"), (4, "q", None, "Songs of the sea"), (5, None, None, None)], "correction_id long, page_url string, fingerprint string, title string")
    p = spark.createDataFrame([(10, "p", "f1", "y"), (11, "p", "f2", "Songs of the sea"), (12, "p", "f3", "Songs of the sea"), (13, "p", None, None)], "event_id long, page_url string, fingerprint string, title string")
    assert {tuple(r) for r in runs.corrected_records(c, p).collect()} == {(1, 10, "fingerprint"), (2, 11, "title")}
    assert runs.corrected_records(c.limit(0), p).count() == 0 and runs.corrected_records(c, p.limit(0)).count() == 0


def test_empty_tables_and_nulls(spark):
    s = spark.createDataFrame([], "source_id string, url string, kind string, etag string, last_modified string, fingerprints array<string>, listing_hash string, content_hash string, extraction_version int, fetched_at timestamp, last_listed_at timestamp")
    e = spark.createDataFrame([(1, None, None, None, None, None)], "event_id long, source_id string, url string, source_url string, drop_reason string, fingerprint string")
    assert runs.conditional_fetches(s).count() == 0 and runs.not_fetched(e, s).count() == 0 and runs.outcomes(e, s).first()["outcome"] == "partial"
    assert runs.diagnoses(e.select(F.col("event_id").alias("report_id"), "url"), s, e).first()["diagnosis"] == "blocked"
    assert runs.still_seen(s, s.select("source_id", "url", F.lit(304).alias("status")), e).count() == 0
    assert runs.listing(e.select("source_id", F.lit("home").alias("kind"), "url")).count() == 0
    assert runs.items(e).first()["extraction_method"] == "unknown"
