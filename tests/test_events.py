from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from evenfall.functions import text, titles, urls
from evenfall.operators import evaluate, events, incremental
from evenfall.sources import feeds

EVENT = "event_id long, source_id string, title string, start_datetime string, location_title string, location_address string, recurrence_freq string, recurrence_interval int, recurrence_byday array<string>, recurrence_month_mode string, fingerprint string, drop_reason string, listing_url string"


def rows(spark, *r):
    return spark.createDataFrame([tuple(x) + (None,) * (13 - len(x)) for x in r], EVENT)


def test_fingerprints_and_duplicates(spark):
    e = rows(spark, (1, "s", "Café!", "2026-01-01T20:00", "Hall"), (2, "s", "cafe", "2026-01-01", None, "hall"), (3, "s", "Café", "2026-01-02", "Hall", None, "weekly", 1, ["TU", "MO"]), (4, "s", "café", "2026-01-09", "HALL", None, "weekly", 1, ["MO", "TU"]), (5, None, None))
    f = {r["event_id"]: r["fingerprint"] for r in events.with_fingerprint(e).collect()}
    assert f[1] == f[2] != f[3] == f[4] and f[5].startswith("unknown:")
    d = {r["event_id"]: r["drop_reason"] for r in events.in_run_duplicates(events.with_fingerprint(e)).collect()}
    assert d == {1: None, 2: "duplicate_in_run", 3: None, 4: "duplicate_in_run", 5: None}
    assert events.in_run_duplicates(e.limit(0)).count() == 0


def test_upsert(spark):
    t = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "fingerprint string, title string")
    b = spark.createDataFrame([("a", "x"), ("b", "new"), ("c", "")], "fingerprint string, title string")
    assert {r["fingerprint"]: r["status"] for r in events.upsert(t, b, content=("title",)).collect()} == {"a": "unchanged", "b": "updated", "c": "created"}


def test_merge_and_context(spark):
    base = spark.createDataFrame([(1, "", 0.0, ["x"]), (2, "t", float("nan"), [])], "id long, title string, lat double, tags array<string>")
    over = spark.createDataFrame([(1, "o", 1.5, ["y"]), (2, "o", 2.5, ["z"])], "id long, title string, lat double, tags array<string>")
    got = {r["id"]: (r["title"], r["lat"], r["tags"]) for r in events.merged(base, over, ["id"], ["title", "lat", "tags"]).collect()}
    assert got == {1: ("o", 1.5, ["x"]), 2: ("t", 2.5, ["z"])}


def test_sessions_and_home_teams(spark):
    e = rows(spark, (1, "s", "Yoga: A", "2026-01-01", None, None, "weekly", 1, ["MO"], None, None, None, "p"), (2, "s", "yoga: B", "2026-01-02", None, None, "weekly", 1, ["MO"], None, None, None, "p"), (3, "s", "Lions vs Bears", "2026-01-02", None, None, None, None, None, None, None, None, "p"), (4, "s", "Lions at Tigers", "2026-01-03", None, None, None, None, None, None, None, None, "p"))
    assert {r["event_id"] for r in events.dated_sessions(e).collect() if r["is_session"]} == {1, 2}
    assert {r["event_id"] for r in events.away_games(e).collect() if r["drop_reason"] == "away_game"} == {4}


def test_titles(spark):
    d = spark.createDataFrame([("Jazz Night — Blues Alley", "Blues Alley", None), ("Jazz | Afterlife", "Afterlife Bar", None), ("Show | Fountain Square", None, "https://www.myfountainsquare.com/x"), ("Murder Mystery | February 26th", None, None), ("Hip-Hop", None, None), ("Blues Alley", "Blues Alley", None), ("A – tickets", None, None), (None, "v", None)], "t string, v string, u string")
    got = [r[0] for r in d.select(titles.clean_title(F.col("t"), F.col("v"), F.col("u"))).collect()]
    assert got == ["Jazz Night", "Jazz", "Show", "Murder Mystery", "Hip-Hop", "Blues Alley", "A", None]
    tags = d.select(titles.matched_tags(F.lit("Drag Bingo, 21+ only"), F.lit(None), F.lit("pub"), F.lit("The Club"))).first()[0]
    assert tags == ["Drag", "21+", "Bingo", "Happy Hour"]


def test_texts_and_urls(spark):
    d = spark.createDataFrame([("  Ärger im   Café!  ", "https://user@WWW.Shop.Example.co.uk:80/a/?q=1#f")], "t string, u string")
    r = d.select(text.fingerprint_text(F.col("t")), text.slug(F.col("t")), urls.site_of(F.col("u")), urls.link_key(F.col("u")), urls.page_key(F.col("u"))).first()
    assert tuple(r) == ("arger im cafe", "ärger-im-café", "example.co.uk", "shop.example.co.uk/a?q=1", "https://user@WWW.Shop.Example.co.uk:80/a/?q=1")


def test_refetch(spark):
    at = datetime(2026, 6, 1)
    d = spark.createDataFrame([(None, 4, None, None, None), (datetime(2026, 5, 31), 3, None, None, None), (datetime(2026, 5, 1), 4, None, None, None), (datetime(2026, 5, 31), 4, "a", "b", None), (datetime(2026, 5, 31), 4, "a", "a", datetime(2026, 6, 1)), (datetime(2026, 5, 31), 4, "a", None, None), (datetime(2026, 5, 31), 4, "a", "a", None)], "f timestamp, v int, k string, l string, m timestamp")
    got = [r[0] for r in d.select(incremental.refetch_reason(F.col("f"), F.col("v"), F.col("k"), F.col("l"), F.col("m"), F.lit(at), 4)).collect()]
    assert got == ["new", "version", "max_age", "listing", "lastmod", "no_signal", None]


def test_pairs_and_regressions(spark):
    s = "case_id long, idx long, title string, start string"
    lab = spark.createDataFrame([(1, 0, "Jazz Night", "2026-01-01"), (1, 1, "Jazz Night", "2026-01-02"), (1, 2, "Other", None)], s)
    rec = spark.createDataFrame([(1, 0, "jazz  night", "2026-01-02"), (1, 1, "Jazz Nights", "2026-01-01"), (1, 2, "Nope", None)], s)
    assert {tuple(r) for r in evaluate.pairs(lab, rec).collect()} == {(1, 0, 1), (1, 1, 0)}
    f = "case_id long, failures array<string>"
    r = evaluate.regressions(spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], f), spark.createDataFrame([(1, ["b", "c"]), (2, ["a"])], f)).collect()
    assert [tuple(x) for x in r] == [(1, ["c"], ["a"])]


def test_feeds(spark):
    bad = spark.createDataFrame([(1, "not json"), (2, None), (3, '{"events":[{"title":"T","start_date":"2026-01-01 20:00:00"}]}')], "id long, body string")
    assert [r["title"] for r in feeds.tribe_events(bad, "id").collect()] == ["T"]
    assert feeds.sitemap_entries(bad, "id").count() == 0 and feeds.map_seeds(bad, "id").count() == 0
    cal = feeds.calendar_events("BEGIN:VEVENT\r\nSUMMARY:A\\nB\r\nDTSTART;VALUE=DATE:20260105\r\nEXDATE:20260112,20260119\r\nRRULE:FREQ=MONTHLY;BYDAY=2TU;COUNT=3\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:old\r\nDTSTART:20200101T000000Z\r\nEND:VEVENT", "2026-01-01")
    assert len(cal) == 1 and cal[0][1] == "A\nB" and cal[0][3] == "2026-01-05" and cal[0][10] == "weekday" and cal[0][14] == ["2026-01-12", "2026-01-19"]


def test_streams(spark, tmp_path):
    from evenfall.streaming import ingest

    schema = "event_id long, fingerprint string, source_id string, crawled_at timestamp_ntz"
    at = lambda d: datetime(2026, 1, d)
    for i, part in enumerate(([(1, "a", "s", at(1)), (2, "b", "s", at(2))], [(3, "a", "s", at(3)), (4, "c", "s", at(4))])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    src = lambda: ingest.read(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files=1)
    q = ingest.run_upsert(src(), str(tmp_path / "table"), str(tmp_path / "c1"))
    q.awaitTermination()
    assert {(r["fingerprint"], r["event_id"]) for r in ingest.upserted(spark, str(tmp_path / "table")).collect()} == {("a", 3), ("b", 2), ("c", 4)}
    # batches one by one: a late row doesn't win, a batch that runs again changes nothing, and bases take in what came before
    write = ingest.upsert_to(str(tmp_path / "t2"), compact=2)
    batches = [[(1, "a", "s", at(5))], [(2, "a", "s", at(3)), (3, "b", "s", None)], [(4, "b", "s", at(1)), (5, None, "s", at(9))], [(6, "c", "s", at(2))], [(7, "a", "s", at(5))]]
    for n, rows in enumerate(batches):
        for _ in range(2):
            write(spark.createDataFrame(rows, schema), n)
    assert {(r["fingerprint"], r["event_id"]) for r in ingest.upserted(spark, str(tmp_path / "t2")).collect()} == {("a", 7), ("b", 4), ("c", 6)}
    assert ingest._numbers(spark, str(tmp_path / "t2" / "base")) == [1, 3] and ingest._numbers(spark, str(tmp_path / "t2" / "batch")) == [2, 3, 4]
    with pytest.raises(ValueError, match="no table"):
        ingest.upserted(spark, str(tmp_path / "t3"))
    for n, stream in enumerate((ingest.per_window(src()), ingest.per_session(src()))):
        ingest.run(stream, str(tmp_path / f"w{n}"), str(tmp_path / f"cw{n}")).awaitTermination()
        assert spark.read.schema(stream.schema).parquet(str(tmp_path / f"w{n}")).count() <= 4
    ingest.run(ingest.first_of_each(src()), str(tmp_path / "first"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "first")).count() == 3


def test_queries_over_all_rows(spark, tmp_path):
    from evenfall import queries

    at = datetime(2026, 5, 1, 12)
    made = [
        (1, "Songs  of\nthe\tsea", "songs of the SEA", "2026-05-03T20:00:00-04:00", "2026-05-03T18:30:00-04:00"),
        (2, "  Two lines\n\nof text ", "lines of text", "May 4, 2026 8 pm", "May 4, 2026 11 pm"),
        (3, "Other", "not there", "2026-05-05", "2026-05-05"),
        (4, None, None, "soon", None),
        (5, "x", " ", None, "2026-05-06T10:00:00Z"),
        (6, "x", "2026-05-07T20:00:00Z", "2026-05-07T20:00:00Z", "2026-05-01T20:00:00Z"),
        (7, "x", "x", "2026-05-08T20:00:00Z", "2026-05-08"),
    ]
    d = spark.createDataFrame([(*r, "America/New_York", "s", at) for r in made], "event_id long, description string, evidence string, start_datetime string, end_datetime string, timezone string, source_id string, crawled_at timestamp")
    d.write.parquet(f"{tmp_path}/event_items.parquet")
    spark.createDataFrame([("s", (None,))], "source_id string, context struct<timezone:string>").write.parquet(f"{tmp_path}/sources.parquet")
    got = lambda name: {r[0]: r[1] for r in queries.QUERIES[name](spark, str(tmp_path)).collect()}
    fold = lambda t: " ".join((t or "").split()).lower()
    assert got("q_evidence_rows") == {i: fold(v) != "" and fold(v) in fold(f"{t or ''} {s or ''}") for i, t, v, s, _ in made}
    assert len(got("q_evidence")) < len(made)
    assert got("q_end_after_start_rows") == {1: "2026-05-04T22:30:00Z", 2: "2026-05-05T03:00:00Z", 3: "2026-05-05", 4: None, 5: "2026-05-06T10:00:00Z", 6: None, 7: "2026-05-08"}
    assert got("q_local_times_rows") == {1: "2026-05-03T20:00", 2: "2026-05-04T20:00", 3: "2026-05-05", 4: "soon", 5: None, 6: "2026-05-07T16:00", 7: "2026-05-08T16:00"}


def test_nearest_in_time_as_brute_force(spark):
    import random

    from evenfall.operators import events

    r = random.Random(1)
    at = lambda: None if r.random() < 0.05 else datetime(2026, 1, 1) + timedelta(minutes=r.randrange(0, 60 * 24 * 40, 30))
    left = [(i, r.choice(["a", "a", "b", None, "z"]), at()) for i in range(200)]
    right = [(f"r{i:03d}", r.choice(["a", "a", "a", "b", None]), at()) for i in range(60)]
    d = spark.createDataFrame(left, "lid long, k string, t timestamp_ntz"), spark.createDataFrame(right, "rid string, k string, u timestamp_ntz")
    want = {}
    for i, k, t in left:
        found = [(abs((u - t).total_seconds()), rid) for rid, q, u in right if k is not None and k == q and t and u]
        if found:
            want[i] = min(found)
    for bucket in (3600, 7 * 86_400):
        got = {x["lid"]: (x["seconds"], x["rid"]) for x in events.nearest_in_time(*d, ["k"], "t", "u", "lid", "rid", bucket).collect()}
        assert got == want
    assert events.nearest_in_time(d[0], d[1].limit(0), ["k"], "t", "u", "lid", "rid").count() == 0
