import json

from evenfall.functions import html
from evenfall.operators import extract, links


def test_visible_text_and_broken_markup():
    t = html.visible_text(html.tree("<html><head><title>x</title></head><body><ul><li>One<li>Two <b>bold</b></ul><script>var a='<p>';</script><p>A<br>B\n\n<table><tr><td>1<td>2</table>"))
    assert t.split("\n") == ["One", "Two bold", "A", "B", "1", "2"]
    assert html.visible_text(html.tree(None)) == ""
    assert html.plain("<p>Tom &amp; Jo</p> <i>x</i>") == "Tom & Jo x"


def test_linked_events():
    block = json.dumps({"@graph": [{"@type": ["MusicEvent"], "name": "A %26 B", "startDate": "2026-01-01", "description": "&lt;p&gt;Hi&lt;/p&gt;", "location": [{"name": "Hall", "geo": {"latitude": "1.5", "longitude": 2}}], "offers": {"lowPrice": "1,200"}}, {"@type": "Place", "name": "no"}, {"@type": "Event", "name": "A %26 B", "startDate": "2026-01-01"}]})
    rows = [dict(zip(extract.FIELDS, r)) for r in extract.linked_of([block, "{broken"], [])]
    assert len(rows) == 1
    assert (rows[0]["title"], rows[0]["description"], rows[0]["location_lat"], rows[0]["ticket_price"]) == ("A & B", "Hi", 1.5, 1200.0)


def test_inline_objects():
    s = [{"attrs": "", "text": 'var p = {"x":"}{","ev":{"title":"T","details":"<b>d</b>","scheduling":{"config":{"startDate":"2026-02-02"}},"venue":{"name":"V"}}};'}]
    all_, best = extract.inline_of(s)
    row = dict(zip(extract.FIELDS, best))
    assert (row["title"], row["start_datetime"], row["location_title"], row["description"]) == ("T", "2026-02-02", "V", "d")
    assert len(all_) == 1
    assert extract.inline_of([{"attrs": "", "text": "var x = {oops"}]) == ([], None)


def test_microdata_and_selectors():
    page = '<div itemscope itemtype="https://schema.org/Event"><h2 itemprop="name">N</h2><time itemprop="startDate" datetime="2026-03-03">x</time><div itemprop="location" itemscope itemtype="https://schema.org/Place"><span itemprop="name">Hall</span></div></div>'
    p = html.parse(page, "https://a.example/")
    rows = [dict(zip(extract.FIELDS, r)) for r in extract.linked_of([], p[9])]
    assert (rows[0]["title"], rows[0]["start_datetime"], rows[0]["location_title"]) == ("N", "2026-03-03", "Hall")
    got = extract.recipe_records('<div class="c"><h3>T</h3><time datetime="2026-01-01">Jan 1</time></div><div class="c"><h3>no date</h3></div>', "https://a.example", "div.c", {"title": "h3", "date": "time::attr(datetime)"})
    assert [(r["title"], r["start_datetime"]) for r in got] == [("T", "2026-01-01")]
    assert extract.recipe_records(page, None, ":::", {}) == []


def test_links(spark):
    body = '<nav><a href="/calendar">Calendar</a></nav><div class="x">' + "".join(f'<p><a href="/events/{i}">E{i}</a></p>' for i in range(4)) + '</div><a href="/x.pdf">events</a><a class="next" href="/events?page=2">2</a><a href="https://other.example/events">away</a>'
    pages = spark.createDataFrame([(1, "https://a.example/events", body), (2, "https://b.example/", None)], "id long, url string, html string")
    a = links.anchors(pages, "id")
    assert sorted(r["link"] for r in links.detail_links(a, "id").collect()) == [f"https://a.example/events/{i}" for i in range(4)]
    assert [r["link"] for r in links.next_pages(a, "id").collect()] == ["https://a.example/events?page=2"]
    assert "https://a.example/calendar" in [r["link"] for r in links.events_pages(a, "id").collect()]
    kept = links.without_nested(spark.createDataFrame([(1, "https://a.example/e"), (1, "https://a.example/e/1"), (1, "https://a.example/ex")], "id long, link string"), "id")
    assert sorted(r["link"] for r in kept.collect()) == ["https://a.example/e", "https://a.example/ex"]


def test_queries_over_the_tables_own_pages_and_texts(spark, tmp_path):
    from datetime import datetime

    from evenfall import queries

    cards = "".join(f'<p class="c"><a class="l" href="/events/show-{i}">Show {i}</a></p>' for i in range(4))
    page = f'<body><div class="tribe-events-bar">x</div><div>{cards}</div><a href="/list?page=2" rel="next">2</a><a href="https://tix.example/e/1">Buy tickets</a></body>'
    spark.createDataFrame([(1, page, "https://a.example/list"), (2, "", "https://a.example/x"), (3, None, None)], "case_id long, html string, url string").write.parquet(f"{tmp_path}/cases.parquet")
    at = datetime(2026, 5, 1)
    e = [(1, "Songs", "Doors at 4 | show at 7:30", at), (2, "Talk", "June 3, June 10 and June 17, 2026 from 7 to 9 p.m.", at), (3, "Live music every Monday", None, at), (4, None, None, at)]
    spark.createDataFrame(e, "event_id long, title string, description string, crawled_at timestamp").write.parquet(f"{tmp_path}/event_items.parquet")
    rows = lambda name: queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows("q_case_links")} == {(1, "detail", f"https://a.example/events/show-{i}") for i in range(4)} | {(1, "next", "https://a.example/list?page=2")}
    texts = {r["case_id"]: r for r in rows("q_case_texts")}
    assert set(texts) == {1, 2, 3} and texts[1]["ticket"] == "https://tix.example/e/1" and texts[1]["platform"] == "tribe" and "Show 2" in texts[1]["full_text"]
    words = {r["event_id"]: r for r in rows("q_event_words")}
    assert set(words) == {1, 2, 3, 4} and words[1]["clock"] == "19:30" and words[2]["start"] == "2026-06-03T19:00:00" and words[2]["rdates"] == "2026-06-10T19:00:00,2026-06-17T19:00:00"
    assert (words[3]["freq"], words[3]["byday"]) == ("weekly", "MO") and words[4]["clock"] is None and words[4]["freq"] is None


def test_event_records(spark):
    from evenfall.plans.pages import event_records

    page = '<html><body><h1>Songs</h1><script type="application/ld+json">{"@type":"Event","name":"Songs","startDate":"2026-06-05T20:00:00","endDate":"2026-06-05T01:00:00"}</script></body></html>'
    context = "struct<location_title:string,location_address:string,location_lat:double,location_lon:double,venue_type:string,timezone:string>"
    rows = [(1, "https://hall.example/e/1", page, "2026-05-01T00:00:00Z", (None, None, None, None, None, "America/New_York")), (2, "https://hall.example/e/2", page, None, (None, None, None, None, None, "America/New_York")), (3, "https://x.example", None, None, None)]
    d = spark.createDataFrame(rows, f"case_id long, url string, html string, captured_at string, seed_context {context}")
    got = {r["case_id"]: r for r in event_records(d).collect()}
    assert got[1]["start_datetime"] == "2026-06-06T00:00:00Z" and got[1]["end_datetime"] == "2026-06-06T05:00:00Z" and got[1]["drop_reason"] is None
    assert got[2]["drop_reason"] == "duplicate_in_run" and got[2]["fingerprint"] == got[1]["fingerprint"] and 3 not in got
    assert event_records(d.limit(0)).count() == 0
