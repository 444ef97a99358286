"""Queries of the core, by name, each with the SQL that gives the same. Each takes (spark, sf_dir).

All of them run over whole tables. Where a feed or page is needed that the tables don't hold, it is made from the rows of a table, so
that what has to come out is known and the SQL reads it from the table directly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from evenfall.functions import grammar, hashing, pagetext, text, titles, urls
from evenfall.functions import html as pages_html
from evenfall.operators import evaluate, events, extract, geo, incremental, links, times
from evenfall.plans import crawl, finalise
from evenfall.plans.pages import event_records, page_events
from evenfall.runtime import cut, shared_folder, spread, table
from evenfall.sources import feeds, platforms

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_KM = "2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2))))"
_OK = "{0}lat IS NOT NULL AND {0}lon IS NOT NULL AND NOT isnan({0}lat) AND NOT isnan({0}lon) AND abs({0}lat) <= 90 AND abs({0}lon) <= 180 AND NOT ({0}lat = 0 AND {0}lon = 0)"


@query(f"""
WITH e AS (SELECT event_id, location_lat AS lat, location_lon AS lon FROM event_items WHERE {_OK.format('location_')}),
s AS (SELECT seed_id, location_lat AS lat, location_lon AS lon FROM venue_seeds WHERE {_OK.format('location_')}),
a AS (SELECT area_id, lat, lon, CASE WHEN radius_km IS NULL OR isnan(radius_km) THEN 10.0 ELSE radius_km END AS km, bbox FROM search_areas)
SELECT e.event_id, 'area' AS near_kind, CAST(a.area_id AS BIGINT) AS near_id FROM e JOIN a ON
  CASE WHEN a.bbox IS NOT NULL THEN e.lat BETWEEN a.bbox.south AND a.bbox.north
      AND CASE WHEN a.bbox.west > a.bbox.east THEN e.lon >= a.bbox.west OR e.lon <= a.bbox.east ELSE e.lon BETWEEN a.bbox.west AND a.bbox.east END
    WHEN {_OK.format('a.')} THEN {_KM.format(a='e.', b='a.')} <= a.km ELSE FALSE END
UNION ALL
SELECT e.event_id, 'seed', s.seed_id FROM e JOIN s ON s.lat BETWEEN e.lat - 0.01 AND e.lat + 0.01 AND {_KM.format(a='e.', b='s.')} <= 0.25
""")
def p2_found(spark, sf_dir):
    return geo.near_all(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "search_areas"), table(spark, sf_dir, "venue_seeds"))


@query()
def p4_found(spark, sf_dir):
    return times.found(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "sources"))


# Texts, hashes and keys

_FP = "trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce({0}, ''))), '[^\\pL\\pM\\p{{Nd}}\\p{{Pc}}\\s\\pZ]', '', 'g'), '[\\s\\pZ]+', ' ', 'g'))"
_FOLD = "lower(trim(regexp_replace(coalesce({0}, ''), '[\\s\\pZ]+', ' ', 'g')))"


@query(f"""
SELECT event_id, coalesce(source_id, 'unknown') || ':' || sha256(CASE WHEN coalesce(recurrence_freq, 'none') <> 'none'
  THEN {_FP.format('title')} || '|' || {_FP.format("coalesce(nullif(location_title, ''), location_address)")} || '|' || recurrence_freq || ':' || coalesce(recurrence_interval, 1) || ':' || coalesce(array_to_string(list_sort(recurrence_byday), ':'), '') || ':' || coalesce(recurrence_month_mode, 'day')
  ELSE {_FP.format('title')} || '|' || substr(coalesce(start_datetime, ''), 1, 10) || '|' || {_FP.format("coalesce(nullif(location_title, ''), location_address)")} END) AS own_fingerprint
FROM event_items""")
def q_source_fingerprint(spark, sf_dir):
    return events.with_fingerprint(table(spark, sf_dir, "event_items"), "own_fingerprint").select("event_id", "own_fingerprint")


@query(f"""
SELECT event_id, {_FOLD.format('title')} AS folded, nullif(trim(regexp_replace(location_address, '[\\s\\pZ]+', ' ', 'g')), '') AS cleaned, {_FP.format('location_title')} AS venue_key FROM event_items""")
def q_text_keys(spark, sf_dir):
    return table(spark, sf_dir, "event_items").select("event_id", text.fold(F.col("title")).alias("folded"), text.clean(F.col("location_address")).alias("cleaned"), text.fingerprint_text(F.col("location_title")).alias("venue_key"))


@query("""
SELECT event_id, regexp_replace(substr(regexp_replace(regexp_replace(regexp_replace(lower(title), '[''’"]', '', 'g'), '[^\\pL\\pM\\p{Nd}\\p{Pc}]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60), '-+$', '') AS slug FROM event_items""")
def q_slug(spark, sf_dir):
    return table(spark, sf_dir, "event_items").select("event_id", text.slug(F.col("title")).alias("slug"))


_HOST = "lower(regexp_extract(coalesce({0}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_PATH = "regexp_extract(coalesce({0}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_QUERY = "regexp_extract(coalesce({0}, ''), '^[^?#]*\\?([^#]*)', 1)"
_TWO = ", ".join(f"'{x}'" for x in urls.TWO_LABELS)
_SITE = f"CASE WHEN regexp_matches({_HOST}, '^[0-9.]*$') OR len(string_split({_HOST}, '.')) < 2 THEN {_HOST} WHEN array_to_string(string_split({_HOST}, '.')[-2:], '.') IN ({_TWO}) AND len(string_split({_HOST}, '.')) > 2 THEN array_to_string(string_split({_HOST}, '.')[-3:], '.') ELSE array_to_string(string_split({_HOST}, '.')[-2:], '.') END"


@query(f"""
SELECT event_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS page_key,
  regexp_replace({_HOST.format('url')}, '^www\\.', '') || regexp_replace({_PATH.format('url')}, '/+$', '') || CASE WHEN {_QUERY.format('url')} <> '' THEN '?' || {_QUERY.format('url')} ELSE '' END AS link_key,
  {_SITE.format('source_url')} AS site, nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) || '/', '/') AS home FROM event_items""")
def q_url_keys(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    return e.select("event_id", urls.page_key(F.col("url")).alias("page_key"), urls.link_key(F.col("url")).alias("link_key"), urls.site_of(F.col("source_url")).alias("site"), urls.home_url(F.col("url")).alias("home"))


_SEGMENTS = f"list_filter(string_split(regexp_replace(lower({_PATH.format('listing_url')}), '/+$', ''), '/'), lambda x: x <> '')"
_NEG = "|".join(urls.NEGATIVE)
_SAY = urls.ANCHOR_WORDS.replace("(?i)", "").replace("'", "''")
_STRONG = "[" + ", ".join(f"'{x}'" for x in urls.STRONG) + "]"


@query(f"""
WITH d AS (SELECT DISTINCT title, listing_url, regexp_replace(lower({_PATH.format('listing_url')}), '/+$', '') AS p, {_SEGMENTS} AS seg, regexp_matches(title, '{_SAY}', 'i') AS said FROM event_items WHERE listing_url IS NOT NULL)
SELECT title, listing_url, CASE WHEN regexp_matches(p, '\\.(pdf|jpe?g|png|gif|webp|svg|zip|docx?|xlsx?|mp[34])$', 'i') THEN -10.0 ELSE
  CASE WHEN list_has_any(seg, {_STRONG}) THEN 3.0 WHEN regexp_matches(p, '{'|'.join(urls.WEAK)}') THEN 1.5 ELSE 0.0 END + CASE WHEN said THEN 3.0 ELSE 0.0 END
  - CASE WHEN len(list_filter(list_concat(seg, regexp_extract_all(lower(title), '[a-z]+')), lambda w: regexp_matches(w, '{_NEG}'))) > 0 THEN 5.0 ELSE 0.0 END
  - CASE WHEN NOT said AND len(seg) > 2 THEN 1.0 ELSE 0.0 END - CASE WHEN {_QUERY.format('listing_url')} <> '' THEN 0.5 ELSE 0.0 END END::DOUBLE AS score FROM d""")
def q_link_scores(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").where("listing_url IS NOT NULL").select("title", "listing_url").distinct()
    return e.withColumn("score", urls.link_score(F.col("title"), F.col("listing_url"), F.lit(False)))


@query("""
SELECT source_id, CASE WHEN ('0x' || substr(sha256(domain), 1, 8))::BIGINT / 4294967295.0::DOUBLE < 0.2 THEN 'eval' ELSE 'train' END AS split FROM sources""")
def q_held_out(spark, sf_dir):
    return table(spark, sf_dir, "sources").select("source_id", hashing.held_out(F.col("domain"), 0.2).alias("split"))


@query("""SELECT event_id, substr(sha256('Extract the events.' || chr(10) || title || ' ' || coalesce(description, '')), 1, 16) AS prompt_hash FROM event_items""")
def q_prompt_hash(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    return e.select("event_id", hashing.prompt_hash(F.lit("Extract the events."), F.concat_ws(" ", "title", F.coalesce("description", F.lit("")))).alias("prompt_hash"))


def _tag_sql() -> str:
    q = lambda s: s.replace("'", "''")
    said = [f"CASE WHEN regexp_matches(t, '{q(titles.tag_pattern(words))}') THEN '{tag}' END" for tag, words in titles.TAG_WORDS]
    implied = [f"CASE WHEN k = '{k}' THEN '{t}' END" for k, tags in titles.VENUE_TYPE_TAGS.items() for t in tags] + [f"CASE WHEN contains(v, '{w}') THEN '{t}' END" for w, t in titles.VENUE_NAME_TAGS]
    distinct = "list_filter(x, lambda y, i: y IS NOT NULL AND list_position(x, y) = i)"
    return f"""WITH s AS (SELECT source_id, any_value(context.venue_type) AS venue_type FROM sources GROUP BY source_id),
e AS (SELECT event_id, lower(title || ' ' || coalesce(description, '')) AS t, lower(trim(coalesce(s.venue_type, ''))) AS k, lower(coalesce(location_title, '')) AS v FROM event_items LEFT JOIN s USING (source_id)),
x AS (SELECT event_id, [{', '.join(said + implied)}] AS x FROM e)
SELECT event_id, array_to_string({distinct}[1:{titles.MOST_TAGS}], '|') AS tags FROM x"""


@query(_tag_sql())
def q_tags(spark, sf_dir):
    s = table(spark, sf_dir, "sources").select("source_id", F.col("context.venue_type").alias("venue_type"))
    e = table(spark, sf_dir, "event_items").join(F.broadcast(s), "source_id", "left")  # sources is fixed at 320 rows
    return e.select("event_id", F.array_join(titles.matched_tags(F.col("title"), F.col("description"), F.col("venue_type"), F.col("location_title")), "|").alias("tags"))


@query()
def q_clean_titles(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    return e.select("event_id", titles.clean_title(F.col("title"), F.col("location_title"), F.col("url"), F.col("source_url")).alias("title"))


# Runs, duplicates, states

@query("""
SELECT event_id, CASE WHEN fingerprint IS NOT NULL AND event_id <> min(event_id) OVER (PARTITION BY source_id, fingerprint) THEN 'duplicate_in_run' ELSE drop_reason END AS drop_reason FROM event_items""")
def q_in_run_duplicates(spark, sf_dir):
    return events.in_run_duplicates(table(spark, sf_dir, "event_items")).select("event_id", "drop_reason")


_LAST = "SELECT * FROM event_items WHERE fingerprint IS NOT NULL AND crawled_at {0} TIMESTAMP '2026-04-01' QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY crawled_at DESC NULLS LAST, event_id DESC NULLS LAST) = 1"
_SAME = " AND ".join(f"nullif(t.{c}, '') IS NOT DISTINCT FROM nullif(b.{c}, '')" for c in events.CONTENT)


@query(f"""
WITH t AS ({_LAST.format('<')}), b AS ({_LAST.format('>=')})
SELECT coalesce(t.fingerprint, b.fingerprint) AS fingerprint, CASE WHEN t.fingerprint IS NULL THEN 'created' WHEN b.fingerprint IS NULL THEN 'kept' WHEN {_SAME} THEN 'unchanged' ELSE 'updated' END AS status
FROM t FULL JOIN b ON t.fingerprint = b.fingerprint""")
def q_upsert_status(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").where("fingerprint IS NOT NULL")
    at = F.lit("2026-04-01").cast("timestamp_ntz")
    last = lambda d: events.latest(d, ["fingerprint"], ["crawled_at", "event_id"])
    return events.upsert(last(e.where(F.col("crawled_at") < at)), last(e.where(F.col("crawled_at") >= at))).select("fingerprint", "status")


@query("""
WITH m AS (SELECT source_id, extraction_method, count(*) AS n FROM event_items WHERE extraction_method IS NOT NULL GROUP BY ALL),
t AS (SELECT source_id, first(extraction_method ORDER BY n DESC, extraction_method) AS strategy_used FROM m GROUP BY source_id)
SELECT e.source_id, count(*) AS events_found, count(*) FILTER (ingest_status = 'created') AS created, count(*) FILTER (ingest_status = 'updated') AS updated, count(*) FILTER (ingest_status = 'unchanged') AS unchanged,
  count(*) FILTER (drop_reason IS NOT NULL AND drop_reason <> 'duplicate_in_run') AS dropped, count(DISTINCT fingerprint) AS seen_fingerprints, count(DISTINCT listing_url) AS pages_fetched, any_value(t.strategy_used) AS strategy_used
FROM event_items e LEFT JOIN t ON e.source_id = t.source_id GROUP BY e.source_id""")
def q_run_report(spark, sf_dir):
    return events.run_report(table(spark, sf_dir, "event_items"))


@query("""
WITH p AS (SELECT listing_url AS page_url, fingerprint FROM event_items WHERE listing_url IS NOT NULL UNION ALL SELECT source_url, fingerprint FROM event_items WHERE source_url IS NOT NULL)
SELECT page_url, array_to_string(list_sort(list(DISTINCT fingerprint)), ',') AS fingerprints FROM p WHERE fingerprint IS NOT NULL GROUP BY page_url""")
def q_fingerprints_by_page(spark, sf_dir):
    return events.fingerprints_by_page(table(spark, sf_dir, "event_items")).select("page_url", F.array_join("fingerprints", ",").alias("fingerprints"))


_STATES = """SELECT * FROM page_states WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id, url ORDER BY fetched_at DESC NULLS LAST, last_listed_at DESC NULLS LAST, content_hash DESC NULLS LAST, listing_hash DESC NULLS LAST, etag DESC NULLS LAST, extraction_version DESC NULLS LAST) = 1"""
_LISTING = "CASE length(url) % 3 WHEN 0 THEN NULL WHEN 1 THEN listing_hash ELSE 'changed' END"
_LASTMOD = "coalesce(try_strptime(nullif(regexp_extract(last_modified, '(\\d{1,2} [A-Z][a-z]{2} \\d{4} \\d{2}:\\d{2}:\\d{2})', 1), ''), '%d %b %Y %H:%M:%S'), try_cast(last_modified AS TIMESTAMP))"
_REASON = f"""CASE WHEN fetched_at IS NULL THEN 'new' WHEN extraction_version IS DISTINCT FROM 4 THEN 'version' WHEN TIMESTAMP '2026-06-01' - fetched_at > INTERVAL 7 DAYS THEN 'max_age'
  WHEN {_LISTING} IS NOT NULL AND listing_hash IS DISTINCT FROM {_LISTING} THEN 'listing' WHEN {_LASTMOD} > fetched_at THEN 'lastmod' WHEN {_LISTING} IS NULL AND {_LASTMOD} IS NULL THEN 'no_signal' END"""


def _reasons(spark, sf_dir):
    s = incremental.current_states(table(spark, sf_dir, "page_states"))
    n = F.length("url") % 3
    listing = F.when(n == 1, F.col("listing_hash")).when(n == 2, F.lit("changed"))
    reason = incremental.refetch_reason(F.col("fetched_at").cast("timestamp"), F.col("extraction_version"), F.col("listing_hash"), listing, incremental.http_date(F.col("last_modified")), F.lit("2026-06-01").cast("timestamp"), 4)
    return s.withColumn("reason", reason)


@query(f"WITH s AS ({_STATES}) SELECT source_id, url, {_REASON} AS reason FROM s")
def q_refetch_reason(spark, sf_dir):
    return _reasons(spark, sf_dir).select("source_id", "url", "reason")


@query(f"WITH s AS ({_STATES}) SELECT DISTINCT source_id, fingerprint FROM (SELECT source_id, unnest(fingerprints) AS fingerprint FROM s WHERE {_REASON} IS NULL OR {_REASON} = 'no_signal') WHERE fingerprint IS NOT NULL")
def q_carried_fingerprints(spark, sf_dir):
    skipped = _reasons(spark, sf_dir).where("reason IS NULL OR reason = 'no_signal'").select("source_id", "url")
    return incremental.carried_fingerprints(table(spark, sf_dir, "page_states"), skipped)


@query(f"""WITH b AS ({_STATES.replace('url IS NOT NULL', "url IS NOT NULL AND fetched_at < TIMESTAMP '2026-07-01'")}), n AS ({_STATES})
SELECT n.source_id, n.url FROM n LEFT JOIN b ON n.source_id = b.source_id AND n.url = b.url WHERE b.url IS NULL OR n.fetched_at IS DISTINCT FROM b.fetched_at OR n.content_hash IS DISTINCT FROM b.content_hash""")
def q_changed_states(spark, sf_dir):
    cols = ("source_id", "url", "fetched_at", "content_hash")
    p = table(spark, sf_dir, "page_states")
    before = incremental.current_states(p.where(F.col("fetched_at") < F.lit("2026-07-01").cast("timestamp_ntz"))).select(*cols)
    return incremental.changed_states(before, incremental.current_states(p).select(*cols)).select("source_id", "url")


@query(f"""WITH s AS ({_STATES}), j AS (SELECT e.event_id, abs(epoch(date_trunc('second', e.crawled_at)) - epoch(date_trunc('second', s.fetched_at))) AS gap FROM event_items e JOIN s ON e.source_id = s.source_id WHERE s.kind = 'listing')
SELECT event_id, CAST(min(gap) AS BIGINT) AS seconds FROM j WHERE gap IS NOT NULL GROUP BY event_id""")
def q_nearest_state(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").withColumn("crawled_at", F.col("crawled_at").cast("timestamp"))
    s = incremental.current_states(table(spark, sf_dir, "page_states")).where("kind = 'listing'").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    return events.nearest_in_time(e, s, ["source_id"], "crawled_at", "fetched_at", "event_id", "url").select("event_id", "seconds")


# Merging and normalising

_NO = "{0} IS NULL OR isnan({0}) OR {0} = 0"


@query(f"""WITH s AS (SELECT source_id, any_value(context) AS c FROM sources GROUP BY source_id)
SELECT event_id, CASE WHEN coalesce(location_title, '') = '' THEN coalesce(c.location_title, location_title) ELSE location_title END AS location_title, CASE WHEN coalesce(timezone, '') = '' THEN coalesce(c.timezone, timezone) ELSE timezone END AS timezone,
  coalesce(CASE WHEN isnan(x) THEN NULL ELSE x END, -999.0) AS location_lat FROM (SELECT e.*, s.c, CASE WHEN {_NO.format('location_lat')} THEN coalesce(c.location_lat, location_lat) ELSE location_lat END AS x FROM event_items e LEFT JOIN s ON e.source_id = s.source_id)""")
def q_with_context(spark, sf_dir):
    return events.with_context(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "sources")).select("event_id", "location_title", "timezone", F.coalesce(F.when(~F.isnan("location_lat"), F.col("location_lat")), F.lit(-999.0)).alias("location_lat"))


_ISO = "^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}(:\\d{2})?$"


@query(f"""WITH e AS (SELECT event_id, try_cast(start_datetime AS TIMESTAMP) AS s, try_cast(end_datetime AS TIMESTAMP) - INTERVAL 6 HOURS AS e FROM event_items WHERE regexp_matches(start_datetime, '{_ISO}') AND regexp_matches(end_datetime, '{_ISO}'))
SELECT event_id, strftime(CASE WHEN e >= s THEN e WHEN e > s - INTERVAL 1 DAY THEN e + INTERVAL 1 DAY END, '%Y-%m-%dT%H:%M:%S') AS end_datetime FROM e WHERE s IS NOT NULL AND e IS NOT NULL""")
def q_end_after_start(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").where(F.col("start_datetime").rlike(_ISO) & F.col("end_datetime").rlike(_ISO))
    e = e.select("event_id", F.try_to_timestamp("start_datetime").alias("s"), (F.try_to_timestamp("end_datetime") - F.expr("INTERVAL 6 HOURS")).alias("e")).where("s IS NOT NULL AND e IS NOT NULL")
    return e.select("event_id", F.date_format(events.end_after_start(F.col("s"), F.col("e")), "yyyy-MM-dd'T'HH:mm:ss").alias("end_datetime"))


@query()
def q_end_after_start_rows(spark, sf_dir):
    """All rows, with the starts and ends of p4; where one of them is a day without a time, days are compared."""
    u = times.with_utc(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "sources"))
    start, end = F.col("start_datetime_utc"), F.col("end_datetime_utc")
    timed = (F.length(start) > 10) & (F.length(end) > 10)
    late = F.date_format(events.end_after_start(F.try_to_timestamp(start), F.try_to_timestamp(end)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kept = F.when(F.substring(end, 1, 10) >= F.substring(start, 1, 10), end)
    return u.select("event_id", F.when(start.isNull(), end).when(timed, late).otherwise(kept).alias("end_datetime"))


@query("""WITH e AS (SELECT event_id, CAST(crawled_at AS DATE) AS d, list_transform(recurrence_byday, lambda x: upper(right(x, 2))) AS c FROM event_items WHERE recurrence_byday IS NOT NULL)
SELECT event_id, strftime(list_filter([d + i::INTEGER for i in range(8)], lambda x: list_contains(c, ['MO','TU','WE','TH','FR','SA','SU'][isodow(x)]))[1], '%Y-%m-%d') AS next_day FROM e""")
def q_next_occurrence(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").where("recurrence_byday IS NOT NULL")
    return e.select("event_id", F.date_format(events.next_occurrence(F.col("recurrence_byday"), F.col("crawled_at")), "yyyy-MM-dd").alias("next_day"))


_D = "try_cast(substr({0}, 1, 10) AS DATE)"


@query(f"""WITH e AS (SELECT *, CASE recurrence_freq WHEN 'daily' THEN 1 WHEN 'weekly' THEN 7 WHEN 'monthly' THEN 28 WHEN 'yearly' THEN 365 END AS p, substr(end_datetime, 1, 10) AS last FROM event_items WHERE regexp_matches(start_datetime, '{_ISO}') AND regexp_matches(end_datetime, '{_ISO}'))
SELECT event_id, CASE WHEN {_D.format('end_datetime')} - {_D.format('start_datetime')} >= p * coalesce(recurrence_interval, 1) AND recurrence_count IS NULL AND (recurrence_until IS NULL OR recurrence_until >= last) THEN last ELSE recurrence_until END AS until FROM e WHERE {_D.format('start_datetime')} IS NOT NULL AND {_D.format('end_datetime')} IS NOT NULL""")
def q_fitted_until(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").where(F.col("start_datetime").rlike(_ISO) & F.col("end_datetime").rlike(_ISO))
    e = e.where("try_cast(substr(start_datetime, 1, 10) AS DATE) IS NOT NULL AND try_cast(substr(end_datetime, 1, 10) AS DATE) IS NOT NULL")
    return e.select("event_id", events.fitted_until(F.col("recurrence_freq"), F.col("recurrence_interval"), F.col("recurrence_count"), F.col("recurrence_until"), F.col("start_datetime"), F.col("end_datetime")).alias("until"))


@query(f"""SELECT event_id, array_to_string(list_filter(rdates, lambda d: NOT coalesce(substr(d, 1, 10) BETWEEN substr(start_datetime, 1, 10) AND greatest(substr(start_datetime, 1, 10), substr(coalesce(end_datetime, start_datetime), 1, 10)), FALSE)), ',') AS rdates
FROM event_items WHERE rdates IS NOT NULL AND regexp_matches(start_datetime, '{_ISO}')""")
def q_other_days(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").where(F.col("rdates").isNotNull() & F.col("start_datetime").rlike(_ISO))
    return e.select("event_id", F.array_join(events.other_days(F.col("rdates"), F.col("start_datetime"), F.col("end_datetime")), ",").alias("rdates"))


@query(f"""WITH e AS (SELECT *, {_FOLD.format("regexp_extract(title, '^([^:]*)', 1)")} AS s, coalesce(array_to_string(list_sort(recurrence_byday), ','), '') AS d, coalesce(recurrence_freq, 'none') <> 'none' AS r FROM event_items),
k AS (SELECT listing_url, s, recurrence_freq, d FROM e WHERE r AND listing_url IS NOT NULL GROUP BY ALL HAVING count(DISTINCT substr(start_datetime, 1, 10)) >= 2)
SELECT event_id, k.s IS NOT NULL AS is_session FROM e LEFT JOIN k ON e.listing_url = k.listing_url AND e.s = k.s AND e.recurrence_freq = k.recurrence_freq AND e.d = k.d""")
def q_dated_sessions(spark, sf_dir):
    return events.dated_sessions(table(spark, sf_dir, "event_items")).select("event_id", "is_session")


@query(f"""WITH h AS (SELECT DISTINCT listing_url, {_FOLD.format("regexp_extract(t, '(?i)^(.+?)\\s+(?:vs?\\.?|versus)\\s+\\S', 1)")} AS team FROM (SELECT listing_url, CASE WHEN event_id % 2 = 0 THEN source_id || ' vs Guests' ELSE source_id || ' at Elsewhere' END AS t FROM event_items))
SELECT event_id, CASE WHEN event_id % 2 = 1 AND h.team IS NOT NULL AND drop_reason IS NULL THEN 'away_game' ELSE drop_reason END AS drop_reason FROM event_items e LEFT JOIN h ON e.listing_url = h.listing_url AND h.team <> '' AND lower(e.source_id) = h.team""")
def q_away_games(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").withColumn("title", F.when(F.col("event_id") % 2 == 0, F.concat("source_id", F.lit(" vs Guests"))).otherwise(F.concat("source_id", F.lit(" at Elsewhere"))))
    return events.away_games(e).select("event_id", "drop_reason")


# Pages

@query("""SELECT case_id, CAST(pos - 1 AS INTEGER) AS pos, href FROM (SELECT case_id, unnest(h) AS href, generate_subscripts(h, 1) AS pos FROM (SELECT case_id, regexp_extract_all(html, '<a\\b[^>]*?\\bhref="([^"]*)"', 1) AS h FROM cases WHERE html IS NOT NULL))""")
def q_page_anchors(spark, sf_dir):
    return links.anchors(table(spark, sf_dir, "cases"), "case_id").select("case_id", "pos", "href")


@query()
def q_events_pages(spark, sf_dir):
    return links.events_pages(links.anchors(table(spark, sf_dir, "cases"), "case_id"), "case_id")


@query("""SELECT event_id, '/events?page=' || (event_id % 7 + 2) AS next_page FROM event_items WHERE event_id % 3 <> 2
UNION ALL SELECT event_id, '/events/page/' || (event_id % 7 + 2) FROM event_items WHERE event_id % 3 = 2""")
def q_next_pages(spark, sf_dir):
    n, k = F.col("event_id") % 7 + 1, F.col("event_id") % 3
    query_url = lambda x: F.format_string("https://a.example/events?page=%d", x)
    body = F.when(k == 0, F.format_string('<body><a href="/">Home</a><a href="/events?page=%d" rel="next">2</a></body>', n + 1)).when(k == 1, F.format_string('<body><a href="/events?page=%d">1</a><a href="/events?page=%d"> Next » </a></body>', n - 1, n + 1)).otherwise(F.format_string('<body><a href="/about">About</a><a href="/events/page/%d">%d</a></body>', n + 1, n + 1))
    p = table(spark, sf_dir, "event_items").select("event_id", F.when(k == 2, F.format_string("https://a.example/events/page/%d", n)).otherwise(query_url(n)).alias("url"), body.alias("html"))
    return links.next_pages(links.anchors(p, "event_id"), "event_id").select("event_id", F.regexp_replace("link", "^https://a.example", "").alias("next_page"))


_LD = """regexp_extract(html, '<script type="application/ld\\+json">(.*?)</script>', 1, 's')"""


@query(f"""SELECT case_id, json_extract_string(j, '$.name') AS title, json_extract_string(j, '$.startDate') AS start_datetime FROM (SELECT case_id, {_LD} AS j FROM cases) WHERE j <> '' AND json_valid(j)""")
def q_jsonld_events(spark, sf_dir):
    p = table(spark, sf_dir, "cases").select("case_id", pages_html.parsed(F.col("html"), F.col("url")).alias("p"))
    return p.select("case_id", F.explode(extract.linked(F.col("p"))).alias("e")).select("case_id", "e.title", "e.start_datetime")


def _case_sides(spark, sf_dir):
    c = table(spark, sf_dir, "cases")
    pages = spread(c.select("case_id", "html", "url"))
    lab = c.select("case_id", F.posexplode(F.from_json("events", "array<struct<title:string,start_datetime:string>>")).alias("idx", "e")).select("case_id", "idx", "e.title", F.substring("e.start_datetime", 1, 16).alias("start"))
    p = pages.select("case_id", pages_html.parsed(F.col("html"), F.col("url")).alias("p")).select("case_id", F.posexplode(extract.linked(F.col("p"))).alias("idx", "e"))
    # the pages are read once; what was found is small and looked at several times
    return c, lab, cut(p.select("case_id", "idx", "e.title", F.substring("e.start_datetime", 1, 16).alias("start")))


_SIDES = f"""l AS (SELECT case_id, count(*) AS labelled FROM (SELECT case_id, unnest(CAST(events AS JSON[])) AS e FROM cases) GROUP BY case_id),
lt AS (SELECT case_id, {_FOLD.format("json_extract_string(e, '$.title')")} AS t FROM (SELECT case_id, unnest(CAST(events AS JSON[])) AS e FROM cases)),
r AS (SELECT case_id, {_FOLD.format("json_extract_string(j, '$.name')")} AS t FROM (SELECT case_id, {_LD} AS j FROM cases) WHERE j <> ''),
m AS (SELECT case_id, count(*) AS found FROM lt JOIN r USING (case_id, t) GROUP BY case_id),
s AS (SELECT c.case_id, c.kind, c.platform, coalesce(l.labelled, 0) AS labelled, coalesce(m.found, 0) AS found, (r.case_id IS NOT NULL)::BIGINT AS parsed, CASE WHEN c.complete THEN (r.case_id IS NOT NULL)::BIGINT - coalesce(m.found, 0) ELSE 0 END AS wrong
  FROM cases c LEFT JOIN l USING (case_id) LEFT JOIN m USING (case_id) LEFT JOIN r USING (case_id))"""


@query(f"WITH {_SIDES} SELECT case_id, labelled, found, parsed, wrong FROM s")
def q_case_scores(spark, sf_dir):
    c, lab, rec = _case_sides(spark, sf_dir)
    return evaluate.case_scores(c, lab, rec, evaluate.pairs(lab, rec))


@query(f"""WITH {_SIDES} SELECT kind, platform, count(*) AS cases, CAST(sum(labelled) AS BIGINT) AS labelled, CAST(sum(found) AS BIGINT) AS found, CAST(sum(wrong) AS BIGINT) AS wrong,
  CASE WHEN sum(labelled) > 0 THEN sum(found) / sum(labelled) ELSE 1.0 END::DOUBLE AS recall, CASE WHEN sum(found) + sum(wrong) > 0 THEN sum(found) / (sum(found) + sum(wrong)) ELSE 1.0 END::DOUBLE AS precision FROM s GROUP BY ROLLUP (kind, platform)""")
def q_scorecard(spark, sf_dir):
    c, lab, rec = _case_sides(spark, sf_dir)
    scores = evaluate.case_scores(c, lab, rec, evaluate.pairs(lab, rec)).join(c.select("case_id", "kind", "platform"), "case_id")
    return evaluate.scorecard(scores, ["kind", "platform"])


@query("""WITH b AS (SELECT case_id, list_filter(['title', 'start', 'url'], lambda x, i: (case_id + i) % 2 = 0) AS f FROM cases), n AS (SELECT case_id, list_filter(['title', 'start', 'url'], lambda x, i: (case_id + i) % 3 = 0) AS f FROM cases),
d AS (SELECT b.case_id, array_to_string(list_sort(list_filter(n.f, lambda x: NOT list_contains(b.f, x))), ',') AS worse, array_to_string(list_sort(list_filter(b.f, lambda x: NOT list_contains(n.f, x))), ',') AS better FROM b JOIN n USING (case_id))
SELECT * FROM d WHERE worse <> '' OR better <> ''""")
def q_regressions(spark, sf_dir):
    c = table(spark, sf_dir, "cases")
    f = lambda m: F.filter(F.array(F.lit("title"), F.lit("start"), F.lit("url")), lambda x, i: (F.col("case_id") + i + 1) % m == 0)
    r = evaluate.regressions(c.select("case_id", f(2).alias("failures")), c.select("case_id", f(3).alias("failures")))
    return r.select("case_id", F.array_join("worse", ",").alias("worse"), F.array_join("better", ",").alias("better"))


@query("""SELECT event_id, coalesce(trim(evidence), '') <> '' AND contains(lower(coalesce(description, '') || ' ' || coalesce(start_datetime, '')), lower(trim(regexp_replace(evidence, '[\\s\\pZ]+', ' ', 'g')))) AS holds FROM event_items WHERE evidence IS NULL OR NOT regexp_matches(coalesce(description, '') || coalesce(start_datetime, ''), '[\\s\\pZ]{2}|[\\n\\t]|^[\\s\\pZ]|[\\s\\pZ]$')""")
def q_evidence(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    body = F.concat(F.coalesce("description", F.lit("")), F.lit(" "), F.coalesce("start_datetime", F.lit("")))
    plain = ~F.concat(F.coalesce("description", F.lit("")), F.coalesce("start_datetime", F.lit(""))).rlike(r"(?U)\s{2}|[\n\t]|^\s|\s$")
    return e.where(F.col("evidence").isNull() | plain).select("event_id", evaluate.evidence_holds(F.col("evidence"), body).alias("holds"))


@query()
def q_evidence_rows(spark, sf_dir):
    """All rows; white space is folded, which the SQL of q_evidence doesn't follow."""
    e = table(spark, sf_dir, "event_items")
    body = F.concat(F.coalesce("description", F.lit("")), F.lit(" "), F.coalesce("start_datetime", F.lit("")))
    return e.select("event_id", evaluate.evidence_holds(F.col("evidence"), body).alias("holds"))


def _generated(spark, sf_dir):
    """Pages of five kinds from event rows, in turn by event_id."""
    e = table(spark, sf_dir, "event_items").select("event_id", F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("t"), F.date_format("crawled_at", "yyyy-MM-dd'T'HH:mm").alias("s"))
    node = F.format_string('{"@type":"MusicEvent","name":"%s","startDate":"%s","location":{"name":"Hall","address":{"streetAddress":"1 Road","addressLocality":"Town"}}}', "t", "s")
    two = F.concat(F.lit('<script type="application/ld+json">{"@graph":['), node, F.lit(","), F.replace(node, F.lit('Event '), F.lit("Other ")), F.lit("]}</script>"))
    one = F.concat(F.lit('<script type="application/ld+json">'), node, F.lit('</script><script>var d = {"eventName":"x","description":"longer text here {really}","startDate":"2020-01-01","venue":"V"};</script>'))
    inline = F.format_string('<script>window.page = {"a":[{"title":"%s","start_date":"%s","venue":{"name":"V"}},{"title":"Other","start_date":"%s","venue":{"name":"W"}}]};</script>', "t", "s", "s")
    og = F.format_string('<head><meta property="og:title" content="%s"><meta property="event:start_time" content="%s"></head>', "t", "s")
    k = F.col("event_id") % 5
    return e.select("event_id", F.lit("https://a.example/x").alias("url"), F.when(k == 0, two).when(k == 1, one).when(k == 2, inline).when(k == 3, og).otherwise(F.lit("<p>nothing</p>")).alias("html"))


@query("""WITH e AS (SELECT event_id, 'Event ' || event_id AS t, strftime(crawled_at, '%Y-%m-%dT%H:%M') AS s, event_id % 5 AS k FROM event_items)
SELECT event_id, 'jsonld' AS strategy, 0 AS pos, 'jsonld' AS extraction_method, t AS title, s AS start_datetime, 'Hall' AS location_title, '1 Road, Town' AS location_address, NULL AS description FROM e WHERE k = 0
UNION ALL SELECT event_id, 'jsonld', 1, 'jsonld', replace(t, 'Event ', 'Other '), s, 'Hall', '1 Road, Town', NULL FROM e WHERE k = 0
UNION ALL SELECT event_id, 'waterfall', 0, 'jsonld', t, s, 'Hall', '1 Road, Town', 'longer text here {really}' FROM e WHERE k = 1
UNION ALL SELECT event_id, 'inline_json', 0, 'inline_json', t, s, 'V', NULL, NULL FROM e WHERE k = 2
UNION ALL SELECT event_id, 'inline_json', 1, 'inline_json', 'Other', s, 'W', NULL, NULL FROM e WHERE k = 2
UNION ALL SELECT event_id, 'waterfall', 0, 'opengraph', t, s, NULL, NULL, NULL FROM e WHERE k = 3""")
def q_waterfall(spark, sf_dir):
    return extract.waterfall(_generated(spark, sf_dir), "event_id").select("event_id", "strategy", "pos", "extraction_method", "title", "start_datetime", "location_title", "location_address", "description")


@query("""WITH e AS (SELECT event_id, unnest(generate_series(1, event_id % 3 + 1)) AS i FROM event_items)
SELECT event_id, 'Show ' || event_id || '-' || i AS title, 'June ' || i || ' 8 pm' AS start_datetime, 'https://a.example/e/' || i AS url FROM e""")
def q_recipe(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").select("event_id", F.sequence(F.lit(1).cast("long"), F.col("event_id") % 3 + 1).alias("n"))
    card = F.transform("n", lambda i: F.concat(F.lit('<div class="card big"><h3>Show '), F.col("event_id").cast("string"), F.lit("-"), i.cast("string"), F.lit('</h3><span class="d">June '), i.cast("string"), F.lit('</span> <em>8 pm</em><a href="/e/'), i.cast("string"), F.lit('">more</a></div>')))
    p = e.select("event_id", F.concat(F.lit('<ul class="list">'), F.array_join(card, ""), F.lit('</ul><div class="card"><h3>No date</h3></div>')).alias("html"))
    css = F.create_map(*[F.lit(x) for x in ("title", "h3", "date", ".d", "time", "em", "link", "a[href]")])
    found = p.select("event_id", F.explode(extract.recipe(F.col("html"), F.lit("https://a.example/list"), F.lit(".list > div.card, div.card"), css)).alias("e"))
    return found.select("event_id", "e.title", "e.start_datetime", "e.url")


@query()
def q_page_events(spark, sf_dir):
    return page_events(table(spark, sf_dir, "cases"))


@query()
def q_event_records(spark, sf_dir):
    return event_records(table(spark, sf_dir, "cases"))


# Feeds

@query("""SELECT event_id, 'Event ' || event_id AS title, CASE WHEN event_id % 5 = 0 THEN strftime(crawled_at, '%Y-%m-%d') WHEN event_id % 3 = 1 THEN strftime(crawled_at, '%Y-%m-%dT%H:%M:%S') ELSE strftime(crawled_at + INTERVAL 5 HOURS, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS start_datetime,
  CASE WHEN event_id % 2 = 0 THEN '1 Road, Town, 12345' ELSE 'Town' END AS location_address, CASE WHEN event_id % 3 = 0 THEN 'America/New_York' END AS timezone FROM event_items""")
def q_feed_tribe(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    at = lambda h: F.date_format(F.col("crawled_at") + F.expr(f"INTERVAL {h} HOURS"), "yyyy-MM-dd HH:mm:ss")
    zone = F.element_at(F.array(F.lit("America/New_York"), F.lit("UTC-5"), F.lit("")), (F.col("event_id") % 3 + 1).cast("int"))
    venue = F.struct(F.lit("Hall &amp; Yard").alias("venue"), F.when(F.col("event_id") % 2 == 0, F.lit("1 Road")).otherwise(F.lit("")).alias("address"), F.lit("Town").alias("city"), F.when(F.col("event_id") % 2 == 0, F.lit("12345")).alias("zip"))
    one = F.struct(F.concat(F.lit("<b>Event</b> "), F.col("event_id").cast("string")).alias("title"), at(0).alias("start_date"), at(5).alias("utc_start_date"), (F.col("event_id") % 5 == 0).alias("all_day"), zone.alias("timezone"), venue.alias("venue"))
    f = e.select("event_id", F.to_json(F.struct(F.array(one).alias("events"))).alias("body"))
    return feeds.tribe_events(f, "event_id").select("event_id", "title", "start_datetime", "location_address", "timezone")


@query("""SELECT event_id, 'Event ' || event_id AS title, strftime(date_trunc('second', crawled_at), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS start_datetime, CASE WHEN event_id % 2 = 0 THEN 40.5 ELSE 0.0 END::DOUBLE AS location_lat, 'https://a.example/e/' || event_id AS url FROM event_items""")
def q_feed_squarespace(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    where = F.struct(F.when(F.col("event_id") % 2 == 0, F.lit("1 Road")).alias("addressLine1"), F.lit(40.5).alias("mapLat"), F.lit(-74.0).alias("mapLng"))
    one = F.struct(F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("title"), F.concat(F.lit("/e/"), F.col("event_id").cast("string")).alias("fullUrl"), F.unix_millis(F.col("crawled_at").cast("timestamp")).alias("startDate"), where.alias("location"))
    f = e.select("event_id", F.lit("https://a.example/events").alias("url"), F.to_json(F.struct(F.array(one).alias("items"))).alias("body"))
    return feeds.squarespace_events(f, "event_id").select("event_id", "title", "start_datetime", F.coalesce("location_lat", F.lit(0.0)).alias("location_lat"), "url")


@query("""SELECT event_id, 'Event, ' || event_id AS title, strftime(crawled_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS start_datetime, CASE WHEN event_id % 2 = 0 THEN 'weekly' END AS freq, CASE WHEN event_id % 2 = 0 THEN 'MO|-1FR' ELSE '' END AS byday, CASE WHEN event_id % 2 = 0 THEN '2030-01-31' END AS until FROM event_items WHERE event_id % 7 <> 0""")
def q_feed_ical(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    rule = F.when(F.col("event_id") % 2 == 0, F.lit("RRULE:FREQ=WEEKLY;BYDAY=MO,-1FR;UNTIL=20300131T000000Z\r\n")).otherwise(F.lit(""))
    status = F.when(F.col("event_id") % 7 == 0, F.lit("STATUS:CANCELLED\r\n")).otherwise(F.lit(""))
    body = F.concat(F.lit("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nSUMMARY:Event\\, \r\n "), F.col("event_id").cast("string"), F.lit("\r\nDTSTART:"), F.date_format("crawled_at", "yyyyMMdd'T'HHmmss'Z'"), F.lit("\r\n"), rule, status, F.lit("END:VEVENT\r\nEND:VCALENDAR\r\n"))
    f = e.select("event_id", body.alias("body"), F.to_date("crawled_at").alias("as_of"))
    return feeds.ical_events(f, "event_id").select("event_id", "title", "start_datetime", "freq", F.array_join("byday", "|").alias("byday"), "until")


@query(f"""WITH s AS ({_STATES}) SELECT source_id, url, 'urlset' AS kind, url AS loc, strftime(date_trunc('second', fetched_at), '%Y-%m-%d %H:%M:%S') AS lastmod FROM s""")
def q_sitemap_entries(spark, sf_dir):
    s = incremental.current_states(table(spark, sf_dir, "page_states"))
    body = F.concat(F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> '), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc>"), F.coalesce(F.concat(F.lit("<lastmod>"), F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</lastmod>")), F.lit("")), F.lit("</url></urlset>"))
    m = s.select(F.struct("source_id", "url").alias("id"), body.alias("body"))
    return feeds.sitemap_entries(m, "id").select("id.source_id", "id.url", "kind", "loc", F.date_format("lastmod", "yyyy-MM-dd HH:mm:ss").alias("lastmod"))


@query("""SELECT seed_id, regexp_replace(url, '/+$', '') AS url, nullif(trim(location_title), '') AS location_title, CASE WHEN seed_id % 2 = 0 THEN '7 Road, Town' ELSE 'Town' END AS location_address, coalesce(venue_type, 'none') AS venue_type FROM venue_seeds WHERE url LIKE 'http%'""")
def q_map_seeds(spark, sf_dir):
    s = table(spark, sf_dir, "venue_seeds")
    tags = F.create_map(F.lit("website"), F.coalesce("url", F.lit("")), F.lit("name"), F.coalesce("location_title", F.lit("")), F.lit("addr:housenumber"), F.when(F.col("seed_id") % 2 == 0, F.lit("7")).otherwise(F.lit("")), F.lit("addr:street"), F.when(F.col("seed_id") % 2 == 0, F.lit("Road")).otherwise(F.lit("")), F.lit("addr:city"), F.lit("Town"), F.lit("amenity"), F.coalesce("venue_type", F.lit("none")))
    one = F.struct(F.lit("node").alias("type"), F.col("seed_id").alias("id"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), tags.alias("tags"))
    a = s.select("seed_id", F.to_json(F.struct(F.array(one).alias("elements"))).alias("body"))
    return feeds.map_seeds(a, "seed_id").select("seed_id", "url", "location_title", "location_address", "venue_type")


@query(f"""SELECT {_SITE.format('url')} AS domain, first(url ORDER BY seed_id) AS homepage_url, count(*) > 1 AS multi_location FROM venue_seeds WHERE {_SITE.format('url')} <> '' GROUP BY 1""")
def q_seed_sources(spark, sf_dir):
    return feeds.seed_sources(table(spark, sf_dir, "venue_seeds")).select("domain", "homepage_url", "multi_location")


# Words

_DAYNAME = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][isodow(crawled_at)]"


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN 'monthly' ELSE 'weekly' END AS freq, CASE event_id % 4 WHEN 1 THEN 2 ELSE 1 END::INTEGER AS interval, (CASE event_id % 4 WHEN 3 THEN '3' ELSE '' END) || ['MO','TU','WE','TH','FR','SA','SU'][isodow(crawled_at)] AS byday,
  CASE event_id % 4 WHEN 2 THEN strftime(crawled_at + INTERVAL 60 DAYS, '%Y-%m-%d') END AS until FROM event_items""")
def q_recurrence_text(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    day, k = F.date_format("crawled_at", "EEEE"), F.col("event_id") % 4
    said = F.when(k == 0, F.concat(F.lit("Live music every "), day, F.lit(" at eight"))).when(k == 1, F.concat(F.lit("We meet every other "), day)).when(k == 2, F.concat(F.lit("Recurring weekly on "), day, F.lit(" until "), F.date_format(F.col("crawled_at") + F.expr("INTERVAL 60 DAYS"), "MMMM d, yyyy"))).otherwise(F.concat(F.lit("On the third "), day, F.lit(" of every month")))
    r = e.select("event_id", grammar.recurrence(said, F.col("crawled_at")).alias("r"))
    return r.select("event_id", "r.freq", "r.interval", F.array_join("r.byday", ",").alias("byday"), "r.until")


@query("""WITH e AS (SELECT event_id, strftime(crawled_at, '%Y-%m-') AS m, event_id % 9 + 1 AS d FROM event_items)
SELECT event_id, m || lpad(d::VARCHAR, 2, '0') || CASE WHEN event_id % 3 = 2 THEN 'T00:00:00' ELSE 'T19:00:00' END AS start,
  CASE event_id % 3 WHEN 0 THEN m || lpad((d + 7)::VARCHAR, 2, '0') || 'T19:00:00,' || m || (d + 14)::VARCHAR || 'T19:00:00' WHEN 1 THEN m || lpad((d + 1)::VARCHAR, 2, '0') || 'T19:00:00,' || m || lpad((d + 2)::VARCHAR, 2, '0') || 'T19:00:00' ELSE m || lpad((d + 9)::VARCHAR, 2, '0') || 'T00:00:00' END AS rdates,
  CASE WHEN event_id % 3 = 2 THEN m || '25T00:00:00' ELSE '' END AS exdates FROM e""")
def q_several_dates(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    m, y, d, k = F.date_format("crawled_at", "MMMM"), F.date_format("crawled_at", "yyyy"), F.col("event_id") % 9 + 1, F.col("event_id") % 3
    n = lambda x: x.cast("string")
    said = F.when(k == 0, F.concat(m, F.lit(" "), n(d), F.lit(", "), m, F.lit(" "), n(d + 7), F.lit(" and "), m, F.lit(" "), n(d + 14), F.lit(", "), y, F.lit(" from 7 to 9 p.m.")))
    said = said.when(k == 1, F.concat(m, F.lit(" "), n(d), F.lit("–"), n(d + 2), F.lit(", "), y, F.lit(" from 7 to 10 pm"))).otherwise(F.concat(m, F.lit(" "), n(d), F.lit(" and "), m, F.lit(" "), n(d + 9), F.lit(", "), y, F.lit("; no show on "), m, F.lit(" 25")))
    t = e.select("event_id", grammar.several_dates(said, F.col("crawled_at")).alias("t"))
    return t.select("event_id", "t.start", F.array_join("t.rdates", ",").alias("rdates"), F.array_join("t.exdates", ",").alias("exdates"))


@query("""WITH e AS (SELECT event_id, event_id % 4 + 5 AS h FROM event_items)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN (h + 12)::VARCHAR || ':30' WHEN 1 THEN (h + 12)::VARCHAR || ':00-' || (h + 14)::VARCHAR || ':00' WHEN 2 THEN (h + 12)::VARCHAR || ':15' WHEN 3 THEN lpad(h::VARCHAR, 2, '0') || ':00' END AS clock FROM e""")
def q_clock_text(spark, sf_dir):
    h, k = (F.col("event_id") % 4 + 5).cast("string"), F.col("event_id") % 5
    said = F.when(k == 0, F.concat(F.lit("Doors at 4 | show at "), h, F.lit(":30"))).when(k == 1, F.concat(F.lit("from "), h, F.lit(" to "), (F.col("event_id") % 4 + 7).cast("string"), F.lit(" p.m."))).when(k == 2, F.concat((F.col("event_id") % 4 + 17).cast("string"), F.lit(":15 sharp"))).when(k == 3, F.concat(F.lit("Breakfast at "), h, F.lit("."))).otherwise(F.lit("at 8 locations in town"))
    return table(spark, sf_dir, "event_items").select("event_id", grammar.clock(said).alias("clock"))


@query()
def q_visible_text(spark, sf_dir):
    p = table(spark, sf_dir, "cases").select("case_id", pages_html.parsed(F.col("html"), F.col("url"))["visible_text"].alias("t"))
    return p.select("case_id", F.size(F.split("t", "\n")).alias("lines"), F.length("t").alias("chars"))


# The tables' own pages and texts, whole; no SQL follows these


@query()
def q_case_links(spark, sf_dir):
    a = cut(links.anchors(table(spark, sf_dir, "cases"), "case_id"))
    found = links.detail_links(a, "case_id").select("case_id", F.lit("detail").alias("kind"), "link")
    return found.unionByName(links.next_pages(a, "case_id").select("case_id", F.lit("next").alias("kind"), "link"))


@query()
def q_case_texts(spark, sf_dir):
    p, page = F.col("p"), F.col("url")
    c = spread(table(spark, sf_dir, "cases").select("case_id", "html", "url")).withColumn("p", pages_html.parsed(F.col("html"), page))
    return c.select("case_id", pagetext.full_text(p).alias("full_text"), pagetext.ticket_link(p, page).alias("ticket"), platforms.platform(p, F.col("html"), page).alias("platform"), F.array_join(platforms.calendar_feeds(p, page), ",").alias("feeds"))


@query()
def q_event_words(spark, sf_dir):
    said = F.concat_ws(" ", "title", "description")
    e = spread(table(spark, sf_dir, "event_items").select("event_id", "title", "description", "crawled_at"))
    e = e.select("event_id", grammar.clock(said).alias("clock"), grammar.several_dates(F.col("description"), F.col("crawled_at")).alias("t"), grammar.recurrence(said, F.col("crawled_at")).alias("r"))
    return e.select("event_id", "clock", "t.start", F.array_join("t.rdates", ",").alias("rdates"), F.array_join("t.exdates", ",").alias("exdates"), "r.freq", "r.interval", F.array_join("r.byday", ",").alias("byday"), "r.until")


# Made pages and records: what has to come out follows from the row


@query("""SELECT event_id, 'https://a.example/events/' || event_id || '-' || i AS link FROM (SELECT event_id, unnest(generate_series(1, event_id % 3 + 2)) AS i FROM event_items) WHERE event_id % 3 > 0""")
def q_detail_groups(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").select("event_id", F.sequence(F.lit(1).cast("long"), F.col("event_id") % 3 + 2).alias("n"))
    cards = F.array_join(F.transform("n", lambda i: F.concat(F.lit('<p class="c"><a class="l" href="/events/'), F.col("event_id").cast("string"), F.lit("-"), i.cast("string"), F.lit('#top">x</a></p>'))), "")
    body = F.concat(F.lit('<body><nav><a class="l" href="/events/nav">n</a></nav><div>'), cards, F.lit('</div><div class="o"><a href="/a">a</a><a href="/b">b</a><a href="/c">c</a><a href="/d">d</a></div></body>'))
    p = e.select("event_id", F.lit("https://a.example/list").alias("url"), body.alias("html"))
    return links.detail_links(links.anchors(p, "event_id"), "event_id").select("event_id", "link")


@query("""SELECT event_id, 'https://a.example/b/' AS link FROM event_items WHERE event_id % 2 = 0 UNION ALL SELECT event_id, 'https://a.example/a#x' FROM event_items WHERE event_id % 2 = 1""")
def q_unclaimed_links(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").select("event_id")
    details = e.select("event_id", F.explode(F.array(F.lit("https://a.example/a#x"), F.lit("https://a.example/b/"))).alias("link"))
    claimed = e.select("event_id", F.when(F.col("event_id") % 2 == 0, F.lit("https://a.example/a/")).otherwise(F.lit("https://a.example/b#y")).alias("url"))
    return links.unclaimed(details, claimed, "event_id")


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'tribe' WHEN 1 THEN 'squarespace' WHEN 2 THEN 'ical' WHEN 3 THEN 'eventbrite' WHEN 4 THEN 'scripts' END AS platform, CASE event_id % 6 WHEN 2 THEN 'https://a.example/x/cal.ics' ELSE '' END AS feeds FROM event_items""")
def q_platforms(spark, sf_dir):
    k = F.col("event_id") % 6
    body = (
        F.when(k == 0, F.lit('<div class="tribe-events-bar">x</div>')).when(k == 1, F.lit('<script src="https://static1.squarespace.com/a.js"></script><div class="eventlist">x</div>'))
        .when(k == 2, F.lit('<link rel="alternate" type="text/calendar" href="cal.ics"><a href="/1.ics">1</a><a href="/2.ics">2</a><a href="/3.ics">3</a>'))
        .when(k == 3, F.lit('<a href="https://www.eventbrite.com/o/us-1">us</a>')).when(k == 4, F.lit('<div id="root"></div>')).otherwise(F.lit("<p>plain</p>"))
    )
    page = F.lit("https://a.example/x/list")
    p = table(spark, sf_dir, "event_items").select("event_id", body.alias("b")).select("event_id", "b", pages_html.parsed(F.col("b"), page).alias("p"))
    return p.select("event_id", platforms.platform(F.col("p"), F.col("b"), page).alias("platform"), F.array_join(platforms.calendar_feeds(F.col("p"), page), ",").alias("feeds"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'weekly' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly' END AS freq, CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END::INTEGER AS interval, CASE event_id % 4 WHEN 0 THEN 'TH' WHEN 1 THEN 'MO,FR' WHEN 2 THEN '' END AS byday, CASE event_id % 4 WHEN 1 THEN '2027-01-31' END AS until FROM event_items""")
def q_schedule_rules(spark, sf_dir):
    k = F.col("event_id") % 4
    node = F.when(k == 0, F.lit('{"eventSchedule":{"repeatFrequency":"P2W","byDay":"https://schema.org/Thursday"}}')).when(k == 1, F.lit('{"eventSchedule":[{"repeatFrequency":"P14D","byDay":["Monday","FR"],"endDate":"2027-01-31T00:00"}]}')).when(k == 2, F.lit('{"Schedule":{"repeatFrequency":"P1M"}}')).otherwise(F.lit('{"name":"x"}'))
    r = table(spark, sf_dir, "event_items").select("event_id", finalise.schedule_rule(node).alias("r"))
    return r.select("event_id", "r.freq", F.coalesce("r.interval", F.lit(0)).alias("interval"), F.when(F.col("r.byday").isNotNull(), F.array_join("r.byday", ",")).alias("byday"), "r.until")


@query("""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'Listed ' || event_id ELSE 'Event ' || event_id END AS title, CASE event_id % 4 WHEN 0 THEN strftime(crawled_at, '%Y-%m-%d') WHEN 1 THEN strftime(crawled_at + INTERVAL 40 DAYS, '%Y-%m-%dT20:00:00') ELSE strftime(crawled_at, '%Y-%m-%dT18:00') END AS start_datetime,
  CASE WHEN event_id % 4 = 2 THEN 'weekly' END AS recurrence_freq, CASE WHEN event_id % 2 = 0 THEN 'Own Hall' ELSE 'Context Hall' END AS location_title FROM event_items""")
def q_finished(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").select("event_id", "crawled_at")
    k, at = F.col("event_id") % 4, F.col("crawled_at")
    name = F.col("event_id").cast("string")
    c = e.select(
        "event_id", F.to_date(at).alias("as_of"), F.when(k == 3, F.lit("Some Site")).otherwise(F.concat(F.lit("Event "), name)).alias("title"),
        F.when(k == 1, F.concat(F.lit("Comes on "), F.date_format(at + F.expr("INTERVAL 40 DAYS"), "MMMM d, yyyy"), F.lit(" at 8 pm."))).when(k == 2, F.lit("Held every Monday.")).otherwise(F.lit("Nothing more.")).alias("description"),
        F.when(k == 0, F.date_format(at, "yyyy-MM-dd'T'00:00")).when(k == 1, F.lit(None)).otherwise(F.date_format(at, "yyyy-MM-dd'T'18:00")).alias("start_datetime"), F.when(k == 0, F.date_format(at, "yyyy-MM-dd'T'23:59")).alias("end_datetime"),
        F.when(F.col("event_id") % 2 == 0, F.lit("Own Hall")).alias("location_title"), F.lit(None).cast("string").alias("location_address"), F.when(k == 3, F.lit("opengraph")).otherwise(F.lit("jsonld")).alias("extraction_method"),
    )
    listed = e.where(k == 3).select("event_id", F.concat(F.lit("Listed "), name).alias("title"))
    context = e.select("event_id", F.lit("Context Hall").alias("location_title"))
    return finalise.finished(c, "event_id", listings=listed, contexts=context).select("event_id", "title", "start_datetime", "recurrence_freq", "location_title")


@query("""SELECT event_id % 50 AS page, CASE WHEN (event_id % 50) % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS agreement FROM event_items GROUP BY event_id % 50""")
def q_recipe_agreement(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").select((F.col("event_id") % 50).alias("page"), F.format_string("Show %05d", "event_id").alias("title"), F.lit("2026-01-01").alias("start_datetime"))
    found = e.select("page", F.concat(F.upper("title"), F.lit("!")).alias("title"), F.when(F.col("page") % 2 == 0, F.lit("2026-01-01T20:00")).otherwise(F.lit("2026-02-02")).alias("start_datetime"))
    return extract.recipe_agreement(found, e, "page")


@query("""SELECT event_id, lower(trim(title)) = lower(trim(title || ' ')) AS same_title, coalesce(rtrim(url, '/'), '') = coalesce(rtrim(url || '/', '/'), '') AS same_url, location_lat IS NULL OR coalesce(NOT isnan(location_lat), FALSE) AS same_lat FROM event_items""")
def q_same_fields(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    near = F.when(~F.isnan("location_lat"), F.col("location_lat") + 0.0004)
    same_lat = F.when(F.isnan("location_lat"), F.lit(False)).otherwise(evaluate.same_point(F.col("location_lat"), near))
    return e.select("event_id", evaluate.same_text(F.col("title"), F.concat("title", F.lit(" "))).alias("same_title"), evaluate.same_url(F.col("url"), F.concat("url", F.lit("/"))).alias("same_url"), same_lat.alias("same_lat"))

@query(f"""WITH s AS ({_STATES}), k AS (SELECT source_id, regexp_replace(url, '/+$', '') AS u, any_value(fetched_at) AS f, any_value(extraction_version) AS v FROM s GROUP BY ALL),
e AS (SELECT p.source_id, e.event_id, CASE WHEN e.event_id % 3 > 0 THEN p.url END AS u, CASE WHEN e.event_id % 2 = 0 THEN 'emit' ELSE '' END AS r FROM event_items e JOIN (SELECT source_id, min(url) AS url FROM page_states GROUP BY source_id) p USING (source_id))
SELECT e.event_id, CASE WHEN e.u IS NULL OR e.r = 'emit' THEN 'emit' WHEN k.f IS NOT NULL AND k.v = 4 AND TIMESTAMP '2026-06-01' - k.f <= INTERVAL 7 DAYS AND TIMESTAMP '2026-01-01' <= k.f THEN 'skip' ELSE 'follow' END AS route FROM e LEFT JOIN k ON e.source_id = k.source_id AND regexp_replace(e.u, '/+$', '') = k.u""")
def q_crawl_routes(spark, sf_dir):
    states = table(spark, sf_dir, "page_states")
    first = states.groupBy("source_id").agg(F.min("url").alias("url"))
    n = F.col("event_id")
    e = table(spark, sf_dir, "event_items").select("source_id", "event_id").join(first, "source_id").select(
        "source_id", "event_id", F.concat(urls.home_url(F.col("url")), F.lit("list")).alias("listing_url"), F.when(n % 3 > 0, F.col("url")).alias("url"), F.lit("2026-01-01").alias("start_datetime"), F.lit("2026-01-01").alias("end_datetime"),
        F.when(n % 2 == 0, F.lit("All is said.")).otherwise(F.lit("More soon…")).alias("description"), F.lit("1 Road").alias("location_address"), F.lit(None).cast("double").alias("location_lat"), F.lit(None).cast("string").alias("listing_hash"), F.lit("2026-01-01").cast("timestamp").alias("lastmod"),
    )
    return crawl.routed(e, states, F.lit("2026-06-01").cast("timestamp"), 4).select("event_id", "route")


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'https://tix.example/e/' || event_id END AS ticket FROM event_items""")
def q_ticket_links(spark, sf_dir):
    n = F.col("event_id").cast("string")
    body = F.concat(F.lit('<nav><a href="https://nav.example/">Tickets</a></nav><a href="/about">Tickets</a><a href="https://'), F.when(F.col("event_id") % 2 == 0, F.lit("tix")).otherwise(F.lit("x.a")), F.lit(".example/e/"), n, F.lit('">Buy tickets (new)</a>'))
    page = F.lit("https://a.example/e")
    p = table(spark, sf_dir, "event_items").select("event_id", pages_html.parsed(body, page).alias("p"))
    return p.select("event_id", pagetext.ticket_link(F.col("p"), page).alias("ticket"))


@query("""SELECT event_id, 'Hello there' || chr(10) || 'Event ' || event_id || ' starts soon' AS full_text FROM event_items""")
def q_full_text(spark, sf_dir):
    n = F.col("event_id").cast("string")
    body = F.concat(F.lit('<p>Hello there</p><script type="application/json">{"a":["Hello there","<b>Event</b> '), n, F.lit(' starts soon","/img/a b.png","x"],"u":"https://a.example/a b"}</script>'))
    p = table(spark, sf_dir, "event_items").select("event_id", pages_html.parsed(body, F.lit(None).cast("string")).alias("p"))
    return p.select("event_id", pagetext.full_text(F.col("p")).alias("full_text"))


@query("""SELECT case_id, concat_ws(',', CASE WHEN coalesce(url, '') = '' THEN 'url' END, CASE WHEN NOT coalesce(kind IN ('listing', 'detail', 'site'), FALSE) THEN 'kind' END, CASE WHEN NOT coalesce(source IN ('manual', 'crawl', 'correction', 'page_review', 'report'), FALSE) THEN 'source' END,
  CASE WHEN try_cast(captured_at AS TIMESTAMPTZ) IS NULL THEN 'captured_at' END, CASE WHEN coalesce(len(list_filter(CAST(events AS JSON[]), lambda e: coalesce(json_extract_string(e, '$.title'), '') = '')), 0) > 0 THEN 'title' END, CASE WHEN coalesce(html, '') = '' THEN 'html' END) AS problems FROM cases""")
def q_case_problems(spark, sf_dir):
    return evaluate.case_problems(table(spark, sf_dir, "cases")).select("case_id", F.array_join("problems", ",").alias("problems"))


@query("""WITH e AS (SELECT event_id, start_datetime AS v, regexp_matches(start_datetime, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(Z|[+-]\\d{2}:\\d{2})$') AS o FROM event_items WHERE start_datetime IS NOT NULL AND NOT contains(start_datetime, '[') AND trim(start_datetime) = start_datetime)
SELECT event_id, CASE WHEN o THEN regexp_replace(strftime(timezone('America/New_York', CAST(v AS TIMESTAMPTZ)), '%Y-%m-%dT%H:%M'), 'T00:00$', '') ELSE '' END AS local FROM e""")
def q_local_times(spark, sf_dir):
    e = table(spark, sf_dir, "event_items").where("start_datetime IS NOT NULL AND NOT contains(start_datetime, '[') AND trim(start_datetime) = start_datetime")
    iso = F.col("start_datetime").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$")
    return e.select("event_id", F.when(iso, evaluate.local_time(F.col("start_datetime"), F.lit("America/New_York"))).otherwise(F.lit("")).alias("local"))


@query()
def q_local_times_rows(spark, sf_dir):
    """All rows, with the starts of p4; what p4 can't read stays as it is."""
    e = table(spark, sf_dir, "event_items")
    u = times.with_utc(e, table(spark, sf_dir, "sources"), ("start_datetime",), ("event_id", "start_datetime"))
    return u.select("event_id", evaluate.local_time(F.coalesce("start_datetime_utc", "start_datetime"), F.lit("America/New_York")).alias("local"))


# Streams

@query("""SELECT fingerprint, event_id FROM event_items WHERE fingerprint IS NOT NULL QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY crawled_at DESC NULLS LAST, event_id DESC) = 1""")
def q_stream_upsert(spark, sf_dir):
    from evenfall.streaming import ingest

    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    path = f"{sf_dir}/event_items.parquet"
    q = ingest.run_upsert(ingest.read(spark, path, spark.read.parquet(path).schema, files=1000), f"{folder}/table", f"{folder}/checkpoint")
    q.awaitTermination()
    return ingest.upserted(spark, f"{folder}/table").select("fingerprint", "event_id")


from evenfall import queries_runs  # noqa: E402, F401  # adds its queries to these
