"""Queries of what runs and their checks need, with the SQL that gives the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenfall.functions import pagetext, urls
from evenfall.operators import evaluate, incremental, links, runs
from evenfall.plans import crawl
from evenfall.queries import _STATES, query
from evenfall.runtime import table
from evenfall.sources import feeds

_KEY = "regexp_replace(regexp_replace({0}, '#.*$', ''), '/+$', '')"


@query(f"""WITH s AS ({_STATES}), a AS (SELECT *, (coalesce(etag, '') <> '' OR coalesce(last_modified, '') <> '') AND len(coalesce(fingerprints, [])) > 0 AS able FROM s)
SELECT source_id, url, CASE WHEN able THEN etag END AS if_none_match, CASE WHEN able THEN last_modified END AS if_modified_since FROM a""")
def q_conditional_fetches(spark, sf_dir):
    return runs.conditional_fetches(table(spark, sf_dir, "page_states"))


@query(f"""WITH s AS ({_STATES}) SELECT DISTINCT source_id, fingerprint FROM (SELECT source_id, fingerprint FROM event_items UNION ALL SELECT source_id, unnest(fingerprints) FROM s WHERE length(url) % 2 = 0 AND source_id IS NOT NULL) WHERE fingerprint IS NOT NULL""")
def q_still_seen(spark, sf_dir):
    states = table(spark, sf_dir, "page_states")
    responses = incremental.current_states(states).select("source_id", "url", F.when(F.length("url") % 2 == 0, 304).otherwise(200).alias("status"))
    return runs.still_seen(states, responses, table(spark, sf_dir, "event_items"))


@query("""SELECT event_id, coalesce(recurrence_freq, 'none') AS freq, coalesce(recurrence_interval, 1) AS interval, array_to_string(coalesce(recurrence_byday, []), ',') AS byday, coalesce(recurrence_month_mode, 'day') AS month_mode, len(coalesce(tag_names, []))::INTEGER AS tags FROM event_items""")
def q_defaults(spark, sf_dir):
    e = runs.with_defaults(table(spark, sf_dir, "event_items"))
    return e.select("event_id", F.col("recurrence_freq").alias("freq"), F.col("recurrence_interval").alias("interval"), F.array_join("recurrence_byday", ",").alias("byday"), F.col("recurrence_month_mode").alias("month_mode"), F.size("tag_names").alias("tags"))


@query("""SELECT event_id, array_to_string(list_filter(list_transform(coalesce(rdates, []), lambda x: strftime(try_cast(x AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S')), lambda x: x IS NOT NULL), ',') AS rdates,
  array_to_string(list_filter(list_transform(coalesce(exdates, []), lambda x: strftime(try_cast(x.datetime AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') || '|' || coalesce(x.reason, '')), lambda x: x IS NOT NULL), ',') AS exdates FROM event_items""")
def q_instants(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    ex = F.transform(runs.exceptions(F.col("exdates")), lambda x: F.concat(x["datetime"], F.lit("|"), F.coalesce(x["reason"], F.lit(""))))
    return e.select("event_id", F.array_join(runs.instants(F.col("rdates")), ",").alias("rdates"), F.array_join(ex, ",").alias("exdates"))


@query("""SELECT event_id, title, start_datetime, location_title, url, fingerprint, coalesce(extraction_method, 'unknown') AS extraction_method FROM event_items""")
def q_items(spark, sf_dir):
    return runs.items(table(spark, sf_dir, "event_items")).select("event_id", "title", "start_datetime", "location_title", "url", "fingerprint", "extraction_method")


@query(f"""SELECT DISTINCT {_KEY.format('url')} AS page_key FROM event_items WHERE url IS NOT NULL AND {_KEY.format('url')} NOT IN (SELECT {_KEY.format('url')} FROM page_states WHERE url IS NOT NULL)""")
def q_not_fetched(spark, sf_dir):
    return runs.not_fetched(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "page_states"))


@query("""WITH n AS (SELECT source_id, count(*) AS n FROM event_items GROUP BY source_id)
SELECT coalesce(status, 'unknown') AS status, count(*) AS sources, coalesce(sum(n), 0)::BIGINT AS events, count(*) FILTER (WHERE coalesce(baseline_events, 0) > 0 AND coalesce(n, 0) = 0) AS broken FROM sources LEFT JOIN n USING (source_id) GROUP BY 1""")
def q_crawl_summary(spark, sf_dir):
    return runs.crawl_summary(table(spark, sf_dir, "sources"), table(spark, sf_dir, "event_items"))


@query("""SELECT source_id, count(*) AS events FROM event_items WHERE source_id IS NOT NULL GROUP BY source_id ORDER BY events DESC, source_id LIMIT 5""")
def q_largest_sources(spark, sf_dir):
    return runs.largest(table(spark, sf_dir, "event_items"), "source_id")


@query("""WITH c AS (SELECT source_id, 2 AS rank, 'links' AS kind, url FROM page_states WHERE kind = 'listing' UNION ALL SELECT source_id, 3, 'sitemap', listing_url FROM page_states UNION ALL SELECT source_id, 5, 'home', homepage_url FROM sources),
g AS (SELECT source_id, rank, kind, array_to_string(list_sort(list_distinct(list(url))), ' ') AS urls FROM c WHERE url IS NOT NULL GROUP BY ALL)
SELECT source_id, kind, urls FROM g QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY rank) = 1""")
def q_listings(spark, sf_dir):
    states = table(spark, sf_dir, "page_states")
    c = states.where("kind = 'listing'").select("source_id", F.lit("links").alias("kind"), "url").unionByName(states.select("source_id", F.lit("sitemap").alias("kind"), F.col("listing_url").alias("url")))
    c = c.unionByName(table(spark, sf_dir, "sources").select("source_id", F.lit("home").alias("kind"), F.col("homepage_url").alias("url")))
    return runs.listing(c).select("source_id", "kind", F.array_join("urls", " ").alias("urls"))


@query(f"""WITH r AS (SELECT DISTINCT source_id, {_KEY.format('url')} AS k FROM page_states WHERE content_hash IS NOT NULL AND url IS NOT NULL)
SELECT event_id, CASE WHEN r.k IS NULL THEN 'partial' ELSE 'page' END AS outcome FROM event_items e LEFT JOIN r ON r.source_id = e.source_id AND r.k = {_KEY.format('e.url')}""")
def q_outcomes(spark, sf_dir):
    return runs.outcomes(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "page_states"))


@query(f"""WITH r AS (SELECT DISTINCT {_KEY.format('url')} AS k FROM page_states WHERE content_hash IS NOT NULL AND url IS NOT NULL),
g AS (SELECT {_KEY.format('source_url')} AS k, count(*) AS n, count(drop_reason) AS d FROM event_items WHERE source_url IS NOT NULL GROUP BY 1),
q AS (SELECT 'event ' || event_id AS report_id, {_KEY.format('url')} AS k FROM event_items UNION ALL SELECT k, k FROM r)
SELECT report_id, CASE WHEN coalesce(n, 0) > coalesce(d, 0) THEN 'not_discovered' WHEN coalesce(n, 0) > 0 THEN 'validation_dropped' WHEN r.k IS NOT NULL THEN 'extraction_failed' ELSE 'blocked' END AS diagnosis FROM q LEFT JOIN r ON r.k = q.k LEFT JOIN g ON g.k = q.k""")
def q_diagnoses(spark, sf_dir):
    e, s = table(spark, sf_dir, "event_items"), table(spark, sf_dir, "page_states")
    # all events' own pages, and all pages that were read
    known = s.where("content_hash IS NOT NULL AND url IS NOT NULL").select(urls.page_key(F.col("url")).alias("url")).distinct()
    reports = e.select(F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("report_id"), "url").unionByName(known.select(F.col("url").alias("report_id"), "url"))
    return runs.diagnoses(reports, s, e)


@query("""SELECT event_id, nullif(CASE WHEN event_id % 3 = 0 THEN title || '!' ELSE title END, '') AS title, CASE WHEN trim(start_datetime) <> '' THEN start_datetime END AS start_datetime, CASE WHEN trim(location_title) <> '' THEN location_title END AS location_title, CASE WHEN coalesce(recurrence_freq, 'none') <> 'none' THEN recurrence_freq END AS recurrence_freq FROM event_items""")
def q_labels(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    none = F.lit(None).cast("string")
    corrected = e.where("event_id % 3 = 0").select("event_id", F.concat("title", F.lit("!")).alias("title"), *[none.alias(c) for c in runs.LABEL[1:]])
    return runs.labels(e, corrected, "event_id").select("event_id", "title", "start_datetime", "location_title", "recurrence_freq")


@query(r"""SELECT event_id, CASE WHEN coalesce(evidence, '') <> '' AND NOT regexp_matches(evidence, '(?i)\b(?:jan|feb|mar|apr|may|jun|jul|aug|sept?|oct|nov|dec|january|february|march|april|june|july|august|september|october|november|december|mon|tue|tues|wed|thu|thur|thurs|fri|sat|sun|monday|tuesday|wednesday|thursday|friday|saturday|sunday|today|tonight|tomorrow|weekend|weekly|daily)\b|\d{1,2}[/.]\d{1,2}|\d{4}-\d{2}-\d{2}')
  AND (substr(start_datetime, 1, 10) = strftime(crawled_at, '%Y-%m-%d') OR regexp_matches(start_datetime, '^\d{4}-\d{2}-01(T00:00(:00)?.*)?$')) THEN NULL ELSE start_datetime END AS start_datetime FROM event_items""")
def q_checked_dates(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    return e.select("event_id", runs.checked_date(F.col("start_datetime"), F.col("evidence"), F.col("crawled_at")).alias("start_datetime"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 AND substr(start_datetime, 1, 10) <> strftime(crawled_at, '%Y-%m-%d') THEN strftime(crawled_at, '%Y-%m-%d') ELSE start_datetime END AS start_datetime FROM event_items""")
def q_listing_days(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    day = F.date_format("crawled_at", "yyyy-MM-dd")
    days = F.when(F.col("event_id") % 2 == 0, F.array(day, day)).otherwise(F.array(day, F.lit("1999-01-01")))
    return e.select("event_id", runs.listing_day(F.col("start_datetime"), day, days).alias("start_datetime"))


@query(r"""WITH v AS (SELECT event_id, start_datetime AS v, try_cast(nullif(regexp_extract(start_datetime, '^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2})?)', 1), '') AS TIMESTAMP) AS w, regexp_extract(start_datetime, 'T\d{2}:\d{2}(?::\d{2})?([+-]\d{2}:\d{2})$', 1) AS o FROM event_items),
m AS (SELECT *, CASE WHEN o <> '' THEN CASE WHEN o[1] = '-' THEN -1 ELSE 1 END * (o[2:3]::INTEGER * 60 + o[5:6]::INTEGER) END AS said, date_diff('minute', timezone('UTC', timezone('America/New_York', w)), w) AS now,
  date_diff('minute', timezone('UTC', timezone('America/New_York', w - INTERVAL 14 DAYS)), w - INTERVAL 14 DAYS) AS before, date_diff('minute', timezone('UTC', timezone('America/New_York', w + INTERVAL 14 DAYS)), w + INTERVAL 14 DAYS) AS behind FROM v)
SELECT event_id, CASE WHEN said <> now AND abs(said - now) = 60 AND (before = said OR behind = said) THEN regexp_replace(v, '[+-]\d{2}:\d{2}$', '') || CASE WHEN now < 0 THEN '-' ELSE '+' END || lpad((abs(now) // 60)::VARCHAR, 2, '0') || ':' || lpad((abs(now) % 60)::VARCHAR, 2, '0') ELSE v END AS start_datetime FROM m""")
def q_stale_offsets(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    return e.select("event_id", runs.without_stale_offset(F.col("start_datetime"), F.lit("America/New_York")).alias("start_datetime"))


@query(f"""WITH s AS ({_STATES}) SELECT source_id, url, coalesce(last_listed_at <= fetched_at AND extraction_version = 4 AND content_hash <> CASE WHEN length(url) % 2 = 0 THEN 'other' ELSE content_hash END, FALSE) AS missed FROM s""")
def q_missed_changes(spark, sf_dir):
    s = incremental.current_states(table(spark, sf_dir, "page_states"))
    content = F.when(F.length("url") % 2 == 0, F.lit("other")).otherwise(F.col("content_hash"))
    return s.select("source_id", "url", incremental.lastmod_missed_change(F.col("fetched_at"), F.col("extraction_version"), F.col("content_hash"), content, F.col("last_listed_at"), 4).alias("missed"))


@query("""SELECT event_id, coalesce(array_to_string(list_filter(coalesce(tag_names, []), lambda x, i: list_position(tag_names, x) = i), '|'), '') AS tags FROM event_items""")
def q_distinct_in_order(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    return e.select("event_id", F.array_join(F.array_distinct(F.array_compact(F.coalesce("tag_names", F.array().cast("array<string>")))), "|").alias("tags"))


@query(r"""WITH u AS (SELECT source_id, homepage_url, regexp_extract(homepage_url, '^([a-z]+://[^/?#]+)', 1) AS home FROM sources)
SELECT source_id, CASE WHEN length(homepage_url) % 2 = 0 THEN home || '/a.xml ' || home || '/b.xml' ELSE home || '/sitemap.xml' END AS roots FROM u""")
def q_sitemap_roots(spark, sf_dir):
    home = F.regexp_extract("homepage_url", r"^([a-z]+://[^/?#]+)", 1)
    robots = F.when(F.length("homepage_url") % 2 == 0, F.concat(F.lit("User-agent: *\nSitemap: "), home, F.lit("/a.xml\n  sitemap :"), home, F.lit("/b.xml \r\nSITEMAP: "), home, F.lit("/a.xml"))).otherwise(F.lit("Disallow: /"))
    return table(spark, sf_dir, "sources").select("source_id", F.array_join(feeds.sitemap_roots(robots, F.col("homepage_url")), " ").alias("roots"))


@query("""SELECT event_id, 'https://x.example/' || CASE k WHEN 0 THEN 'Events' WHEN 1 THEN 'pages' ELSE 'show' END || event_id || '.xml' AS loc, CASE k WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 2 END AS rank FROM event_items, (SELECT unnest([0, 1, 2]) AS k)""")
def q_sitemap_children(spark, sf_dir):
    n = F.col("event_id").cast("string")
    body = F.concat(F.lit("<sitemapindex><sitemap><loc>https://x.example/Events"), n, F.lit(".xml</loc></sitemap><sitemap><loc>https://x.example/pages"), n, F.lit(".xml</loc></sitemap><sitemap><loc>https://x.example/show"), n, F.lit(".xml</loc></sitemap></sitemapindex>"))
    m = table(spark, sf_dir, "event_items").select("event_id", body.alias("body"))
    return feeds.sitemap_children(feeds.sitemap_entries(m, "event_id"), "event_id")


@query("""SELECT area_id, lat - radius_km / 111.0 AS south, lon - radius_km / 111.0 / cos(radians(lat)) AS west, lat + radius_km / 111.0 AS north, lon + radius_km / 111.0 / cos(radians(lat)) AS east FROM search_areas""")
def q_area_boxes(spark, sf_dir):
    a = table(spark, sf_dir, "search_areas")
    return a.select("area_id", feeds.area_box(F.col("lat"), F.col("lon"), F.col("radius_km")).alias("b")).select("area_id", "b.*")


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Songs' || chr(10) || 'All of it' ELSE 'Songs' || chr(10) || CASE event_id % 3 WHEN 1 THEN '' ELSE 'Previous' || chr(10) || 'no date here' || chr(10) || 'Other show' || chr(10) END || 'All of it' END AS text FROM event_items""")
def q_without_pagers(spark, sf_dir):
    k = F.col("event_id") % 3
    text = F.when(k == 0, F.lit("Songs\nAll of it")).when(k == 1, F.lit("Songs\n« Previous event\nMay 4 at 8\nOther show\nAll of it")).otherwise(F.lit("Songs\nPrevious\nno date here\nOther show\nAll of it"))
    return table(spark, sf_dir, "event_items").select("event_id", pagetext.without_pager(text).alias("text"))


@query("""SELECT event_id, length(coalesce(description, '')) >= 50 OR (contains(coalesce(end_datetime, ''), 'T') AND event_id % 2 = 0) OR event_id % 5 = 0 AS added FROM event_items""")
def q_added_info(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    before = F.when(F.col("event_id") % 2 == 0, F.lit("2026-01-01")).otherwise(F.lit("2026-01-01T10:00"))
    return e.select("event_id", pagetext.added_info(F.lit(None).cast("string"), F.col("description"), before, F.col("end_datetime"), F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)).alias("added"))


@query(f"""WITH s AS ({_STATES}) SELECT DISTINCT source_id, fingerprint FROM (SELECT source_id, fingerprint FROM event_items WHERE event_id % 2 = 0 AND source_id IS NOT NULL UNION ALL SELECT source_id, unnest(fingerprints) FROM s WHERE length(url) % 3 = 0 AND source_id IS NOT NULL) WHERE fingerprint IS NOT NULL""")
def q_still_listed(spark, sf_dir):
    e, states = table(spark, sf_dir, "event_items"), table(spark, sf_dir, "page_states")
    routes = e.select("source_id", "event_id", F.when(F.col("event_id") % 2 == 0, "emit").otherwise("follow").alias("route"), F.lit(None).cast("string").alias("detail_url"))
    skipped = states.where("length(url) % 3 = 0").select("source_id", F.lit(None).cast("long").alias("event_id"), F.lit("skip").alias("route"), F.col("url").alias("detail_url")).distinct()
    return crawl.still_listed(e, routes.unionByName(skipped), states)


@query("""SELECT event_id, coalesce(list_sort(list_distinct(list_transform(coalesce(tag_names, []), lambda x: x))), []) = [] OR event_id % 2 = 0 AS same FROM event_items""")
def q_same_sets(spark, sf_dir):
    e = table(spark, sf_dir, "event_items")
    none = F.array().cast("array<string>")
    tags = F.array_compact(F.coalesce("tag_names", none))
    other = F.when(F.col("event_id") % 2 == 0, F.concat(F.reverse(tags), F.transform(tags, F.upper))).otherwise(none)
    return e.select("event_id", evaluate.same_set(tags, other).alias("same"))


@query("""SELECT source_id, homepage_url || '/events/' AS link FROM sources""")
def q_events_pages_of_sitemaps(spark, sf_dir):
    s = table(spark, sf_dir, "sources")
    paths = F.array(*[F.lit(x) for x in ("/events/", "/events/2026/jam", "/about", "/events/")])
    entries = s.select("source_id", F.explode(F.transform(paths, lambda x: F.concat("homepage_url", x))).alias("loc"))
    return links.events_pages_of_sitemap(entries, "source_id").select("source_id", "link")
