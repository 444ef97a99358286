"""What a run and its checks need besides extraction: conditional fetches, projections, coverage, labels and diagnoses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenfall.functions import urls
from evenfall.operators import incremental
from evenfall.operators.evaluate import similarity

# Words that date a text, besides figures.
DATED = r"(?i)\b(?:jan|feb|mar|apr|may|jun|jul|aug|sept?|oct|nov|dec|january|february|march|april|june|july|august|september|october|november|december|mon|tue|tues|wed|thu|thur|thurs|fri|sat|sun|monday|tuesday|wednesday|thursday|friday|saturday|sunday|today|tonight|tomorrow|weekend|weekly|daily)\b|\d{1,2}[/.]\d{1,2}|\d{4}-\d{2}-\d{2}"


def conditional_fetches(states: DataFrame) -> DataFrame:
    """source_id, url, if_none_match, if_modified_since: validators that a fetch of each known page sends.

    Both are null, so the page is fetched whole, unless the page's last state has a validator and fingerprints that could be carried.
    """
    s = incremental.current_states(states)
    able = (F.coalesce("etag", F.lit("")) != "") | (F.coalesce("last_modified", F.lit("")) != "")
    able = able & (F.size(F.coalesce("fingerprints", F.array().cast("array<string>"))) > 0)
    return s.select("source_id", "url", F.when(able, F.col("etag")).alias("if_none_match"), F.when(able, F.col("last_modified")).alias("if_modified_since"))


def still_seen(states: DataFrame, responses: DataFrame, seen: DataFrame) -> DataFrame:
    """source_id, fingerprint: what a run has seen, with what pages listed before that answer that they haven't changed.

    responses: source_id, url, status; seen: source_id, fingerprint.
    """
    same = responses.where(F.col("status") == 304)
    return seen.where("fingerprint IS NOT NULL").select("source_id", "fingerprint").unionByName(incremental.carried_fingerprints(states, same)).distinct()


def with_defaults(events: DataFrame) -> DataFrame:
    """Nulls of recurrence and tags by their defaults: no frequency, every period, no days, by day, no tags."""
    none = F.array().cast("array<string>")
    default = {"recurrence_freq": F.lit("none"), "recurrence_interval": F.lit(1), "recurrence_byday": none, "recurrence_month_mode": F.lit("day"), "tag_names": none}
    return events.withColumns({c: F.coalesce(F.col(c), d) for c, d in default.items()})


def instants(values: Column) -> Column:
    """ISO dates of an array to the second, in UTC; what is none, and what is null, is left out."""
    parsed = F.transform(values, lambda v: F.date_format(F.try_to_timestamp(v), "yyyy-MM-dd'T'HH:mm:ss"))
    return F.array_compact(F.coalesce(parsed, F.array().cast("array<string>")))


def exceptions(values: Column) -> Column:
    """The same for an array of structs (datetime, reason), which keep their reasons."""
    parsed = F.transform(values, lambda v: F.struct(F.date_format(F.try_to_timestamp(v["datetime"]), "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"), v["reason"].alias("reason")))
    return F.filter(F.coalesce(parsed, F.array().cast("array<struct<datetime:string,reason:string>>")), lambda v: v["datetime"].isNotNull())


#: Fields that leave the pipeline with an event.
ITEM = ("title", "description", "start_datetime", "end_datetime", "location_title", "location_address", "location_lat", "location_lon", "ticket_url", "rsvp_url", "url", "image_url", "tag_names", "recurrence_freq", "recurrence_interval", "recurrence_byday", "recurrence_month_mode", "recurrence_until", "recurrence_count", "rdates", "exdates", "source_url", "listing_url", "fingerprint", "extraction_method")


def items(events: DataFrame, key: str = "event_id") -> DataFrame:
    """The key and the known fields only; missing ones are null, and an unnamed method is 'unknown'."""
    at = {c: F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in ITEM}
    at["extraction_method"] = F.coalesce(at["extraction_method"], F.lit("unknown")).alias("extraction_method")
    return events.select(key, *at.values())


def not_fetched(expected: DataFrame, fetched: DataFrame, url: str = "url") -> DataFrame:
    """page_key: expected pages that no run has fetched, compared without fragments and trailing slashes."""
    keys = lambda d: d.where(F.col(url).isNotNull()).select(urls.page_key(F.col(url)).alias("page_key")).distinct()
    return keys(expected).join(keys(fetched), "page_key", "left_anti")


def crawl_summary(sources: DataFrame, events: DataFrame) -> DataFrame:
    """status, sources, events, broken: by status, the sources, their events, and how many gave some before and give none now."""
    n = events.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    j = sources.select("source_id", F.coalesce("status", F.lit("unknown")).alias("status"), "baseline_events").join(n, "source_id", "left")
    found = F.coalesce("n", F.lit(0))
    broken = (F.coalesce("baseline_events", F.lit(0)) > 0) & (found == 0)
    return j.groupBy("status").agg(F.count(F.lit(1)).alias("sources"), F.sum(found).alias("events"), F.count_if(broken).alias("broken"))


def largest(events: DataFrame, by: str, top: int = 5) -> DataFrame:
    """by, events: a report of the top groups by rows, ties by name; top is the feature."""
    return events.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("events")).orderBy(F.desc("events"), by).limit(top)


def listing(candidates: DataFrame, order: tuple[str, ...] = ("platform", "links", "sitemap", "model", "home")) -> DataFrame:
    """source_id, kind, urls: of a source's candidate pages (source_id, kind, url) those of the first kind in order that it has, sorted."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("kind"))
    c = candidates.where("url IS NOT NULL").groupBy("source_id", "kind", rank.alias("_rank")).agg(F.array_sort(F.collect_set("url")).alias("urls")).where("_rank > 0")
    return c.groupBy("source_id").agg(F.min(F.struct("_rank", "kind", "urls")).alias("b")).select("source_id", "b.kind", "b.urls")


def outcomes(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """event_id, outcome: 'page' where the entry's page (by source_id and url) was read, else 'partial': the entry as its listing gives it."""
    read = pages.where("content_hash IS NOT NULL AND url IS NOT NULL").select("source_id", urls.page_key(F.col("url")).alias("_k")).distinct().withColumn("_read", F.lit(True))
    e = entries.withColumn("_k", urls.page_key(F.col("url"))).join(read, ["source_id", "_k"], "left")
    return e.select("event_id", F.when(F.col("_read"), F.lit("page")).otherwise(F.lit("partial")).alias("outcome"))


def diagnoses(reports: DataFrame, states: DataFrame, events: DataFrame) -> DataFrame:
    """report_id, diagnosis: why the event of a reported page (url) is missing.

    'blocked': the page has never been read; 'extraction_failed': it gave no event; 'validation_dropped': all it gave were dropped;
    'not_discovered': it gives events, so the one reported stands on a page that isn't known.
    """
    key = lambda c: urls.page_key(F.col(c)).alias("_k")
    read = states.where("content_hash IS NOT NULL AND url IS NOT NULL").select(key("url")).distinct().withColumn("_read", F.lit(True))
    gave = events.where("source_url IS NOT NULL").groupBy(key("source_url")).agg(F.count(F.lit(1)).alias("_all"), F.count("drop_reason").alias("_dropped"))
    j = reports.select("report_id", key("url")).join(read, "_k", "left").join(gave, "_k", "left")
    n = F.coalesce("_all", F.lit(0))
    return j.select("report_id", F.when(n > F.coalesce("_dropped", F.lit(0)), "not_discovered").when(n > 0, "validation_dropped").when(F.col("_read"), "extraction_failed").otherwise("blocked").alias("diagnosis"))


def _similarities(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype=float)


LABEL = ("title", "start_datetime", "end_datetime", "location_title", "location_address", "url")


def labels(parsed: DataFrame, corrected: DataFrame | None = None, key: str = "fingerprint") -> DataFrame:
    """key and the fields of a label: what was parsed, overridden by what was corrected; blank values are null, recurrence only of recurring events."""
    blank = lambda c: F.when(F.trim(c) != "", c)
    rule = F.when(F.coalesce("recurrence_freq", F.lit("none")) != "none", F.col("recurrence_freq"))
    p = parsed.select(key, *[blank(F.col(c)).alias(c) for c in LABEL], rule.alias("recurrence_freq"))
    if corrected is None:
        return p
    c = corrected.select(key, *[blank(F.col(x)).alias(f"_{x}") for x in LABEL])
    return p.join(c, key, "left").select(key, *[F.coalesce(f"_{x}", x).alias(x) for x in LABEL], "recurrence_freq")


def corrected_records(corrections: DataFrame, parsed: DataFrame, least: float = 0.8) -> DataFrame:
    """correction_id, event_id, how: the parsed record that a correction means: of the same fingerprint, else of the most similar title on its page.

    corrections: correction_id, page_url, fingerprint, title; parsed: event_id, page_url, fingerprint, title. Titles count from a similarity
    of least on; ties go to the lesser event_id. Only what has no fingerprint in common is compared, and only within a page.
    """
    exact = corrections.where("fingerprint IS NOT NULL").join(parsed.where("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.min("event_id").alias("event_id")), "fingerprint").select("correction_id", "event_id", F.lit("fingerprint").alias("how"))
    rest = corrections.join(exact.select("correction_id"), "correction_id", "left_anti")
    titles = parsed.where("title IS NOT NULL").groupBy("page_url", F.col("title").alias("_title")).agg(F.min("event_id").alias("event_id"))
    near = rest.where("title IS NOT NULL").join(titles, "page_url").withColumn("_s", F.pandas_udf(_similarities, "double")("title", "_title")).where(F.col("_s") >= least)
    best = near.groupBy("correction_id").agg(F.min(F.struct((-F.col("_s")).alias("s"), F.col("event_id").alias("event_id"))).alias("b"))
    return exact.unionByName(best.select("correction_id", F.col("b.event_id").alias("event_id"), F.lit("title").alias("how")))


def checked_date(start: Column, evidence: Column, captured: Column) -> Column:
    """A start that a model gave, null where its evidence has no word that dates it and it is the day of the capture or midnight of a month's first."""
    undated = F.coalesce(evidence, F.lit("")) != ""
    undated = undated & ~evidence.rlike(DATED)
    guessed = (F.substring(start, 1, 10) == F.date_format(captured, "yyyy-MM-dd")) | start.rlike(r"^\d{4}-\d{2}-01(?:T00:00(?::00)?.*)?$")
    return F.when(F.coalesce(undated & guessed, F.lit(False)), F.lit(None).cast("string")).otherwise(start)


def listing_day(structured: Column, listed: Column, page_days: Column) -> Column:
    """The listing's day where the page's structured one differs and the page's text names the listing's day alone; else the structured one.

    Days are yyyy-MM-dd; page_days is the array of those in the page's text.
    """
    days = F.array_distinct(F.coalesce(page_days, F.array().cast("array<string>")))
    other = (F.substring(structured, 1, 10) != F.substring(listed, 1, 10)) & (F.size(days) == 1) & F.array_contains(days, F.substring(listed, 1, 10))
    return F.when(F.coalesce(other, F.lit(False)), listed).otherwise(structured)


def without_stale_offset(value: Column, zone: Column) -> Column:
    """An ISO time whose offset is its zone's, but of the other season, with the zone's offset on that day: the wall clock is what was meant.

    Both offsets have to be seen within 14 days, an hour apart. Without a zone, or with any other offset, the value stays.
    """
    wall = F.try_to_timestamp(F.regexp_extract(value, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2})?)", 1)).cast("timestamp_ntz")
    said = F.regexp_extract(value, r"T\d{2}:\d{2}(?::\d{2})?([+-]\d{2}:\d{2})$", 1)
    stated = F.when(said != "", F.when(F.startswith(said, F.lit("-")), -1).otherwise(1) * (F.substring(said, 2, 2).cast("int") * 60 + F.substring(said, 5, 2).cast("int")))

    def offset(t: Column) -> Column:
        """Minutes that the zone is ahead of UTC at a wall clock."""
        utc = F.convert_timezone(zone, F.lit("UTC"), t)
        return ((F.unix_micros(t.cast("timestamp")) - F.unix_micros(utc.cast("timestamp"))) / 60_000_000).cast("int")

    now, before, behind = offset(wall), offset(wall - F.expr("INTERVAL 14 DAYS")), offset(wall + F.expr("INTERVAL 14 DAYS"))
    stale = (stated != now) & (F.abs(stated - now) == 60) & ((before == stated) | (behind == stated))
    right = F.concat(F.when(now < 0, "-").otherwise("+"), F.lpad(F.floor(F.abs(now) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(now) % 60).cast("string"), 2, "0"))
    return F.when(F.coalesce(stale & zone.isNotNull(), F.lit(False)), F.concat(F.regexp_replace(value, r"[+-]\d{2}:\d{2}$", ""), right)).otherwise(value)
