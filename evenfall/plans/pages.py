"""Plans from tables of pages to event records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.functions import grammar, html, titles, urls
from evenfall.operators import events, extract, times
from evenfall.runtime import cut


def page_events(pages: DataFrame, page_id: str = "case_id") -> DataFrame:
    """The flagship: pages to event records, with clean titles, tags, and recurrences read from their text.

    pages: page_id, url, html, captured_at, seed_context. A page is parsed once; html isn't carried any further than that.
    """
    e = _records(pages, page_id)
    return e.select(page_id, "pos", "strategy", "extraction_method", "title", "start_datetime", "end_datetime", "location_title", "location_address", F.array_join("tag_names", "|").alias("tags"), "recurrence_freq")


def _records(pages: DataFrame, page_id: str) -> DataFrame:
    e = extract.waterfall(pages, page_id)
    as_of = F.coalesce(F.try_to_timestamp("captured_at"), F.lit("2026-01-01").cast("timestamp"))
    seed = F.col("seed_context")
    c = pages.select(page_id, F.col("url").alias("page_url"), as_of.alias("as_of"), seed["location_title"].alias("_venue"), seed["location_address"].alias("_where"), seed["venue_type"].alias("_type"), seed["timezone"].alias("timezone"))
    e = e.join(c, page_id)
    e = e.withColumn("location_title", F.coalesce("location_title", "_venue")).withColumn("location_address", F.coalesce("location_address", "_where"))
    e = e.withColumn("title", titles.clean_title(F.col("title"), F.col("location_title"), F.col("page_url")))
    e = e.withColumn("tag_names", titles.matched_tags(F.col("title"), F.col("description"), F.col("_type"), F.col("location_title")))
    e = e.withColumn("_rule", grammar.recurrence(F.concat_ws(" ", "title", "description"), F.col("as_of")))
    rule = [F.col(f"_rule.{a}").alias(b) for a, b in (("interval", "recurrence_interval"), ("byday", "recurrence_byday"), ("month_mode", "recurrence_month_mode"), ("until", "recurrence_until"), ("count", "recurrence_count"))]
    known = {c for c in e.columns if c.startswith("recurrence_")}
    return e.select(*[c for c in e.columns if c not in known and c not in ("_rule", "_venue", "_where", "_type")], F.coalesce("_rule.freq", F.lit("none")).alias("recurrence_freq"), *rule)


def event_records(pages: DataFrame, page_id: str = "case_id") -> DataFrame:
    """Pages to the records that leave a run: page_events with starts and ends in UTC, ends after starts, fingerprints by site, and duplicates marked.

    Times that name no date, and ends further than a day before their start, are null. A record without a title or start is dropped, with the
    reason in drop_reason; so is every later one of a fingerprint (duplicate_in_run), in the order of page and place on it.
    """
    e = cut(_records(pages, page_id)).withColumn("crawled_at", F.col("as_of")).withColumn("source_id", F.lit(None).cast("string"))
    none = e.sparkSession.createDataFrame([], "source_id string, context struct<timezone:string>")
    keep = tuple(c for c in e.columns if c not in ("start_datetime", "end_datetime"))
    e = times.with_utc(e, none, ("start_datetime", "end_datetime"), keep).withColumnsRenamed({"start_datetime_utc": "start_datetime", "end_datetime_utc": "end_datetime"})
    ended = events.end_after_start(F.try_to_timestamp("start_datetime"), F.try_to_timestamp("end_datetime"))
    e = e.withColumn("end_datetime", F.when(F.length("end_datetime") > 10, F.date_format(ended, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.col("end_datetime")))
    e = events.with_fingerprint(e.withColumn("_site", urls.site_of(F.col("page_url"))), prefix="_site")
    reason = F.when(F.coalesce("title", F.lit("")) == "", "missing_title").when(F.col("start_datetime").isNull() & (F.col("recurrence_freq") == "none"), "missing_start")
    e = e.withColumn("drop_reason", reason).withColumn("_order", F.struct(page_id, "pos")).withColumn("_key", F.when(F.col("drop_reason").isNull(), F.col("fingerprint")))
    e = events.in_run_duplicates(e, "_site", "_key", "_order")
    return e.select(page_id, "pos", "extraction_method", "title", "start_datetime", "end_datetime", "location_title", "location_address", "recurrence_freq", "fingerprint", "drop_reason")


__all__ = ["event_records", "events", "html", "page_events"]
