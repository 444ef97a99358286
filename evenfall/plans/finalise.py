"""From extracted candidates to finished events: gaps, days, recurrences, dates and tags, each step a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenfall.functions import grammar, text, titles
from evenfall.operators import events
from evenfall.runtime import keyed_join

#: Fields that a listing's entry, and then the ambient context, may fill.
FROM_LISTING = ("title", "description", "start_datetime", "end_datetime", "location_title", "location_address", "url", "image_url", "ticket_url")
FROM_CONTEXT = ("location_title", "location_address", "location_lat", "location_lon", "timezone", "venue_type")


def all_day(start: Column, end: Column) -> Column:
    """struct<start, end>: a day from midnight to a minute before the next is that day, not a time."""
    whole = start.rlike(r"T00:00(:00)?") & end.rlike(r"T23:59(:\d\d)?") & (F.substring(start, 1, 10) == F.substring(end, 1, 10))
    day = F.substring(start, 1, 10)
    return F.struct(F.when(whole, day).otherwise(start).alias("start"), F.when(whole, day).otherwise(end).alias("end"))


def schedule_rule(node: Column) -> Column:
    """grammar.RULE from the schema.org schedule of a JSON-LD node (its text); null members without one."""
    s = F.coalesce(F.get_json_object(node, "$.eventSchedule[0]"), F.get_json_object(node, "$.eventSchedule"), F.get_json_object(node, "$.Schedule"))
    raw = F.upper(F.coalesce(F.get_json_object(s, "$.repeatFrequency"), F.lit("")))
    n, unit = F.expr("0") + F.coalesce(F.regexp_extract(raw, r"^P(\d{1,4})[DWMY]", 1).try_cast("int"), F.lit(0)), F.regexp_extract(raw, r"^P\d{1,4}([DWMY])", 1)
    weeks = (unit == "D") & (n > 1) & (n % 7 == 0)
    freq = F.when(weeks, "weekly").when(unit == "D", "daily").when(unit == "W", "weekly").when(unit == "M", "monthly").when(unit == "Y", "yearly")
    interval = F.when(weeks, F.floor(n / 7)).when((unit == "W") & (n > 1), n).otherwise(1).cast("int")
    days = F.get_json_object(s, "$.byDay")
    listed = F.coalesce(F.from_json(days, "array<string>"), F.when(days.isNotNull(), F.array(days)), F.array().cast("array<string>"))
    code = lambda d: F.upper(F.substring(F.regexp_extract(d, r"([A-Za-z]+)\s*$", 1), 1, 2))
    got = freq.isNotNull()
    return F.struct(
        freq.alias("freq"), F.when(got, interval).alias("interval"), F.when(got, F.filter(F.transform(listed, code), lambda c: c.isin(*grammar.CODES))).alias("byday"), F.when(got, F.lit("day")).alias("month_mode"),
        F.when(got, F.nullif(F.substring(F.get_json_object(s, "$.endDate"), 1, 10), F.lit(""))).alias("until"), F.when(got, F.get_json_object(s, "$.repeatCount").try_cast("int")).alias("count"),
    )


def finished(candidates: DataFrame, page_id: str, *, listings: DataFrame | None = None, contexts: DataFrame | None = None) -> DataFrame:
    """Candidates with every step applied, in order.

    candidates: page_id, as_of, the fields of an event, extraction_method, node (JSON-LD as text), schedule_text, page_text (only of
    pages that are one event). listings: page_id and FROM_LISTING, the event as its listing shows it; contexts: page_id and
    FROM_CONTEXT. Both have one row per page. Candidates whose title stays empty are dropped with drop_reason 'missing_title'.
    """
    df = candidates
    for c in ("node", "schedule_text", "page_text", "timezone", "venue_type"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    for c in ("location_lat", "location_lon"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    df = df.withColumn("_d", all_day(F.col("start_datetime"), F.col("end_datetime"))).withColumn("start_datetime", F.col("_d.start")).withColumn("end_datetime", F.col("_d.end")).drop("_d")
    if listings is not None:
        named = listings.select(page_id, F.col("title").alias("_lt"))
        df = keyed_join(df, named, [page_id], "left")
        # page metadata may be the site's own; a title without a word of the listing's is not the event's
        wrong = (F.col("extraction_method") == "opengraph") & F.col("_lt").isNotNull() & (text.words_in_common(F.col("title"), F.col("_lt")) == 0)
        df = df.withColumn("title", F.when(F.coalesce(wrong, F.lit(False)), F.col("_lt")).otherwise(F.col("title"))).drop("_lt")
        df = events.merged(df, listings, [page_id], [f for f in FROM_LISTING if f in listings.columns and f in df.columns])
    if contexts is not None:
        df = events.merged(df, contexts, [page_id], [f for f in FROM_CONTEXT if f in contexts.columns])
    df = df.withColumn("drop_reason", F.when(text.clean(F.col("title")).isNull(), F.lit("missing_title")))
    said = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))
    df = df.withColumn("_r1", schedule_rule(F.col("node"))).withColumn("_r2", grammar.recurrence(F.col("schedule_text"), F.col("as_of"))).withColumn("_r3", grammar.recurrence(said, F.col("as_of")))
    pick = lambda m: F.when(F.col("_r1.freq").isNotNull(), F.col(f"_r1.{m}")).when(F.col("_r2.freq").isNotNull(), F.col(f"_r2.{m}")).otherwise(F.col(f"_r3.{m}"))
    df = df.select("*", *[pick(m).alias(f"recurrence_{m}") for m in ("freq", "interval", "byday", "month_mode", "until", "count")]).drop("_r1", "_r2", "_r3")
    # days that a text names: the page's own first, then the schedule's, then the description's
    texts = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("page_text", "schedule_text", "description")])
    df = df.withColumn("_t", grammar.several_dates(texts, F.col("as_of"))).withColumn("_s", grammar.single_start(F.when(F.coalesce("start_datetime", F.lit("")) == "", F.coalesce("page_text", said)), F.col("title"), F.col("as_of")))
    first = F.coalesce(F.nullif(F.col("start_datetime"), F.lit("")), F.col("_t.start"), F.col("_s.start"))
    soon = F.date_format(events.next_occurrence(F.col("recurrence_byday"), F.col("as_of")), "yyyy-MM-dd")
    start = F.coalesce(first, F.when(F.col("recurrence_freq") == "weekly", soon))
    end = F.coalesce(F.nullif(F.col("end_datetime"), F.lit("")), F.when(F.coalesce("start_datetime", F.lit("")) == "", F.coalesce(F.col("_t.end"), F.col("_s.end"))))
    df = df.withColumn("start_datetime", start).withColumn("end_datetime", end)
    df = df.withColumn("rdates", events.other_days(F.col("_t.rdates"), F.col("start_datetime"), F.col("end_datetime"))).withColumn("exdates", F.col("_t.exdates")).drop("_t", "_s")
    df = df.withColumn("recurrence_until", events.fitted_until(F.col("recurrence_freq"), F.col("recurrence_interval"), F.col("recurrence_count"), F.col("recurrence_until"), F.col("start_datetime"), F.col("end_datetime")))
    df = df.withColumn("tag_names", titles.matched_tags(F.col("title"), F.col("description"), F.col("venue_type"), F.col("location_title")))
    return df.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.coalesce("start_datetime", F.lit("")) == "", F.lit("missing_start"))))
