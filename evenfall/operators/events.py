"""Event rows: merging, normalising, fingerprints, in-run duplicates, upserts and what runs report.

Rows are never lost: a row that is left out carries its reason in drop_reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenfall.functions import hashing, text
from evenfall.runtime import keyed_join

#: Fields that an event's own row decides; ambient context never gives them.
OWN_FIELDS = ("title", "start_datetime", "end_datetime")
CONTEXT_FIELDS = ("location_title", "location_address", "location_lat", "location_lon", "timezone")
#: Fields whose change makes an event changed.
CONTENT = ("title", "description", "start_datetime", "end_datetime", "location_title", "location_address", "ticket_url", "url", "image_url")


def is_empty(c: Column, kind: str) -> Column:
    """Null, an empty string or list, zero and false: what a merge may overwrite."""
    if kind == "string":
        return c.isNull() | (c == "")
    if kind.startswith("array"):
        return c.isNull() | (F.size(c) == 0)
    if kind == "boolean":
        return c.isNull() | ~c
    if kind in ("double", "float"):
        return c.isNull() | F.isnan(c) | (c == 0)
    if kind in ("int", "bigint"):
        return c.isNull() | (c == 0)
    return c.isNull()


def merged(base: DataFrame, over: DataFrame, on: list[str], fields: list[str], *, longer: tuple[str, ...] = ()) -> DataFrame:
    """base with the empty ones of its fields filled from over; fields in `longer` take the longer text of both. Columns of base stay."""
    kinds = dict(base.dtypes)
    o = over.select(*on, *[F.col(f).alias(f"_o_{f}") for f in fields])
    df = keyed_join(base, o, on, "left")
    cols = []
    for c in base.columns:
        if c in fields:
            x, y = F.col(c), F.col(f"_o_{c}")
            v = F.when(is_empty(x, kinds[c]), F.coalesce(y, x)).otherwise(x)
            if c in longer:
                v = F.when(F.length(y) > F.length(F.coalesce(x, F.lit(""))), y).otherwise(v)
            cols.append(v.alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def with_context(events: DataFrame, sources: DataFrame) -> DataFrame:
    """Gaps in where an event is, filled from its source's context; what the event says itself stays."""
    ctx = sources.select("source_id", *[F.col(f"context.{f}").alias(f) for f in CONTEXT_FIELDS]).dropDuplicates(["source_id"])
    return merged(events, ctx, ["source_id"], list(CONTEXT_FIELDS))


def end_after_start(start: Column, end: Column) -> Column:
    """Timestamps: an end up to a day before its start is of the next day; one further before is wrong, so null."""
    return F.when(end >= start, end).when(end > start - F.expr("INTERVAL 1 DAY"), end + F.expr("INTERVAL 1 DAY"))


def with_fingerprint(events: DataFrame, name: str = "fingerprint", prefix: str = "source_id", start: str = "start_datetime") -> DataFrame:
    fp = hashing.source_fingerprint(F.col(prefix), F.col("title"), F.col(start), F.col("location_title"), F.col("location_address"), F.col("recurrence_freq"), F.col("recurrence_interval"), F.col("recurrence_byday"), F.col("recurrence_month_mode"))
    return events.withColumn(name, fp)


def in_run_duplicates(events: DataFrame, run: str = "source_id", key: str = "fingerprint", order: str = "event_id") -> DataFrame:
    """drop_reason 'duplicate_in_run' on all rows of a run's fingerprint but the first by order; rows without a fingerprint are no duplicates.

    The first row of each is found by an aggregate that is combined before the shuffle, and joined back; a fingerprint with very many
    rows is split by adaptive execution, as its other side is one row.
    """
    first = events.where(F.col(key).isNotNull()).groupBy(run, key).agg(F.min(order).alias("_first"))
    df = events.join(first, [run, key], "left")
    return df.withColumn("drop_reason", F.when(F.col("_first") != F.col(order), F.lit("duplicate_in_run")).otherwise(F.col("drop_reason"))).drop("_first")


def latest(df: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """The row of each key that is last by the given columns, nulls before all values; null keys are a key of their own.

    An aggregate that is combined before the shuffle, so a key with very many rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in key]
    last = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r"))
    return last.select(*[F.col(c) if c in key else F.col(f"_r.{c}") for c in df.columns])


def upsert(target: DataFrame, batch: DataFrame, key: str = "fingerprint", content: tuple[str, ...] = CONTENT) -> DataFrame:
    """key, status, content_hash after the batch is put over the target: created, updated, unchanged, or kept (not in the batch).

    Both sides have one row per key; rows with a null key are left out, as they can't be found again.
    """
    t = target.where(F.col(key).isNotNull()).select(key, hashing.content_hash(list(content)).alias("_was"))
    b = batch.where(F.col(key).isNotNull()).select(key, hashing.content_hash(list(content)).alias("_is"))
    status = F.when(F.col("_was").isNull(), "created").when(F.col("_is").isNull(), "kept").when(F.col("_was") == F.col("_is"), "unchanged").otherwise("updated")
    return t.join(b, key, "full_outer").select(key, status.alias("status"), F.coalesce("_is", "_was").alias("content_hash"))


def run_report(events: DataFrame) -> DataFrame:
    """One row per source: what its run found, by outcome, with its most common method and its distinct fingerprints."""
    n = lambda c: F.count_if(c).alias
    methods = events.where("extraction_method IS NOT NULL").groupBy("source_id", "extraction_method").count()
    top = methods.groupBy("source_id").agg(F.min(F.struct(-F.col("count"), F.col("extraction_method"))).alias("m")).select("source_id", F.col("m.extraction_method").alias("strategy_used"))
    counts = events.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("events_found"),
        n(F.col("ingest_status") == "created")("created"),
        n(F.col("ingest_status") == "updated")("updated"),
        n(F.col("ingest_status") == "unchanged")("unchanged"),
        n(F.col("drop_reason").isNotNull() & (F.col("drop_reason") != "duplicate_in_run"))("dropped"),
        F.count_distinct("fingerprint").alias("seen_fingerprints"),
        F.count_distinct("listing_url").alias("pages_fetched"),
    )
    return counts.join(top, "source_id", "left")


def fingerprints_by_page(events: DataFrame) -> DataFrame:
    """page_url, fingerprints: the sorted distinct fingerprints that each listing and each detail page gave."""
    listed = events.where("listing_url IS NOT NULL").select(F.col("listing_url").alias("page_url"), "fingerprint")
    detail = events.where("source_url IS NOT NULL").select(F.col("source_url").alias("page_url"), "fingerprint")
    return listed.unionByName(detail).where("fingerprint IS NOT NULL").groupBy("page_url").agg(F.array_sort(F.collect_set("fingerprint")).alias("fingerprints"))


def dated_sessions(events: DataFrame, page: str = "listing_url") -> DataFrame:
    """Rows of a series that a page lists with two or more different start days are single dates: their recurrence is taken off.

    A series is the title in front of a colon, with frequency and days. Adds is_session.
    """
    series = text.fold(F.regexp_extract(F.col("title"), r"^([^:]*)", 1))
    df = events.withColumn("_series", series).withColumn("_days", F.array_join(F.array_sort(F.coalesce("recurrence_byday", F.array().cast("array<string>"))), ","))
    key = [page, "_series", "recurrence_freq", "_days"]
    recurring = F.coalesce(F.col("recurrence_freq"), F.lit("none")) != "none"
    days = df.where(recurring & F.col(page).isNotNull()).groupBy(*key).agg(F.count_distinct(F.substring("start_datetime", 1, 10)).alias("_n")).where("_n >= 2")
    df = df.join(days, key, "left").withColumn("is_session", F.col("_n").isNotNull())
    return df.withColumn("recurrence_freq", F.when(F.col("is_session"), F.lit("none")).otherwise(F.col("recurrence_freq"))).drop("_series", "_days", "_n")


def away_games(events: DataFrame, page: str = "listing_url") -> DataFrame:
    """drop_reason 'away_game' for "X at …" where the same page has "X vs …": the home team plays elsewhere."""
    home = events.select(page, text.fold(F.regexp_extract("title", r"(?i)^(.+?)\s+(?:vs?\.?|versus)\s+\S", 1)).alias("_team")).where("_team != ''").distinct().withColumn("_home", F.lit(True))
    df = events.withColumn("_team", text.fold(F.regexp_extract("title", r"(?i)^(.+?)\s+(?:at|@)\s+\S", 1)))
    df = df.join(home, [page, "_team"], "left")
    return df.withColumn("drop_reason", F.when(F.col("_home") & F.col("drop_reason").isNull(), F.lit("away_game")).otherwise(F.col("drop_reason"))).drop("_team", "_home")


#: Rows of a key are sorted in buckets of so many seconds.
BUCKET = 7 * 86_400


def nearest_in_time(left: DataFrame, right: DataFrame, on: list[str], left_at: str, right_at: str, left_id: str, right_id: str, bucket: int = BUCKET) -> DataFrame:
    """left_id, right_id, seconds: for each left row the right row of the same key that is nearest in time, either way; ties by right_id.

    Both sides are sorted together by time, within buckets of it, so a key with very many rows is no single task's; what a bucket
    doesn't hold comes from the last right row of the buckets before, and the first of those behind. No rows are paired. Null keys and times have no row.
    """
    at = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    none = F.lit(None).cast(f"struct<at:bigint,id:{right.schema[right_id].dataType.simpleString()}>")
    keyed = F.lit(True)
    for c in on:
        keyed = keyed & F.col(c).isNotNull()
    r = right.where(keyed & F.col(right_at).isNotNull()).groupBy(*on, at(right_at).alias("_at")).agg(F.min(right_id).alias("_id"))
    r = r.select(*on, "_at", F.lit(None).cast(left.schema[left_id].dataType).alias("_lid"), F.struct(F.col("_at").alias("at"), F.col("_id").alias("id")).alias("_r"))
    mine = left.where(keyed & F.col(left_at).isNotNull()).select(*on, at(left_at).alias("_at"), F.col(left_id).alias("_lid"), none.alias("_r"))
    u = mine.unionByName(r).withColumn("_b", F.floor(F.col("_at") / bucket))
    ends = u.where("_r IS NOT NULL").groupBy(*on, "_b").agg(F.min("_r").alias("_first"), F.max("_r").alias("_last"))
    buckets = u.select(*on, "_b").distinct().join(ends, [*on, "_b"], "left")
    w = Window.partitionBy(*on).orderBy("_b")
    buckets = buckets.select(*on, "_b", F.last("_last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.first("_first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_behind"))
    w = Window.partitionBy(*on, "_b").orderBy("_at", F.col("_r").isNull())  # of the same time, right rows first
    u = u.withColumn("_p", F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.first("_r", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    j = u.where("_lid IS NOT NULL").join(buckets, [*on, "_b"])
    near = lambda c: F.when(c.isNotNull(), F.struct(F.abs(c["at"] - F.col("_at")).alias("gap"), c["id"].alias("id")))
    best = F.array_min(F.array_compact(F.array(near(F.coalesce("_p", "_before")), near(F.coalesce("_n", "_behind")))))
    return j.select(F.col("_lid").alias(left_id), best.alias("_best")).where("_best IS NOT NULL").select(left_id, F.col("_best.id").alias(right_id), F.col("_best.gap").alias("seconds"))


def other_days(rdates: Column, start: Column, end: Column) -> Column:
    """Dates (ISO strings) outside the days from start to end; a plain midnight takes the start's time of day."""
    first, last = F.substring(start, 1, 10), F.greatest(F.substring(start, 1, 10), F.substring(F.coalesce(end, start), 1, 10))
    clock = F.regexp_extract(start, r"^\d{4}-\d{2}-\d{2}(T.*)$", 1)
    kept = F.filter(rdates, lambda d: ~F.coalesce(F.substring(d, 1, 10).between(first, last), F.lit(False)))
    return F.transform(kept, lambda d: F.when(d.rlike(r"^\d{4}-\d{2}-\d{2}T00:00:00$") & (clock != ""), F.concat(F.substring(d, 1, 10), clock)).otherwise(d))


def next_occurrence(byday: Column, as_of: Column) -> Column:
    """The next day from as_of on, at most seven days ahead, whose weekday is among the codes (MO to SU, ordinals ignored)."""
    codes = F.transform(byday, lambda d: F.upper(F.substring(d, -2, 2)))
    names = F.array(*[F.lit(x) for x in ("MO", "TU", "WE", "TH", "FR", "SA", "SU")])
    day = F.to_date(as_of)
    ahead = F.filter(F.sequence(day, F.date_add(day, 7)), lambda d: F.array_contains(codes, F.element_at(names, F.weekday(d) + 1)))
    return F.try_element_at(ahead, F.lit(1))


def fitted_until(freq: Column, interval: Column, count: Column, until: Column, start: Column, end: Column) -> Column:
    """A series whose end lies a period or more behind its start ends there: that day becomes its until, if nothing else says when it ends."""
    period = F.coalesce(F.element_at(F.create_map(F.lit("daily"), F.lit(1), F.lit("weekly"), F.lit(7), F.lit("monthly"), F.lit(28), F.lit("yearly"), F.lit(365)), freq), F.lit(None).cast("int"))
    days = F.datediff(F.to_date(F.substring(end, 1, 10)), F.to_date(F.substring(start, 1, 10)))
    fits = (days >= period * F.coalesce(interval, F.lit(1))) & count.isNull() & (until.isNull() | (until >= F.substring(end, 1, 10)))
    return F.when(F.coalesce(fits, F.lit(False)), F.substring(end, 1, 10)).otherwise(until)
