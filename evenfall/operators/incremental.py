"""What earlier runs knew about pages, and which pages need another look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenfall.operators.events import latest

#: Version of the extraction; pages read with another one are read again.
EXTRACTION_VERSION = 15
MAX_AGE_DAYS = 7


def current_states(states: DataFrame) -> DataFrame:
    """The last state of each page (source_id, url): repeated and late rows don't matter. Null urls are left out."""
    return latest(states.where("url IS NOT NULL"), ["source_id", "url"], ["fetched_at", "last_listed_at", "content_hash", "listing_hash", "etag", "extraction_version"])


def http_date(c: Column) -> Column:
    """The instant of an HTTP date ("Tue, 15 Sep 2026 13:00:00 GMT") or an ISO one; null if it is neither."""
    cut = F.regexp_extract(c, r"(\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2})", 1)
    return F.coalesce(F.try_to_timestamp(F.nullif(cut, F.lit("")), F.lit("d MMM yyyy HH:mm:ss")), F.try_to_timestamp(c))


def refetch_reason(fetched: Column, version: Column, known_listing: Column, listing: Column, lastmod: Column, as_of: Column, current: int = EXTRACTION_VERSION) -> Column:
    """Why a page has to be fetched again, the first that holds; null if nothing speaks for it."""
    return (
        F.when(fetched.isNull(), "new")
        .when(~version.eqNullSafe(F.lit(current)), "version")
        .when(as_of - fetched > F.expr(f"INTERVAL {MAX_AGE_DAYS} DAYS"), "max_age")
        .when(listing.isNotNull() & ~known_listing.eqNullSafe(listing), "listing")
        .when(lastmod > fetched, "lastmod")
        .when(listing.isNull() & lastmod.isNull(), "no_signal")
    )


def lastmod_missed_change(fetched: Column, version: Column, known_content: Column, content: Column, lastmod: Column, current: int = EXTRACTION_VERSION) -> Column:
    """The page reads differently now, though its sitemap says that it hasn't changed since it was fetched."""
    return F.coalesce((lastmod <= fetched) & (version == current) & (known_content != content), F.lit(False))


def carried_fingerprints(states: DataFrame, skipped: DataFrame) -> DataFrame:
    """source_id, fingerprint: what pages that are skipped listed last time is still listed. skipped: source_id, url."""
    s = current_states(states).join(skipped.select("source_id", "url").distinct(), ["source_id", "url"], "left_semi")
    return s.select("source_id", F.explode("fingerprints").alias("fingerprint")).where("fingerprint IS NOT NULL").distinct()


def changed_states(before: DataFrame, now: DataFrame) -> DataFrame:
    """The states of now that are new or differ from before in any column: what has to be written back."""
    keys = ["source_id", "url"]
    rest = [c for c in now.columns if c not in keys]
    b = before.select(*keys, F.xxhash64(*rest).alias("_was"))
    n = now.withColumn("_is", F.xxhash64(*rest))
    return n.join(b, keys, "left").where(~F.col("_was").eqNullSafe(F.col("_is"))).drop("_was", "_is")
