"""One run over a source's pages: which entries of its listings are followed, which stand as they are, and what is still there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenfall.functions import urls
from evenfall.operators import incremental


def needs_detail(start: Column, description: Column, address: Column, lat: Column, end: Column) -> Column:
    """'required' if an entry lacks start or description, 'soft' if its page probably says more, null if it is complete."""
    open_end = F.length(description) < 300
    cut = F.rtrim(description).rlike(r"(…|\.\.\.)$") | (open_end & ~F.rtrim(description).rlike(r"[.!?\"”)]$"))
    no_place = (F.coalesce(address, F.lit("")) == "") & (lat.isNull() | F.isnan(lat))
    lacking = (F.coalesce(start, F.lit("")) == "") | (F.coalesce(description, F.lit("")) == "")
    return F.when(lacking, "required").when(cut | no_place | (F.coalesce(end, F.lit("")) == ""), "soft")


def routed(entries: DataFrame, states: DataFrame, as_of: Column, version: int = incremental.EXTRACTION_VERSION) -> DataFrame:
    """source_id, event_id, detail_url, route, refetch: every entry of a run's listings with where it goes.

    'emit': stands as it is (no own page, or nothing more is expected there); 'follow': its page is fetched, for the reason in refetch;
    'skip': its page hasn't changed, so what it gave last time is carried. entries: source_id, event_id, listing_url, url,
    start_datetime, end_datetime, description, location_address, location_lat, listing_hash, lastmod.
    """
    own = (urls.site_of(F.col("url")) == urls.site_of(F.col("listing_url"))) & (urls.page_key(F.col("url")) != urls.page_key(F.col("listing_url")))
    e = entries.withColumn("detail_url", F.when(F.coalesce(own, F.lit(False)), urls.page_key(F.col("url"))))
    e = e.withColumn("_need", needs_detail(F.col("start_datetime"), F.col("description"), F.col("location_address"), F.col("location_lat"), F.col("end_datetime")))
    s = incremental.current_states(states).select("source_id", urls.page_key(F.col("url")).alias("detail_url"), F.col("fetched_at").cast("timestamp").alias("_at"), F.col("extraction_version").alias("_v"), F.col("listing_hash").alias("_known")).dropDuplicates(["source_id", "detail_url"])
    j = e.join(s, ["source_id", "detail_url"], "left")
    j = j.withColumn("refetch", incremental.refetch_reason(F.col("_at"), F.col("_v"), F.col("_known"), F.col("listing_hash"), F.col("lastmod"), as_of, version))
    route = F.when(F.col("detail_url").isNull() | F.col("_need").isNull(), "emit").when(F.col("refetch").isNull(), "skip").otherwise("follow")
    return j.select("source_id", "event_id", "detail_url", route.alias("route"), F.when(route == "follow", F.col("refetch")).alias("refetch"))


def still_listed(entries: DataFrame, routes: DataFrame, states: DataFrame) -> DataFrame:
    """source_id, fingerprint: all that the run has seen, the emitted entries' and what skipped pages gave before."""
    seen = entries.join(routes.where("route = 'emit'").select("source_id", "event_id"), ["source_id", "event_id"], "left_semi").where("fingerprint IS NOT NULL").select("source_id", "fingerprint")
    skipped = routes.where("route = 'skip'").select("source_id", F.col("detail_url").alias("url"))
    return seen.unionByName(incremental.carried_fingerprints(states, skipped)).distinct()
