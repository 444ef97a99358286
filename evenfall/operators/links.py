"""The links of pages: which lead to events, to listings, to the next page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenfall.functions import html, urls
from evenfall.runtime import spread

#: A listing page scores at least so much, and from a sitemap, where no text speaks for it, less.
THRESHOLD, SITEMAP_THRESHOLD = 3.0, 1.5
TOP = 3
#: A group of links with the same markup is a list of events from so many links on, if so large a share looks like events.
GROUP_LEAST, GROUP_SHARE = 3, 0.5
# Texts of links to the next page, and parameters that count pages.
NEXT_TEXT = r"(?i)^\s*(next|more|older|load more|next page|›|»|→|>)\s*(events?|page|»|›)?\s*$"
PAGE_PARAMETERS = "page|paged|p|pg|offset"


def anchors(pages: DataFrame, page_id: str, url: str = "url", body: str = "html") -> DataFrame:
    """page_id, page_url, pos, href, link (absolute, without fragment), text, rel, cls, in_nav, in_chrome, signature of every anchor."""
    p = spread(pages.select(page_id, F.col(url).alias("page_url"), F.col(body).alias("_b"))).select(page_id, "page_url", html.parsed(F.col("_b"), F.col("page_url")).alias("_p"))
    a = p.select(page_id, "page_url", F.explode("_p.anchors").alias("a"))
    return a.select(page_id, "page_url", "a.pos", "a.href", F.regexp_replace("a.url", "#.*$", "").alias("link"), "a.text", "a.rel", "a.cls", "a.in_nav", "a.in_chrome", "a.signature")


def page_links(links: DataFrame, page_id: str) -> DataFrame:
    """Links to the page's own site, the first of each: no fragments, mail, phone or script links."""
    own = links.where(~F.col("href").rlike(r"(?i)^(#|mailto:|tel:|javascript:|$)") & F.col("link").rlike("(?i)^http") & (urls.site_of(F.col("link")) == urls.site_of(F.col("page_url"))))
    first = Window.partitionBy(page_id, "link").orderBy("pos")
    return own.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def without_nested(scored: DataFrame, page_id: str, link: str = "link") -> DataFrame:
    """Without links that lie under another kept link of the same page: the listing stays, its entries go.

    A page's links come together in an array, where each is looked up by the paths above it, so no two links of a page are paired and
    the links are made only once.
    """
    key = urls.page_key(F.col(link))
    parts = F.split(F.regexp_extract(key, r"^[a-z]+://(.*)$", 1), "/")
    scheme = F.regexp_extract(key, r"^([a-z]+://)", 1)
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(parts) - 1)), lambda n: F.concat(scheme, F.array_join(F.slice(parts, F.lit(1), n), "/")))
    above = F.when(F.size(parts) > 1, above).otherwise(F.array().cast("array<string>"))
    rest = [c for c in scored.columns if c != page_id]
    pages = scored.groupBy(page_id).agg(F.collect_list(F.struct(F.struct(*rest).alias("row"), key.alias("key"), above.alias("above"))).alias("_links"), F.collect_set(key).alias("_keys"))
    kept = F.filter("_links", lambda x: ~F.coalesce(F.arrays_overlap(x["above"], F.col("_keys")), F.lit(False)))
    return pages.select(page_id, F.explode(F.transform(kept, lambda x: x["row"])).alias("_row")).select(page_id, "_row.*").select(*scored.columns)


def events_pages(links: DataFrame, page_id: str, top: int = TOP) -> DataFrame:
    """page_id, link, score, rank: the links of a page that most look like listings of events, not the page itself, none under another."""
    s = page_links(links, page_id).where(urls.page_key(F.col("link")) != urls.page_key(F.col("page_url")))
    s = s.withColumn("score", urls.link_score(F.col("text"), F.col("link"), F.col("in_nav"))).where(F.col("score") >= THRESHOLD)
    return _best(without_nested(s, page_id), page_id, top)


def _best(s: DataFrame, page_id: str, top: int) -> DataFrame:
    order = Window.partitionBy(page_id).orderBy(F.desc("score"), F.length("link"), F.desc("link"))
    return s.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(page_id, "link", "score", "rank")


def events_pages_of_sitemap(entries: DataFrame, source: str, loc: str = "loc", top: int = TOP) -> DataFrame:
    """The same from sitemap entries, which have no link text."""
    s = entries.select(source, F.col(loc).alias("link")).distinct().withColumn("score", urls.link_score(F.lit(""), F.col("link"), F.lit(False))).where(F.col("score") >= SITEMAP_THRESHOLD)
    return _best(without_nested(s, source), source, top)


def detail_links(links: DataFrame, page_id: str) -> DataFrame:
    """page_id, link, pos: links of the group with the same markup that best looks like a list of events; of equal groups the first."""
    listing = F.regexp_replace(urls.path(F.col("page_url")), "/+$", "")
    own = links.where(~F.col("in_chrome") & F.col("link").rlike("(?i)^http") & (urls.site_of(F.col("link")) == urls.site_of(F.col("page_url"))) & (F.col("link") != F.col("page_url")))
    own = own.withColumn("_event", urls.looks_like_event(F.col("link"), listing)).groupBy(page_id, "signature", "link").agg(F.min("pos").alias("pos"), F.max("_event").alias("_event"))
    groups = own.groupBy(page_id, "signature").agg(F.count(F.lit(1)).alias("_n"), F.avg(F.col("_event").cast("int")).alias("_share"), F.min("pos").alias("_first"))
    good = groups.where((F.col("_n") >= GROUP_LEAST) & (F.col("_share") >= GROUP_SHARE))
    best = good.groupBy(page_id).agg(F.max(F.struct((F.col("_n") * F.col("_share")).alias("s"), (-F.col("_first")).alias("f"), F.col("signature").alias("signature"))).alias("b"))
    return own.join(best.select(page_id, F.col("b.signature").alias("signature")), [page_id, "signature"]).select(page_id, "link", "pos")


def next_pages(links: DataFrame, page_id: str) -> DataFrame:
    """page_id, link: the page that follows a listing: by rel=next, else by the link's text or class, else by a counted-up number."""
    own = links.where((F.col("link") != F.col("page_url")) & (urls.site_of(F.col("link")) == urls.site_of(F.col("page_url"))))
    number = lambda c: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(c, rf"[?&](?:{PAGE_PARAMETERS})=(\d{{1,9}})\b", 1), F.lit("")), F.lit("999999999")).cast("int"), F.try_to_number(F.nullif(F.regexp_extract(c, r"/page/(\d{1,9})", 1), F.lit("")), F.lit("999999999")).cast("int"))
    how = (
        F.when(F.concat(F.lit(" "), F.lower("rel"), F.lit(" ")).contains(" next "), 1)
        .when(F.col("text").rlike(NEXT_TEXT) | F.concat(F.lit(" "), F.lower("cls"), F.lit(" ")).contains(" next "), 2)
        .when((number(F.col("link")) == F.coalesce(number(F.col("page_url")), F.lit(1)) + 1) & ((urls.path(F.col("link")) == urls.path(F.col("page_url"))) | urls.path(F.col("link")).rlike(r"/page/\d+/?$")), 3)
    )
    w = Window.partitionBy(page_id).orderBy("_how", "pos")
    return own.withColumn("_how", how).where("_how IS NOT NULL").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(page_id, "link")


def unclaimed(details: DataFrame, events: DataFrame, page_id: str, event_url: str = "url") -> DataFrame:
    """Detail links that none of the page's events names as its own: an anti-join on the page key."""
    claimed = events.where(F.col(event_url).isNotNull()).select(page_id, urls.page_key(F.col(event_url)).alias("_k")).distinct()
    return details.withColumn("_k", urls.page_key(F.col("link"))).join(claimed, [page_id, "_k"], "left_anti").drop("_k")
