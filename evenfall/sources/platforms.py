"""Which site builder or calendar a page comes from, and the addresses of its feeds: expressions over a parsed page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenfall.functions import urls

#: Pages with less visible text than this and an empty root element are drawn by scripts.
DRAWN_BELOW = 300
#: More calendar-file links than this are buttons of single events, not a feed; so many links of other kinds are taken at most.
MOST_CALENDARS, MOST_ORGANIZERS, MOST_LISTED, MOST_WIDGETS = 2, 2, 20, 2


def _absolute(href: Column, page: Column) -> Column:
    """An address on the page's own terms: whole, from the root, or beside the page."""
    root = F.regexp_extract(page, r"^([a-z]+://[^/?#]+)", 1)
    beside = F.concat(F.regexp_extract(page, r"^([a-z]+://[^?#]*/)", 1), href)
    return F.when(href.rlike("^[a-z][a-z0-9+.-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(page, r"^([a-z]+:)", 1), href)).when(F.startswith(href, F.lit("/")), F.concat(root, href)).otherwise(beside)


def _hrefs(parsed: Column, pattern: str) -> Column:
    return F.array_distinct(F.transform(F.filter(parsed["anchors"], lambda a: a["url"].rlike(pattern)), lambda a: F.regexp_replace(a["url"], "#.*$", "")))


def _meta(parsed: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(F.filter(parsed["metas"], lambda m: F.lower(m["key"]) == key), F.lit(1))["content"], F.lit(""))


def calendar_feeds(parsed: Column, page: Column) -> Column:
    """Calendar files that a page links to, subscribes to or embeds."""
    linked = F.transform(F.filter(parsed["link_rels"], lambda r: F.lower(F.coalesce(r["type"], F.lit(""))) == "text/calendar"), lambda r: _absolute(r["href"], page))
    files = F.array_distinct(F.transform(F.filter(parsed["anchors"], lambda a: a["href"].rlike(r"(?i)^webcal:") | urls.path(a["url"]).rlike(r"(?i)\.ics$")), lambda a: F.when(a["href"].rlike("(?i)^webcal:"), F.concat(F.lit("https:"), F.substring(F.trim(a["href"]), F.lit(8), F.length(a["href"])))).otherwise(a["url"])))
    frames = F.filter(parsed["iframes"], lambda s: s.rlike(r"//calendar\.google\.com/.*embed"))
    ids = F.flatten(F.transform(frames, lambda s: F.regexp_extract_all(s, F.lit(r"[?&]src=([^&#]+)"), 1)))
    embedded = F.transform(ids, lambda i: F.concat(F.lit("https://calendar.google.com/calendar/ical/"), F.url_encode(F.try_url_decode(i)), F.lit("/public/basic.ics")))
    return F.array_distinct(F.concat(linked, embedded, F.when(F.size(files) <= MOST_CALENDARS, files).otherwise(F.array().cast("array<string>"))))


def listed_feeds(parsed: Column) -> Column:
    """Pages of an organizer on a ticket platform, else its single events if there are two or more."""
    organizers = _hrefs(parsed, r"(?i)://(?:www\.)?eventbrite\.[a-z.]+/o/")
    single = _hrefs(parsed, r"(?i)://(?:www\.)?eventbrite\.[a-z.]+/e/")
    none = F.array().cast("array<string>")
    return F.when(F.size(organizers) > 0, F.slice(organizers, 1, MOST_ORGANIZERS)).when(F.size(single) >= 2, F.slice(single, 1, MOST_LISTED)).otherwise(none)


def widget_feeds(parsed: Column, body: Column) -> Column:
    """Pages of embedded calendar widgets."""
    named = F.transform(F.regexp_extract_all(body, F.lit(r'data-tockify-calendar="([^"]+)"'), 1), lambda n: F.concat(F.lit("https://tockify.com/"), n))
    framed = F.filter(parsed["iframes"], lambda s: s.rlike(r"(?i)//(?:[\w-]+\.)*(?:tockify\.com|timely\.fun|time\.ly)/"))
    return F.slice(F.array_distinct(F.concat(named, framed)), 1, MOST_WIDGETS)


def drawn_by_scripts(parsed: Column, body: Column) -> Column:
    root = body.rlike(r'(?is)<div[^>]+id="(?:root|app|__next|__nuxt|main-app)"[^>]*>\s*</div>')
    return F.coalesce(root & (F.length(F.coalesce(parsed["visible_text"], F.lit(""))) < DRAWN_BELOW), F.lit(False))


def platform(parsed: Column, body: Column, page: Column) -> Column:
    """The first that fits, null if none does. body is the page's HTML; marks of site builders are looked for in its first part."""
    head = F.substring(body, 1, 20_000)
    return (
        F.when(body.rlike(r"(?i)tribe-events|/wp-json/tribe/events|tribe_events"), "tribe")
        .when(body.rlike(r"(?i)squarespace") & body.rlike(r"(?i)eventlist|events-collection|collection-type-events"), "squarespace")
        .when(F.size(calendar_feeds(parsed, page)) > 0, "ical")
        .when(F.size(listed_feeds(parsed)) > 0, "eventbrite")
        .when(F.size(widget_feeds(parsed, body)) > 0, "widget")
        .when(F.lower(_meta(parsed, "generator")).contains("wix.com") | head.rlike("(?i)static\\.wixstatic\\.com|static\\.parastorage\\.com"), "wix")
        .when(drawn_by_scripts(parsed, body), "scripts")
    )
