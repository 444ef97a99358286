"""URL expressions: keys that URLs are compared by, sites, and how much a link looks like one to events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public suffixes of two labels that venue sites use; all others are one label.
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "com.au", "net.au", "org.au", "edu.au", "co.nz", "org.nz", "co.za", "com.br", "com.mx", "com.ar", "co.jp", "or.jp", "co.in", "com.es", "org.es", "com.fr", "asso.fr", "com.fj", "co.at", "or.at", "com.tr", "com.sg", "com.hk", "com.cn", "co.kr")
# Words of event listings in paths and link texts, words that speak against, and file endings.
STRONG = ("events", "event", "calendar", "whats-on", "whatson", "shows", "gigs", "concerts", "live-music", "livemusic", "lineup", "line-up", "happenings", "upcoming", "schedule", "performances", "programme", "program", "agenda")
WEAK = ("event", "calendar", "gig", "show", "concert")
ANCHOR_WORDS = r"(?i)\b(events?|calendar|what'?s on|shows?|gigs?|concerts?|live music|line-?up|happenings|upcoming|schedule|performances|programme|program|agenda|tickets)\b"
NEGATIVE = ("past", "archive", "private", "book", "booking", "reservation", "reserve", "menu", "careers", "jobs", "hire", "wedding", "gift", "login", "cart", "shop")
FILES = r"(?i)\.(pdf|jpe?g|png|gif|webp|svg|zip|docx?|xlsx?|mp[34])$"
EVENT_PATH = r"(?i)/(events?|shows?|gigs?|concerts?|calendar|performances?|tickets?|whats-on|happenings)/[^/]+|/20\d\d[/-]\d\d([/-]\d\d)?\b|[?&](event|eid|event_id)="


def host(url: Column) -> Column:
    """Lower-case host without port; '' if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)


def page_key(url: Column) -> Column:
    """A URL as it is compared with others: without fragment and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "/+$", "")


def link_key(url: Column) -> Column:
    """Host without www., path without trailing slashes, and query."""
    q = query(url)
    return F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/+$", ""), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def site_of(url: Column) -> Column:
    """The registrable domain: two labels, three under a public suffix of two; addresses and bare names as they are."""
    h = host(url)
    labels = F.split(h, r"\.")
    two = F.concat_ws(".", F.slice(labels, -2, 2))
    three = F.concat_ws(".", F.slice(labels, -3, 3))
    return F.when(h.rlike(r"^[0-9.]*$") | (F.size(labels) < 2), h).when(two.isin(*TWO_LABELS) & (F.size(labels) > 2), three).otherwise(two)


def home_url(url: Column) -> Column:
    """Scheme and host with a slash; null without."""
    return F.nullif(F.regexp_replace(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1), "$", "/"), F.lit("/"))


def looks_like_event(url: Column, listing_path: Column) -> Column:
    p = F.regexp_replace(path(url), "/+$", "")
    q = query(url)
    full = F.concat(p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return full.rlike(EVENT_PATH) | ((listing_path != "") & F.startswith(p, F.concat(listing_path, F.lit("/"))))


def link_score(text: Column, url: Column, in_nav: Column) -> Column:
    """How much a link looks like one to a page that lists events."""
    p = F.regexp_replace(F.lower(path(url)), "/+$", "")
    segments = F.filter(F.split(p, "/"), lambda s: s != "")
    said = F.coalesce(text, F.lit("")).rlike(ANCHOR_WORDS)
    words = F.concat(segments, F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), 0))
    against = F.exists(words, lambda w: w.rlike("|".join(NEGATIVE)))
    n = lambda c, x: F.when(c, F.lit(float(x))).otherwise(F.lit(0.0))
    by_path = F.when(F.arrays_overlap(segments, F.array(*[F.lit(s) for s in STRONG])), F.lit(3.0)).otherwise(n(p.rlike("|".join(WEAK)), 1.5))
    score = by_path + n(said, 3) + n(in_nav, 1) - n(against, 5) - n(~said & (F.size(segments) > 2), 1) - n(query(url) != "", 0.5)
    return F.when(p.rlike(FILES), F.lit(-10.0)).otherwise(score)
