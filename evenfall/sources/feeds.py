"""Feeds: calendars, event interfaces of site builders, sitemaps and map data, from the text of a response to rows."""

from __future__ import annotations

import gzip
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenfall.functions import html, urls

#: Events of one calendar feed, addresses of one sitemap, and sitemaps of an index that are read, at most.
MOST_EVENTS, MOST_ADDRESSES, MOST_CHILDREN = 500, 50_000, 20

TRIBE = "struct<events:array<struct<title:string,description:string,url:string,start_date:string,end_date:string,utc_start_date:string,utc_end_date:string,all_day:boolean,timezone:string,website:string,cost:string,cost_details:struct<values:array<string>>,image:struct<url:string>,venue:struct<venue:string,address:string,city:string,state:string,zip:string,geo_lat:string,geo_lng:string>>>,next_rest_url:string>"
SQUARESPACE = "array<struct<title:string,fullUrl:string,startDate:bigint,endDate:bigint,excerpt:string,body:string,assetUrl:string,location:struct<addressTitle:string,addressLine1:string,addressLine2:string,mapLat:double,mapLng:double,markerLat:double,markerLng:double>>>"
ELEMENTS = "struct<elements:array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>>"


def _empty(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def tribe_events(feeds: DataFrame, feed_id: str, body: str = "body") -> DataFrame:
    """Events of a calendar plugin's interface. UTC times where the site has a real zone, else its local ones; days for all-day events."""
    e = feeds.select(feed_id, F.posexplode(F.from_json(body, TRIBE)["events"]).alias("pos", "e")).where("e.title IS NOT NULL AND e.title != ''")
    fixed = F.coalesce(F.col("e.timezone").rlike(r"^UTC(?:[+-]\d{1,2}(?::?\d{2})?)?$"), F.lit(False))
    day = F.coalesce(F.col("e.all_day"), F.lit(False))

    def when(utc: str, local: str) -> Column:
        u, loc = F.col(f"e.{utc}"), F.col(f"e.{local}")
        return F.when(day, F.substring(loc, 1, 10)).when(~fixed & (F.coalesce(u, F.lit("")) != ""), F.concat(F.replace(u, F.lit(" "), F.lit("T")), F.lit("+00:00"))).otherwise(F.replace(loc, F.lit(" "), F.lit("T")))

    parts = [_empty(F.col(f"e.venue.{p}")) for p in ("address", "city", "state", "zip")]
    return e.select(
        feed_id, "pos", html.plain_text(F.col("e.title")).alias("title"), html.plain_text(F.col("e.description")).alias("description"), when("utc_start_date", "start_date").alias("start_datetime"), when("utc_end_date", "end_date").alias("end_datetime"),
        html.plain_text(F.col("e.venue.venue")).alias("location_title"), _empty(F.concat_ws(", ", *parts)).alias("location_address"), F.expr("try_cast(e.venue.geo_lat AS double)").alias("location_lat"), F.expr("try_cast(e.venue.geo_lng AS double)").alias("location_lon"),
        F.coalesce(F.try_element_at("e.cost_details.values", F.lit(1)), _empty(F.col("e.cost"))).alias("ticket_price"), html.plain_text(F.col("e.website")).alias("ticket_url"), html.plain_text(F.col("e.url")).alias("url"), F.col("e.image.url").alias("image_url"), F.when(~fixed, _empty(F.col("e.timezone"))).alias("timezone"),
    )


def squarespace_events(feeds: DataFrame, feed_id: str, url: str = "url", body: str = "body") -> DataFrame:
    """Events of a site builder's collection: the upcoming ones, or all if the feed doesn't tell them apart. A pin without an address is the builder's own."""
    both = F.from_json(body, f"struct<upcoming:{SQUARESPACE},items:{SQUARESPACE}>")
    e = feeds.select(feed_id, F.col(url).alias("_url"), F.posexplode(F.coalesce(both["upcoming"], both["items"])).alias("pos", "e")).where("e.title IS NOT NULL AND e.title != ''")
    address = _empty(F.concat_ws(", ", _empty(F.col("e.location.addressLine1")), _empty(F.col("e.location.addressLine2"))))
    iso = lambda c: F.date_format(F.timestamp_seconds(F.floor(F.col(c) / 1000)), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    pin = lambda a, b: F.when(address.isNotNull(), F.coalesce(F.nullif(F.col(f"e.location.{a}"), F.lit(0.0)), F.nullif(F.col(f"e.location.{b}"), F.lit(0.0))))
    page = F.when(F.col("e.fullUrl").rlike("^[a-z]+://"), F.col("e.fullUrl")).when(F.startswith("e.fullUrl", F.lit("/")), F.concat(F.regexp_extract("_url", r"^([a-z]+://[^/?#]+)", 1), F.col("e.fullUrl")))
    return e.select(
        feed_id, "pos", html.plain_text(F.col("e.title")).alias("title"), F.coalesce(html.plain_text(F.col("e.excerpt")), html.plain_text(F.col("e.body"))).alias("description"), iso("e.startDate").alias("start_datetime"), iso("e.endDate").alias("end_datetime"),
        html.plain_text(F.col("e.location.addressTitle")).alias("location_title"), address.alias("location_address"), pin("mapLat", "markerLat").alias("location_lat"), pin("mapLng", "markerLng").alias("location_lon"), page.alias("url"), F.col("e.assetUrl").alias("image_url"),
    )


ICAL = "array<struct<uid:string,title:string,description:string,start_datetime:string,end_datetime:string,location_title:string,url:string,freq:string,interval:int,byday:array<string>,month_mode:string,until:string,count:int,rdates:array<string>,exdates:array<string>>>"
_ICAL_FIELDS = ("uid", "title", "description", "start_datetime", "end_datetime", "location_title", "url", "freq", "interval", "byday", "month_mode", "until", "count", "rdates", "exdates")


def _stamp(value: str) -> str | None:
    m = re.fullmatch(r"(\d{4})(\d\d)(\d\d)(?:T(\d\d)(\d\d)(\d\d)?(Z)?)?", value.strip())
    if not m:
        return None
    day = f"{m[1]}-{m[2]}-{m[3]}"
    return day if m[4] is None else f"{day}T{m[4]}:{m[5]}:{m[6] or '00'}" + ("+00:00" if m[7] else "")


def _said(value: str | None) -> str | None:
    return re.sub(r"\\([\;,nN])", lambda m: "\n" if m[1] in "nN" else m[1], value).strip() or None if value else None


def calendar_events(body: str | None, today: str) -> list[tuple]:
    """Events of an iCalendar text that are to come: no cancelled ones, no moved instances of a series; as _ICAL_FIELDS."""
    out: list[tuple] = []
    lines = re.sub(r"\r?\n[ \t]", "", body or "").splitlines()
    event: dict[str, list[tuple[str, str]]] | None = None
    for line in lines:
        m = re.match(r"([A-Za-z-]+)((?:;[^:\"]*(?:\"[^\"]*\")?[^:\"]*)*):(.*)$", line)
        if not m:
            continue
        name, value = m[1].upper(), m[3]
        if name == "BEGIN" and value.strip().upper() == "VEVENT":
            event = {}
        elif name == "END" and value.strip().upper() == "VEVENT" and event is not None:
            row = _calendar_row(event, today)
            if row:
                out.append(row)
            event = None
            if len(out) >= MOST_EVENTS:
                break
        elif event is not None:
            event.setdefault(name, []).append((m[2], value))
    return out


def _calendar_row(e: dict, today: str) -> tuple | None:
    one = lambda k: e[k][0][1] if k in e else None
    if "RECURRENCE-ID" in e or (one("STATUS") or "").strip().upper() == "CANCELLED":
        return None
    title, start, end = _said(one("SUMMARY")), _stamp(one("DTSTART") or ""), _stamp(one("DTEND") or "")
    if not title or not start:
        return None
    rule = dict(p.split("=", 1) for p in (one("RRULE") or "").upper().split(";") if "=" in p)
    freq = rule.get("FREQ", "").lower()
    freq = freq if freq in ("daily", "weekly", "monthly", "yearly") else None
    byday = [d for d in rule.get("BYDAY", "").split(",") if d] if freq else []
    until = (_stamp(rule.get("UNTIL", "")) or "")[:10] or None if freq else None
    if until < today if freq and until else (not freq and (end or start)[:10] < _day_before(today)):
        return None
    number = lambda k, default: int(rule[k]) if rule.get(k, "").isdigit() else default
    dates = lambda k: [s for _, v in e.get(k, []) for x in v.split(",") if (s := _stamp(x))]
    mode = ("weekday" if any(len(d) > 2 for d in byday) else "day") if freq else None
    return (one("UID"), title, _said(one("DESCRIPTION")), start, end, _said(one("LOCATION")), _said(one("URL")), freq, number("INTERVAL", 1) if freq else None, byday, mode, until, number("COUNT", None) if freq else None, dates("RDATE"), dates("EXDATE"))


def _day_before(day: str) -> str:
    return str((pd.Timestamp(day) - pd.Timedelta(days=1)).date())


def _calendar_batch(body: pd.Series, today: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(_ICAL_FIELDS, r)) for r in calendar_events(b, str(t))] for b, t in zip(body, today)], dtype=object)


def ical_events(feeds: DataFrame, feed_id: str, body: str = "body", as_of: str = "as_of") -> DataFrame:
    """A row per event of a calendar feed that is to come on the day as_of; unreadable feeds have none."""
    events = F.pandas_udf(_calendar_batch, ICAL)(F.col(body), F.col(as_of).cast("date").cast("string"))
    return feeds.select(feed_id, F.posexplode(events).alias("pos", "e")).select(feed_id, "pos", "e.*")


def sitemap_roots(robots: Column, home: Column) -> Column:
    """The sitemaps that a robots file names, at most five, else the usual place."""
    named = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(robots, F.lit("")), F.lit(r"(?im)^\s*sitemap\s*:\s*(\S+)"), 1), lambda x: F.trim(x)))
    return F.when(F.size(named) > 0, F.slice(named, 1, 5)).otherwise(F.array(F.concat(F.regexp_extract(home, r"^([a-z]+://[^/?#]+)", 1), F.lit("/sitemap.xml"))))


def _unpacked(body: pd.Series) -> pd.Series:
    out = []
    for b in body:
        b = bytes(b) if b is not None else b""
        if b[:2] == b"\x1f\x8b":
            try:
                b = gzip.decompress(b)
            except (OSError, EOFError, ValueError):
                b = b""
        out.append(b.decode("utf-8", "replace"))
    return pd.Series(out, dtype=object)


def sitemap_entries(maps: DataFrame, map_id: str, body: str = "body") -> DataFrame:
    """map_id, kind (urlset, sitemapindex), pos, loc, lastmod: the entries of sitemaps, as text or bytes, gzipped or not. What is no sitemap has none."""
    text = F.pandas_udf(_unpacked, "string")(F.col(body)) if dict(maps.dtypes)[body] == "binary" else F.col(body)
    kind = F.lower(F.regexp_extract("_text", r"(?is)<(?:\w+:)?(urlset|sitemapindex)\b", 1))
    blocks = F.slice(F.regexp_extract_all("_text", F.lit(r"(?is)<(?:\w+:)?(?:url|sitemap)>(.*?)</(?:\w+:)?(?:url|sitemap)>"), 1), 1, MOST_ADDRESSES)
    m = maps.select(map_id, text.alias("_text")).select(map_id, kind.alias("kind"), F.posexplode(blocks).alias("pos", "_b")).where("kind != ''")
    loc = F.trim(F.regexp_extract("_b", r"(?is)<(?:\w+:)?loc>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</", 1))
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        loc = F.replace(loc, F.lit(name), F.lit(sign))
    when = F.trim(F.regexp_extract("_b", r"(?is)<(?:\w+:)?lastmod>(.*?)</", 1))
    return m.select(map_id, "kind", "pos", loc.alias("loc"), F.try_to_timestamp(F.nullif(when, F.lit(""))).alias("lastmod")).where("loc != ''")


def sitemap_children(entries: DataFrame, map_id: str, most: int = MOST_CHILDREN) -> DataFrame:
    """The sitemaps of an index that are read next: those that sound like events first, else in order."""
    w = Window.partitionBy(map_id).orderBy(F.when(F.col("loc").rlike("(?i)event|calendar|show|concert|performance|happening"), 0).otherwise(1), "pos")
    return entries.where("kind = 'sitemapindex'").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select(map_id, "loc", "rank")


def map_seeds(answers: DataFrame, answer_id: str, body: str = "body") -> DataFrame:
    """Venue seeds from a map's elements: each website once, the first element's."""
    e = answers.select(answer_id, F.posexplode(F.from_json(body, ELEMENTS)["elements"]).alias("pos", "e"))
    tag = lambda k: _empty(F.try_element_at("e.tags", F.lit(k)))
    site = F.regexp_replace(F.coalesce(tag("website"), tag("contact:website"), tag("url")), "/+$", "")
    street = _empty(F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street")))
    node = F.col("e.type") == "node"
    rows = e.select(
        answer_id, "pos", site.alias("url"), tag("name").alias("location_title"), _empty(F.concat_ws(", ", street, tag("addr:city"), tag("addr:state"), tag("addr:postcode"))).alias("location_address"),
        F.when(node, F.col("e.lat")).otherwise(F.col("e.center.lat")).alias("location_lat"), F.when(node, F.col("e.lon")).otherwise(F.col("e.center.lon")).alias("location_lon"), F.col("e.id").cast("string").alias("osm_id"), F.col("e.type").alias("osm_type"), F.coalesce(tag("amenity"), tag("tourism"), tag("leisure")).alias("venue_type"),
    ).where("url LIKE 'http%'")
    w = Window.partitionBy(answer_id, "url").orderBy("pos")
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def seed_sources(seeds: DataFrame, order: str = "seed_id", skip: tuple[str, ...] = ()) -> DataFrame:
    """One source per site from its first seed; multi_location where a site has several."""
    s = seeds.withColumn("domain", urls.site_of(F.col("url"))).where((F.col("domain") != "") & ~F.col("domain").isin(*skip) if skip else F.col("domain") != "")
    first = F.min_by(F.struct(F.col("url").alias("homepage_url"), "location_title", "location_address", "venue_type"), order)
    return s.groupBy("domain").agg(first.alias("f"), F.count(F.lit(1)).alias("_n")).select("domain", "f.*", (F.col("_n") > 1).alias("multi_location"))


def area_box(lat: Column, lon: Column, km: Column) -> Column:
    """struct<south, west, north, east> around a point, in plain degrees: what map queries ask for."""
    d = km / 111.0
    w = d / F.cos(F.radians(lat))
    return F.struct((lat - d).alias("south"), (lon - w).alias("west"), (lat + d).alias("north"), (lon + w).alias("east"))
