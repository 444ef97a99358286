"""Texts of a page: what its scripts carry besides what is visible, and links and lines that say something of the event."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from evenfall.functions import urls
from evenfall.functions.html import plain

MOST_CHARS, DEPTH, LIST = 50_000, 12, 500
_ADDRESS = re.compile(r"^(?:https?:|/|www\.|#)|^\S+\.(?:jpe?g|png|gif|webp|svg|css|js)$", re.IGNORECASE)
# Texts of ticket links, and hosts that sell tickets.
TICKET_TEXT = r"(?i)^(?:(?:buy|get|book|purchase|order|reserve|find)\s+)?(?:your\s+|online\s+)?tickets?(?:\s+(?:here|now|online|&\s*info|and\s+info))?$|^(?:buy|book)\s+now$|^register(?:\s+now)?$|^rsvp$"
TICKET_HOSTS = ("eventbrite.com", "ticketmaster.com", "axs.com", "seetickets.us", "etix.com", "ticketweb.com", "dice.fm", "tixr.com", "universe.com", "brownpapertickets.com", "showclix.com", "ticketleap.com", "eventim.de", "ticketspice.com", "prekindle.com", "freshtix.com", "simpletix.com", "humanitix.com")


def _strings(data, depth: int, out: list[str]) -> None:
    if depth > DEPTH:
        return
    if isinstance(data, str):
        if data.strip()[:1] in ("{", "["):
            try:
                _strings(json.loads(data), depth + 1, out)
                return
            except (ValueError, RecursionError):
                pass
        out.append(data)
    elif isinstance(data, dict):
        for v in data.values():
            _strings(v, depth + 1, out)
    elif isinstance(data, list):
        for v in data[:LIST]:
            _strings(v, depth + 1, out)


def carried_strings(scripts) -> list[str]:
    """Sentences in the JSON of a page's scripts: strings with a space and letters that are no addresses; each once, in order."""
    from evenfall.operators.extract import script_data

    found: list[str] = []
    for s in scripts if scripts is not None else []:
        for data in script_data(s["attrs"] or "", s["text"] or ""):
            _strings(data, 0, found)
    out: dict[str, None] = {}
    for x in found:
        t = (plain(x) or "") if "<" in x else " ".join(x.split())
        if " " in t and re.search(r"[^\W\d_]{2}", t) and not _ADDRESS.search(t):
            out[t] = None
    return list(out)


def _full(visible: pd.Series, scripts: pd.Series) -> pd.Series:
    return pd.Series(["\n".join(x for x in (v or "", *(t for t in carried_strings(s) if t not in (v or ""))) if x)[:MOST_CHARS] for v, s in zip(visible, scripts)], dtype=object)


def full_text(parsed: Column) -> Column:
    """The visible text and, behind it, what only the scripts carry."""
    return F.pandas_udf(_full, "string")(parsed["visible_text"], parsed["scripts"])


def ticket_link(parsed: Column, page: Column) -> Column:
    """The first link outside navigation whose text offers tickets and that leads off the site or to a ticket path; none on ticket hosts."""
    off = lambda a: urls.site_of(a["url"]) != urls.site_of(page)
    offers = F.filter(parsed["anchors"], lambda a: ~a["in_chrome"] & F.trim(F.regexp_replace(a["text"], r"\([^)]*\)", "")).rlike(TICKET_TEXT) & a["url"].rlike("(?i)^https?:") & (off(a) | F.lower(urls.path(a["url"])).contains("ticket")))
    return F.when(~urls.site_of(page).isin(*TICKET_HOSTS), F.try_element_at(offers, F.lit(1))["url"])


def without_pager(text: Column) -> Column:
    """Without a "Previous" or "Next" line, the short dated line and the title that follow it: another event's."""
    return F.regexp_replace(text, r"(?im)^(?:«\s*)?(?:previous|next)(?:\s+event)?(?:\s*»)?\n(?=.{0,60}\d)[^\n]{1,60}\n[^\n]{1,120}(?:\n|$)", "")


def added_info(before_description: Column, after_description: Column, before_end: Column, after_end: Column, new_fields: Column) -> Column:
    """Whether a detail page told more than its listing: a new field, 50 more characters of text, or a time on the end."""
    longer = F.length(F.coalesce(after_description, F.lit(""))) >= F.length(F.coalesce(before_description, F.lit(""))) + 50
    timed = F.contains(F.coalesce(after_end, F.lit("")), F.lit("T")) & ~F.contains(F.coalesce(before_end, F.lit("")), F.lit("T"))
    return (new_fields > 0) | longer | timed


