"""Mixed timestamp notations and zones to one UTC form.

All notations are one regular expression with named groups that runs once over a value. What it captures is validated against the
calendar; the instant is put together from day numbers (proleptic Gregorian) and seconds, with the zone's offsets taken from a
table of its changes. The expression runs in an Arrow function over batches; everything else of the operator is DataFrame algebra.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from datetime import datetime, timedelta, timezone
from functools import cache, lru_cache
from zoneinfo import ZoneInfo, available_timezones

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.runtime import keyed_join, spread

# Month names by language, three letters or the full word, as they are written on event pages.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
}
MONTHS_MORE = {"sept": 9, "mrz": 3, "maerz": 3, "mär": 3, "okt": 10, "dez": 12, "jänner": 1, "ene": 1, "abr": 4, "ago": 8, "dic": 12, "setiembre": 9, "fevrier": 2, "aout": 8, "decembre": 12, "janv": 1, "févr": 2, "fev": 2, "fév": 2, "avr": 4, "juil": 7, "déc": 12, "mai": 5}
# Hours east of UTC of zone abbreviations.
ABBREVIATIONS = {"UTC": 0, "GMT": 0, "Z": 0, "WET": 0, "BST": 1, "WEST": 1, "CET": 1, "MEZ": 1, "CEST": 2, "MESZ": 2, "EET": 2, "EEST": 3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "AKST": -9, "AKDT": -8, "HST": -10, "AST": -4, "ADT": -3, "NST": -3.5, "NDT": -2.5, "AEST": 10, "AEDT": 11, "ACST": 9.5, "ACDT": 10.5, "AWST": 8, "NZST": 12, "NZDT": 13, "FJT": 12, "FJST": 13, "IST": 5.5, "JST": 9}
# Loose zone names.
LOOSE_ZONES = {"eastern": "America/New_York", "central": "America/Chicago", "mountain": "America/Denver", "pacific": "America/Los_Angeles", "alaska": "America/Anchorage", "hawaii": "Pacific/Honolulu", "atlantic": "America/Halifax", "arizona": "America/Phoenix", "central european": "Europe/Berlin", "eastern european": "Europe/Athens", "western european": "Europe/Lisbon", "greenwich mean": "UTC", "coordinated universal": "UTC"}
# Zones of Europe whose names don't begin with Europe/.
EUROPEAN = {"CET", "EET", "WET", "MET", "GB", "GB-Eire", "Eire", "Portugal", "Poland", "Iceland", "Atlantic/Canary", "Atlantic/Madeira", "Atlantic/Azores", "Atlantic/Faroe", "Atlantic/Reykjavik", "Africa/Ceuta", "Arctic/Longyearbyen", "Asia/Nicosia", "Turkey"}


def _months() -> dict[str, int]:
    out: dict[str, int] = dict(MONTHS_MORE)
    for words in MONTHS.values():
        for i, w in enumerate(words.split(), 1):
            out.setdefault(w, i)
    for i, w in enumerate(MONTHS["en"].split(), 1):
        out.setdefault(w[:3], i)
    return out


_MONTH = _months()
_M = "(?:" + "|".join(sorted(map(re.escape, _MONTH), key=len, reverse=True)) + r")\b\.?"
_WEEKDAY = r"(?:[^\W\d_]{2,10}\.?,?\s+)?"


def _clock(n: str) -> str:
    """Time of day; n tells the groups of the alternatives apart."""
    return (
        rf"(?:(?P<h{n}>\d{{1,2}})(?:[:.h](?P<mi{n}>\d{{2}})(?::(?P<s{n}>\d{{2}})(?:[.,]\d+)?)?)?\s*(?:(?P<ap{n}>[ap])\.?\s?m\b\.?|(?:Uhr|h|hs|heures)\b\.?)?|(?P<word{n}>noon|midnight|mittags?|mitternacht|mediodía|medianoche|midi|minuit)\b)"
    )


def _zone(n: str) -> str:
    return (
        rf"(?:\s*(?P<z{n}>(?:GMT|UTC)?[+-]\d{{2}}:?\d{{2}}|[+-]\d{{2}}\b|Z\b|[A-Z]{{2,5}}\b))?(?:\s*\[(?P<r{n}>[A-Za-z_/+\-\d]+)\])?(?:\s*\([^)]*\))?"
    )


_SEP = r"(?:\s*(?:,|@|·|\||–|-|at|um|a las|à|kl\.?)?\s*)"
PATTERN = re.compile(
    "|".join(
        (
            r"(?P<epoch>-?\d{9,13})",
            # 2026-03-28T13:30:00-05:00, 2026-03-28 13:30, 2026-03-28
            rf"(?P<y1>\d{{4}})[-/.](?P<m1>\d{{1,2}})[-/.](?P<d1>\d{{1,2}})(?:(?:[T ]|,?\s+){_clock('1')}{_zone('1')})?",
            # 20260328T133000Z, with or without TZID=
            rf"(?:TZID=(?P<r2>[A-Za-z_/+\-]+):)?(?P<y2>\d{{4}})(?P<m2>\d{{2}})(?P<d2>\d{{2}})(?:[T ](?P<h2>\d{{2}})(?P<mi2>\d{{2}})(?P<s2>\d{{2}})?(?:\.\d+)?\s*(?P<z2>Z|[+-]\d{{2}}:?\d{{2}})?)?",
            # Sat Jul 25 2026 11:30:00 GMT-0400; Saturday, March 7th, 2026 @ 6 PM; Mar 7, 3pm
            rf"{_WEEKDAY}(?P<m3>{_M})\s*(?P<d3>\d{{1,2}})(?:st|nd|rd|th)?\b(?:,?\s+(?P<y3>\d{{4}})\b)?(?:{_SEP}{_clock('3')}{_zone('3')})?",
            # Sat, 14 Nov 2026 12:30:00 -0800; 13. Juni 2026; 18 de abril de 2026, 15:00 h
            rf"{_WEEKDAY}(?P<d4>\d{{1,2}})(?:\.|st|nd|rd|th|er|º)?\s*(?:de\s+|of\s+)?(?P<m4>{_M})(?:,?\s+(?:de\s+|del\s+)?(?P<y4>\d{{4}})\b)?(?:{_SEP}{_clock('4')}{_zone('4')})?",
            # 05/09/2026 23:00: order by zone
            rf"{_WEEKDAY}(?P<a5>\d{{1,2}})/(?P<b5>\d{{1,2}})/(?P<y5>\d{{4}})(?:{_SEP}{_clock('5')}{_zone('5')})?",
            # 28-02-2026 20.45 h, 23.07.2026, 22:45 Uhr: day first
            rf"{_WEEKDAY}(?P<d6>\d{{1,2}})[-.](?P<m6>\d{{1,2}})[-.](?P<y6>\d{{4}})(?:{_SEP}{_clock('6')}{_zone('6')})?",
            # without a year: 05/09 7pm, 28.4. 20:30
            rf"{_WEEKDAY}(?P<a7>\d{{1,2}})/(?P<b7>\d{{1,2}})(?:{_SEP}{_clock('7')}{_zone('7')})?",
            rf"{_WEEKDAY}(?P<d8>\d{{1,2}})\.(?P<m8>\d{{1,2}})\.(?:{_SEP}{_clock('8')}{_zone('8')})?",
        )
    ),
    re.IGNORECASE,
)
_WORD = {"noon": 12, "mittag": 12, "mittags": 12, "mediodía": 12, "midi": 12, "midnight": 0, "mitternacht": 0, "medianoche": 0, "minuit": 0}
_SLASHED = {"5", "7"}


def days_from_civil(y: int, m: int, d: int) -> int:
    """Days since 1970-01-01 of a proleptic Gregorian date, by integer arithmetic."""
    y -= m <= 2
    era = y // 400
    yoe = y - era * 400
    doy = (153 * (m + (-3 if m > 2 else 9)) + 2) // 5 + d - 1
    return era * 146097 + yoe * 365 + yoe // 4 - yoe // 100 + doy - 719468


def civil_from_days(z: int) -> tuple[int, int, int]:
    z += 719468
    era = z // 146097
    doe = z - era * 146097
    yoe = (doe - doe // 1460 + doe // 36524 - doe // 146096) // 365
    doy = doe - (365 * yoe + yoe // 4 - yoe // 100)
    mp = (5 * doy + 2) // 153
    m = mp + (3 if mp < 10 else -9)
    return yoe + era * 400 + (m <= 2), m, doy - (153 * mp + 2) // 5 + 1


def month_length(y: int, m: int) -> int:
    return 29 if m == 2 and y % 4 == 0 and (y % 100 != 0 or y % 400 == 0) else (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)[m - 1]


@cache
def _zone_names() -> dict[str, str]:
    return {z.lower(): z for z in available_timezones()}


@lru_cache(4096)
def zone_name(text: str | None) -> str | None:
    """The IANA name that a loosely written zone means; None if it is blank or means none."""
    if not text or not (t := text.replace("\\", "").strip()):
        return None
    low = re.sub(r"\s+", " ", t.lower())
    if (z := _zone_names().get(low.replace(" ", "_"))) and z not in {"localtime"}:
        return z
    base = re.sub(r"\s*(?:standard|daylight|summer)?\s*time(?: zone)?$", "", low).removeprefix("us ")
    if base in LOOSE_ZONES:
        return LOOSE_ZONES[base]
    tails = [z for k, z in _zone_names().items() if k.rpartition("/")[2] == low.replace(" ", "_")]
    return min(tails, key=len) if tails else None


@cache
def _changes(zone: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """UTC times of a zone's changes, 1900 to 2100, the offsets after them (first: before all), and the wall times from which the new offset holds."""
    tz = ZoneInfo(zone)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    off = lambda t: int((epoch + timedelta(seconds=t)).astimezone(tz).utcoffset().total_seconds())
    start, end = days_from_civil(1900, 1, 1) * 86400, days_from_civil(2100, 1, 1) * 86400
    step = 14 * 86400
    times, offsets = [], [off(start)]
    t = start
    while t < end:
        if off(t) != off(t + step):
            lo, hi = t, t + step
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if off(mid) == off(lo) else (lo, mid)
            times.append(hi)
            offsets.append(off(hi))
        t += step
    # first pass of a repeated hour and the old offset in a skipped one: the new offset holds from the later of the two wall times
    walls = [x + max(a, b) for x, a, b in zip(times, offsets, offsets[1:])]
    return times, offsets, walls, offsets


def to_utc(wall: int, zone: str) -> int:
    """UTC seconds of wall-clock seconds in a zone."""
    _, offsets, walls, _ = _changes(zone)
    return wall - offsets[bisect_right(walls, wall)]


def to_wall(utc: int, zone: str) -> int:
    times, offsets, _, _ = _changes(zone)
    return utc + offsets[bisect_right(times, utc)]


@lru_cache(200_000)
def components(text: str) -> tuple | None:
    """What one run of PATTERN finds in a whole value: (kind, year, month or first number, day or second, second of day, offset, zone).

    kind: 'epoch' (year holds the instant), 'date', 'slash' (order of the first two numbers by zone). second of day None: no time.
    None: no full date, or a part is out of its range.
    """
    t = re.sub(r"\s+", " ", text.replace(" ", " ").replace(" ", " ")).strip()
    m = PATTERN.fullmatch(t)
    if not m:
        return None
    g = {k: v for k, v in m.groupdict().items() if v is not None}
    if e := g.get("epoch"):
        n = int(e)
        return ("epoch", n // 1000 if len(e.lstrip("-")) >= 12 else n, 0, 0, None, None, None) if len(e.lstrip("-")) in (9, 10, 12, 13) else None
    n = next(k[-1] for k in g if k[:-1] in ("y", "d", "a"))
    year = int(g[f"y{n}"]) if f"y{n}" in g else None
    if n in _SLASHED:
        a, b = int(g[f"a{n}"]), int(g[f"b{n}"])
    else:
        month = g[f"m{n}"].lower()
        a, b = int(month) if month.isdigit() else _MONTH[month.rstrip(".")], int(g[f"d{n}"])
    sec = None
    if w := g.get(f"word{n}"):
        sec = _WORD[w.lower()] * 3600
    elif h := g.get(f"h{n}"):
        hour, minute, second = int(h), int(g.get(f"mi{n}", 0)), int(g.get(f"s{n}", 0))
        if ap := g.get(f"ap{n}"):
            if not 1 <= hour <= 12:
                return None
            hour = hour % 12 + 12 * (ap.lower() == "p")
        if hour > 23 or minute > 59 or second > 59:
            return None
        sec = hour * 3600 + minute * 60 + second
    offset, zone = None, g.get(f"r{n}")
    if z := g.get(f"z{n}"):
        z = z.upper()
        if d := re.fullmatch(r"(?:GMT|UTC)?([+-])(\d{2}):?(\d{2})?", z):
            offset = (int(d[2]) * 3600 + int(d[3] or 0) * 60) * (1 if d[1] == "+" else -1)
        elif z in ABBREVIATIONS:
            offset = int(ABBREVIATIONS[z] * 3600)
        elif z not in ("UHR", "H", "HS"):
            return None
    return ("slash" if n in _SLASHED else "date", year, a, b, sec, offset, zone)


@lru_cache(200_000)
def utc_value(text: str | None, row_zone: str | None, source_zone: str | None, crawled: int | None) -> str | None:
    """One value in UTC, `yyyy-MM-ddTHH:mm:ssZ`, or `yyyy-MM-dd` for a value without time of day; None if it names no full date.

    crawled: UTC seconds, floored to the day by the caller's choice of zone here. A zone that can't be told is UTC.
    """
    if not text or (c := components(text)) is None:
        return None
    kind, year, a, b, sec, offset, named = c
    if kind == "epoch":
        return _format(year)
    zone = (zone_name(named) if named else None) or zone_name(row_zone) or zone_name(source_zone) or "UTC"
    month, day = a, b
    if kind == "slash" and (zone.startswith("Europe/") or zone in EUROPEAN):
        month, day = b, a
    if not 1 <= month <= 12 or day < 1 or (year is not None and not 1 <= year <= 9999):
        return None
    if year is None:
        if crawled is None:
            return None
        today = to_wall(crawled, zone) // 86400
        year = civil_from_days(today)[0]
        while day > month_length(year, month) or days_from_civil(year, month, day) < today:
            year += 1
            if year > civil_from_days(today)[0] + 8:
                return None
    if day > month_length(year, month):
        return None
    if sec is None:
        return f"{year:04d}-{month:02d}-{day:02d}"
    wall = days_from_civil(year, month, day) * 86400 + sec
    return _format(wall - offset if offset is not None else to_utc(wall, zone))


def _format(utc: int) -> str | None:
    days, s = divmod(utc, 86400)
    y, m, d = civil_from_days(days)
    return f"{y:04d}-{m:02d}-{d:02d}T{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}Z" if 1 <= y <= 9999 else None


def _normalised(text: pd.Series, row_zone: pd.Series, source_zone: pd.Series, crawled: pd.Series) -> pd.Series:
    none = lambda x: None if x is None or x != x else x
    return pd.Series([utc_value(none(t), none(z), none(s), None if c is None or c != c else int(c)) for t, z, s, c in zip(text, row_zone, source_zone, crawled)], dtype=object)


def with_utc(events: DataFrame, sources: DataFrame, fields: tuple[str, ...] = ("start_datetime", "end_datetime"), keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """The kept columns and, for each field, `<field>_utc`. Sources give the zone where the row's own is null or blank.

    Source ids are unique; a row whose source is null or unknown has only its own zone. Without any zone, wall times are UTC.
    """
    zones = sources.select(F.col("source_id").alias("_sid"), F.col("context.timezone").alias("_szone")).dropDuplicates(["_sid"])
    e = events.select(*keep, *[F.col(f).alias(f"_{f}") for f in fields], F.col("timezone").alias("_zone"), F.col("source_id").alias("_sid"), F.unix_seconds(F.col("crawled_at").cast("timestamp")).alias("_crawled"))
    e = keyed_join(spread(e), zones, ["_sid"], "left")
    normalised = F.pandas_udf(_normalised, "string")
    blank = F.trim(F.coalesce(F.col("_zone"), F.lit(""))) == ""
    zone = F.when(blank, F.lit(None)).otherwise(F.col("_zone"))
    return e.select(*keep, *[normalised(F.col(f"_{f}"), zone, F.col("_szone"), F.col("_crawled")).alias(f"{f}_utc") for f in fields])


def found(events: DataFrame, sources: DataFrame) -> DataFrame:
    """(event_id, field_name, utc_value): a row for every start or end that names a full date."""
    u = with_utc(events, sources)
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}_utc").alias("utc_value")) for f in ("start_datetime", "end_datetime")])
    return u.select("event_id", F.explode(F.filter(pairs, lambda x: x["utc_value"].isNotNull())).alias("p")).select("event_id", "p.field_name", "p.utc_value")
