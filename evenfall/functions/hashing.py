"""Hashes that identify events, contents and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenfall.functions.text import fingerprint_text


def recurrence_signature(freq: Column, interval: Column, byday: Column, mode: Column) -> Column:
    """The same whichever date of a series is seen."""
    days = F.array_join(F.array_sort(F.coalesce(byday, F.array().cast("array<string>"))), ":")
    return F.concat_ws(":", F.coalesce(freq, F.lit("none")), F.coalesce(interval, F.lit(1)).cast("string"), days, F.coalesce(mode, F.lit("day")))


def source_fingerprint(prefix: Column, title: Column, start: Column, venue: Column, address: Column, freq: Column, interval: Column, byday: Column, mode: Column) -> Column:
    """prefix:sha256 of title, date and venue; of a series, title, venue and its signature, as its next date keeps changing.

    The venue is its name or else its address; a null prefix is 'unknown'.
    """
    place = fingerprint_text(F.coalesce(F.nullif(venue, F.lit("")), address))
    series = F.coalesce(freq, F.lit("none")) != "none"
    day = F.substring(F.coalesce(start, F.lit("")), 1, 10)
    one = F.concat_ws("|", fingerprint_text(title), day, place)
    many = F.concat_ws("|", fingerprint_text(title), place, recurrence_signature(freq, interval, byday, mode))
    return F.concat(F.coalesce(prefix, F.lit("unknown")), F.lit(":"), F.sha2(F.when(series, many).otherwise(one), 256))


def content_hash(columns: list[str]) -> Column:
    """Hash of an event's own fields, in alphabetical order, nulls and empty values left out."""
    parts = [F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def held_out(key: Column, share: float) -> Column:
    """'eval' for about that share of keys, 'train' for the others; always the same for a key."""
    n = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.when(n / F.lit(0xFFFFFFFF) < share, F.lit("eval")).otherwise(F.lit("train"))


def prompt_hash(system: Column, message: Column) -> Column:
    return F.substring(F.sha2(F.concat(system, F.lit("\n"), message), 256), 1, 16)
