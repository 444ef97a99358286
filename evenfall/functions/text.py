"""Text expressions: all of them run inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"


def clean(c: Column) -> Column:
    """White space collapsed and trimmed; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, SPACE, " ")), F.lit(""))


def fold(c: Column) -> Column:
    """For comparing texts: white space collapsed, lower case; '' for null."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " ")))


@cache
def _accents() -> tuple[str, str]:
    """Letters that decompose into one base letter and marks, and their base letters."""
    pairs = []
    for n in range(0xC0, 0x2000):
        c = chr(n)
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(d) == 1 and d != c and d.isalpha():
            pairs.append((c, d))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def without_accents(c: Column) -> Column:
    return F.translate(c, *_accents())


def fingerprint_text(c: Column) -> Column:
    """Titles and venues as fingerprints compare them: lower case, no accents, no punctuation, single spaces; '' for null.

    Characters that decompose into several letters (ligatures, fractions) are kept as they are.
    """
    bare = F.regexp_replace(without_accents(F.lower(F.coalesce(c, F.lit("")))), r"(?U)[^\w\s]", "")
    return F.trim(F.regexp_replace(bare, SPACE, " "))


def slug(c: Column, most: int = 60) -> Column:
    """Lower-case words joined by hyphens, without quotes, at most so long; '' for null."""
    s = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "['’\"]", ""), r"(?U)[^\w]+", "-")
    return F.regexp_replace(F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, most), "-+$", "")


def words_in_common(a: Column, b: Column, least: int = 3) -> Column:
    """How many distinct words of at least so many letters two texts share."""
    w = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(?U)\w{%d,}" % least), 0))
    return F.size(F.array_intersect(w(a), w(b)))
