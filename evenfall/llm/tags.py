"""Freely typed values mapped to a reference list.

All entries of the list and their aliases are paths of one trie. A typed value is folded to its letters and digits, cleared of
decoration, and walked over the trie with a Levenshtein automaton (bit-parallel: one word per number of edits, a swap of
neighbours is one edit). Every entry within a distance that depends on the length is found; the closest one is taken.

The trie is built from the reference list once per task; the list is counted first and must not be longer than MAX_ENTRIES.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.runtime import keyed_join

#: A reference list of more entries is refused, as every worker holds the trie.
MAX_ENTRIES = 500_000
# What is put before and behind a value without changing what it means.
BEFORE = re.compile(r"^(?:genre|category|categories|tag|tags|type|topic|theme|kategorie|categoria|thema|tipo)s?\s*[:/=>|]\s*", re.IGNORECASE)
BEHIND = re.compile(r"\s*(?:(?:&|and|\+|und|y|et)[\s_-]+more|[\s_-]events?|[\s_-]*\(?all[\s_-]ages\)?|\([^()]*\))[\s!.]*$", re.IGNORECASE)

#: The same run together with the value.
RUN_ON = re.compile(r"(?:andmores?|allages|events?)$")


def fold(text: str) -> str:
    """Letters and digits only, lower case, without accents."""
    t = unicodedata.normalize("NFKD", text.replace("&", " and ")).lower()
    return re.sub(r"[^a-z0-9]+", "", t)


def bare(text: str) -> str:
    """Without decoration around the value."""
    t = re.sub(r"[\s  ]+", " ", text).strip(" #•★*\"'“”-_.!")
    return BEHIND.sub("", BEFORE.sub("", t)).strip() or t


def allowed(length: int) -> int:
    """Edits that a value of so many letters may have."""
    return 0 if length <= 3 else 1 if length <= 6 else 2


class Trie:
    """Entries as paths of letters; ends hold what the entry means."""

    def __init__(self) -> None:
        self.root: dict = {}
        self.exact: dict[str, int] = {}

    def add(self, path: str, meaning: int, rank: int) -> None:
        """rank: of equal paths the one with the lowest holds."""
        if not path:
            return
        node = self.root
        for c in path:
            node = node.setdefault(c, {})
        end = node.get("")
        if end is None or (rank, meaning) < end[:2]:
            node[""] = (rank, meaning, len(path))
            self.exact[path] = meaning

    def search(self, word: str, most: int) -> list[tuple[int, int, int, int]]:
        """(edits, rank, meaning, length) of every entry within most (0 to 2) edits, by the automaton's states over the trie."""
        n = len(word)
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | (2 << i)
        full = (2 << n) - 1
        goal = 1 << n
        out: list[tuple[int, int, int, int]] = []
        # bit i of state d: i letters of the word are read with at most d edits
        s1 = 3 & full if most > 0 else 0
        s2 = 7 & full if most > 1 else 0
        stack = [(self.root, 1, s1, s2, 0, 0, 0)]
        while stack:
            node, a0, a1, a2, prev, p0, p1 = stack.pop()
            for c, child in node.items():
                if c == "":
                    if a0 & goal:
                        out.append((0, *child))
                    elif a1 & goal:
                        out.append((1, *child))
                    elif a2 & goal:
                        out.append((2, *child))
                    continue
                m = masks.get(c, 0)
                b0 = (a0 << 1) & m
                b1 = b2 = 0
                if most > 0:
                    # swap: the entry has c where the word has the letter before it, and the other way round
                    b1 = (((a1 << 1) & m) | a0 | (a0 << 1) | (b0 << 1) | (((p0 << 2) & prev) & (m << 1))) & full
                    if most > 1:
                        b2 = (((a2 << 1) & m) | a1 | (a1 << 1) | (b1 << 1) | (((p1 << 2) & prev) & (m << 1))) & full
                if b0 or b1 or b2:
                    stack.append((child, b0, b1, b2, m, a0, a1))
        return out

    def best(self, text: str) -> int | None:
        """The meaning of the closest entry, None if none is close enough; equally close entries go by rank, then meaning."""
        raw = fold(text)
        for n in dict.fromkeys((raw, fold(bare(text)), RUN_ON.sub("", raw))):
            if n in self.exact:
                return self.exact[n]
            if n.endswith("s") and n[:-1] in self.exact:
                return self.exact[n[:-1]]
        hits: list[tuple[int, int, int, int]] = []
        for n in dict.fromkeys((fold(bare(text)), RUN_ON.sub("", raw), raw)):
            for w in (n, n[:-1]) if n.endswith("s") else (n,):
                if k := allowed(len(w)):
                    hits = [h for h in self.search(w, k) if h[0] <= allowed(min(len(w), h[3]))]
                if hits:
                    return min(hits)[2]
        return None


def build(entries: list[tuple[int, str, list[str] | None]]) -> Trie:
    """The trie of entries (meaning, name, aliases): names before aliases before other orders of their words."""
    trie = Trie()
    for meaning, name, aliases in entries:
        for rank, text in [(0, name), *[(1, a) for a in aliases or [] if a]]:
            if not text:
                continue
            trie.add(fold(text), meaning, rank)
            if "&" in text:
                trie.add(fold(text.replace("&", " ")), meaning, rank)
            words = text.split()
            for i in range(1, len(words)):
                trie.add(fold(" ".join(words[i:] + words[:i])), meaning, rank + 2)
    return trie


def mapped_tags(events: DataFrame, tags: DataFrame) -> DataFrame:
    """(event_id, tag_pos, tag_id): what every entry of tag_names means that isn't a tag's name itself; -1 for none.

    Null and blank entries have no row, null or empty lists none; entries that repeat have a row each. Of equally close tags the
    one found by its name, then the lowest id is taken. An empty reference list maps everything to -1.
    """
    listed = tags.select(F.col("tag_id").cast("int").alias("tag_id"), F.col("tag_name"), F.col("keywords")).where("tag_id IS NOT NULL AND tag_name IS NOT NULL")
    rows = listed.limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"a reference list of more than {MAX_ENTRIES} entries")
    entries = sorted((r["tag_id"], r["tag_name"], list(r["keywords"] or [])) for r in rows)
    sent = events.sparkSession.sparkContext.broadcast(entries)
    key = uuid.uuid4().hex

    def meaning(texts: pd.Series) -> pd.Series:
        best = _cached(key, sent)
        return pd.Series([best(t) for t in texts], dtype="int32")

    e = events.select("event_id", F.posexplode("tag_names").alias("tag_pos", "tag_name"))
    e = e.where(F.col("tag_name").isNotNull() & ~F.col("tag_name").rlike(r"(?U)^[\s ]*$"))
    names = listed.select("tag_name", F.lit(True).alias("_listed")).dropDuplicates(["tag_name"])
    e = keyed_join(e, names, ["tag_name"], "left").where("_listed IS NULL")
    return e.select("event_id", "tag_pos", F.pandas_udf(meaning, "int")("tag_name").alias("tag_id"))


_BUILT: dict[str, object] = {}


def _cached(key: str, sent) -> object:
    """One trie per worker process and reference list."""
    if key not in _BUILT:
        _BUILT.clear()
        trie = build(sent.value)

        @lru_cache(100_000)
        def best(text: str) -> int:
            found = trie.best(text)
            return -1 if found is None else found

        _BUILT[key] = best
    return _BUILT[key]
