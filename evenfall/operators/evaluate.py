"""Extracted records against labels: pairing, fields, recall and precision, and what got worse."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenfall.functions.text import fold

#: Titles are the same from so similar on, descriptions, and points so near in degrees.
TITLE_LEAST, DESCRIPTION_LEAST, DEGREES = 0.8, 0.9, 0.0005


def similarity(a: str | None, b: str | None) -> float:
    """Ratcliff-Obershelp ratio of the folded texts; 1 for equal ones."""
    x, y = (" ".join((t or "").split()).casefold() for t in (a, b))
    return 1.0 if x == y else SequenceMatcher(None, x, y).ratio()


def _pairs_of(group: pd.DataFrame) -> pd.DataFrame:
    """Best pairs first, each label and record once; a start in common goes before a more similar title."""
    expected, actual = group[group["side"] == 0], group[group["side"] == 1]
    scored = []
    for e in expected.itertuples():
        for a in actual.itertuples():
            s = similarity(e.title, a.title)
            if s >= TITLE_LEAST:
                scored.append((-(s + (e.start == a.start and e.start is not None)), e.idx, a.idx))
    used_e, used_a, out = set(), set(), []
    for _, e, a in sorted(scored):
        if e not in used_e and a not in used_a:
            used_e.add(e)
            used_a.add(a)
            out.append((group["case_id"].iat[0], e, a))
    return pd.DataFrame(out, columns=["case_id", "label_idx", "event_idx"])


def pairs(labels: DataFrame, records: DataFrame) -> DataFrame:
    """(case_id, label_idx, event_idx): labels and records (case_id, idx, title, start) of a case paired one to one by title.

    Equal folded titles with equal starts, one of each in a case, are joined without comparing anything; only the rest of a case, a
    page's few events, goes through the greedy pairing.
    """
    key = lambda d, i: d.select("case_id", F.col("idx").alias(i), fold(F.col("title")).alias("_t"), F.col("start").alias("_s"))
    alone = lambda d, i: d.where("_s IS NOT NULL").groupBy("case_id", "_t", "_s").agg(F.min(i).alias(i), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    sure = alone(key(labels, "label_idx"), "label_idx").join(alone(key(records, "event_idx"), "event_idx"), ["case_id", "_t", "_s"]).select("case_id", "label_idx", "event_idx")
    rest = lambda d, i, side: d.join(sure.select("case_id", F.col(i).alias("idx")), ["case_id", "idx"], "left_anti").select("case_id", F.lit(side).alias("side"), F.col("idx").cast("long").alias("idx"), "title", F.col("start").cast("string").alias("start"))
    both = rest(labels, "label_idx", 0).unionByName(rest(records, "event_idx", 1))
    loose = both.groupBy("case_id").applyInPandas(_pairs_of, "case_id long, label_idx long, event_idx long")
    return sure.select(F.col("case_id").cast("long").alias("case_id"), F.col("label_idx").cast("long").alias("label_idx"), F.col("event_idx").cast("long").alias("event_idx")).unionByName(loose)


def same_text(a: Column, b: Column) -> Column:
    """Both empty, or equal when folded."""
    return fold(a) == fold(b)


def same_url(a: Column, b: Column) -> Column:
    end = lambda c: F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "/+$", "")
    return end(a) == end(b)


def same_point(a: Column, b: Column) -> Column:
    return (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) <= DEGREES, F.lit(False))


def same_set(a: Column, b: Column) -> Column:
    norm = lambda c: F.array_sort(F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: fold(x))))
    return norm(a) == norm(b)


def case_scores(cases: DataFrame, labels: DataFrame, records: DataFrame, paired: DataFrame) -> DataFrame:
    """case_id, labelled, found, parsed, wrong: records that no label names are wrong where the labels are complete."""
    n = lambda d, name: d.groupBy("case_id").agg(F.count(F.lit(1)).alias(name))
    c = cases.select("case_id", F.coalesce("complete", F.lit(False)).alias("complete"))
    for d, name in ((labels, "labelled"), (records, "parsed"), (paired, "found")):
        c = c.join(n(d, name), "case_id", "left")
    c = c.fillna(0, ["labelled", "parsed", "found"])
    return c.select("case_id", "labelled", "found", "parsed", F.when(F.col("complete"), F.col("parsed") - F.col("found")).otherwise(F.lit(0)).cast("long").alias("wrong"))


def scorecard(scores: DataFrame, by: list[str]) -> DataFrame:
    """Totals with recall and precision over all, and over each group of the first columns: by (a), (a, b), … Nothing to find is 1."""
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(1.0))
    t = scores.rollup(*by).agg(F.count(F.lit(1)).alias("cases"), F.sum("labelled").alias("labelled"), F.sum("found").alias("found"), F.sum("wrong").alias("wrong"))
    return t.select(*by, "cases", "labelled", "found", "wrong", share(F.col("found"), F.col("labelled")).alias("recall"), share(F.col("found"), F.col("found") + F.col("wrong")).alias("precision"))


def regressions(before: DataFrame, now: DataFrame) -> DataFrame:
    """case_id, worse, better: failures (arrays of paths) that are new, and those that are gone; cases without either have no row.

    All failures of a case that only one side has are new, or gone. Null failures are none.
    """
    none = F.array().cast("array<string>")
    j = before.select("case_id", F.col("failures").alias("_b")).join(now.select("case_id", F.col("failures").alias("_n")), "case_id", "full_outer")
    j = j.select("case_id", F.coalesce("_b", none).alias("_b"), F.coalesce("_n", none).alias("_n"))
    out = j.select("case_id", F.array_sort(F.array_except("_n", "_b")).alias("worse"), F.array_sort(F.array_except("_b", "_n")).alias("better"))
    return out.where((F.size("worse") > 0) | (F.size("better") > 0))


def evidence_holds(evidence: Column, page_text: Column) -> Column:
    """Whether a record's evidence stands in the page's text, both folded; without evidence it doesn't."""
    e = fold(evidence)
    return (e != "") & F.contains(fold(page_text), e)


# Kinds of cases and where they come from.
KINDS, ORIGINS = ("listing", "detail", "site"), ("manual", "crawl", "correction", "page_review", "report")


def case_problems(cases: DataFrame) -> DataFrame:
    """case_id, problems: what keeps a case from being used, as codes in this order: url, kind, source, captured_at, title, html."""
    labels = F.from_json("events", "array<struct<title:string>>")
    untitled = F.exists(labels, lambda e: F.coalesce(e["title"], F.lit("")) == "")
    bad = lambda c, allowed: ~F.coalesce(F.col(c).isin(*allowed), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(F.coalesce("url", F.lit("")) == "", F.lit("url")), F.when(bad("kind", KINDS), F.lit("kind")), F.when(bad("source", ORIGINS), F.lit("source")),
            F.when(F.try_to_timestamp("captured_at").isNull(), F.lit("captured_at")), F.when(F.coalesce(untitled, F.lit(False)), F.lit("title")), F.when(F.coalesce("html", F.lit("")) == "", F.lit("html")),
        )
    )
    return cases.select("case_id", found.alias("problems"))


def local_time(value: Column, zone: Column) -> Column:
    """An ISO time with an offset as a zone's wall clock, to the minute; midnight as its day. Anything else stays. zone: a known name or null."""
    has_offset = value.rlike(r"T.*(?:Z|[+-]\d{2}:?\d{2})$")
    wall = F.convert_timezone(F.lit("UTC"), F.coalesce(zone, F.lit("UTC")), F.try_to_timestamp(value).cast("timestamp_ntz"))
    text = F.date_format(wall, "yyyy-MM-dd'T'HH:mm")
    return F.when(has_offset & zone.isNotNull() & wall.isNotNull(), F.regexp_replace(text, "T00:00$", "")).otherwise(value)
