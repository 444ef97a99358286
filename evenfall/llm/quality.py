"""Per-document text quality statistics, and documents that are not natural prose.

One pass over the texts gives the statistics. Each of those that count (WORSE) is ranked as it is, exactly, within each language and, so
that junk which fills a language can't hide itself, among the distinct texts of all languages, where copies count once: distinct values with their
counts are range-partitioned and sorted, each partition is offset by the counts before it. The share of documents whose value is
as bad or worse is the empirical tail probability; the least of the two counts. Negative logarithms of the tails, in standard deviations,
add up to the outlier score, each weighted by the share that the first principal component of all tails takes of it: statistics that
go along with the others count for more, and noise for little. Documents beyond the valley between the two classes of
scores are outliers, if there are two.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenfall.runtime import cut

LANGUAGES = ("en", "de", "es", "fr")
#: Stands for all languages together.
POOL = "all"
#: Statistics that are ranked, and whether high (1) or low (-1) values are bad.
WORSE = {"words": -1, "mean_word_length": 1, "symbol_ratio": 1, "digit_ratio": 1, "line_end_ratio": -1, "common_ratio": -1, "sentence_ratio": -1}
#: Steps that scores are counted in for the threshold, and how low the density between two classes is, compared to the classes.
SCORE_STEPS, APART = 1000, 0.8
# What text decoded with the wrong character set is full of.
_GARBLED = re.compile(r"[ÃÂ][\u0080-¿Œ-Ÿ‚-›€\s]|â‚¬|â€|Ã.|Â|ï¿½|�")
_GARBLES = "ÃÂâï�"
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_TOKEN = re.compile(r"\w+(?:['’]\w+)*")
_END = re.compile(r"[.!?…][\"'”’)\]]*$")
_DIGIT = re.compile(r"\d+")
_CLOSING = "\"'”’)]"
#: Pictures and hashtags behind a text.
_TAIL = re.compile(r"(?:\s*(?:#\w+|[\u2600-\u27bf\U0001f000-\U0001faff\ufe0f]+))+\s*$")
_SPLIT = re.compile(r"(?<=[.!?…]),\s+|(?<=[.!?…])[\"'”’)\]]*\s+(?=[^\W\d_a-zß-öø-ÿ]|[a-zß-öø-ÿ]|[\"“¿¡(–-])")


def units(text: str) -> list[str]:
    """Sentences and lines: lines that were wrapped are joined, then text is split behind sentence ends."""
    out: list[str] = []
    held = ""
    for line in text.split("\n"):
        s = line.strip()
        if held and s and "   " not in s and (s[0].islower() or (len(held) - held.rfind("\n") >= 58 and not _END.search(held) and (s[0].isalnum() or s[0] in "\"“„«¿¡(") and "\t" not in s)):
            held += " " + s
            continue
        if held:
            out.append(held)
        held = s
    if held:
        out.append(held)
    # a tail ends in a picture or has a hashtag
    return [x for u in out for x in _SPLIT.split(_TAIL.sub("", u) if "#" in u or u[-1] >= "\u2600" else u) if x and x.strip()]


def is_sentence(unit: str, common: frozenset[str]) -> bool:
    """A unit that reads like part of prose: enough words, some of them common, few figures, symbols and capitals."""
    if unit.count("\t") > 1 or unit.count("|") > 1 or unit.count("»") > 1:
        return False
    tokens = _TOKEN.findall(unit)
    words = [t for t in tokens if not t[0].isdigit()]
    n, marks = len(words), len(unit) - unit.count(" ") - len("".join(tokens))
    if n < 5 or len(tokens) - n > 0.2 * len(tokens) or marks > 0.14 * len(unit):
        return False
    known = sum(map(common.__contains__, map(str.lower, words))) / n
    if known < 0.12:
        return False
    titled = sum(map(str.istitle, words[1:])) / (n - 1)
    if unit.rstrip(_CLOSING)[-1:] in (".", "!", "?", "…"):
        return titled < 0.6 or known >= 0.2
    return n >= 8 and known >= 0.18 and titled < 0.6 and unit.count(",") < 0.4 * n


def is_heading(unit: str) -> bool:
    """A short line of words that may stand over prose; it speaks neither for it nor against it."""
    return len(unit) <= 80 and 1 <= len(_WORD.findall(unit)) <= 11 and not re.search(r"[|;\t=<>{}\\]|\d{1,2}[:.]\d{2}|https?:", unit) and unit[0] not in "-*•·–[\"" and not unit[0].isdigit() or bool(re.match(r"\d{4} \w+: \w", unit))


def statistics(text: str | None, common: frozenset[str]) -> tuple:
    """(words, mean_word_length, symbol_ratio, digit_ratio, line_end_ratio, common_ratio, sentence_ratio, garbled_ratio, single_ratio)."""
    t = text or ""
    words = _WORD.findall(t)
    n = len(words)
    solid = len("".join(t.split()))
    letters = len("".join(words))
    digits = len("".join(_DIGIT.findall(t)))
    lines = [x for x in map(str.strip, t.split("\n")) if x]
    prose = whole = 0
    for k, u in enumerate(units(t)):
        size = len(u) - u.count(" ")
        ok = is_sentence(u, common)
        if k == 0 and not ok and is_heading(u):
            continue
        whole += size
        prose += size * ok
    return (
        n,
        letters / n if n else 0.0,
        (solid - letters - digits) / solid if solid else 0.0,
        digits / solid if solid else 0.0,
        sum(x.rstrip(_CLOSING)[-1:] in (".", "!", "?", "…") for x in lines) / len(lines) if lines else 0.0,
        sum(map(common.__contains__, map(str.lower, words))) / n if n else 0.0,
        prose / whole if whole else 0.0,
        min(1.0, len(_GARBLED.findall(t)) / n) if n and any(map(t.__contains__, _GARBLES)) else 0.0,
        list(map(len, words)).count(1) / n if n else 0.0,
    )


NAMES = ("words", "mean_word_length", "symbol_ratio", "digit_ratio", "line_end_ratio", "common_ratio", "sentence_ratio", "garbled_ratio", "single_ratio")
_SCHEMA = "words long, " + ", ".join(f"{n} double" for n in NAMES[1:])


def language(lang: str = "lang"):
    """The two-letter language, 'other' for what is null or unknown."""
    two = F.lower(F.substring(F.trim(F.col(lang)), 1, 2))
    return F.when(two.isin(*LANGUAGES), two).otherwise(F.lit("other"))


def document_statistics(documents: DataFrame, common_words: DataFrame, *keep) -> DataFrame:
    """doc_id, language, columns to keep and the statistics of every document. Null and empty texts have 0 everywhere.

    common_words is the fixed list of a few hundred words; words of all languages count, as a document's language tag may be wrong.
    """
    rows = common_words.select("word").where("word IS NOT NULL").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("a list of more than 100000 common words")
    sent = documents.sparkSession.sparkContext.broadcast(frozenset(r["word"].lower() for r in rows))

    def measure(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t, sent.value) for t in text], columns=NAMES)

    d = documents.select("doc_id", language().alias("language"), *keep, F.pandas_udf(measure, _SCHEMA)("text").alias("s"))
    return d.select(*d.columns[:-1], "s.*")


def exact_tails(values: DataFrame) -> DataFrame:
    """language, statistic, value, tail: the share of a language's documents that have this value or a lower one.

    values: language, statistic, value, one row per document and statistic. Ranks are exact: counts of distinct values, sorted by
    range partitions, within a partition by a running sum, and before it by the sums of the partitions in front.
    """
    counts = values.groupBy("language", "statistic", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = cut(counts.repartitionByRange("language", "statistic", "value").withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy("language", "statistic", "part").agg(F.sum("n").alias("sum"))
    group = Window.partitionBy("language", "statistic")
    before = sums.withColumn("before", F.sum("sum").over(group.orderBy("part")) - F.col("sum")).withColumn("all", F.sum("sum").over(group)).drop("sum")
    running = ranged.withColumn("here", F.sum("n").over(Window.partitionBy("language", "statistic", "part").orderBy("value")))
    # a row for every group and partition: as many as partitions and groups together
    return running.join(F.broadcast(before), ["language", "statistic", "part"]).select("language", "statistic", "value", ((F.col("before") + F.col("here")) / F.col("all")).alias("tail"))


def tails(stats: DataFrame) -> DataFrame:
    """doc_id and a column for each statistic that counts: the negative logarithm of its tail.

    stats: as document_statistics gives them, with text_key, which is the same for copies of a text. Bad values of all statistics are made
    low ones; texts without a word are worse than any other in all of them.
    """
    none = F.col("words") == 0
    low = [F.when(none, F.lit(float("-inf"))).otherwise(-g * F.col(n).cast("double")).alias(n) for n, g in WORSE.items()]
    # texts with the same language and statistics have the same tails, so they are one row with a number
    rows = cut(stats.select("doc_id", "text_key", "language", *low).withColumn("group", F.xxhash64("language", *WORSE)))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("statistic"), F.col(n).alias("value")) for n in WORSE])).alias("p")
    values = rows.select("language", pairs).select("language", "p.*")
    pool = rows.dropDuplicates(["text_key"]).select(F.lit(POOL).alias("language"), pairs).select("language", "p.*")
    t = cut(exact_tails(values.unionByName(pool)))
    mine = t.where(F.col("language") != POOL).join(t.where(F.col("language") == POOL).select("statistic", "value", F.col("tail").alias("pooled")), ["statistic", "value"])
    mine = mine.select("language", "statistic", "value", (-F.log(F.least("tail", "pooled"))).alias("l"))
    groups = rows.groupBy("group").agg(F.first("language").alias("language"), *[F.first(n).alias(n) for n in WORSE])
    long = groups.select("group", "language", pairs).select("group", "language", "p.*").join(mine, ["language", "statistic", "value"])
    wide = long.groupBy("group").agg(*[F.max(F.when(F.col("statistic") == n, F.col("l"))).alias(n) for n in WORSE])
    return rows.select("doc_id", "group").join(wide, "group").drop("group")


def weights(logs: DataFrame) -> dict[str, float]:
    """What a unit of each statistic's logarithm counts for: its share in the first principal component, over its standard deviation."""
    names = [n for n in WORSE if n in logs.columns]
    pairs = [(a, b) for k, a in enumerate(names) for b in names[k:]]
    got = logs.agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(f"s_{n}") for n in names], *[F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs]).first()
    n = got["n"]
    if not n:
        return {}
    mean = np.array([got[f"s_{x}"] for x in names]) / n
    square = np.zeros((len(names), len(names)))
    for a, b in pairs:
        i, j = names.index(a), names.index(b)
        square[i, j] = square[j, i] = got[f"p_{a}_{b}"] / n - mean[i] * mean[j]
    sd = np.sqrt(np.maximum(np.diag(square), 0.0))
    if not (sd > 1e-9).any():
        return {}
    scale = np.where(sd > 1e-9, 1 / np.maximum(sd, 1e-9), 0.0)
    _, vectors = np.linalg.eigh(square * scale[:, None] * scale[None, :])
    first = vectors[:, -1]
    first = np.maximum(first if first.sum() >= 0 else -first, 0.0)  # what goes against the others counts for nothing
    return {x: float(w) for x, w in zip(names, first**2 * scale) if w > 0}


def parting(counts: list[tuple[int, int]]) -> int | None:
    """The last step of the lower of two classes; None if there is but one.

    The classes are those that lie farthest apart for their sizes (Otsu). Between their modes, in a Gaussian estimate of the density, the
    least density parts them. They are two if there the density is less than APART of that at the lower mode.
    """
    x, n = np.array([c[0] for c in counts], dtype=int), np.array([c[1] for c in counts], dtype=float)
    total = n.sum()
    if len(x) < 2:
        return None
    h = np.bincount(x, weights=n, minlength=2 * SCORE_STEPS + 1)
    steps = np.arange(len(h))
    below, sums = np.cumsum(h)[:-1], np.cumsum(h * steps)[:-1]
    inside = (below > 0) & (below < total)
    mean = sums[-1] / total if below[-1] == total else (h * steps).sum() / total
    between = np.where(inside, (mean * below - sums) ** 2 / np.maximum(below * (total - below), 1e-9), 0.0)
    k = int(between.argmax())
    spread = math.sqrt((h * (steps - mean) ** 2).sum() / total)
    sigma = max(1.0, spread * total**-0.2)
    reach = np.arange(-int(4 * sigma), int(4 * sigma) + 1)
    density = np.convolve(h, np.exp(-0.5 * (reach / sigma) ** 2))[len(reach) // 2 :][: len(h)]
    low, high = int(density[: k + 1].argmax()), k + 1 + int(density[k + 1 :].argmax())
    valley = low + int(density[low : high + 1].argmin())
    return valley if density[valley] < APART * min(density[low], density[high]) else None


def outlier_scores(stats: DataFrame) -> tuple[DataFrame, int | None]:
    """doc_id, score of every document in steps of which most documents have less than SCORE_STEPS, and the last step of the lower class."""
    logs = cut(tails(stats))
    w = weights(logs)
    if not w:
        return logs.select("doc_id", F.lit(0).alias("score")), None
    score = sum(F.col(n) * x for n, x in w.items())
    # 12 standard deviations and more are one step, so one far outlier doesn't stretch the scale
    steps = F.least(F.floor(score * (SCORE_STEPS / 12)), F.lit(2 * SCORE_STEPS)).cast("int")
    scored = logs.select("doc_id", steps.alias("score"))
    counts = scored.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 SCORE_STEPS + 1 rows
    return scored, parting([(r["score"], r["n"]) for r in counts])


def not_prose(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id): documents whose text is mainly a list, a table, records or junk. Null and empty texts are junk.

    doc_id is unique. Where the documents are all alike there are no outliers but texts without a word.
    """
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    stats = cut(document_statistics(documents, common_words, key))
    scores, last = outlier_scores(stats)
    empty = stats.where("words = 0").select("doc_id")
    return empty if last is None else scores.where(F.col("score") > last).select("doc_id").union(empty).distinct()
