"""Near-duplicate records with small edits.

The words of a text, counted with repeats, are a set of (word, occurrence) elements; the similarity of two texts is the Jaccard
coefficient of these sets. Each text gets SetSketch registers: the minimum over its elements of exponentially distributed hash
values, truncated to a logarithmic scale with base B. Registers are mergeable, and equal with a probability that grows with the
similarity, so bands of registers, together with the time slot of the record, are join keys. A pair that shares a key goes through
a look at two bits of each of many minima, then the likelihood of its registers, jointly with both set sizes, gives an estimate of
the similarity, and what may reach the threshold is verified exactly on the words.

Texts with the same words are one class throughout; classes are expanded to records at the very end, by time. What costs much to ask of
a record, as whether it is residue, is asked only of those that may have a pair.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.llm import residue
from evenfall.operators import times
from evenfall.runtime import HOT_PARTS, cut, keyed_join

#: Registers that are banded: BANDS bands of ROWS registers. A pair of similarity 0.7 shares a band with a probability of 0.996, one
#: of 0.75 with 0.9995.
ROWS, BANDS = 4, 20
REGISTERS = ROWS * BANDS
#: Two bits of so many of the minima are kept, and so many of these bits may differ: a pair of similarity 0.7 passes by 4.5 standard
#: deviations (minima that differ, with a chance of 0.3, differ in one of the two bits on average).
MINIMA, MAX_DIFFERENT = 64, 41
#: A band is hot if so many of its classes are among one of HOT_SAMPLE, and is then split into HOT_PARTS parts; at most MOST_HOT bands are.
HOT_SAMPLE, HOT_COUNT, MOST_HOT = 100, 50, 500
#: Records meet in time slots of so many windows.
SLOT = 3
#: Texts that are sketched at a time: their rows of hash values stay in the processor's cache.
CHUNK = 50
#: Base of the registers' scale, and the largest value of one (a byte).
BASE, TOP = 1.1, 254
#: Estimates may fall short of the threshold by so many standard deviations of the estimator.
SLACK = 4.5
_WORD = re.compile(r"\w+")
_A = (np.arange(REGISTERS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def element_hash(word: str, occurrence: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, seed=occurrence)


class Numbers(dict):
    """The row that an element has in a table; new elements get the next ones and are noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, element) -> int:
        self.new.append(element)
        n = self[element] = len(self)
        return n


class Hasher:
    """Hash values of elements for every register, kept for the elements seen lately."""

    def __init__(self, most: int = 60_000) -> None:
        self.most = most
        self.rows = Numbers()
        self.table = np.empty((1024, REGISTERS), dtype=np.uint32)

    def add(self, new: list) -> None:
        """The values of the elements numbered last."""
        at = len(self.rows) - len(new)
        while len(self.rows) > len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        h = np.array([element_hash(*e) if isinstance(e, tuple) else element_hash(e, 0) for e in new], dtype=np.uint64)
        with np.errstate(over="ignore"):
            self.table[at : at + len(new)] = (_mix(h[:, None] * _A[None, :] + (_A[None, :] >> np.uint64(17))) >> np.uint64(32)).astype(np.uint32)

    def minima(self, texts: list[list]) -> np.ndarray:
        """The least hash value of each text's elements for every register; no text may be empty."""
        if len(self.rows) > self.most:
            self.rows.clear()
        lengths = list(map(len, texts))
        ids = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(texts)), np.intp, sum(lengths))
        if self.rows.new:
            self.add(self.rows.new)
            self.rows.new = []
        return np.minimum.reduceat(self.table.take(ids, axis=0), np.cumsum([0, *lengths[:-1]]), axis=0)


def elements(tokens: list[str]) -> list:
    """Every distinct word, and for each further time it occurs, the word with a number."""
    counts = Counter(tokens)
    out: list = list(counts)
    if len(out) < len(tokens):
        out += [(w, k) for w, n in counts.items() if n > 1 for k in range(1, n)]
    return out


def registers(minima: np.ndarray) -> np.ndarray:
    """Truncated logarithms of exponential minima: the hash values are uniform, so -log(1 - u) is exponential, and so is its minimum."""
    x = -np.log1p(-(minima.astype(np.float64) + 0.5) / 2**32)
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.uint8)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The most likely Jaccard coefficient of pairs (rows of registers a and b, set sizes na and nb).

    A register of a is greater with probability p(u - v J), of b with p(v - u J), and equal else, where u and v are the shares of the
    two sizes and p(x) = -log_B(1 - x (B - 1) / B); the likelihood is concave in J, so its maximum is found by golden sections.
    """
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u, v = na / (na + nb), nb / (na + nb)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        pa, pb = p(u - v * j), p(v - u * j)
        return above * np.log(pa) + below * np.log(pb) + equal * np.log(np.clip(1 - pa - pb, 1e-12, 1))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    g = (np.sqrt(5) - 1) / 2
    for _ in range(24):
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        right = likelihood(x) < likelihood(y)
        lo, hi = np.where(right, x, lo), np.where(right, hi, y)
    return (lo + hi) / 2


def jaccard(a: list[str], b: list[str]) -> float:
    """Shared words, counted with repeats, over all words of both less the shared ones."""
    x, y = Counter(a), Counter(b)
    shared = sum((x & y).values())
    total = len(a) + len(b) - shared
    return shared / total if total else 0.0


_SKETCH = "k1 long, k2 long, size int, sketch binary, b1 long, b2 long"


def _sketch_batch(text: pd.Series) -> pd.DataFrame:
    import xxhash

    hasher = _HASHERS.setdefault("h", Hasher())
    out = []
    for at in range(0, len(text), CHUNK):
        tokens = [words(t) for t in text[at : at + CHUNK]]
        full = [i for i, t in enumerate(tokens) if t]
        least = hasher.minima([elements(tokens[i]) for i in full]) if full else np.empty((0, REGISTERS), np.uint32)
        regs = registers(least)
        low = (least[:, :MINIMA, None] >> np.arange(2, dtype=np.uint32)) & 1
        bits = np.packbits(low.reshape(len(full), 2 * MINIMA).astype(np.uint8), axis=1).view(np.int64) if full else np.empty((0, 2), np.int64)
        rows = {i: n for n, i in enumerate(full)}
        for i, t in enumerate(tokens):
            k1, k2 = np.frombuffer(xxhash.xxh3_128_digest("\n".join(sorted(t))), dtype=np.int64)
            n = rows.get(i)
            out.append((k1, k2, len(t), regs[n].tobytes(), bits[n, 0], bits[n, 1]) if n is not None else (k1, k2, 0, b"", 0, 0))
    return pd.DataFrame(out, columns=["k1", "k2", "size", "sketch", "b1", "b2"])


_HASHERS: dict[str, Hasher] = {}


def _likely_batch(threshold: float):
    def likely(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x = np.frombuffer(b"".join(a), dtype=np.uint8).reshape(len(a), REGISTERS)
        y = np.frombuffer(b"".join(b), dtype=np.uint8).reshape(len(b), REGISTERS)
        slack = SLACK * np.sqrt(threshold * (1 - threshold) / REGISTERS)
        return pd.Series(estimate(x, y, na.to_numpy(float), nb.to_numpy(float)) >= threshold - slack)

    return likely


def _same_batch(threshold: float):
    def same(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(words(x), words(y)) >= threshold - 1e-12 for x, y in zip(a, b)], dtype=bool)

    return same


def slot_of(length: int):
    """The number of the slot of so many seconds that at lies in, rounded down before 1970 too."""
    return F.expr(f"(at - pmod(at, {length})) div {length}")


def similar_pairs(records: DataFrame, texts: DataFrame, threshold: float, window: int, counts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(id_a, id_b), id_a < id_b: records with at least that similarity whose times are at most window seconds apart.

    records: id LONG unique, at LONG (seconds), text STRING; texts: id and text of the same records (and maybe others), cheap to make
    again, as texts are looked at again rather than kept. Null ids, times and texts, and texts without a word have no pairs.
    counts: adds the column counts to rows of texts, whether pairs of the record count; null is no. All count without it.
    """
    sketch = F.pandas_udf(_sketch_batch, _SKETCH)
    r = records.where("id IS NOT NULL AND at IS NOT NULL AND text IS NOT NULL").select("id", "at", sketch("text").alias("k"))
    r = cut(r.where("k.size > 0").select("id", "at", "k.*"))
    # one record stands for all with the same words: they have the same registers
    classes = cut(r.groupBy("k1", "k2").agg(F.min_by(F.struct(F.col("id").alias("rep"), "size", "sketch", "b1", "b2"), "id").alias("c"), F.count(F.lit(1)).alias("members")).select("k1", "k2", "c.*", "members"))
    members = cut(r.select("id", "at", "k1", "k2").join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select("id", "at", "rep"))
    length = SLOT * window
    slot = slot_of(length)
    spans = members.groupBy("rep", slot.alias("slot")).agg(F.min("at").alias("first"), F.max("at").alias("last")).join(classes.select("rep", "size", "sketch", "b1", "b2"), "rep")
    # a class stands in its slot, and in the next one if it reaches within a window of it
    near = F.col("last") >= (F.col("slot") + 1) * length - window
    spans = spans.withColumn("slot", F.explode(F.when(near, F.array(F.col("slot"), F.col("slot") + 1)).otherwise(F.array(F.col("slot")))))
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", i * ROWS + 1, ROWS), F.col("slot")) for i in range(BANDS)])
    # times from the start of the slot, which the key fixes: small whatever the date, so the rows stay narrow
    rows = spans.select(F.explode(keys).alias("key"), "rep", "size", "b1", "b2", (F.col("first") - F.col("slot") * length).alias("first"), (F.col("last") - F.col("slot") * length).alias("last"))
    # a template that many classes share makes a hot band: its rows are dealt out, and met by copies of the others in every part. Which
    # bands are hot is told by a sample of the classes; that only decides where pairs meet, not which
    some = spans.where(F.pmod(F.xxhash64("rep"), F.lit(HOT_SAMPLE)) == 0).select(F.explode(keys).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = [h["key"] for h in some.where(F.col("n") >= HOT_COUNT).orderBy(F.desc("n"), "key").limit(MOST_HOT).collect()]
    is_hot = F.col("key").isin(hot) if hot else F.lit(False)
    x = rows.withColumn("part", F.when(is_hot, F.pmod(F.xxhash64("rep"), F.lit(HOT_PARTS)).cast("int")).otherwise(F.lit(0))).alias("x") if hot else rows.alias("x")
    y = rows.withColumn("part", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0))))).alias("y") if hot else rows.alias("y")
    meets = (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.first") - window <= F.col("y.last")) & (F.col("y.first") - window <= F.col("x.last"))
    meets = meets & (F.col("x.part") == F.col("y.part")) if hot else meets
    fits = F.least("x.size", "y.size") >= F.greatest("x.size", "y.size") * F.lit(threshold)
    differ = F.bit_count(F.col("x.b1").bitwiseXOR(F.col("y.b1"))) + F.bit_count(F.col("x.b2").bitwiseXOR(F.col("y.b2")))
    pairs = x.join(y, meets & fits & (differ <= MAX_DIFFERENT)).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    likely = F.pandas_udf(_likely_batch(threshold), "boolean")
    pairs = pairs.join(classes.select(F.col("rep").alias("a"), F.col("sketch").alias("xa"), F.col("size").alias("na")), "a")
    pairs = pairs.join(classes.select(F.col("rep").alias("b"), F.col("sketch").alias("xb"), F.col("size").alias("nb")), "b")
    pairs = cut(pairs.where(likely("xa", "xb", "na", "nb")).select("a", "b"))
    # the texts of classes that may be similar, and of copies
    copies = classes.where("members > 1").select("rep")
    reps = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(copies).distinct()
    texts = texts.join(members.join(reps, "rep").select("id"), "id", "left_semi")
    texts = cut((counts(texts) if counts else texts.withColumn("counts", F.lit(True))).select("id", "text", "counts"))
    same = F.pandas_udf(_same_batch(threshold), "boolean")
    pairs = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    pairs = cut(pairs.where(same("ta", "tb")).select("a", "b"))
    # back to records: pairs of two classes, and of one class with itself
    both = pairs.unionByName(copies.select(F.col("rep").alias("a"), F.col("rep").alias("b")))
    members = members.join(texts.where("counts").select("id"), "id", "left_semi")
    mine = members.withColumn("slot", slot_of(window))
    left = keyed_join(mine.select(F.col("rep").alias("a"), F.col("id").alias("ia"), F.col("at").alias("ta"), F.col("slot").alias("sa")), both, ["a"])
    left = left.withColumn("slot", F.explode(F.array(F.col("sa") - 1, F.col("sa"), F.col("sa") + 1)))
    right = mine.select(F.col("rep").alias("b"), "slot", F.col("id").alias("ib"), F.col("at").alias("tb"))
    joined = keyed_join(left, right, ["b", "slot"]).where((F.abs(F.col("ta") - F.col("tb")) <= window) & ((F.col("a") != F.col("b")) | (F.col("ia") < F.col("ib"))))
    return joined.select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))


def same_events(events: DataFrame, sources: DataFrame, threshold: float = 0.7, window: int = 3600) -> DataFrame:
    """(event_id_a, event_id_b), a < b: rows that announce the same event.

    Both have a description that is not blank and a start with time of day, neither's title or description is residue, the starts are
    at most window seconds apart, and title + ' ' + description share at least threshold of their words. A null title counts as empty.
    """
    fields = residue.fields_of(events)
    model = residue.learn(fields)
    e = times.with_utc(events.where("description IS NOT NULL AND trim(description) != ''"), sources, ("start_datetime",), ("event_id", "title", "description"))
    e = e.where(F.length("start_datetime_utc") > 10)
    # filler is alike everywhere, so much of it would meet; what opens like it is scored at once, all else if it may have a pair
    e = residue.scored_rows(e, model, tuple(F.when(residue.opens_trusted(x), F.col(x)) for x in ("title", "description"))).where("score <= 0").drop("score")
    at = F.unix_seconds(F.to_timestamp("start_datetime_utc", "yyyy-MM-dd'T'HH:mm:ssX"))
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.col("description")).alias("text")
    records = e.select(F.col("event_id").cast("long").alias("id"), at.alias("at"), text)
    texts = events.where("description IS NOT NULL").select(F.col("event_id").cast("long").alias("id"), text, "title", "description")
    real = lambda t: residue.scored_rows(t, model).withColumn("counts", F.col("score") <= 0)
    return similar_pairs(records, texts, threshold, window, real).select(F.col("id_a").alias("event_id_a"), F.col("id_b").alias("event_id_b"))
