"""Filling fixed-capacity containers with items.

Items are only cut if they are larger than a container. What matters for a packing is the histogram of item sizes, which has at most as
many entries as the capacity, whatever the number of items. Over it the configuration linear program (as few containers as possible, each
with one of the possible fillings, so that every size is covered) is solved by multiplicative weights: a size's weight falls
exponentially with the share of it that is covered. In every round a knapsack dynamic program prices the fillings: of those with the
least room unused, one that takes the sizes of greatest weight first, and this one is used for a part of what is left of its sizes.
Weights over the worth of the best filling are a solution of the dual program, so a knapsack by weights also gives a lower bound for any
packing.

The solution is rounded down to whole containers. What is left is a packing problem of the same kind with few items of each size. It is
rounded on by diving: the fullest fillings around the largest size that is left are fixed at as many whole containers as its items
allow. Each uses a size up, so work depends on the number of sizes, not of items. Items are then dealt to the containers by their rank
among the items of their size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.llm import tokens
from evenfall.runtime import cut

#: Most rounds of multiplicative weights for each size, and how much of what is left of its sizes a filling is used for in one.
ROUNDS, STEP = 16, 0.5
#: Share of a size that may be left to cover; the rounding covers it.
DONE = 0.002
#: How fast a size's weight falls with the share of it that is covered.
RATE = 1.0
#: A filling is used if it is at least so full, compared to the fullest one so far.
NEAR = 0.995


def worth(sizes: np.ndarray, values: np.ndarray, capacity: int) -> float:
    """The value of the best filling, any number of each size."""
    best = np.zeros(capacity + 1)
    upto = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(int(sizes[0]), capacity + 1):
        best[c] = max(best[c - 1], (best[c - sizes[: upto[c]]] + values[: upto[c]]).max())
    return float(best[capacity])


@dataclass
class Plan:
    """Fillings (size: how often) with the number of containers of each; the value of the linear program's solution, the dual bound, and how many
    items the solution placed when it was rounded down."""

    fillings: list[tuple[dict[int, int], int]]
    value: float
    bound: float
    rounded: int


def solve(counts: dict[int, int], capacity: int) -> Plan:
    """A plan that holds every item of the histogram exactly once."""
    counts = {s: n for s, n in counts.items() if n > 0 and s > 0}
    if not counts:
        return Plan([], 0.0, 0.0, 0)
    sizes = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[int(s)] for s in sizes], dtype=float)
    share = sizes / capacity
    left, weight = n.copy(), np.ones(len(n))
    skipped = np.zeros(len(n), dtype=bool)
    found: dict[tuple, float] = {}
    least = float((share * n).sum())
    fullest_yet = 0
    for _ in range(ROUNDS * len(n)):
        open_ = left >= np.maximum(1, DONE * n)
        anchors = open_ & ~skipped
        if not anchors.any():
            break
        first = int(np.argmax(share * weight * anchors))
        order = np.argsort(-(share * weight)[open_], kind="stable")
        here = np.flatnonzero(open_)[order]
        f = fullest(sizes[here].tolist(), left[here].astype(np.int64).tolist(), capacity, int(np.flatnonzero(here == first)[0]))
        used = sum(int(sizes[here[i]]) * a for i, a in f.items())
        fullest_yet = max(fullest_yet, used)
        if used < NEAR * fullest_yet:
            skipped[first] = True  # with what is left no filling with it is worth as much as others are
            continue
        most = min(left[here[i]] / a for i, a in f.items())
        times = max(1.0, STEP * most)
        key = tuple(sorted((int(here[i]), a) for i, a in f.items()))
        found[key] = found.get(key, 0.0) + times
        for i, a in key:
            left[i] -= a * times
            weight[i] = np.exp(-RATE * (1 - left[i] / n[i]))
    # the lower bounds by plain sizes, by the weights, and by steps that count the large sizes
    for y in (share * weight, np.where(share > 0.5, 1.0, np.where(share == 0.5, 0.5, 0.0))):
        if y.any():
            least = max(least, float((y * n).sum() / worth(sizes, y, capacity)))
    value = sum(found.values()) + float(min(2 * (share * left).sum() + (left > 0).any(), left.sum()))  # the rest fits twice its size
    out: dict[tuple, int] = {}
    rest = n.astype(np.int64)
    for key, times in found.items():
        whole = int(times + 1e-9)
        if whole:
            out[key] = whole
            for i, a in key:
                rest[i] -= a * whole
    rounded = int(n.sum() - rest.sum())
    dive(sizes, rest, out, capacity)
    return Plan([({int(sizes[i]): a for i, a in key}, times) for key, times in out.items()], float(max(value, least)), float(least), rounded)


def fullest(sizes: list[int], left: list[int], capacity: int, first: int) -> dict[int, int]:
    """The filling with the least room unused that holds the size with index first, by indices; no size more often than there are items left.

    A bounded knapsack whose reachable sums are the bits of one number. Sizes come in their order until the room can be filled,
    and are asked last to first whether the sum can do without them, so the first ones are taken as far as they fit.
    """
    room = capacity - sizes[first]
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []
    for k, size in enumerate(sizes):
        most = min(left[k] - (k == first), room // size)
        some = 1
        while most > 0:  # so many at a time, so that any number up to most can be made
            some = min(some, most)
            steps.append((k, some, reach))
            reach |= (reach << (some * size)) & mask
            most -= some
            some *= 2
        if reach >> room:
            break
    at = reach.bit_length() - 1
    used = {first: 1}
    for k, some, before in reversed(steps):
        if not before >> at & 1:
            used[k] = used.get(k, 0) + some
            at -= some * sizes[k]
    return used


def dive(sizes: np.ndarray, rest: np.ndarray, out: dict[tuple, int], capacity: int) -> None:
    """Adds whole fillings to out until nothing of rest is left."""
    here = [int(k) for k in np.flatnonzero(rest)[::-1]]  # largest first: small ones fit anywhere, so they are kept for later
    s, left = [int(sizes[k]) for k in here], [int(rest[k]) for k in here]
    while here:
        f = fullest(s, left, capacity, 0)
        times = min(left[i] // a for i, a in f.items())
        key = tuple(sorted((here[i], a) for i, a in f.items()))
        out[key] = out.get(key, 0) + times
        for i, a in f.items():
            left[i] -= a * times
        for i in sorted((i for i in f if left[i] == 0), reverse=True):
            del here[i], s[i], left[i]


class Deal:
    """Which container the item of a rank among its size's items goes to."""

    def __init__(self, fillings: list[tuple[dict[int, int], int]]) -> None:
        starts: dict[int, list[int]] = {}
        each: dict[int, list[int]] = {}
        base: dict[int, list[int]] = {}
        fill: dict[int, list[int]] = {}
        at: dict[int, int] = {}
        first = 0
        for f, times in fillings:
            used = sum(s * a for s, a in f.items())
            for s, a in f.items():
                starts.setdefault(s, []).append(at.get(s, 0))
                each.setdefault(s, []).append(a)
                base.setdefault(s, []).append(first)
                fill.setdefault(s, []).append(used)
                at[s] = at.get(s, 0) + a * times
            first += times
        self.containers = first
        self.tables = {s: tuple(np.array(x[s], dtype=np.int64) for x in (starts, each, base, fill)) for s in starts}


def packed(documents: DataFrame, jobs: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """(job_name, container_id, doc_id, piece, tokens, container_tokens, fill): every document in a container of each job.

    A document of more tokens than the capacity is cut into pieces of the capacity and a rest; all others have the one piece 0.
    Documents without tokens take no room; they stand in container 0. Jobs with a null name, or a capacity that is null or not positive,
    have no rows; of a job given several times the least capacity counts. doc_id is unique. All jobs, a small fixed list, are packed in one pass.
    """
    return _packed(documents, jobs, vocabulary)[0]


def _packed(documents: DataFrame, jobs: DataFrame, vocabulary: str) -> tuple[DataFrame, dict[str, Plan]]:
    spark = documents.sparkSession
    listed = jobs.where("job_name IS NOT NULL AND capacity_tokens > 0").groupBy("job_name").agg(F.min("capacity_tokens").cast("long").alias("capacity"))
    listed = sorted(map(tuple, listed.collect()))
    d = cut(tokens.with_tokens(documents.select("doc_id", "text"), vocabulary=vocabulary).select("doc_id", "tokens"))
    # full pieces fill a container each; what is left of a document is an item of less than the capacity, or of all of it
    # a row per job and document
    each = F.array(*[F.struct(F.lit(name).alias("job_name"), F.lit(capacity).cast("long").alias("capacity")) for name, capacity in listed or [("", 1)]])
    d = d.select("*", F.explode(each).alias("_job")).select("doc_id", "tokens", "_job.*").where(F.lit(bool(listed)))
    whole = F.floor((F.greatest(F.col("tokens"), F.lit(1)) - 1) / F.col("capacity")).cast("long")
    d = d.withColumn("_full", whole).withColumn("_rest", F.col("tokens") - F.col("_full") * F.col("capacity"))
    # at most capacity + 1 rows for each job
    histogram = d.groupBy("job_name", "capacity", "_rest").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[tuple[str, int], dict[int, int]] = {}
    for r in histogram:
        counts.setdefault((r["job_name"], r["capacity"]), {})[r["_rest"]] = r["n"]
    plans = {name: solve(c, capacity) for (name, capacity), c in counts.items()}
    deals = {name: Deal(plan.fillings) for name, plan in plans.items()}
    sent = spark.sparkContext.broadcast({name: deal.tables for name, deal in deals.items()})
    rows = max((r["n"] for r in histogram), default=0)
    items = tokens.running_sum(d, ["job_name", "_rest"], F.xxhash64("doc_id"), ["doc_id"], F.lit(1), rows, "_rank")

    def place(name: pd.Series, size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"container_id": np.zeros(len(size), dtype=np.int64), "container_tokens": np.zeros(len(size), dtype=np.int64)})
        for (job, one), at in size.groupby([name.to_numpy(), size.to_numpy()]).indices.items():
            if one > 0:
                starts, each, base, used = sent.value[job][int(one)]
                r = rank.to_numpy()[at]
                k = np.searchsorted(starts, r, side="right") - 1
                out.iloc[at, 0], out.iloc[at, 1] = base[k] + (r - starts[k]) // each[k], used[k]
        return out

    placed = items.withColumn("p", F.pandas_udf(place, "container_id long, container_tokens long")("job_name", "_rest", F.col("_rank").cast("long")))
    last = placed.select("job_name", "capacity", F.col("p.container_id").alias("container_id"), "doc_id", F.col("_full").cast("int").alias("piece"), F.col("_rest").alias("tokens"), F.col("p.container_tokens").alias("container_tokens"))
    # full pieces are numbered behind the shared containers, by the running sum of pieces in front of a document
    big = d.where("_full > 0")
    many = {r["job_name"]: r["n"] for r in big.groupBy("job_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    full = tokens.running_sum(big, ["job_name"], F.xxhash64("doc_id"), ["doc_id"], F.col("_full"), max(many.values(), default=0), "_first")
    full = full.select("job_name", "capacity", "doc_id", F.posexplode(F.sequence(F.col("_first"), F.col("_first") + F.col("_full") - 1)).alias("piece", "_at"))
    shared = spark.createDataFrame([(name, deal.containers) for name, deal in sorted(deals.items())], "job_name string, _shared long")
    full = full.join(F.broadcast(shared), "job_name")
    full = full.select("job_name", "capacity", (F.col("_at") + F.col("_shared")).cast("long").alias("container_id"), "doc_id", "piece", F.col("capacity").alias("tokens"), F.col("capacity").alias("container_tokens"))
    both = last.unionByName(full).withColumn("fill", F.col("container_tokens") / F.col("capacity"))
    return both.select("job_name", "container_id", "doc_id", "piece", "tokens", "container_tokens", "fill"), plans


def fills(documents: DataFrame, jobs: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """job_name, containers, least, program, rounded, documents, tokens, fill: of each job.

    least is the dual bound: no packing has fewer containers; program is the value of the solution of the linear program, rounded up, and rounded
    the share of the items that it places when it is rounded down. All three count the containers of full pieces.
    """
    p, plans = _packed(documents, jobs, vocabulary)
    boxes = p.groupBy("job_name", "container_id").agg(F.sum("tokens").alias("tokens"), F.sum(F.when(F.col("piece") == 0, 1).otherwise(0)).alias("documents"), F.max("container_tokens").alias("used"), F.max("fill").alias("fill"))
    # items of no size stand in containers 0, so a container may be one without tokens
    boxes = boxes.groupBy("job_name").agg(F.sum(F.when(F.col("used") > 0, 1).otherwise(0)).alias("containers"), F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"), F.max(F.round(F.col("used") / F.when(F.col("fill") > 0, F.col("fill")))).alias("capacity"))
    shared = [(name, sum(t for _, t in plan.fillings), plan.bound, plan.value, plan.rounded, sum(a * t for f, t in plan.fillings for a in f.values())) for name, plan in sorted(plans.items())]
    known = p.sparkSession.createDataFrame(shared, "job_name string, _shared long, _bound double, _value double, _placed long, _items long")
    b = boxes.join(F.broadcast(known), "job_name")
    full = F.col("containers") - F.col("_shared")
    up = lambda c: (full + F.ceil(F.round(F.col(c), 6))).cast("long")
    return b.select("job_name", "containers", up("_bound").alias("least"), up("_value").alias("program"), F.when(F.col("_items") > 0, F.col("_placed") / F.col("_items")).otherwise(1.0).alias("rounded"), "documents", "tokens", F.coalesce(F.col("tokens") / (F.col("containers") * F.col("capacity")), F.lit(0.0)).alias("fill"))


def faults(documents: DataFrame, jobs: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """job_name, documents, lost, twice, overfull, misstated, torn: how often a packing breaks its rules; all but documents are 0.

    Documents that are in no container, pieces that stand twice, containers of more tokens than the capacity or than they say, and documents
    that are cut though they fit a container.
    """
    p = _packed(documents, jobs, vocabulary)[0]
    listed = jobs.where("job_name IS NOT NULL AND capacity_tokens > 0").groupBy("job_name").agg(F.min("capacity_tokens").cast("long").alias("capacity"))
    p = cut(p.join(F.broadcast(listed), "job_name"))
    whole = tokens.with_tokens(documents.select("doc_id", "text"), vocabulary=vocabulary).select("doc_id", F.col("tokens").alias("whole"))
    docs = p.groupBy("job_name", "capacity", "doc_id").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"), F.countDistinct("piece").alias("distinct"))
    docs = docs.join(whole, "doc_id", "right")
    d = docs.groupBy("job_name").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.when(F.coalesce("tokens", F.lit(-1)) != F.col("whole"), 1).otherwise(0)).alias("lost"), F.sum(F.col("pieces") - F.col("distinct")).alias("twice"), F.sum(F.when((F.col("pieces") > 1) & (F.col("whole") <= F.col("capacity")), 1).otherwise(0)).alias("torn"))
    boxes = p.where("tokens > 0").groupBy("job_name", "capacity", "container_id").agg(F.sum("tokens").alias("tokens"), F.min("container_tokens").alias("least"), F.max("container_tokens").alias("most"))
    b = boxes.groupBy("job_name").agg(F.sum(F.when(F.col("tokens") > F.col("capacity"), 1).otherwise(0)).alias("overfull"), F.sum(F.when((F.col("least") != F.col("tokens")) | (F.col("most") != F.col("tokens")), 1).otherwise(0)).alias("misstated"))
    return d.join(b, "job_name", "left").fillna(0).select("job_name", "documents", "lost", "twice", "overfull", "misstated", "torn")
