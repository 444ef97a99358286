"""Mixing sources to target weights.

A mix is as large as its targets and repeat limits allow: the source that runs out first, used as often as it may be, sets the total,
and every source gets its share of it as a budget in tokens. Within a source, documents are sorted by a hash-random key; prefix sums of
their tokens tell where the budget is used up. Whole epochs come first; the rest of the budget is cut at the document whose end
is nearest to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.llm import tokens
from evenfall.runtime import cut


def budgets(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """mix_name, source, target_share, max_repeats, have, budget, epochs, rest: tokens that a source has and has to give.

    sizes: source, have. A source that has no tokens, a target share or a repeat limit of 0 or null can give nothing and doesn't
    limit the mix; its budget is 0, and the others keep their proportions.
    """
    t = targets.where("mix_name IS NOT NULL AND source IS NOT NULL").groupBy("mix_name", "source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = t.join(sizes, "source", "left").withColumn("have", F.coalesce("have", F.lit(0)).cast("long"))
    able = (F.col("have") > 0) & (F.coalesce("target_share", F.lit(0.0)) > 0) & (F.coalesce("max_repeats", F.lit(0)) > 0)
    t = t.withColumn("able", able)
    total = t.where("able").groupBy("mix_name").agg(F.min(F.col("have") * F.col("max_repeats") / F.col("target_share")).alias("total"))
    t = t.join(total, "mix_name", "left").withColumn("budget", F.when(F.col("able"), F.least(F.round(F.col("total") * F.col("target_share")).cast("long"), F.col("have") * F.col("max_repeats"))).otherwise(F.lit(0)).cast("long"))
    return t.withColumn("epochs", F.when(F.col("have") > 0, F.floor(F.col("budget") / F.col("have"))).otherwise(0).cast("long")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("have")).drop("able", "total")


def copies(documents: DataFrame, targets: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """(mix_name, source, doc_id, tokens, copies): how often each mix uses a document; documents that it doesn't use have no row.

    Documents with a null source belong to no mix. Documents without a token count for nothing and come along only in whole epochs.
    doc_id is unique. targets is a small fixed list (a row per mix and source).
    """
    d = tokens.with_tokens(documents.where("source IS NOT NULL").select("doc_id", "source", "text"), vocabulary=vocabulary).select("doc_id", "source", "tokens")
    d = cut(d)
    sizes = d.groupBy("source").agg(F.sum("tokens").alias("have"), F.count(F.lit(1)).alias("docs"))
    plan = cut(budgets(sizes.drop("docs"), targets))
    rows = sizes.agg(F.max("docs")).first()[0] or 0
    # the plan has a row per mix and source, so it is as small as targets
    drawn = d.join(F.broadcast(plan.where("budget > 0").select("mix_name", "source", "epochs", "rest")), "source")
    drawn = tokens.running_sum(drawn, ["mix_name", "source"], F.xxhash64("mix_name", "doc_id"), ["doc_id"], F.col("tokens"), rows)
    extra = (F.col("rest") > F.col("before")) & (F.col("before") + F.col("tokens") - F.col("rest") <= F.col("rest") - F.col("before"))
    out = drawn.withColumn("copies", (F.col("epochs") + F.when(extra, 1).otherwise(0)).cast("int"))
    return out.where("copies > 0").select("mix_name", "source", "doc_id", "tokens", "copies")


def shares(documents: DataFrame, targets: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """mix_name, source, target_share, actual_share, tokens, documents, copies, most_repeats: a row for every target, drawn from or not."""
    c = copies(documents, targets, vocabulary).groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.sum("copies").cast("long").alias("copies"), F.max("copies").alias("most_repeats"))
    all_ = c.groupBy("mix_name").agg(F.sum("tokens").alias("_all"))
    t = targets.where("mix_name IS NOT NULL AND source IS NOT NULL").groupBy("mix_name", "source").agg(F.sum("target_share").alias("target_share"))
    out = t.join(c, ["mix_name", "source"], "left").join(all_, "mix_name", "left").fillna(0, ["tokens", "documents", "copies", "most_repeats"])
    share = F.when(F.col("_all") > 0, F.col("tokens") / F.col("_all")).otherwise(F.lit(0.0))
    return out.select("mix_name", "source", "target_share", share.alias("actual_share"), "tokens", "documents", "copies", "most_repeats")
