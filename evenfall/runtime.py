"""Session, table access and the few physical helpers that all operators share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many rows may be broadcast; the rows that are sent are narrow (ids, cells, keys).
BROADCAST_ROWS = 200_000
#: A key that holds more than this share of the rows is split over several tasks.
HOT_SHARE = 1 / 500
#: Parts that a hot key is split into.
HOT_PARTS = 32


def session(app: str = "evenfall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators assume (UTC, adaptive execution)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the one that spark.checkpoint.dir names. Without it there is none on a cluster; where all runs on
    one machine in one process, as in tests, a temporary one serves."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return tempfile.mkdtemp(prefix="evenfall-")


def spread(df: DataFrame) -> DataFrame:
    """A scan that comes in fewer partitions than there are cores is dealt out to all of them, for work that costs more than moving its rows.

    Large inputs come in more partitions and stay as they are, and so do plans with a shuffle, which can't be counted without a run.
    """
    plan = df._jdf.queryExecution()
    if plan.executedPlan().toString().startswith("AdaptiveSparkPlan"):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if plan.toRdd().getNumPartitions() < cores else df


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; reads no more than it must."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", *, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join for a right side that is small or not, and a left side that may have hot keys.

    The right side is broadcast if a count shows it has at most `rows` rows. Otherwise both sides are shuffled; keys that hold
    more than HOT_SHARE of the left rows are split into HOT_PARTS parts, for which the right rows of those keys are copied.
    At most 1 / HOT_SHARE keys can be that hot, so the list of hot keys is bounded whatever the input. The part comes from the
    row's own values, so a task that runs again makes the same parts. Null keys never join.
    how: inner or left.
    """
    keys = list(keys)
    if at_most(right, rows):
        return left.join(F.broadcast(right), keys, how)
    key = F.xxhash64(*keys)
    counts = left.groupBy(key.alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = [r["_h"] for r in counts.where(F.col("_n") > F.lit(max(total * HOT_SHARE, 10_000))).select("_h").collect()]
    if not hot:
        return left.join(right, keys, how)
    is_hot = key.isin(hot)
    part = F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(HOT_PARTS)).cast("int")).otherwise(F.lit(0))
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("_part", part).join(right.withColumn("_part", F.explode(parts)), [*keys, "_part"], how).drop("_part")
