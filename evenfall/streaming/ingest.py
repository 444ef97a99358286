"""The same event tables as streams: late rows, duplicates, windows and upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Rows may be so late; after that a page's memory is dropped.
LATENESS = "7 days"


def read(spark: SparkSession, path: str, schema, files: int = 10) -> DataFrame:
    """A folder of parquet files, or a single one, as a stream; crawled_at is event time, in UTC."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    single = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile()
    folder, names = (path.rpartition("/")[0], path.rpartition("/")[2]) if single else (path, "*.parquet")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", names).parquet(folder)
    return stream.withColumn("crawled_at", F.col("crawled_at").cast("timestamp"))


def first_of_each(events: DataFrame) -> DataFrame:
    """The first delivery of each fingerprint of a source within LATENESS; state is dropped behind the watermark."""
    return events.where("fingerprint IS NOT NULL").withWatermark("crawled_at", LATENESS).dropDuplicatesWithinWatermark(["source_id", "fingerprint"])


def per_window(events: DataFrame, size: str = "1 day", slide: str | None = None) -> DataFrame:
    """Rows and distinct sources (about) per window of event time, final once the watermark has passed it."""
    w = F.window("crawled_at", size, slide) if slide else F.window("crawled_at", size)
    return events.withWatermark("crawled_at", LATENESS).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("events"), F.approx_count_distinct("source_id").alias("sources")).select(F.col("w.start").alias("window_start"), "events", "sources")


def per_session(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Crawl sessions: a source's rows without a pause longer than gap."""
    return events.withWatermark("crawled_at", LATENESS).groupBy("source_id", F.session_window("crawled_at", gap).alias("w")).agg(F.count(F.lit(1)).alias("events")).select("source_id", F.col("w.start").alias("session_start"), "events")


#: So many batches are put together to a new base.
COMPACT = 8


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished parts n=… of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = lambda p: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted(int(f.getPath().getName()[2:]) for f in fs.listStatus(path) if f.getPath().getName().startswith("n=") and done(f.getPath()))


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _last(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")


def _upto(spark: SparkSession, path: str, most: int) -> DataFrame | None:
    """The newest base that is not beyond a batch, and the batches behind it up to that one."""
    base = max((n for n in _numbers(spark, f"{path}/base") if n <= most), default=-1)
    parts = [f"{path}/base/n={base}"] if base >= 0 else []
    parts += [f"{path}/batch/n={n}" for n in _numbers(spark, f"{path}/batch") if base < n <= most]
    return spark.read.parquet(*parts) if parts else None


def upserted(spark: SparkSession, path: str, key: str = "fingerprint", order: tuple[str, ...] = ("crawled_at", "event_id")) -> DataFrame:
    """The table that upsert_to keeps under path: the last row of each key."""
    rows = _upto(spark, path, 1 << 62)
    if rows is None:
        raise ValueError(f"no table under {path}")
    return _last(rows, key, order)


def upsert_to(path: str, key: str = "fingerprint", order: tuple[str, ...] = ("crawled_at", "event_id"), compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: keeps the last row of each key by order, however late it comes, in a table under path (see upserted).

    A batch writes its own last rows only. Every compact batches they are put over the base, and what the base before that was made of
    is removed; so a row is written again once in compact batches, and a batch that runs again gives the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _last(batch, key, order).write.mode("overwrite").parquet(f"{path}/batch/n={batch_id}")
        if (batch_id + 1) % compact:
            return
        before = max((n for n in _numbers(spark, f"{path}/base") if n < batch_id), default=-1)
        parts = [f"{path}/base/n={before}"] if before >= 0 else []
        parts += [f"{path}/batch/n={n}" for n in _numbers(spark, f"{path}/batch") if before < n <= batch_id]
        _last(spark.read.parquet(*parts), key, order).write.mode("overwrite").parquet(f"{path}/base/n={batch_id}")
        for n in _numbers(spark, f"{path}/base"):
            if n < before:
                _drop(spark, f"{path}/base/n={n}")
        for n in _numbers(spark, f"{path}/batch"):
            if n <= before:
                _drop(spark, f"{path}/batch/n={n}")

    return write


def run(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that is there now, written as parquet to sink; exactly once across restarts with the same checkpoint."""
    return stream.writeStream.outputMode(mode).format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_upsert(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(upsert_to(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
