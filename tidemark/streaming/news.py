"""Structured Streaming forms of the incremental jobs; each equals its batch twin on a finished input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import normalize_url
from tidemark.sources.sinks import upsert


def event_stream(spark: SparkSession, folder: str, file: str) -> DataFrame:
    """A file stream over the Parquet files of one name in a folder."""
    schema = spark.read.parquet(f"{folder}/{file}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)


def dedup_articles(stream: DataFrame, at: str, delay: str = "2 days") -> DataFrame:
    """STM1: the first article of each normalised URL within the watermark."""
    return stream.withColumn("url_norm", normalize_url(F.col("url"))).withWatermark(at, delay).dropDuplicatesWithinWatermark(["url_norm"])


def daily_counts(stream: DataFrame, at: str, key: str, delay: str = "1 day") -> DataFrame:
    """STM2: rows of each key and day; days end when the watermark passes them."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, "1 day"), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), key, "n")


def rolling_mean(stream: DataFrame, at: str, key: str, value: str, delay: str = "1 day") -> DataFrame:
    """STM3: mean of each key in the last 24 hours, each hour.

    Rows are summed by hour first, and the overlapping windows take these sums: no row is copied for each window, and
    the state is an hour's sum and a window's for each key that the watermark hasn't passed. A window without any
    value has a null mean.
    """
    hours = stream.withWatermark(at, delay).groupBy(F.window(at, "1 hour"), key).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    windows = hours.groupBy(F.window(F.window_time("window"), "24 hours", "1 hour"), key)
    mean = F.try_divide(F.sum("_sum"), F.sum("_n"))
    return windows.agg(mean.alias("mood")).select(F.col("window.end").alias("until"), key, "mood")


def alerts(stream: DataFrame, score: str, least: float) -> DataFrame:
    """STM4: stateless filter."""
    return stream.where(F.col(score) >= least)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there now and returns what it wrote."""
    spark = stream.sparkSession
    query = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """STM4, STM5: hands each micro-batch and its id to `each`, which must give the same result for the same id again."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_into(path: str, key: list[str], partition: str, cut: Callable[[DataFrame], DataFrame], run: int | None = None) -> Callable[[DataFrame, int], None]:
    """STM5: a batch writer that upserts into a table partitioned by one of its keys. A batch reads and rewrites the
    partitions that it touches and no others; what is stored there stays unless the batch has its key.

    The table may be filled before the stream begins. A row's `ingest_seq` is its run's number, then its batch's (32 bits), so
    a batch that is repeated in a run gives the same table. `run` is by default one more than the highest that is stored when
    the writer's first batch comes: a new checkpoint over an old table, or a second stream, is newer than what it finds.
    `cut` writes what a batch makes to the shared checkpoint folder before partitions are overwritten."""
    runs: list[int] = [] if run is None else [run]

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema) + ", ingest_seq long"
        table = spark.read.schema(columns).parquet(path) if there else None
        if not runs:
            last = None if table is None else table.agg(F.max("ingest_seq")).first()[0]
            runs.append(0 if last is None else (last >> 32) + 1)
        rows = batch.withColumn("ingest_seq", F.lit((runs[0] << 32) + n).cast("long"))
        stored = rows.limit(0) if table is None else table.join(rows.select(partition).distinct(), partition, "left_semi").select(*rows.columns)
        done = cut(upsert(stored, rows, key))
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    return write
