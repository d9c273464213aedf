"""Bloom filters stored beside the day partitions of a table of articles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import normalize_url
from tidemark.sources.sinks import new_articles

#: Bits of a filter for each key, and bits that a key sets, all in one word of 64.
BITS_PER_KEY, BITS_SET = 32, 6
#: Words of the smallest filter, as a power of two. Words without bits aren't stored.
LEAST_SIZE = 16


def mask(key: str) -> Column:
    """The bits that a key sets in its word."""
    bits = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(_hash, {6 * i}) & 63 AS INT))" for i in range(BITS_SET))
    return F.expr(bits.replace("_hash", f"xxhash64(`{key}`, 1)"))


def word(key: str, size: Column) -> Column:
    """The number of a key's word in a filter of 2 ** size words."""
    return F.xxhash64(key).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), size.cast("int")) - 1)


def day_filters(keys: DataFrame, key: str, day: str) -> DataFrame:
    """A filter for each day: its stored words as rows. A filter's size follows the day's keys."""
    counts = keys.groupBy(day).agg(F.count("*").alias("_n"))
    size = F.greatest(F.lit(LEAST_SIZE), F.ceil(F.log2(F.col("_n") * BITS_PER_KEY / 64)).cast("int"))
    sized = keys.select(day, key).join(counts.select(day, size.alias("size")), day)
    return sized.groupBy(day, "size", word(key, F.col("size")).alias("word")).agg(F.bit_or(mask(key)).alias("bits"))


def days_that_may_hold(filters: DataFrame, keys: DataFrame, key: str, day: str) -> list:
    """Days whose filters have all bits of any of the keys: every day that holds one, and few others.

    The list is bounded by the table's day partitions. Words and keys meet in a join on the word, so a filter is never
    whole in one place. A day is met by chance at one key in 2,000 to 20,000, so large batches read more days.
    """
    sizes = [r["size"] for r in filters.select("size").distinct().collect()]
    asked = keys.select(key).distinct().select(key, mask(key).alias("_mask"), F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("size"))
    asked = asked.select("size", word(key, F.col("size")).alias("word"), "_mask").distinct()
    held = filters.join(asked, ["size", "word"]).where(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
    return [r[0] for r in held.select(day).distinct().collect()]


def there(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds rows that were written whole."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def append_articles(batch: DataFrame, path: str, day: str, order: list[Column], cut: Callable[[DataFrame], DataFrame], ignore_scheme: bool = False) -> DataFrame:
    """SNK5 as a sink: appends articles whose normalised URL isn't stored to the day partitions of `path`; returns them.

    Filters lie in `path` + "-filters", partitioned by day; each batch adds one a day that it writes. They are written before
    the articles, so a run that dies between leaves a filter that claims too much, never one that claims too little. A
    stored table without filters gets them first. The stored keys of the days that the filters name are read, and no
    others; these decide exactly. Articles with a null URL are never held to be stored; the first of a batch is kept.
    An article whose day is null is stored in the partition of null and found there. One writer at a time, and all of
    them by this function. `cut` writes rows to a shared folder and reads them again.
    """
    spark, at = batch.sparkSession, path + "-filters"
    found = normalize_url(F.col("url"), ignore_scheme)
    keyed = lambda df: df.select(day, F.coalesce(found, F.lit("")).alias("_url"))
    # Days are text in filters, and null is a day.
    named = lambda df: keyed(df).withColumn(day, F.coalesce(F.col(day).cast("string"), F.lit("none")))
    put = lambda df: day_filters(named(df), "_url", day).write.mode("append").partitionBy(day).parquet(at)
    stored = spark.read.schema(batch.select(day, "url").schema).parquet(path) if there(spark, path) else None
    if stored is not None:
        if not there(spark, f"{at}/_SUCCESS"):
            put(stored)
        filters = spark.read.schema(f"size int, word long, bits long, `{day}` string").parquet(at)
        days = days_that_may_hold(filters, keyed(batch), "_url", day)
        stored = stored.where(F.coalesce(F.col(day).cast("string"), F.lit("none")).isin(days))
    fresh = cut(new_articles(batch, batch.limit(0) if stored is None else stored, order, ignore_scheme))
    put(fresh)
    fresh.write.mode("append").partitionBy(day).parquet(path)
    return fresh
