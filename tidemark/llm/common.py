"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a Python worker handles at once.
SLICE_BYTES = 1 << 19

#: Rows of an Arrow batch; texts may be long, so it is below Spark's default.
ARROW_ROWS = 500


def tuned(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches for columns of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id's text modulo `modulus`; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; a local one only where it is unset and the master is local."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return sc.getCheckpointDir()


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def freed(spark: SparkSession) -> None:
    """Has garbage collected, upon which Spark deletes the shuffle files and checkpoints of tables that nothing refers to any
    more; else they stay until the driver happens to collect, which large inputs don't bring about sooner. Takes a second, in
    which Python's bridge to the driver's JVM lets go of what Python has dropped, and two collections, as some of what the
    first one clears refers to more."""
    gc.collect()
    time.sleep(1.2)
    for _ in range(2):
        spark._jvm.System.gc()
        time.sleep(0.3)


def skew_join(left: DataFrame, right: DataFrame, key: str, hot_parts: int = 1000, keys: DataFrame | None = None, few: int = 100_000) -> DataFrame:
    """Inner join with `right`, which has one row or few for each key. Keys with more than a `hot_parts`-th of
    the left rows, fewer than `hot_parts` keys therefore, are joined by broadcast and shuffle no left rows. `keys` has the
    left's keys, as often as they occur there, if they are cheaper to count elsewhere. Up to `few` left rows, of which any
    number may have one key, the join is a plain one."""
    counts = (left if keys is None else keys).groupBy(key).agg(F.count("*").alias("__n"))
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")).first()["n"]
    if total <= few:
        return left.join(right, key)
    hot = F.broadcast(counts.where(F.col("__n") > max(100, total // hot_parts)).select(key))
    return left.join(hot, key, "left_anti").join(right, key).unionByName(left.join(F.broadcast(right.join(hot, key)), key))


def maybe_among(df: DataFrame, hash_: Column, hashes: DataFrame, bits: int = 22) -> DataFrame:
    """`df` with `__maybe`: false only where the hash (long) isn't in the one column of `hashes`. Decided by a
    bitmap of 2**bits bits, broadcast as a table of 2**(bits - 6) rows at most, so no row is shuffled."""
    word, bit = F.shiftrightunsigned("__h", 64 - bits + 6).cast("int"), F.shiftrightunsigned("__h", 64 - bits).bitwiseAND(63).cast("int")
    marks = hashes.toDF("__h").groupBy(word.alias("__word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("__bits"))
    read = df.withColumn("__h", hash_).withColumn("__word", word).join(F.broadcast(marks), "__word", "left")
    return read.withColumn("__maybe", F.coalesce(F.call_function("shiftrightunsigned", F.col("__bits"), bit).bitwiseAND(1) == 1, F.lit(False))).drop("__h", "__word", "__bits")


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `limit` bytes, one row at least."""
    lo, total = 0, 0
    for hi, size in enumerate(sizes.tolist()):
        if hi > lo and total + size > limit:
            yield lo, hi
            lo, total = hi, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def map_texts(
    df: DataFrame,
    keep: list[str],
    text_col: str,
    fields: list[T.StructField],
    start: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """The columns `keep`, then `fields`, made by Python workers from slices of texts in UTF-8.

    `start` runs once for each task and returns the function that turns a slice of texts, in which
    None stands for null, into one Arrow array for each of `fields`; of any length, if nothing is kept.
    """
    picked = df.select(*keep, F.col(text_col).cast("string").cast("binary").alias("__text"))
    schema = T.StructType([*(picked.schema[c] for c in keep), *fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            texts = batch.column(len(keep))
            sizes = np.array([0 if n is None else n for n in pa.compute.binary_length(texts).to_pylist()], dtype=np.int64)
            for lo, hi in slices(sizes, limit):
                made = work(texts.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[: len(keep)]), *made], names=names)
            pa.default_memory_pool().release_unused()

    import pyarrow.compute  # noqa: F401  binds pa.compute for the workers

    return picked.mapInArrow(run, schema)


def pieces(body: bytes, size: int = 1 << 20, at: bytes = b" ") -> Iterator[bytes]:
    """Parts of about `size` bytes that end before an `at`, so that a very long text needs memory for one part at a time."""
    lo = 0
    while len(body) - lo > size:
        hi = body.find(at, lo + size)
        if hi < 0:
            break
        yield body[lo:hi]
        lo = hi
    yield body[lo:]


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """`df` with the 1-based place of each row in `order`, which no two rows share. Sorted by range, so that no task holds
    more than its range; the sizes of the ranges, a row a partition, place them."""
    placed = shared_checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__at", 33).cast("int")
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).orderBy("__part").collect()  # a row a partition
    before, starts = 0, {}
    for r in sizes:
        starts[r["__part"]] = before
        before += r["n"]
    if not starts:
        return placed.withColumn(name, F.col("__at")).drop("__at")
    offsets = df.sparkSession.createDataFrame(list(starts.items()), "__part int, __before long")
    at = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(name, at).drop("__part", "__before", "__at")
