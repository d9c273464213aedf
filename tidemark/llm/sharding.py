"""Shards of near equal bytes by sampled splitters.

Records are ordered by a key, the hash of their text and their id, so that equal texts are neighbours.
Keys are sampled with chances in proportion to size; quantiles of the sample split the key space into
many more ranges than there are shards. A hash that several splitters share has a range of its own,
and every range above the bytes a range may have is subdivided by a salt. Ranges' exact sizes, a small
table, then place each record on one line of bytes: its shard is where it falls, its slot the number of
records before it in the shard. Only ids, hashes and sizes are shuffled, never texts; one task sorts no
more than one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shared_checkpoint

#: Keys sampled for each range, as expected; least and most ranges; records of a range, as expected.
KEYS_PER_RANGE, LEAST_RANGES, MOST_RANGES, RANGE_ROWS = 16, 64, 4096, 500_000

#: A range above this many times the mean is subdivided. Equal texts within one part of a range stay in
#: one shard up to this share of a shard's bytes.
OVERFULL, GROUP_SHARE = 2.0, 1 / 32


def record_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, size (UTF-8 bytes and one), crc32 of the text, hash of the text, and a salt."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("crc"),
        F.xxhash64(body).alias("hash"),
        # Rows alike in every column differ in their place in the input.
        F.xxhash64(F.col(id_col).cast("string"), F.monotonically_increasing_id()).alias("salt"),
    )


def splitters(records: DataFrame, total_bytes: int, ranges: int) -> tuple[list[int], list[int]]:
    """Upper bounds of hash ranges, and the hashes that two bounds or more fall on."""
    wanted = ranges * KEYS_PER_RANGE
    chance = F.col("size") * F.lit(wanted / max(1, total_bytes))
    uniform = F.pmod(F.xxhash64("salt", F.lit(4)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A record above the step counts as often as its size has steps, so weights stay in proportion.
    sample = records.where(uniform < chance).select("hash", F.greatest(F.lit(1.0), chance).alias("weight"))
    order = Window.orderBy("hash")
    heavy = sample.groupBy("hash").agg(F.sum("weight").alias("weight"))
    lined = heavy.select("hash", "weight", F.sum("weight").over(order).alias("upto"), F.sum("weight").over(Window.partitionBy()).alias("all"))
    step = F.col("all") / F.lit(float(ranges))
    first, last = F.floor((F.col("upto") - F.col("weight")) / step), F.floor(F.col("upto") / step)
    rows = lined.where(first < last).select("hash", (last - first).cast("long").alias("n")).orderBy("hash").collect()
    return [r["hash"] for r in rows], [r["hash"] for r in rows if r["n"] > 1]


def range_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds below the key, in two steps over literals of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    tops = F.array(*(F.lit(g[-1]) for g in groups[:-1])) if len(groups) > 1 else F.array().cast("array<bigint>")
    coarse = F.size(F.filter(tops, lambda b: b < key))
    rows = F.array(*(F.array(*map(F.lit, g)) for g in groups))
    return coarse * width + F.size(F.filter(F.element_at(rows, coarse + 1), lambda b: b < key))


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: id, `size`, `text_crc32`, `shard` and `slot` (from 0, without gaps in each shard).

    Shards follow the order of keys and differ in bytes by one record, or by one group of equal texts
    of GROUP_SHARE of a shard, at most. Larger groups are split where the bytes demand. Null texts are empty ones of
    size 1; null ids and repeated rows are records like others. With fewer records than shards some
    shards have none; an empty table gives an empty result. Other columns are not read.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    records = record_keys(docs, id_col, text_col)
    sums = records.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
    ranges = min(MOST_RANGES, max(LEAST_RANGES, shards, sums["n"] // RANGE_ROWS))
    bounds, hot = splitters(records, sums["b"], ranges)
    most = OVERFULL * sums["b"] / ranges
    # A hot hash takes an odd place of its own between the ranges below and above it.
    is_hot = F.col("hash").isin(hot) if hot else F.lit(False)
    keyed = records.withColumn("place", range_of(F.col("hash"), bounds) * 2 + is_hot.cast("int"))
    loads = keyed.groupBy("place").agg(F.sum("size").alias("load"))
    parts = F.broadcast(loads.select("place", F.ceil(F.col("load") / F.lit(max(1.0, most))).cast("long").alias("parts")))  # two rows a range, at most
    whole = keyed.join(parts, "place").withColumn("hot", is_hot)
    part = whole.withColumn("part", F.pmod(F.when(F.col("hot"), F.col("salt")).otherwise(F.xxhash64("hash")), F.col("parts")))
    part = part.withColumn("sort_hash", F.col("hash")).drop("parts", "hot")
    spots = shared_checkpoint(part)
    per_part = spots.groupBy("place", "part").agg(F.sum("size").alias("load"), F.count("*").alias("rows"))
    line = Window.orderBy("place", "part")
    starts = per_part.select("place", "part", (F.sum("load").over(line) - F.col("load")).alias("bytes_before"), (F.sum("rows").over(line) - F.col("rows")).alias("rows_before"))
    within = Window.partitionBy("place", "part").orderBy("sort_hash", F.col("id").asc_nulls_first(), "salt")
    group = Window.partitionBy("place", "part", "sort_hash")
    lined = (
        spots.join(F.broadcast(starts), ["place", "part"])
        .withColumn("upto", F.col("bytes_before") + F.sum("size").over(within))
        .withColumn("row", F.col("rows_before") + F.row_number().over(within) - 1)
        .withColumn("group_first", F.min(F.col("upto") - F.col("size")).over(group))
        .withColumn("group_last", F.max("upto").over(group))
    )
    share = F.lit(max(1.0, sums["b"] / shards))
    small = F.col("group_last") - F.col("group_first") <= share * F.lit(GROUP_SHARE)
    middle = F.when(small, (F.col("group_first") + F.col("group_last")) / 2).otherwise(F.col("upto") - F.col("size") / 2)
    placed = shared_checkpoint(lined.select("id", "size", "crc", "row", F.least(F.lit(shards - 1), F.floor(middle / share)).cast("int").alias("shard")))
    begins = F.broadcast(placed.groupBy("shard").agg(F.min("row").alias("begin")))  # a row a shard
    return placed.join(begins, "shard").select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("begin")).alias("slot"))
