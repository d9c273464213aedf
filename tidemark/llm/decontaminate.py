"""Benchmark decontamination by winnowing.

Texts are cut into words. Of every `w` consecutive k-grams, k + w - 1 = `span`, the least hash is
kept (of equal ones the last), so any shared run of `span` words has a common fingerprint. Items
shorter than `span` are one window of their own length m: k = m, w = 1. Fingerprints of documents pass
a bitmap of the items' fingerprints, which has a fixed size, and are joined with the items'; each hit is
extended over the words around it, and counts if the equal run reaches the window's length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_texts, shared_checkpoint, skew_join

#: Words of a window, words of a k-gram, and bits of the bitmap's address.
SPAN, GRAM, ADDRESS_BITS = 10, 5, 22

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of other characters, and makes the rest a space.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(0x100000001B3)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_TABLE).split()


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive word codes; k is part of it."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k, np.uint64) * MIX
    for i in range(k):
        h = (h ^ codes[i : i + n]) * FOLD
        h ^= h >> np.uint64(29)
    h *= MIX
    return h ^ (h >> np.uint64(32))


def is_kept(h: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, w: int) -> np.ndarray:
    """Whether the hash at each place is the last least one of some window of w among places lo..hi-1."""
    left = np.zeros(len(at), np.int64)
    right = np.zeros(len(at), np.int64)
    go_left = np.ones(len(at), bool)
    go_right = go_left.copy()
    for i in range(1, w):
        p = at - i
        go_left &= (p >= lo) & (h[np.maximum(p, 0)] >= h[at])
        left += go_left
        p = at + i
        go_right &= (p < hi) & (h[np.minimum(p, len(h) - 1)] > h[at])
        right += go_right
    return left + right + 1 >= w


def windows(texts: list[bytes | None], spans: list[tuple[int, int]], bitmap: np.ndarray | None = None, exact: bool = False):
    """The number of words of each text, and of each kept fingerprint: text number, span, hash, place,
    and the words around it (before; from it on) that a window may reach.

    spans: (length, k). exact: a span below the longest holds for texts of just that length.
    """
    split = [words_of(t) for t in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    codes = np.fromiter((zlib.crc32(x) for part in split for x in part), np.uint64, total)
    found = []
    longest = max(s for s, _ in spans)
    for span, k in spans:
        h = gram_hashes(codes, k)
        if not len(h):
            continue
        if bitmap is None:
            at = np.arange(len(h))
        else:
            address = h >> np.uint64(64 - ADDRESS_BITS)
            at = np.flatnonzero((bitmap[(address >> np.uint64(6)).astype(np.int64)] >> (address & np.uint64(63))) & np.uint64(1))
        owner = np.searchsorted(ends, at, side="right")
        lo, hi = ends[owner] - sizes[owner], ends[owner] - k + 1
        ok = (at < hi) & (sizes[owner] >= span)
        if exact and span < longest:
            ok &= sizes[owner] == span
        at, owner, lo, hi = at[ok], owner[ok], lo[ok], hi[ok]
        kept = is_kept(h, at, lo, hi, span - k + 1)
        for a, o in zip(at[kept].tolist(), owner[kept].tolist(), strict=True):
            place = a - int(ends[o] - sizes[o])
            part = split[o]
            found.append((o, span, int(h[a].astype(np.int64)), place, b" ".join(part[max(0, place - span + k) : place]), b" ".join(part[place : place + span])))
    return sizes, found


FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("span", T.IntegerType()),
            T.StructField("print", T.LongType()),
            T.StructField("place", T.LongType()),
            T.StructField("before", T.BinaryType()),
            T.StructField("onward", T.BinaryType()),
        ]
    )
)
FOUND_ARROW = pa.list_(pa.struct([("span", pa.int32()), ("print", pa.int64()), ("place", pa.int64()), ("before", pa.binary()), ("onward", pa.binary())]))


def fingerprints(df: DataFrame, keep: list[str], text_col: str, spans: list[tuple[int, int]], bitmap=None, exact: bool = False) -> DataFrame:
    """The columns `keep`, `n_words` and `found`, the kept fingerprints of each text."""

    def start():
        bits = None if bitmap is None else bitmap.value

        def work(texts):
            sizes, found = windows(texts, spans, bits, exact)
            rows: list[list] = [[] for _ in texts]
            for o, span, h, place, before, onward in found:
                rows[o].append({"span": span, "print": h, "place": place, "before": before, "onward": onward})
            return [pa.array(sizes), pa.array(rows, FOUND_ARROW)]

        return work

    return map_texts(df, keep, text_col, [T.StructField("n_words", T.LongType()), T.StructField("found", FOUND)], start, limit=2 << 20)


def extended(joined: DataFrame) -> DataFrame:
    """Rows whose equal run of words around the common k-gram reaches the window's length: row,
    context, and the run's first place `a` and the place `b` behind it in the document."""
    schema = T.StructType([joined.schema["row"], joined.schema["context"], T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    picked = joined.select("row", "context", "span", "place", "before", "onward", "item_before", "item_onward")

    def equal(x: list[bytes], y: list[bytes]) -> int:
        n = 0
        for p, q in zip(x, y, strict=False):
            if p != q:
                break
            n += 1
        return n

    def run(batches):
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for row, context, span, place, before, onward, item_before, item_onward in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                back = equal(before.split()[::-1], item_before.split()[::-1])
                ahead = equal(onward.split(), item_onward.split())
                if ahead and back + ahead >= span:
                    for column, x in zip(out, (row, context, place - back, place + ahead), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=schema.names)

    return picked.mapInArrow(run, schema)


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN, gram: int = GRAM
) -> DataFrame:
    """One row for each row of `docs`: its id, `n_words`, `n_hit` (words inside windows of items),
    `item_ids` (sorted as strings; items with windows that occur) and `spans` (sorted runs [a, b) of
    words that windows cover; they may overlap).

    A window is `span` consecutive words of an item, or a shorter item as a whole. Null and empty texts
    and items without words have no windows; null item ids are not listed. Very long texts count whole. Repeated
    rows, ids and items stay apart or fall together by these rules; of equal least hashes of a window the last
    counts. An empty table on either side gives no hits. Columns other than those named are not read.
    """
    spark = docs.sparkSession
    bench = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("body"))
    spans = [(span, min(gram, span)), *((m, m) for m in range(1, span))]
    kept = fingerprints(bench, ["item"], "body", spans, exact=True).select("item", F.explode("found").alias("f")).select("item", "f.*")
    kept = shared_checkpoint(kept.select("item", "span", "print", F.col("before").alias("item_before"), F.col("onward").alias("item_onward")).distinct())
    # The context's key: equal contexts of many items are compared once.
    kept = kept.withColumn("context", F.xxhash64("span", "print", "item_before", "item_onward"))
    contexts = kept.select("span", "print", "context", "item_before", "item_onward").distinct()
    members = kept.where("item IS NOT NULL").select("context", "item").distinct()
    address = F.shiftrightunsigned("print", 64 - ADDRESS_BITS)
    marks = kept.select("print").distinct().groupBy(F.shiftright(address, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(print, {64 - ADDRESS_BITS}) & 63 as int))")).alias("bits"))
    bitmap = np.zeros(1 << (ADDRESS_BITS - 6), np.uint64)
    for r in marks.toLocalIterator():  # as many rows as the bitmap has words, at most
        bitmap[r["at"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    lengths = {r["span"] for r in kept.select("span").distinct().collect()}  # `span` values at most
    used = [s for s in spans if s[0] in lengths] or spans[:1]
    shared = spark.sparkContext.broadcast(bitmap)
    numbered = docs.select(id_col, F.col(text_col).alias("__body")).withColumn("row", F.monotonically_increasing_id())
    read = shared_checkpoint(fingerprints(numbered, ["row", id_col], "__body", used, shared))
    hits = read.select("row", F.explode("found").alias("f")).select("row", "f.*")
    # A fingerprint that many documents have is joined by broadcast of its contexts.
    key = F.struct("span", "print").alias("key")
    met = skew_join(hits.select("row", key, "place", "before", "onward"), contexts.select(key, "context", "item_before", "item_onward"), "key")
    runs = shared_checkpoint(extended(met.withColumn("span", F.col("key.span"))).distinct())
    covered = runs.select("row", F.struct("a", "b").alias("run")).groupBy("row").agg(F.sort_array(F.collect_set("run")).alias("spans"))
    named = runs.select("row", "context").distinct().join(members, "context").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    union = F.expr(
        "aggregate(spans, named_struct('last', 0L, 'n', 0L), (acc, x) -> named_struct("
        "'last', greatest(acc.last, x.b), 'n', acc.n + greatest(0L, x.b - greatest(acc.last, x.a))), acc -> acc.n)"
    )
    out = read.select("row", id_col, "n_words").join(covered, "row", "left").join(named, "row", "left")
    return out.select(
        id_col,
        "n_words",
        F.coalesce(union, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")).alias("spans"),
    )
