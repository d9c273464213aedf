"""Target-distribution importance resampling: texts most like a target set are drawn without replacement.

Hashed n-grams of words are counted over all source texts and all target texts. A bucket's gain is its log likelihood
ratio, in thousandths and rounded down; a text's weight is the sum of the gains of its n-grams, which workers look up in
one array. A Gumbel number from a hash of the id is added to each weight, so that the highest scores are a sample without
replacement by weight.

The cutoff of the highest scores isn't found by sorting them. A quantile sketch brackets it; exact counts outside the
bracket validate the bracket or widen it; only the scores within it are counted and sorted to locate the cutoff.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_texts, pieces, ranked, shared_checkpoint, slices

#: Words of the longest n-grams, buckets of features, percent of the eligible texts that are drawn, least words of an
#: eligible text, and the seed of the Gumbel numbers.
ORDERS, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, 2024

#: Half the width of the first bracket as a share of the eligible texts, and its accuracy in the sketch.
HALF_WIDTH, ACCURACY = 0.002, 2000

#: A-Z become a-z, all other ASCII characters but digits and letters become spaces.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def buckets(text: bytes | None, orders: int, n_buckets: int) -> Iterator[np.ndarray]:
    """The buckets of a text's n-grams of 1 to `orders` words, in parts; repeats included. None for a text without words."""
    held: list[bytes] = []
    for part in pieces((text or b"").translate(WORD_BYTES)):
        words = part.split()
        yield np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % n_buckets
        if orders > 1:
            # The last words of the part before begin n-grams that end in this one.
            run = held + words
            for n in range(2, orders + 1):
                grams = [b" ".join(run[i : i + n]) for i in range(max(0, len(held) - n + 1), len(run) - n + 1)]
                yield np.fromiter(map(zlib.crc32, grams), np.uint32, len(grams)) % n_buckets
            held = run[-(orders - 1) :]


def bucket_counts(df: DataFrame, text_col: str = "text", orders: int = ORDERS, n_buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts of `df`; summed in each task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for lo, hi in slices(np.asarray(pc.binary_length(batch.column(0)).fill_null(0))):
                for text in batch.column(0).slice(lo, hi - lo).to_pylist():
                    for part in buckets(text, orders, n_buckets):
                        counts += np.bincount(part, minlength=n_buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], names=["bucket", "n"])

    texts = df.select(F.col(text_col).cast("string").cast("binary").alias("__text"))
    out = np.zeros(n_buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets."""
    n = len(source)
    # Products of counts pass 2**53 from some 10**8 features on; Python's integers round once, as a quotient.
    big_s, big_t = int(source.sum()) + n, int(target.sum()) + n
    top, low = ((x.astype(np.float64) + 1.0) * float(y) for x, y in ((target, big_s), (source, big_t)))
    return np.floor(1000 * np.log(top / low)).astype(np.int64)


def gumbel(id_col: str, seed: int) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2**32))), h being the first 8 hex digits of sha256 of `seed:id`; of a null id, of `seed:`."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def bracket(scores: DataFrame, k: int, score_col: str = "score", half_width: float = HALF_WIDTH, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """Two scores between which the `k` highest scores end (1 <= k <= rows), and how many scores are above both.

    A sketch gives the quantiles beside the wanted one. The exact counts outside tell whether the cutoff lies between them; if
    not, the bracket is widened to twice the width, and to the extremes at last.
    """
    wanted, width, s = 1 - k / scores.count(), half_width, F.col(score_col)
    while True:
        if width < 1:
            low, high = scores.agg(F.percentile_approx(score_col, [max(0.0, wanted - width), min(1.0, wanted + width)], accuracy)).first()[0]
        else:
            low, high = scores.agg(F.min(s), F.max(s)).first()
        above, below, n = scores.agg(F.count_if(s > high), F.count_if(s < low), F.count("*")).first()
        if above < k <= n - below:
            return low, high, above
        width *= 2


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    orders: int = ORDERS,
    n_buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    target_text_col: str = "text",
) -> DataFrame:
    """One row for each row of `docs`: its id, `n_features`, `weight`, `score` and `rank`, null for rows that aren't drawn.

    Of the texts with `least_words` words or more, floor(percent * n / 100) of the highest scores are drawn; ties go to the
    smaller id (null ids first), then to fewer features and the smaller weight; rows equal in all of these are drawn one by
    one, in no order, as their results are equal. Null, empty and blank texts have no features and weight 0. Very long texts
    count whole, piece by piece. Repeated rows count as often as they occur, and have ranks of their own. An empty table
    gives an empty result; without a target text the gains are those of an empty target. Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs, text_col, orders, n_buckets), bucket_counts(target, target_text_col, orders, n_buckets)))

    def start():
        gain = held.value

        def work(texts):
            n, w, words = (np.zeros(len(texts), np.int64) for _ in range(3))
            for i, text in enumerate(texts):
                for k, part in enumerate(buckets(text, orders, n_buckets)):
                    n[i] += len(part)
                    w[i] += gain[part].sum()
                    if k % orders == 0:
                        words[i] += len(part)
            return [pa.array(n), pa.array(w), pa.array(words)]

        return work

    fields = [T.StructField(c, T.LongType()) for c in ("n_features", "weight", "__words")]
    weighed = map_texts(docs, [id_col], text_col, fields, start)
    rows = shared_checkpoint(weighed.withColumn("score", F.col("weight") + gumbel(id_col, seed)).withColumn("__tie", F.monotonically_increasing_id()))
    eligible = rows.where(F.col("__words") >= least_words)
    k = eligible.count() * percent // 100
    shown = [id_col, "n_features", "weight", "score"]
    if not k:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    low, high, above = bracket(eligible, k)
    s, none = F.col("score"), F.lit(None).cast("long")
    order = [s.desc(), F.col(id_col).asc_nulls_first(), "n_features", "weight", "__tie"]
    # The cutoff is the bracket's row of this place; those above it are sorted for their ranks alone.
    near = ranked(eligible.where((s >= low) & (s <= high)), order)
    cut = near.select(*shown, F.when(F.col("rank") <= k - above, F.col("rank") + above).alias("rank"))
    top = ranked(eligible.where(s > high), order).select(*shown, "rank")
    rest = rows.where((F.col("__words") < least_words) | (s < low)).select(*shown, none.alias("rank"))
    return top.union(cut).union(rest)
