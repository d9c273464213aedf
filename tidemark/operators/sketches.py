"""Summaries a month that merge: a refresh reads new months alone, not the whole history.

A month of a series is one row: counts, ends, and a sketch of its values. Distributions from sketches are approximate;
the forms in `aggregates` are exact and the default. NaN isn't a value here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.align import Names, names

#: Size of a sketch. Up to so many values it is exact.
SIZE = 2000
#: Greatest distance of a rank from a sketch's, as a share of the values, with 99 % of certainty.
RANK_ERROR = 2.296 / SIZE**0.9021


def by_month(df: DataFrame, key: Names, date: str, value: str) -> DataFrame:
    """The summary of each series and month; rows without a value or a date take no part."""
    v = F.col(value).cast("double")
    known = df.where(v.isNotNull() & ~F.isnan(v) & F.col(date).isNotNull()).select(*names(key), F.col(date).alias("_d"), v.alias("_v"), F.date_format(date, "yyyy-MM").alias("month"))
    return known.groupBy(*names(key), "month").agg(
        F.count("*").alias("n"),
        F.min("_d").alias("first"),
        F.max("_d").alias("last"),
        F.max_by("_v", "_d").alias("latest"),
        F.min("_v").alias("least"),
        F.max("_v").alias("most"),
        F.kll_sketch_agg_double("_v", SIZE).alias("sketch"),
    )


def refresh(df: DataFrame, path: str, key: Names, date: str, value: str, since: str | None = None) -> None:
    """Writes the summaries of the months from `since` ('yyyy-MM-dd', a month's first day; null: all) on; others stay.

    The bound is on the date column itself, so that it reaches the scan. A month is replaced whole, which makes a
    repeated run give the same rows; a month that lost all of its rows keeps its old summary.
    """
    if since is not None:
        if not since.endswith("-01"):
            raise ValueError("since must be the first day of a month")
        df = df.where(F.col(date) >= F.lit(since).cast("date"))
    by_month(df, key, date, value).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def merged(summaries: DataFrame, key: Names) -> DataFrame:
    """One summary a series, from those of its months."""
    return summaries.groupBy(*names(key)).agg(
        F.sum("n").alias("n"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max_by("latest", "last").alias("latest"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch", SIZE).alias("sketch"),
    )


def quantile(share: float) -> Column:
    """The least value of a merged sketch that so large a share of the values doesn't exceed."""
    return F.kll_sketch_get_quantile_double("sketch", F.lit(float(share)))


def clip_bounds(summaries: DataFrame, key: Names) -> DataFrame:
    """AGG13 from summaries: first and last percentile within RANK_ERROR, a tenth of their distance further out."""
    lo, hi = F.col("_lo"), F.col("_hi")
    ends = merged(summaries, key).select(*names(key), quantile(0.01).alias("_lo"), quantile(0.99).alias("_hi"))
    return ends.select(*names(key), (lo - (hi - lo) * 0.1).alias("lo"), (hi + (hi - lo) * 0.1).alias("hi"))


def profile(summaries: DataFrame, key: Names) -> DataFrame:
    """AGG15 from summaries, exact: values, first and last date, and latest value of each series. No sketch is read."""
    return merged(summaries, key).select(*names(key), "n", "first", "last", "latest")


def histogram(summaries: DataFrame, key: Names, bins: int = 40) -> DataFrame:
    """AGG19 from summaries: rows in each of `bins` equal intervals; empty ones are left out.

    The rank of an edge is read off SIZE quantiles, so it is within RANK_ERROR and 1 / SIZE. Rows of a series add up to
    its count, and series of at most SIZE values are exact. The interval of a value on an edge is the lower one.
    """
    shares = F.array(*(F.lit((i + 0.5) / SIZE) for i in range(SIZE)))
    whole = merged(summaries, key).withColumn("_width", (F.col("most") - F.col("least")) / bins)
    whole = whole.withColumn("_q", F.kll_sketch_get_quantile_double("sketch", shares)).drop("sketch")
    upto = lambda b: F.round(F.size(F.filter("_q", lambda q: q <= F.col("least") + F.col("_width") * b)) / SIZE * F.col("n")).cast("long")
    inner = F.transform(F.sequence(F.lit(1), F.lit(bins - 1)), upto)
    ranks = F.concat(F.array(F.lit(0).cast("long")), F.when(F.col("_width") == 0, F.array_repeat(F.col("n"), bins - 1)).otherwise(inner), F.array("n"))
    each = whole.select(*names(key), ranks.alias("_r")).select(*names(key), "_r", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return each.select(*names(key), "bin", (F.get("_r", F.col("bin") + 1) - F.get("_r", F.col("bin"))).alias("rows")).where("rows > 0")
