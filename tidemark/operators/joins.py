"""Joins of series and enrichment of event tables, and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.align import Names, names

#: Seconds of a bucket in which as-of rows of one key meet in one task.
BUCKET_SECONDS = 30 * 86_400


def outer_merge(long: DataFrame, date: str, key: str, value: str, series: list[str]) -> DataFrame:
    """JN1: one column a series, on all dates that any has: a pivot in place of n - 1 full joins."""
    return long.groupBy(date).pivot(key, series).agg(F.first(value, ignorenulls=True))


def inner_merge(long: DataFrame, date: str, key: str, value: str, series: list[str]) -> DataFrame:
    """JN2: dates that all series have."""
    merged = long.where(F.col(key).isin(series)).groupBy(date)
    return merged.pivot(key, series).agg(F.first(value)).join(merged.agg(F.count_distinct(key).alias("_n")).where(F.col("_n") == len(series)).drop("_n"), date, "left_semi")


def mixed_merge(main: DataFrame, auxiliary: DataFrame, date: str) -> DataFrame:
    """JN3: every row of main with what the auxiliary has for its date."""
    return main.join(auxiliary, date, "left")


def asof_backward(left: DataFrame, right: DataFrame, key: Names, at: str, right_at: str, values: list[str], bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """JN4: each left row with `values` of the latest right row of its key at or before it; null without one.

    Rows of one key are dealt to buckets of time, so that a hot key spreads over tasks: a window finds
    the latest right row inside the bucket, and a second one, over one row a bucket, what earlier
    buckets carry into it. Of right rows at one time the one of the greatest values counts. Left rows
    with a null key or time are kept and get nulls.
    """
    keys = names(key)
    payload = F.struct(F.col(right_at).alias("at"), *values)
    r = right.where(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).cast("timestamp").alias("_at"), payload.alias("_pay"))
    bucket = F.floor(F.unix_seconds("_at") / bucket_seconds)
    r = r.withColumn("_bucket", bucket)
    el = left.withColumn("_at", F.col(at).cast("timestamp")).withColumn("_bucket", bucket)
    carried = r.groupBy(*keys, "_bucket").agg(F.max("_pay").alias("_last"))
    stops = carried.unionByName(el.select(*keys, "_bucket").distinct().withColumn("_last", F.lit(None).cast(carried.schema["_last"].dataType)))
    stops = stops.groupBy(*keys, "_bucket").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = stops.withColumn("_carry", F.last("_last", ignorenulls=True).over(before)).select(*keys, "_bucket", "_carry")
    rows = el.withColumn("_side", F.lit(1)).unionByName(r.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_side", "_pay").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_here", F.last("_pay", ignorenulls=True).over(inside)).where("_side = 1")
    same = [found[k].eqNullSafe(carry[k]) for k in keys] + [found["_bucket"].eqNullSafe(carry["_bucket"])]
    joined = found.join(carry.select(*(F.col(k) for k in keys), "_bucket", "_carry"), same, "left")
    got = F.when(found["_at"].isNotNull(), F.coalesce("_here", "_carry"))
    return joined.select(*(found[c] for c in left.columns), *(got[v].alias(v) for v in values))


def exact_then_ffill(events: DataFrame, daily: DataFrame, day: str, values: list[str], tiebreak: Names) -> DataFrame:
    """JN5: what the day's own row has, else what the last matched event before carries.

    The order is over all events, which one task would sort; so days' last matched values, one row a
    day, are carried forward in a window of their own and joined back by day.
    """
    matched = events.join(daily.select(day, F.struct(*values).alias("_m")), day, "left")
    per_day = matched.where(F.col(day).isNotNull()).groupBy(day).agg(F.first("_m", ignorenulls=True).alias("_m"))
    fill = [F.last(F.col(f"_m.{v}"), ignorenulls=True).over(Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)).alias(v) for v in values]
    return events.join(per_day.select(day, *fill), day, "left").select(*events.columns, *values)


def ticker_enrich(events: DataFrame, price_signals: DataFrame, fundamentals: DataFrame, ticker: str) -> DataFrame:
    """JN6: signals of the event's ticker (trimmed, in capitals); fundamentals go before price signals of one name; without ticker all null."""
    both = [c for c in price_signals.columns if c != ticker]
    more = [c for c in fundamentals.columns if c != ticker and c not in both]
    signals = price_signals.alias("p").join(fundamentals.alias("f"), ticker, "full")
    value = {c: F.coalesce(f"f.{c}", f"p.{c}") if c in fundamentals.columns else F.col(f"p.{c}") for c in both} | {c: F.col(f"f.{c}") for c in more}
    lookup = signals.select(F.col(ticker).alias("_t"), *(v.alias(c) for c, v in value.items()))
    keyed = events.withColumn("_t", F.nullif(F.upper(F.trim(F.col(ticker))), F.lit("")))
    # Events without a ticker, any number of them, don't meet in one partition of the join.
    found = keyed.where("_t IS NOT NULL").join(lookup, "_t", "left")
    return found.unionByName(keyed.where("_t IS NULL"), allowMissingColumns=True).drop("_t")


def not_stored(new: DataFrame, stored: DataFrame, key: Names) -> DataFrame:
    """JN7, SET3: rows whose key isn't stored."""
    return new.join(stored.select(*names(key)).distinct(), names(key), "left_anti")


def distinct_in_order(df: DataFrame, value: str, order: str) -> DataFrame:
    """SET2: distinct values with the first place of each."""
    return df.groupBy(value).agg(F.min(order).alias(order))


def dimension(df: DataFrame, dim: DataFrame, key: Names) -> DataFrame:
    """JN9: labels and the like from a dimension table. Spark broadcasts it if its bytes, known from the files or measured
    at run time, are within spark.sql.autoBroadcastJoinThreshold, and shuffles else."""
    return df.join(dim, names(key), "left")


def by_calendar_month(df: DataFrame, baseline: DataFrame, key: Names, month: Column) -> DataFrame:
    """JN10: a baseline of the key's month of the year (columns: key, moy, baseline)."""
    return df.withColumn("moy", month).join(baseline, [*names(key), "moy"], "left").drop("moy")
