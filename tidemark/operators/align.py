"""Calendar alignment, gap filling and row filters over long tables.

A series is a key; functions take the names of the key, date and value columns and keep tables long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start

Names = str | Sequence[str]


def names(x: Names) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def ordered(key: Names, date: str):
    return Window.partitionBy(*names(key)).orderBy(date)


def daily_to_monthly_mean(df: DataFrame, key: Names, date: str = "date", value: str = "value") -> DataFrame:
    """CAL2: mean of the values that aren't null in each month; a month of nulls is a null row."""
    return df.groupBy(*names(key), month_start(F.col(date)).alias("month")).agg(F.avg(value).alias(value))


def monthly_first(df: DataFrame, key: Names, date: str = "date", value: str = "value") -> DataFrame:
    """CAL3: the value of each month's first day, null or not."""
    return df.groupBy(*names(key), month_start(F.col(date)).alias("month")).agg(F.min_by(value, date).alias(value))


def monthly_last_valid(df: DataFrame, key: Names, values: list[str], date: str = "date") -> DataFrame:
    """CAL7: each value column's last one in the month that isn't null; months of nulls alone are dropped."""
    last = [F.expr(f"max_by({v}, {date}) FILTER (WHERE {v} IS NOT NULL)").alias(v) for v in values]
    return df.groupBy(*names(key), month_start(F.col(date)).alias("month")).agg(*last).dropna("all", subset=values)


def month_spine(bounds: DataFrame, key: Names, first: str = "first", last: str = "last") -> DataFrame:
    """CAL9: one row for each month between two dates of each row."""
    return bounds.select(*names(key), F.explode(F.sequence(month_start(F.col(first)), month_start(F.col(last)), F.expr("INTERVAL 1 MONTH"))).alias("month"))


def on_spine(df: DataFrame, spine: DataFrame, key: Names) -> DataFrame:
    return spine.join(df, [*names(key), "month"], "left")


def ffill(value: str, key: Names, date: str, limit: int | None = None) -> Column:
    """CAL10, CAL11: the last value that isn't null, at most `limit` rows back."""
    start = Window.unboundedPreceding if limit is None else -limit
    return F.last(value, ignorenulls=True).over(ordered(key, date).rowsBetween(start, 0))


def sparse_to_monthly(df: DataFrame, key: Names, end: Column, date: str = "date", value: str = "value") -> DataFrame:
    """CAL5, CAL6: quarterly or annual values on every month from a key's first to `end`, carried forward."""
    monthly = df.groupBy(*names(key), month_start(F.col(date)).alias("month")).agg(F.max_by(value, date).alias(value))
    spine = month_spine(monthly.groupBy(*names(key)).agg(F.min("month").alias("first")).withColumn("last", end), key)
    return on_spine(monthly, spine, key).withColumn(value, ffill(value, key, "month"))


def changes_to_monthly(df: DataFrame, key: Names, end: Column, date: str = "date", value: str = "value") -> DataFrame:
    """CAL4: the value in force at each month's end, from change events, without a row for each day."""
    return sparse_to_monthly(df.where(F.col(value).isNotNull()), key, end, date, value)


def stamped(df: DataFrame, batch_day: Column, date: str = "observation_date") -> DataFrame:
    """CAL13: rows dated with their batch's Monday, so that a run again replaces its own rows."""
    return df.withColumn(date, F.date_trunc("week", batch_day).cast("date"))


def enough_series(df: DataFrame, group: Names, date: str, value: str, series: int) -> DataFrame:
    """FLT3: rows of dates that have at least int(n - n / 2 + 1) of n series' values."""
    w = Window.partitionBy(*names(group), date)
    return df.withColumn("_n", F.count(value).over(w)).where(F.col("_n") >= int(series - series / 2 + 1)).drop("_n")


def enough_rows(df: DataFrame, key: Names, value: str, least: int) -> DataFrame:
    """FLT4: series with at least `least` values."""
    long = df.groupBy(*names(key)).agg(F.count(value).alias("_n")).where(F.col("_n") >= least).drop("_n")
    return df.join(long, names(key), "left_semi")


def from_common_start(df: DataFrame, group: Names, key: Names, date: str, value: str) -> DataFrame:
    """FLT6: rows from the latest of the series' first dates on."""
    first = df.where(F.col(value).isNotNull()).groupBy(*names(group), *names(key)).agg(F.min(date).alias("_first"))
    start = first.groupBy(*names(group)).agg(F.max("_first").alias("_start"))
    return df.join(start, names(group)).where(F.col(date) >= F.col("_start")).drop("_start")


def from_anchor_start(df: DataFrame, group: Names, key: str, anchor: str, date: str, value: str) -> DataFrame:
    """FLT7: rows from the first date of one anchor series on."""
    start = df.where((F.col(key) == anchor) & F.col(value).isNotNull()).groupBy(*names(group)).agg(F.min(date).alias("_start"))
    return df.join(start, names(group)).where(F.col(date) >= F.col("_start")).drop("_start")


def on_day(df: DataFrame, at: str, day: str) -> DataFrame:
    """FLT9: rows of one day, as bounds of the column itself, which reach the scan."""
    first = F.lit(day).cast("date")
    return df.where((F.col(at) >= first.cast("timestamp_ntz")) & (F.col(at) < F.date_add(first, 1).cast("timestamp_ntz")))


def lookback(df: DataFrame, at: str, as_of: Column, hours: int) -> DataFrame:
    """FLT14: rows of the `hours` before `as_of`."""
    return df.where((F.col(at) > as_of - F.make_interval(hours=F.lit(hours))) & (F.col(at) <= as_of))


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Adds the columns of a table of one row to every row."""
    return df.withColumn("_k", F.lit(1)).join(F.broadcast(row.withColumn("_k", F.lit(1))), "_k").drop("_k")
