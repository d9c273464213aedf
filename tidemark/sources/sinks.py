"""Incremental maintenance of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import normalize_url
from tidemark.operators.align import Names, names


def upsert(existing: DataFrame, new: DataFrame, key: Names, seq: str = "ingest_seq") -> DataFrame:
    """SNK1, SNK2: one row a key, the one of the highest `seq`; of equals the new table's; nothing is deleted."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    latest = F.row_number().over(Window.partitionBy(*names(key)).orderBy(F.desc(seq), F.desc("_new")))
    return both.withColumn("_n", latest).where("_n = 1").drop("_n", "_new")


def refresh_start(series: DataFrame, key: Names, date: str, source: str) -> DataFrame:
    """SNK3: first day to fetch: 30 days back for fred and spy, two months for etf, the year's start, 1990 at least, for bls."""
    last = F.max(date)
    start = (
        F.when(F.col("_source").isin("fred", "spy"), F.date_sub("_last", 30))
        .when(F.col("_source") == "etf", F.add_months("_last", -2))
        .when(F.col("_source") == "bls", F.make_date(F.greatest(F.year("_last"), F.lit(1990)), F.lit(1), F.lit(1)))
    )
    return series.groupBy(*names(key), F.col(source).alias("_source")).agg(last.alias("_last")).select(*names(key), F.col("_source").alias(source), start.alias("start"))


def newer_only(new: DataFrame, existing: DataFrame, key: Names, date: str) -> DataFrame:
    """SNK4: rows of series whose newest date is later than what is stored."""
    a = new.groupBy(*names(key)).agg(F.max(date).alias("_new"))
    b = existing.groupBy(*names(key)).agg(F.max(date).alias("_old"))
    fresh = a.join(b, names(key), "left").where(F.col("_old").isNull() | (F.col("_new") > F.col("_old"))).select(*names(key))
    return new.join(fresh, names(key), "left_semi")


def new_articles(batch: DataFrame, stored: DataFrame, order: list[Column], ignore_scheme: bool = False) -> DataFrame:
    """SNK5: articles whose normalised URL isn't stored, the first of each in the batch."""
    url = normalize_url(F.col("url"), ignore_scheme)
    first = F.row_number().over(Window.partitionBy("url_norm").orderBy(*order))
    fresh = batch.withColumn("url_norm", url).join(stored.select(url.alias("url_norm")).distinct(), "url_norm", "left_anti")
    return fresh.withColumn("_n", first).where("_n = 1").drop("_n")


def write_days(df: DataFrame, path: str, day: str) -> None:
    """SNK6: replaces the days that df has, and only those."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def missing_states(df: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """SNK7: rows of states that aren't stored yet; all if forced."""
    return df if force else df.join(stored.select("state").distinct(), "state", "left_anti")


def write_states(df: DataFrame, path: str) -> None:
    """SNK7: adds states' partitions."""
    df.write.mode("append").partitionBy("state").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """SNK8."""
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    """SNK9: full overwrite."""
    df.write.mode("overwrite").parquet(path)


def fan_out(df: DataFrame, members: DataFrame, key: Names) -> DataFrame:
    """SNK10: a copy of each row for each group that its series is in."""
    return df.join(members, names(key))


def recent_runs(runs: DataFrame, n: int = 52) -> DataFrame:
    """SNK11: the newest runs of an append-only log."""
    return runs.orderBy(F.desc("run_at"), F.desc("run_id")).limit(n)
