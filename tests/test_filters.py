"""Filters beside day partitions: nothing stored is missed, and few days are read."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.sources import filters


@pytest.fixture()
def cut(spark, tmp_path):
    def write(df):
        at = f"{tmp_path}/cut-{uuid.uuid4().hex}"
        df.write.parquet(at)
        return spark.read.parquet(at)

    return write


def articles(spark, first, last, per_day=1000):
    ids = spark.range(first, last)
    return ids.select("id", F.concat(F.lit("https://Site.com/a/"), "id", F.lit("?utm_source=x")).alias("url"), F.concat(F.lit("d"), F.floor(F.col("id") / per_day).cast("string")).alias("day"))


def test_every_stored_key_is_found_and_few_others(spark):
    keys = articles(spark, 0, 20_000).select("day", "url")
    made = filters.day_filters(keys, "url", "day").persist()
    assert sorted(filters.days_that_may_hold(made, keys, "url", "day")) == sorted(f"d{n}" for n in range(20))
    single = keys.where("url like '%/7123?%'")
    assert filters.days_that_may_hold(made, single, "url", "day") == ["d7"]
    asked = articles(spark, 50_000, 51_000).select("url", filters.mask("url").alias("m"), filters.word("url", F.lit(filters.LEAST_SIZE)).alias("word"))
    chance = made.join(asked, "word").where(F.col("bits").bitwiseAND(F.col("m")) == F.col("m")).count()
    assert chance / (1000 * 20) < 1e-3
    made.unpersist()


def test_filters_grow_with_the_day(spark):
    keys = spark.range(300_000).select(F.col("id").cast("string").alias("url"), F.lit("d").alias("day"))
    made = filters.day_filters(keys, "url", "day")
    assert [r.size for r in made.select("size").distinct().collect()] == [18]


def test_a_batch_reads_only_days_that_may_hold_its_articles(spark, tmp_path, cut):
    path, order = str(tmp_path / "articles"), [F.asc("id")]
    first = filters.append_articles(articles(spark, 0, 30_000), path, "day", order, cut)
    assert first.count() == 30_000
    # Twenty known articles of day 3, one known one of day 8 under another query, and ten new ones of a day of their own.
    batch = articles(spark, 3000, 3020).unionByName(articles(spark, 8000, 8001).withColumn("url", F.lit("https://site.com/a/8000"))).unionByName(articles(spark, 90_000, 90_010))
    known = batch.select(filters.normalize_url(F.col("url")).alias("u"))
    touched = set(filters.days_that_may_hold(spark.read.parquet(path + "-filters"), known, "u", "day"))
    assert {"d3", "d8"} <= touched and len(touched) <= 4
    # Files of other days can't be read any more, which does no harm.
    spoiled = [f for f in (tmp_path / "articles").rglob("*.parquet") if f.parent.name[4:] not in touched]
    assert len({f.parent for f in spoiled}) == 30 - len(touched)
    for f in spoiled:
        f.write_bytes(b"no parquet")
    fresh = filters.append_articles(batch.unionByName(batch), path, "day", order, cut)
    assert sorted(r.id for r in fresh.collect()) == list(range(90_000, 90_010))
    assert filters.append_articles(batch, path, "day", order, cut).isEmpty()


def test_a_table_without_filters_null_days_and_null_urls(spark, tmp_path, cut):
    path, order = str(tmp_path / "old"), [F.asc("id")]
    old = spark.createDataFrame([(1, "https://a/1", "x"), (2, "https://a/2", None)], "id long, url string, day string")
    old.write.partitionBy("day").parquet(path)
    batch = spark.createDataFrame([(3, "https://a/1", "y"), (4, "https://a/2", "y"), (5, "https://a/3", None), (6, None, "y"), (7, None, "x"), (8, "", "x")], "id long, url string, day string")
    fresh = filters.append_articles(batch, path, "day", order, cut)
    assert sorted(r.id for r in fresh.collect()) == [5, 6, 8]
    again = filters.append_articles(batch, path, "day", order, cut)
    assert [r.id for r in again.collect()] == [6]


def test_an_empty_batch_and_an_empty_store(spark, tmp_path, cut):
    path = str(tmp_path / "none")
    empty = articles(spark, 0, 0)
    assert filters.append_articles(empty, path, "day", [F.asc("id")], cut).isEmpty()
    assert filters.append_articles(articles(spark, 0, 5), path, "day", [F.asc("id")], cut).count() == 5
