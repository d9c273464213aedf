"""Summaries a month against all rows: exact counts and ends, ranks within the stated error, refreshes of few months."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, sketches


def long(spark, n=300_000):
    """A skewed series of n values over three years, and a small one of a null key."""
    at = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int"))
    many = spark.range(n).select(F.lit("a").alias("k"), at.alias("day"), F.exp(F.randn(3) * 2).alias("v"))
    few = spark.range(40).select(F.lit(None).cast("string").alias("k"), at.alias("day"), F.col("id").cast("double").alias("v"))
    return many.unionByName(few)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sketches"))
    long(spark).write.parquet(f"{at}/rows")
    rows = spark.read.parquet(f"{at}/rows")
    sketches.refresh(rows, f"{at}/months", "k", "day", "v")
    return rows, spark.read.parquet(f"{at}/months")


def test_ranks_are_within_the_stated_error(stored):
    rows, months = stored
    assert months.select("month").distinct().count() == 33
    v = np.sort(rows.where("k = 'a'").toPandas().v.to_numpy())
    shares = [0.001, 0.01, 0.25, 0.5, 0.9, 0.99, 0.999]
    got = sketches.merged(months, "k").where("k = 'a'").select(*(sketches.quantile(p).alias(str(p)) for p in shares)).first()
    for p in shares:
        assert abs(np.searchsorted(v, got[str(p)], "right") / len(v) - p) <= sketches.RANK_ERROR


def test_profile_is_exact(stored):
    rows, months = stored
    want = aggregates.profile(rows, "k", "day", "v").select("k", "n", "first", "last").collect()
    got = sketches.profile(months, "k")
    assert sorted(got.select("k", "n", "first", "last").collect(), key=str) == sorted(want, key=str)
    assert "sketch" not in got._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]


def test_histogram_counts_add_up_and_edges_are_near(stored):
    rows, months = stored
    exact = {r.bin: r.rows for r in aggregates.histogram(rows.where("k = 'a'"), "k", "v").collect()}
    got = {r.bin: r.rows for r in sketches.histogram(months, "k").where("k = 'a'").collect()}
    assert sum(got.values()) == sum(exact.values()) == 300_000
    assert all(abs(sum(got.get(b, 0) - exact.get(b, 0) for b in range(n))) <= (sketches.RANK_ERROR + 1 / sketches.SIZE) * 300_000 for n in range(1, 41))
    few = sketches.histogram(months, "k").where("k IS NULL")
    assert [r.rows for r in few.orderBy("bin").collect()] == [1] * 40


def test_small_series_are_exact(stored):
    rows, months = stored
    r = sketches.clip_bounds(months, "k").where("k IS NULL").first()
    assert (r.lo, r.hi) == pytest.approx((0 - 3.9, 39 + 3.9))


def test_a_refresh_replaces_its_months_and_keeps_others(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-05", 1.0), ("a", "2024-02-05", 2.0), ("a", "2024-02-06", None)], "k string, day string, v double").withColumn("day", F.to_date("day"))
    path = str(tmp_path / "months")
    sketches.refresh(rows, path, "k", "day", "v")
    # January is changed too, but isn't asked for; February has a value more.
    changed = spark.createDataFrame([("a", "2024-01-05", 99.0), ("a", "2024-02-05", 2.0), ("a", "2024-02-06", 5.0)], "k string, day string, v double").withColumn("day", F.to_date("day"))
    for _ in range(2):
        sketches.refresh(changed, path, "k", "day", "v", "2024-02-01")
    got = sketches.merged(spark.read.parquet(path), "k").first()
    assert (got.n, got.latest, got.least, got.most) == (3, 5.0, 1.0, 5.0)
    with pytest.raises(ValueError):
        sketches.refresh(rows, path, "k", "day", "v", "2024-02-02")


def test_values_that_are_none_or_alike(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-05", float("nan")), ("a", "2024-01-06", 4.0), ("a", "2024-01-07", 4.0), ("b", "2024-01-05", None), ("a", None, 9.0)], "k string, day string, v double").withColumn("day", F.to_date("day"))
    months = sketches.by_month(rows, "k", "day", "v")
    assert [(r.k, r.n) for r in months.collect()] == [("a", 2)]
    assert [(r.bin, r.rows) for r in sketches.histogram(months, "k").collect()] == [(0, 2)]
    assert sketches.clip_bounds(months.limit(0), "k").isEmpty()
