"""Scans in two levels against plain windows and loops, with segments of a few rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scan


def made(spark, seed, series=4, most=120):
    """Series of different length, one of a null key, with gaps, bursts and long runs."""
    rng, rows = random.Random(seed), []
    for k in [*(f"s{n}" for n in range(series)), None]:
        at = dt.date(2000, 1, 1)
        value = None
        for _ in range(rng.randrange(most)):
            at += dt.timedelta(days=rng.choice([1, 1, 1, 1, 40]))
            if rng.random() < 0.5:
                value = None if rng.random() < 0.6 else float(rng.randrange(3))
            rows.append((k, at, value))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "series_id string, day date, value double").repartition(3)


def by_series(rows):
    out = {}
    for k, at, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        out.setdefault(k, []).append((at, v))
    return out


def loop_fill(values, limit):
    out, last, since = [], None, 0
    for v in values:
        last, since = (v, 0) if v is not None else (last, since + 1)
        out.append(last if limit is None or since <= limit else None)
    return out


def loop_interpolate(values, limit):
    out = list(values)
    known = [i for i, v in enumerate(values) if v is not None]
    for i, v in enumerate(values):
        left = max((j for j in known if j <= i), default=None)
        right = min((j for j in known if j >= i), default=None)
        if v is None and left is not None and i - left <= limit:
            out[i] = values[left] if right is None else values[left] + (values[right] - values[left]) * (i - left) / (right - left)
    return out


def same(df, want):
    got = {(r.series_id, r.day): r.value for r in df.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rows", [3, 1000])
def test_fills_equal_loops(spark, seed, rows):
    data, df = made(spark, seed)
    for limit in (None, 2):
        want = {(k, at): v for k, s in by_series(data).items() for (at, _), v in zip(s, loop_fill([v for _, v in s], limit))}
        same(scan.carried(df, "series_id", "day", "value", limit, rows), want)
    want = {(k, at): v for k, s in by_series(data).items() for (at, _), v in zip(s, loop_interpolate([v for _, v in s], 2))}
    same(scan.interpolated(df, "series_id", "day", "value", 2, rows), want)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rows", [2, 1000])
def test_spans_equal_a_loop(spark, seed, rows):
    data, df = made(spark, seed)
    want = []
    for k, s in by_series(data).items():
        runs = []
        for at, v in s:
            if runs and runs[-1][1] == v:
                runs[-1][3] += 1
            else:
                runs.append([k, v, at, 1])
        want += [(*r, n[2] if n else None) for r, n in zip(runs, [*runs[1:], None])]
    got = [(r.series_id, r.value, r.start, r.rows, r.until) for r in scan.spans(df, "series_id", "day", "value", rows).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_series_spreads_over_segments(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("series_id"), F.timestamp_seconds("id").alias("day"), F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("value"))
    sizes = [r["count"] for r in scan.segmented(df, "series_id", "day", 10_000).groupBy("_seg").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 10_001
    filled = scan.carried(df, "series_id", "day", "value", rows=10_000)
    assert filled.where(F.col("value") != F.floor(F.unix_seconds("day") / 1000) * 1000).isEmpty()
    assert filled.where("value IS NULL").isEmpty()


def test_rows_without_a_date_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None, 7.0), ("a", dt.date(2000, 1, 1), None)], "series_id string, day date, value double")
    assert sorted(r.value for r in scan.carried(df, "series_id", "day", "value").collect()) == [7.0, 7.0]
    for out in (scan.carried(df.limit(0), "series_id", "day", "value"), scan.interpolated(df.limit(0), "series_id", "day", "value", 2), scan.spans(df.limit(0), "series_id", "day", "value")):
        assert out.isEmpty()
