"""Window features of series, and the feature table for forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import cyclical
from tidemark.functions.numeric import pct_change
from tidemark.operators.align import Names, ffill, names, ordered

#: Lags and windows of the feature table.
LAGS, WINDOWS = (1, 2, 3, 6, 12), (3, 6, 12)


def lags(key: Names, date: str, value: str, steps=LAGS) -> dict[str, Column]:
    """WIN1."""
    return {f"lag{k}": F.lag(value, k).over(ordered(key, date)) for k in steps}


def rolling(key: Names, date: str, value: str, windows=WINDOWS, full: bool = False) -> dict[str, Column]:
    """WIN2, WIN3: mean and sample deviation of the w rows before, if max(1, w // 2) of them (full: w) have values."""
    out = {}
    for w in windows:
        frame = ordered(key, date).rowsBetween(-w, -1)
        enough = F.count(value).over(frame) >= (w if full else max(1, w // 2))
        out[f"roll{w}_mean"] = F.when(enough, F.avg(value).over(frame))
        out[f"roll{w}_std"] = F.when(enough, F.stddev_samp(value).over(frame))
    return out


def momentum(key: Names, date: str, filled: str) -> dict[str, Column]:
    """WIN4: percent change of the row before against one and twelve rows before it; `filled` is carried forward."""
    lag = lambda k: F.lag(filled, k).over(ordered(key, date))
    return {"mom": pct_change(lag(1), lag(2)), "yoy": pct_change(lag(1), lag(13))}


def engineer_features(panel: DataFrame, key: Names, date: str = "month", value: str = "value") -> DataFrame:
    """FC1: lags, rolling windows, momentum and calendar features of all series in one pass over each."""
    w = panel.withColumn("_filled", ffill(value, key, date))
    cols = lags(key, date, value) | rolling(key, date, value) | momentum(key, date, "_filled")
    return w.withColumns(cols | {"month_of_year": F.month(date), "quarter": F.quarter(date)}).drop("_filled")


def pair_cross(features: DataFrame, group: Names, key: str, date: str, pair: tuple[str, str], feature: str = "lag1") -> DataFrame:
    """IND7: product of one feature of two series, by date."""
    one = F.max(F.when(F.col(key) == pair[0], F.col(feature)))
    two = F.max(F.when(F.col(key) == pair[1], F.col(feature)))
    return features.groupBy(*names(group), date).agg((one * two).alias("cross"))


def seasonal_features(features: DataFrame, date: str = "month") -> DataFrame:
    """FC2, IND10: the feature table with the month's sine and cosine for month and quarter."""
    sine, cosine = cyclical(F.month(date))
    return features.withColumns({"month_sin": sine, "month_cos": cosine}).drop("month_of_year", "quarter")


def crossover(df: DataFrame, key: Names, day: str, value: str, spans=(9, 20, 50)) -> DataFrame:
    """WIN5: simple means of full windows, and for each pair of spans Y if the short mean is above the long one, else N."""
    w = ordered(key, day)
    mean = {n: F.when(F.count(value).over(w.rowsBetween(-(n - 1), 0)) >= n, F.avg(value).over(w.rowsBetween(-(n - 1), 0))) for n in spans}
    out = df.withColumns({f"sma{n}": c for n, c in mean.items()})
    flags = {f"sma{a}_over_{b}": F.when(F.col(f"sma{a}") > F.col(f"sma{b}"), "Y").when(F.col(f"sma{a}").isNotNull() & F.col(f"sma{b}").isNotNull(), "N") for i, a in enumerate(spans) for b in spans[i + 1 :]}
    return out.withColumns(flags)


def expanding_pct_rank(df: DataFrame, key: Names, date: str, value: str, least: int = 12, name: str = "pct_rank") -> DataFrame:
    """WIN6: mean rank of a value among all of its series up to its date, over their count; null before `least` values.

    A series of n values is cut into about sqrt(n) buckets of dates and as many of values. What is in earlier buckets
    of dates and lower ones of values is counted by prefix sums over the grid of buckets; only rows of the same
    bucket of dates, and counts of the same bucket of values, are compared one by one. So a series of n values takes
    n * sqrt(n) comparisons, spread over tasks by bucket. Dates of a series are distinct.
    """
    keys = names(key)
    by_date, by_value = Window.partitionBy(*keys).orderBy("_d"), Window.partitionBy(*keys).orderBy("_v")
    # Null keys are series too.
    number = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys] + [F.col(k).isNull() for k in keys]
    known = df.where(F.col(value).isNotNull()).select(*keys, F.struct(*number).alias("_k"), F.col(date).alias("_d"), F.col(value).alias("_v"))
    placed = known.withColumns({"_at": F.row_number().over(by_date), "_rank": F.rank().over(by_value), "_all": F.count("*").over(Window.partitionBy(*keys))})
    size = F.ceil(F.sqrt("_all"))
    rows = placed.select("*", F.floor((F.col("_at") - 1) / size).cast("int").alias("_t"), F.floor((F.col("_rank") - 1) / size).cast("int").alias("_b"))
    # The grid: rows of each pair of buckets, then of earlier and lower ones.
    ends = rows.groupBy("_k").agg(F.max("_t").alias("_ts"), F.max("_b").alias("_bs"))
    grid = ends.select("_k", F.explode(F.sequence(F.lit(0), F.col("_ts"))).alias("_t"), "_bs").select("_k", "_t", F.explode(F.sequence(F.lit(0), F.col("_bs"))).alias("_b"))
    cells = grid.join(rows.groupBy("_k", "_t", "_b").agg(F.count("*").alias("_n")), ["_k", "_t", "_b"], "left")
    earlier = F.coalesce(F.sum("_n").over(Window.partitionBy("_k", "_b").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lower = F.coalesce(F.sum("_n").over(Window.partitionBy("_k", "_t").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    grid = cells.withColumn("_n", earlier).withColumn("_below", lower).select("_k", "_t", "_b", "_below")
    less, same = F.col("_w") < F.col("_v"), F.col("_w") == F.col("_v")
    count = lambda c, n=1: F.sum(F.when(c, n).otherwise(0))
    own = ["_k", "_d"]
    near = rows.select("_k", "_t", F.col("_d").alias("_e"), F.col("_v").alias("_w"))
    within = rows.join(near, ["_k", "_t"]).where("_e <= _d").groupBy(*own).agg(count(less).alias("_less1"), count(same).alias("_same1"))
    alike = rows.groupBy("_k", "_b", F.col("_t").alias("_s"), F.col("_v").alias("_w")).agg(F.count("*").alias("_m"))
    beside = rows.join(alike, ["_k", "_b"]).where("_s < _t").groupBy(*own).agg(count(less, F.col("_m")).alias("_less2"), count(same, F.col("_m")).alias("_same2"))
    counted = rows.join(grid, ["_k", "_t", "_b"]).join(within, own).join(beside, own, "left")
    below = F.col("_below") + F.col("_less1") + F.coalesce("_less2", F.lit(0))
    equal = F.col("_same1") + F.coalesce("_same2", F.lit(0))
    ranked = counted.select("_k", "_d", F.when(F.col("_at") >= least, (below + (equal + 1) / 2) / F.col("_at")).alias(name))
    return df.withColumns({"_k": F.struct(*number), "_d": F.col(date)}).join(ranked, own, "left").select(*df.columns, name)


def shift_with_default(key: Names, date: str, value: str, steps: int = 3) -> Column:
    """WIN8: the value some rows before, else the row's own."""
    return F.coalesce(F.lag(value, steps).over(ordered(key, date)), F.col(value))


def trailing_momentum(df: DataFrame, key: Names, day: str, value: str, days: int = 35) -> DataFrame:
    """WIN9: percent change from the first to the last value of the trailing days, if there are two."""
    last = df.groupBy(*names(key)).agg(F.max(day).alias("_last"))
    recent = df.where(F.col(value).isNotNull()).join(last, names(key)).where(F.datediff(F.col("_last"), F.col(day)) < days)
    ends = recent.groupBy(*names(key)).agg(F.count("*").alias("_n"), F.min_by(value, day).alias("_a"), F.max_by(value, day).alias("_b"))
    return ends.where("_n >= 2").select(*names(key), ((F.col("_b") - F.col("_a")) / (F.abs("_a") + 1e-9) * 100).alias("momentum"))


def last_valid(df: DataFrame, key: Names, date: str, value: str) -> DataFrame:
    """WIN11: last value that isn't null, and its date."""
    return df.where(F.col(value).isNotNull()).groupBy(*names(key)).agg(F.max(date).alias("last_date"), F.max_by(value, date).alias("last_value"))


def stress_index(panel: DataFrame, date: str, key: str, value: str, signs: dict[str, int], least: int = 12) -> DataFrame:
    """IND1: mean over series of the expanding rank of the signed value; dates without any rank are dropped."""
    sign = F.create_map(*[F.lit(x) for kv in signs.items() for x in kv])
    signed = panel.where(F.col(key).isin(list(signs))).withColumn(value, F.col(value) * sign[F.col(key)])
    return expanding_pct_rank(signed, key, date, value, least).groupBy(date).agg(F.avg("pct_rank").alias("fsi")).where(F.col("fsi").isNotNull())


def regime_history(index: DataFrame, date: str = "month", months: int = 120) -> DataFrame:
    """IND3: regime of each month of one index series, for the last `months`."""
    from tidemark.functions.scoring import regime

    one = index.withColumn("_one", F.lit(1))
    out = one.withColumn("regime", regime(F.col("fsi"), shift_with_default("_one", date, "fsi")))
    place = F.row_number().over(Window.partitionBy("_one").orderBy(F.desc(date)))
    return out.withColumn("_place", place).where(F.col("_place") <= months).drop("_one", "_place")
