"""Grouped summaries: climate, funding, news, profiles and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start
from tidemark.functions.numeric import fixed, pct_change
from tidemark.functions.scoring import REGIMES
from tidemark.operators.align import Names, names, with_row

#: Degrees of a degree day's base, hot and cold days; depths of wet and very wet days; least days of a month.
BASE, HOT, COLD, WET, VERY_WET, LEAST_DAYS = 65.0, 90.0, 32.0, 0.01, 1.0, 20


def climate_monthly(daily: DataFrame, key: Names, limits: dict[str, float] | None = None, least_days: int = LEAST_DAYS) -> DataFrame:
    """AGG1: monthly climate of each city: means, degree days, day counts and sums of the columns that `daily` has, for months of `least_days` mean temperatures."""
    at = {"base": BASE, "hot": HOT, "cold": COLD, "wet": WET, "very_wet": VERY_WET} | (limits or {})
    if "mean_temp" not in daily.columns:
        return daily.select(*names(key), month_start(F.col("date")).alias("month")).where("false")
    t = F.col("mean_temp")
    day = lambda c: F.sum(c.cast("long"))
    measures: dict[str, tuple[str, Column]] = {
        "temp_mean": ("mean_temp", F.avg(t)),
        "hdd": ("mean_temp", F.sum(F.greatest(at["base"] - t, F.lit(0.0)) + t * 0)),
        "cdd": ("mean_temp", F.sum(F.greatest(t - at["base"], F.lit(0.0)) + t * 0)),
        "day_count": ("mean_temp", F.count(t)),
        "precip_total": ("precip", F.sum("precip")),
        "precip_days": ("precip", day(F.col("precip") > at["wet"])),
        "extreme_precip_days": ("precip", day(F.col("precip") > at["very_wet"])),
        "snow_total": ("snow_depth", F.sum("snow_depth")),
        "extreme_heat_days": ("max_temp", day(F.col("max_temp") > at["hot"])),
        "extreme_cold_days": ("min_temp", day(F.col("min_temp") < at["cold"])),
        "wind_mean": ("wind_speed", F.avg("wind_speed")),
        "cloud_cover_mean": ("cloud_cover", F.avg("cloud_cover")),
    }
    aggs = [c.alias(n) for n, (column, c) in measures.items() if column in daily.columns]
    return daily.groupBy(*names(key), month_start(F.col("date")).alias("month")).agg(*aggs).where(F.col("day_count") >= least_days)


def state_monthly(city: DataFrame, measures: list[str], least: int = 2) -> DataFrame:
    """AGG2: plain mean over a state's cities, for months with `least` cities."""
    return city.groupBy("state", "month").agg(*(F.avg(m).alias(m) for m in measures), F.count_distinct("city").alias("city_count")).where(F.col("city_count") >= least)


def geography_levels(state: DataFrame, regions: DataFrame, measures: list[str], nation: str = "national") -> DataFrame:
    """AGG3, AGG4: plain mean over the states of each region and of the nation, for months that half of a level's states with data have, one at least."""
    level = state.join(regions, "state").withColumn("level", F.explode(F.array("region", F.lit(nation))))
    level = level.dropDuplicates(["level", "state", "month"])
    means = level.groupBy("level", "month").agg(*(F.avg(m).alias(m) for m in measures), F.count_distinct("state").alias("state_count"), F.collect_set("state").alias("_states"))
    # States with data come from the monthly means, a few rows a level, so that the panel is made once.
    available = F.size(F.array_distinct(F.flatten(F.collect_list("_states").over(Window.partitionBy("level")))))
    return means.withColumn("_all", available).where(F.col("state_count") >= F.greatest(F.lit(1), F.floor(F.col("_all") / 2))).drop("_all", "_states")


def anomaly(monthly: DataFrame, key: Names, value: str, first: int = 2000, last: int = 2019, least_years: int = 10) -> DataFrame:
    """AGG5: value less the mean of its calendar month over the base years; null with fewer than `least_years` of them."""
    keys = names(key)
    years = monthly.where(F.year("month").between(first, last) & F.col(value).isNotNull())
    enough = years.groupBy(*keys).agg(F.count_distinct(F.year("month")).alias("_years")).where(F.col("_years") >= least_years)
    base = years.join(enough, keys, "left_semi").groupBy(*keys, F.month("month").alias("moy")).agg(F.avg(value).alias("_base"))
    joined = monthly.withColumn("moy", F.month("month")).join(base, [*keys, "moy"], "left")
    return joined.withColumn("anomaly", F.col(value) - F.col("_base")).drop("_base", "moy")


#: Accuracy of the sketch that brackets a percentile, ranks (as a share of a group) that a bracket reaches to both sides, three
#: times the sketch's error, and groups so small that all of their values are the bracket.
SKETCH, REACH, SMALL = 2000, 3 / 2000, 4000


def percentiles(df: DataFrame, key: Names, value: str, shares: list[float], name: str = "quantiles") -> DataFrame:
    """Exact percentiles of each key, linear between neighbours, as an array; keys without values have no row.

    A mergeable sketch brackets each percentile. Values below a bracket are only counted, before they are shuffled; those
    within it, about 0.3 % of a large group, are counted by value and picked by rank. So no task sorts a group.
    """
    keys = names(key)
    known = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    sides = [min(1.0, max(0.0, p + d)) for p in shares for d in (-REACH, REACH)]
    sketched = known.groupBy(*keys).agg(F.count("*").alias("_all"), F.percentile_approx("_v", sides, SKETCH).alias("_q"))
    small = F.col("_all") <= SMALL
    low = [F.when(small | F.lit(p - REACH <= 0), float("-inf")).otherwise(F.get("_q", F.lit(2 * i))) for i, p in enumerate(shares)]
    high = [F.when(small | F.lit(p + REACH >= 1), float("inf")).otherwise(F.get("_q", F.lit(2 * i + 1))) for i, p in enumerate(shares)]
    brackets = sketched.select(*keys, "_all", F.array(*low).alias("_lows"), F.array(*high).alias("_highs"))
    # Null stands for all values below the bracket; NaN is above all numbers, as in Spark's order.
    cells = [F.struct(F.lit(i).alias("i"), F.when(F.col("_v") >= F.get("_lows", F.lit(i)), F.col("_v")).alias("v"), (F.isnan("_v") & (F.get("_highs", F.lit(i)) < float("inf")) | (F.col("_v") > F.get("_highs", F.lit(i)))).alias("above")) for i in range(len(shares))]
    met = null_safe_join(known, brackets, keys).select(*keys, "_all", F.inline(F.filter(F.array(*cells), lambda c: ~c["above"])))
    counted = met.groupBy(*keys, "i", "v").agg(F.first("_all").alias("_all"), F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    rank = F.element_at(F.array(*(F.lit(float(p)) for p in shares)), F.col("i") + 1) * (F.col("_all") - 1)
    placed = counted.select(*keys, "i", "v", "_n", upto.alias("_end"), rank.alias("_at"))
    pick = lambda at: F.max(F.when((F.col("_end") - F.col("_n") <= at) & (at < F.col("_end")), F.col("v")))
    a, b, part = pick(F.floor("_at")), pick(F.ceil("_at")), F.max(F.col("_at") - F.floor("_at"))
    each = placed.groupBy(*keys, "i").agg((a + F.when(part > 0, (b - a) * part).otherwise(0.0)).alias("q"))
    return each.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "q"))), lambda x: x["q"]).alias(name))  # one a share


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which null keys are equal; the left's keys stay."""
    other = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    return left.join(other, [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys], how).drop(*(f"_r_{k}" for k in keys))


def funding_metrics(rounds: DataFrame, by: Names) -> DataFrame:
    """AGG6: companies, rounds, capital, exact median size and rounds with a lead investor."""
    sums = rounds.groupBy(*names(by)).agg(
        F.count_distinct("org_uuid").alias("company_count"),
        F.count("*").alias("round_count"),
        F.coalesce(F.sum("money"), F.lit(0.0)).alias("capital_raised"),
        F.sum("lead").alias("lead_investor_count"),
    )
    return null_safe_join(sums, percentiles(rounds, by, "money", [0.5]), names(by), "left").withColumn("median_round_size", F.col("quantiles")[0]).drop("quantiles")


def news_monthly(articles: DataFrame, day: str, sectors: list[str]) -> DataFrame:
    """AGG7: articles a month, in all and by sector, and the sectors' mean sentiment, 0 where none is scored."""
    count = [F.sum((F.col("sector") == s).cast("long")).alias(f"volume_{s}") for s in sectors]
    mean = [F.coalesce(F.avg(F.when(F.col("sector") == s, F.col("sentiment"))), F.lit(0.0)).alias(f"sentiment_{s}") for s in sectors]
    return articles.groupBy(month_start(F.col(day)).alias("month")).agg(F.count("*").alias("volume"), *count, *mean)


def sector_mood(articles: DataFrame) -> DataFrame:
    """AGG8: mean sentiment of each named sector, three digits."""
    named = articles.where(F.col("sentiment").isNotNull() & (F.col("sector") != ""))
    return named.groupBy("sector").agg(fixed(F.avg("sentiment"), 3).alias("mood"))


def tag_volume(articles: DataFrame, least: int = 3) -> DataFrame:
    """AGG9: articles of each macro tag that has `least` or more."""
    return articles.where(F.col("macro_tag").isNotNull()).groupBy("macro_tag").agg(F.count("*").alias("articles")).where(F.col("articles") >= least)


def volume_spike(articles: DataFrame, sector: str, day: str, least_days: int = 7) -> DataFrame:
    """AGG10: 0.5 plus half of the latest day's deviation from a sector's mean daily count, in thirds of three sigmas, within 0 and 1."""
    days = articles.agg(F.count_distinct(day).alias("_days"))
    daily = articles.groupBy(sector, day).agg(F.count("*").cast("double").alias("_n"))
    stats = daily.groupBy(sector).agg(F.avg("_n").alias("_mu"), F.stddev_pop("_n").alias("_sd"), F.max_by("_n", day).alias("_last"))
    z = F.least((F.col("_last") - F.col("_mu")) / F.col("_sd"), F.lit(3.0)) / 3
    spike = F.when((F.col("_days") < least_days) | (F.col("_sd") == 0), 0.5).otherwise(F.least(F.greatest(0.5 + 0.5 * z, F.lit(0.0)), F.lit(1.0)))
    return with_row(stats, days).select(sector, fixed(spike).alias("spike"))


def regime_distribution(history: DataFrame) -> DataFrame:
    """AGG11: share of months of each regime, all of them present, four digits."""
    labels = history.sparkSession.createDataFrame([(r,) for r in REGIMES], "regime string")
    counted = history.groupBy("regime").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return labels.join(counted, "regime", "left").select("regime", fixed(F.coalesce(F.col("n") / total, F.lit(0.0))).alias("share"))


def cold_start(articles: DataFrame, day: str, least: int = 30) -> DataFrame:
    """AGG12: whether fewer than `least` distinct days were collected."""
    return articles.agg(F.count_distinct(day).alias("days_collected")).select((F.col("days_collected") < least).alias("cold_start"), "days_collected", F.lit(least).alias("min_required"))


def clip_bounds(df: DataFrame, key: Names, value: str) -> DataFrame:
    """AGG13: first and last percentile, a tenth of their distance further out."""
    p = percentiles(df, key, value, [0.01, 0.99], "_p")
    lo, hi = F.col("_p")[0], F.col("_p")[1]
    return p.select(*names(key), (lo - (hi - lo) * 0.1).alias("lo"), (hi + (hi - lo) * 0.1).alias("hi"))


def clip_bounds_volume(df: DataFrame, key: Names, value: str) -> DataFrame:
    """AGG14: bounds of counts: a tenth below the first percentile, not below 0, and a tenth above the last, one above the unclipped lower bound at least."""
    p = percentiles(df, key, value, [0.01, 0.99], "_p")
    lo, hi = F.col("_p")[0] * 0.9, F.col("_p")[1] * 1.1
    return p.select(*names(key), F.greatest(lo, F.lit(0.0)).alias("lo"), F.greatest(hi, lo + 1).alias("hi"))


def profile(df: DataFrame, key: Names, date: str, value: str) -> DataFrame:
    """AGG15: values, first and last date, and latest value of each series."""
    valid = df.where(F.col(value).isNotNull())
    return valid.groupBy(*names(key)).agg(F.count("*").alias("n"), F.min(date).alias("first"), F.max(date).alias("last"), F.max_by(value, date).alias("latest"))


def refresh_status(runs: DataFrame) -> DataFrame:
    """AGG16: runs by source prefix: counts of ok and error, first error by order, and OK, FAILED or PARTIAL."""
    ok, bad = F.count_if(F.col("status") == "ok"), F.count_if(F.col("status") != "ok")
    first = F.expr("min_by(error, seq) FILTER (WHERE status <> 'ok' AND error IS NOT NULL AND error <> '')")
    out = runs.groupBy(F.split("source", "/")[0].alias("prefix")).agg(ok.alias("n_ok"), bad.alias("n_error"), F.substring(first, 1, 70).alias("first_error"))
    partial = F.concat(F.lit("PARTIAL ("), F.col("n_ok"), F.lit("/"), F.col("n_ok") + F.col("n_error"), F.lit(" ok)"))
    return out.withColumn("state", F.when(F.col("n_error") == 0, "OK").when(F.col("n_ok") == 0, "FAILED").otherwise(partial))


def validation_metrics(pairs: DataFrame, key: Names, actual: str, predicted: str) -> DataFrame:
    """AGG17: MAE, RMSE and R2 over pairs without null, for series with two or more."""
    e = F.col(actual) - F.col(predicted)
    both = pairs.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    sums = both.groupBy(*names(key)).agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(actual).alias("var"))
    return sums.where("n > 1").select(*names(key), "n", fixed(F.col("mae")).alias("mae"), fixed(F.sqrt("mse")).alias("rmse"), fixed(1 - F.try_divide("mse", "var")).alias("r2"))


def snapshot(panel: DataFrame, key: str, date: str, value: str, wanted: dict[str, str], spread: tuple[str, str, str] | None = None) -> DataFrame:
    """AGG18: one row of series' last values under new names, and the difference of two of them."""
    last = {n: F.max_by(F.when((F.col(key) == s) & F.col(value).isNotNull(), F.col(value)), F.when((F.col(key) == s) & F.col(value).isNotNull(), F.col(date))) for n, s in wanted.items()}
    row = panel.agg(*(c.alias(n) for n, c in last.items()))
    return row if spread is None else row.withColumn(spread[0], F.col(spread[1]) - F.col(spread[2]))


def histogram(df: DataFrame, key: Names, value: str, bins: int = 40) -> DataFrame:
    """AGG19: rows in each of `bins` equal intervals from least to greatest value; the greatest is in the last."""
    keys = names(key)
    ends = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_ = F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("_lo")) / width).cast("int")))
    return df.where(F.col(value).isNotNull()).join(ends, keys).groupBy(*keys, bin_.alias("bin")).agg(F.count("*").alias("rows"))


def scorecard(rounds: DataFrame, as_of: Column, windows: dict[str, int]) -> DataFrame:
    """AGG20: each segment's companies, rounds, capital and median size in trailing windows of days, and the change of capital against the window before."""
    spans = F.array(*(F.struct(F.lit(n).alias("window"), F.lit(d).alias("days")) for n, d in windows.items()))
    age = F.datediff(as_of, F.col("announced_on"))
    aged = rounds.withColumn("_age", age).where(F.col("_age") >= 0).withColumn("_w", F.explode(spans)).where(F.col("_age") < 2 * F.col("_w.days"))
    now = F.col("_age") < F.col("_w.days")
    aged = aged.withColumns({"window": F.col("_w.window"), "_now": F.when(now, F.col("money"))})
    medians = percentiles(aged, ["segment", "window"], "_now", [0.5])
    out = aged.groupBy("segment", "window").agg(
        F.count_distinct(F.when(now, F.col("org_uuid"))).alias("company_count"),
        F.count_if(now).alias("new_round_count"),
        F.coalesce(F.sum(F.when(now, F.col("money"))), F.lit(0.0)).alias("capital_raised"),
        F.coalesce(F.sum(F.when(~now, F.col("money"))), F.lit(0.0)).alias("_before"),
    )
    out = null_safe_join(out, medians, ["segment", "window"], "left").withColumn("median_round_size", F.col("quantiles")[0])
    return out.withColumn("momentum_pct", pct_change(F.col("capital_raised"), F.col("_before"))).drop("_before", "quantiles")


def top_values(rounds: DataFrame, by: str, value: str, n: int = 3) -> DataFrame:
    """AGG20: the values with most rounds in each segment; ties go to the smaller value."""
    counted = rounds.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("rounds"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("rounds"), value))
    return counted.withColumn("place", place).where(F.col("place") <= n)


def stage_mix(rounds: DataFrame, stages: list[str]) -> DataFrame:
    """AGG21: rounds of each segment by stage."""
    return rounds.groupBy("segment").pivot("stage", stages).agg(F.count(F.lit(1))).na.fill(0)
