"""Queries over grouped summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numeric import fixed
from tidemark.operators import aggregates as agg
from tidemark.operators import briefing, sketches
from tidemark.plans.catalog import ARTICLES, DAILY, PANEL, ROUNDS, STATION, articles, daily, panel, query, r4, rounds, station, table

CLIMATE = (
    "city AS (SELECT region, state, city, CAST(date_trunc('month', date) AS DATE) AS month, avg(mean_temp) AS temp_mean, sum(greatest(65 - mean_temp, 0)) AS hdd, sum(greatest(mean_temp - 65, 0)) AS cdd, count(mean_temp) AS day_count, "
    "sum(precip) AS precip_total, count(*) FILTER (WHERE precip > 0.01) AS precip_days, count(*) FILTER (WHERE precip > 1) AS extreme_precip_days, sum(snow_depth) AS snow_total, count(*) FILTER (WHERE max_temp > 90) AS extreme_heat_days, "
    "count(*) FILTER (WHERE min_temp < 32) AS extreme_cold_days, avg(wind_speed) AS wind_mean, avg(cloud_cover) AS cloud_cover_mean FROM station GROUP BY 1, 2, 3, 4 HAVING count(mean_temp) >= 2)"
)
FLOATS = ["temp_mean", "hdd", "cdd", "precip_total", "snow_total", "wind_mean", "cloud_cover_mean"]
COUNTS = ["day_count", "precip_days", "extreme_precip_days", "extreme_heat_days", "extreme_cold_days"]
MEASURES = ["temp_mean", "hdd", "cdd"]
STATE = f"{STATION}, {CLIMATE}, state AS (SELECT region, state, month, avg(temp_mean) AS temp_mean, avg(hdd) AS hdd, avg(cdd) AS cdd, count(DISTINCT city) AS city_count FROM city GROUP BY 1, 2, 3 HAVING count(DISTINCT city) >= 2)"


def out(df, columns=MEASURES):
    return df.withColumns({c: fixed(F.col(c)) for c in columns})


def city(spark, sf):
    return agg.climate_monthly(station(spark, sf), ["region", "state", "city"], least_days=2)


def state(spark, sf):
    return agg.state_monthly(city(spark, sf), MEASURES)


def levels(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    regions = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("state"), F.col("r_name").alias("region"))
    return agg.geography_levels(state(spark, sf), regions, MEASURES)


@query("agg1_climate_monthly", f"WITH {STATION}, {CLIMATE} SELECT region, state, city, month, {', '.join(COUNTS)}, {', '.join(f'{r4(c)} AS {c}' for c in FLOATS)} FROM city", days=("month",))
def agg1(spark, sf):
    return out(city(spark, sf), FLOATS)


@query("agg2_state_monthly", f"WITH {STATE} SELECT state, month, city_count, {', '.join(f'{r4(c)} AS {c}' for c in MEASURES)} FROM state", days=("month",))
def agg2(spark, sf):
    return out(state(spark, sf))


def level_sql(level: str) -> str:
    return f"SELECT {level} AS level, month, avg(temp_mean) AS temp_mean, avg(hdd) AS hdd, avg(cdd) AS cdd, count(DISTINCT state) AS state_count, (SELECT count(DISTINCT state) FROM state s2 WHERE {'s2.region = state.region' if level == 'region' else 'TRUE'}) AS n FROM state GROUP BY {'region, ' if level == 'region' else ''}month"


def levels_sql(level: str) -> str:
    return f"WITH {STATE}, l AS ({level_sql(level)}) SELECT level, month, state_count, {', '.join(f'{r4(c)} AS {c}' for c in MEASURES)} FROM l WHERE state_count >= greatest(1, n // 2)"


@query("agg3_region_monthly", levels_sql("region"), days=("month",))
def agg3(spark, sf):
    return out(levels(spark, sf).where("level <> 'national'"))


@query("agg4_national_monthly", levels_sql("'national'"), days=("month",))
def agg4(spark, sf):
    return out(levels(spark, sf).where("level = 'national'"))


@query(
    "agg5_temperature_anomaly",
    f"WITH {STATE}, y AS (SELECT * FROM state WHERE year(month) BETWEEN 1995 AND 1999), ok AS (SELECT state FROM y GROUP BY 1 HAVING count(DISTINCT year(month)) >= 4), b AS (SELECT state, month(month) AS moy, avg(temp_mean) AS base FROM y WHERE state IN (FROM ok) GROUP BY 1, 2) SELECT s.state, s.month, {r4('temp_mean - base')} AS anomaly FROM state s LEFT JOIN b ON b.state = s.state AND b.moy = month(s.month)",
    days=("month",)
)
def agg5(spark, sf):
    return out(agg.anomaly(state(spark, sf), "state", "temp_mean", 1995, 1999, 4).select("state", "month", "anomaly"), ["anomaly"])


@query("ind8_climate_cross_features", f"WITH {STATION}, {CLIMATE}, n AS (SELECT state, month, sum(hdd) AS hdd, sum(precip_total) AS precip, sum(cdd) AS cdd, avg(wind_mean) AS wind FROM city GROUP BY 1, 2), g AS (SELECT *, lag(hdd) OVER w * lag(precip) OVER w AS hp, lag(cdd) OVER w * lag(wind) OVER w AS cw FROM n WINDOW w AS (PARTITION BY state ORDER BY month)) SELECT state, month, {r4('hp', 2)} AS hdd_precip, {r4('cw', 2)} AS cdd_wind FROM g", days=("month",))
def ind8(spark, sf):
    from tidemark.operators.align import ordered

    n = city(spark, sf).groupBy("state", "month").agg(F.sum("hdd").alias("hdd"), F.sum("precip_total").alias("precip"), F.sum("cdd").alias("cdd"), F.avg("wind_mean").alias("wind"))
    lag = lambda c: F.lag(c).over(ordered("state", "month"))
    return n.select("state", "month", fixed(lag("hdd") * lag("precip"), 2).alias("hdd_precip"), fixed(lag("cdd") * lag("wind"), 2).alias("cdd_wind"))


VC = "count(DISTINCT org_uuid) AS company_count, count(*) AS round_count, round(sum(money) + 1e-9, 2) AS capital_raised, round(median(money) + 1e-9, 2) AS median_round_size, CAST(sum(lead) AS BIGINT) AS lead_investor_count"


def vc(df):
    return df.withColumns({c: fixed(F.col(c), 2) for c in ("capital_raised", "median_round_size")})


@query("agg6_vc_segment_metrics", f"WITH {ROUNDS} SELECT segment, CAST(date_trunc('week', announced_on) AS DATE) AS week, {VC} FROM rounds GROUP BY 1, 2", days=("week",))
def agg6(spark, sf):
    from tidemark.functions.dates import week_monday

    return vc(agg.funding_metrics(rounds(spark, sf).withColumn("week", week_monday(F.col("announced_on"))), ["segment", "week"]))


@query("jn11_round_segment_mapping", f"WITH {ROUNDS}, m AS (SELECT DISTINCT org_uuid, segment FROM rounds UNION SELECT o_custkey, p_brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) SELECT m.segment, count(*) AS round_count, round(sum(money), 2) AS capital FROM rounds r JOIN m ON r.org_uuid = m.org_uuid GROUP BY 1")
def jn11(spark, sf):
    r = rounds(spark, sf)
    o, li, p = table(spark, sf, "orders"), table(spark, sf, "lineitem"), table(spark, sf, "part")
    bought = o.join(li, o.o_orderkey == li.l_orderkey).join(p, li.l_partkey == p.p_partkey).select(F.col("o_custkey").alias("org_uuid"), F.col("p_brand").alias("segment"))
    mapping = r.select("org_uuid", "segment").union(bought).distinct()
    return r.drop("segment").join(mapping, "org_uuid").groupBy("segment").agg(F.count("*").alias("round_count"), F.round(F.sum("money"), 2).alias("capital"))


LANGS = ["en", "de", "fr", "es"]
NEWS = ", ".join(f"count(*) FILTER (WHERE sector = '{s}') AS volume_{s}, {r4(f"coalesce(avg(sentiment) FILTER (WHERE sector = '{s}'), 0)")} AS sentiment_{s}" for s in LANGS)


@query("agg7_news_monthly_metrics", f"WITH {ARTICLES} SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS volume, {NEWS} FROM articles GROUP BY 1", days=("month",))
def agg7(spark, sf):
    return out(agg.news_monthly(articles(spark, sf), "day", LANGS), [f"sentiment_{s}" for s in LANGS])


@query("agg8_sector_mood", f"WITH {ARTICLES} SELECT sector, {r4('avg(sentiment)', 3)} AS mood FROM articles WHERE sentiment IS NOT NULL AND sector <> '' GROUP BY 1")
def agg8(spark, sf):
    return agg.sector_mood(articles(spark, sf))


@query("agg9_tag_volume", f"WITH {ARTICLES} SELECT macro_tag, count(*) AS articles FROM articles WHERE macro_tag IS NOT NULL GROUP BY 1 HAVING count(*) >= 3")
def agg9(spark, sf):
    return agg.tag_volume(articles(spark, sf))


SPIKE = (
    "dc AS (SELECT sector, day, CAST(count(*) AS DOUBLE) AS n FROM articles GROUP BY 1, 2), ds AS (SELECT sector, avg(n) AS mu, stddev_pop(n) AS sd, arg_max(n, day) AS last FROM dc GROUP BY 1), "
    f"spikes AS (SELECT sector, {r4('CASE WHEN (SELECT count(DISTINCT day) FROM articles) < 7 OR sd = 0 THEN 0.5 ELSE least(greatest(0.5 + 0.5 * least((last - mu) / sd, 3) / 3, 0), 1) END')} AS spike FROM ds)"
)


@query("agg10_sector_volume_spike", f"WITH {ARTICLES}, {SPIKE} SELECT sector, spike FROM spikes")
def agg10(spark, sf):
    return agg.volume_spike(articles(spark, sf), "sector", "day")


@query("agg12_cold_start_gate", f"WITH {ARTICLES} SELECT count(DISTINCT day) < 30 AS cold_start, count(DISTINCT day) AS days_collected, 30 AS min_required FROM articles")
def agg12(spark, sf):
    return agg.cold_start(articles(spark, sf), "day")


@query("agg13_clip_bounds", f"WITH {PANEL}, q AS (SELECT series_id, quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM panel GROUP BY 1) SELECT series_id, {r4('a - (b - a) * 0.1')} AS lo, {r4('b + (b - a) * 0.1')} AS hi FROM q")
def agg13(spark, sf):
    return out(agg.clip_bounds(panel(spark, sf), "series_id", "value"), ["lo", "hi"])


@query("agg14_clip_bounds_volume", f"WITH n AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2), q AS (SELECT event_type, quantile_cont(n, 0.01) * 0.9 AS a, quantile_cont(n, 0.99) * 1.1 AS b FROM n GROUP BY 1) SELECT event_type, {r4('greatest(a, 0)')} AS lo, {r4('greatest(b, a + 1)')} AS hi FROM q")
def agg14(spark, sf):
    n = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return out(agg.clip_bounds_volume(n, "event_type", "n"), ["lo", "hi"])


@query("agg15_profile_series", f"WITH {DAILY} SELECT series_id, count(*) AS n, min(day) AS first, max(day) AS last, {r4('arg_max(value, day)')} AS latest FROM daily WHERE value IS NOT NULL GROUP BY 1", days=("first", "last"))
def agg15(spark, sf):
    return out(agg.profile(daily(spark, sf), "series_id", "day", "value"), ["latest"])


def month_summaries(spark, sf, df, date, since):
    """Summaries written in two runs: of all, then again of the months from `since` on."""
    from tidemark.plans.news import folder

    at = f"{folder(spark)}/summaries"
    sketches.refresh(df, at, "series_id", date, "value")
    sketches.refresh(df, at, "series_id", date, "value", since)
    return spark.read.parquet(at)


@query("agg13_clip_bounds_from_months", f"WITH {PANEL}, q AS (SELECT series_id, quantile_disc(value, 0.01) AS a, quantile_disc(value, 0.99) AS b FROM panel GROUP BY 1) SELECT series_id, {r4('a - (b - a) * 0.1')} AS lo, {r4('b + (b - a) * 0.1')} AS hi FROM q")
def agg13_months(spark, sf):
    return out(sketches.clip_bounds(month_summaries(spark, sf, panel(spark, sf), "month", "1998-01-01"), "series_id"), ["lo", "hi"])


@query("agg15_profile_from_months", f"WITH {DAILY} SELECT series_id, count(*) AS n, min(day) AS first, max(day) AS last, {r4('arg_max(value, day)')} AS latest FROM daily WHERE value IS NOT NULL GROUP BY 1", days=("first", "last"))
def agg15_months(spark, sf):
    return out(sketches.profile(month_summaries(spark, sf, daily(spark, sf), "day", "2024-02-01"), "series_id"), ["latest"])


@query("agg19_history_distribution_from_months")
def agg19_months(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("value"))
    return sketches.histogram(month_summaries(spark, sf, o, "day", "1998-01-01"), "series_id")


RUNS = "runs AS (SELECT event_type || '/' || user_id AS source, CASE WHEN event_type = 'error' OR value < 1 THEN 'error' ELSE 'ok' END AS status, 'code ' || props AS error, event_id AS seq FROM events)"
STATUS = (
    "p AS (SELECT split_part(source, '/', 1) AS prefix, count(*) FILTER (WHERE status = 'ok') AS n_ok, count(*) FILTER (WHERE status <> 'ok') AS n_error, left(arg_min(error, seq) FILTER (WHERE status <> 'ok' AND error IS NOT NULL AND error <> ''), 70) AS first_error FROM runs GROUP BY 1), "
    "st AS (SELECT *, CASE WHEN n_error = 0 THEN 'OK' WHEN n_ok = 0 THEN 'FAILED' ELSE 'PARTIAL (' || n_ok || '/' || (n_ok + n_error) || ' ok)' END AS state FROM p)"
)


def runs(spark, sf):
    e = table(spark, sf, "events")
    bad = (F.col("event_type") == "error") | (F.col("value") < 1)
    return e.select(F.concat("event_type", F.lit("/"), F.col("user_id").cast("string")).alias("source"), F.when(bad, "error").otherwise("ok").alias("status"), F.concat(F.lit("code "), "props").alias("error"), F.col("event_id").alias("seq"))


@query("agg16_refresh_status_rollup", f"WITH {RUNS}, {STATUS} SELECT prefix, n_ok, n_error, first_error, state FROM st")
def agg16(spark, sf):
    return agg.refresh_status(runs(spark, sf))


@query("vw11_pipeline_status", f"WITH {RUNS}, {STATUS} SELECT 'Sector data: ' || prefix AS component, state AS status, n_ok || ' ok, ' || n_error || ' errors' || CASE WHEN coalesce(first_error, '') <> '' THEN ' — ' || first_error ELSE '' END AS detail FROM st")
def vw11(spark, sf):
    from tidemark.operators.views import pipeline_status

    return pipeline_status(agg.refresh_status(runs(spark, sf)))


@query(
    "agg17_validation_metrics",
    f"WITH {PANEL}, p AS (SELECT series_id, value, lag(value, 12) OVER (PARTITION BY series_id ORDER BY month) AS guess FROM panel), m AS (SELECT series_id, count(*) AS n, avg(abs(value - guess)) AS mae, avg((value - guess) ** 2) AS mse, var_pop(value) AS v FROM p WHERE guess IS NOT NULL GROUP BY 1) SELECT series_id, n, {r4('mae')} AS mae, {r4('sqrt(mse)')} AS rmse, {r4('1 - mse / nullif(v, 0)')} AS r2 FROM m WHERE n > 1",
)
def agg17(spark, sf):
    from tidemark.operators.align import ordered

    p = panel(spark, sf).withColumn("guess", F.lag("value", 12).over(ordered("series_id", "month")))
    return agg.validation_metrics(p, "series_id", "value", "guess")


@query("agg18_market_snapshot", f"WITH {PANEL}, l AS (SELECT series_id, arg_max(value, month) AS v FROM panel GROUP BY 1) SELECT {r4("max(v) FILTER (WHERE series_id = '1-URGENT')")} AS vix, {r4("max(v) FILTER (WHERE series_id = '2-HIGH')")} AS long_rate, {r4("max(v) FILTER (WHERE series_id = '5-LOW')")} AS short_rate, {r4("max(v) FILTER (WHERE series_id = '2-HIGH') - max(v) FILTER (WHERE series_id = '5-LOW')")} AS slope FROM l")
def agg18(spark, sf):
    return out(agg.snapshot(panel(spark, sf), "series_id", "month", "value", {"vix": "1-URGENT", "long_rate": "2-HIGH", "short_rate": "5-LOW"}, ("slope", "long_rate", "short_rate")), ["vix", "long_rate", "short_rate", "slope"])


@query("agg19_history_distribution", "WITH e AS (SELECT o_orderpriority AS p, o_totalprice AS v FROM orders), b AS (SELECT p, min(v) AS lo, max(v) AS hi FROM e GROUP BY 1) SELECT p AS series_id, CASE WHEN lo = hi THEN 0 ELSE least(39, CAST(floor((v - lo) / ((hi - lo) / 40)) AS INTEGER)) END AS bin, count(*) AS rows FROM e JOIN b USING (p) GROUP BY 1, 2")
def agg19(spark, sf):
    return agg.histogram(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("series_id"), F.col("o_totalprice").alias("v")), "series_id", "v")


WINDOWS = {"30d": 30, "90d": 90, "180d": 180, "365d": 365}


@query(
    "agg20_segment_scorecard",
    f"WITH {ROUNDS}, w AS (SELECT * FROM (VALUES ('30d', 30), ('90d', 90), ('180d', 180), ('365d', 365)) AS t(win, days)), a AS (SELECT *, DATE '2001-08-01' - announced_on AS age FROM rounds), j AS (SELECT * FROM a JOIN w ON age >= 0 AND age < 2 * days), "
    f"s AS (SELECT segment, win, count(DISTINCT org_uuid) FILTER (WHERE age < days) AS company_count, count(*) FILTER (WHERE age < days) AS new_round_count, coalesce(sum(money) FILTER (WHERE age < days), 0) AS c, median(money) FILTER (WHERE age < days) AS m, coalesce(sum(money) FILTER (WHERE age >= days), 0) AS b FROM j GROUP BY 1, 2) "
    f'SELECT segment, win AS "window", company_count, new_round_count, round(c + 1e-9, 2) AS capital_raised, round(m + 1e-9, 2) AS median_round_size, {r4("(c - b) / nullif(b, 0) * 100")} AS momentum_pct FROM s',
)
def agg20(spark, sf):
    s = agg.scorecard(rounds(spark, sf), F.lit("2001-08-01").cast("date"), WINDOWS)
    return out(vc(s), ["momentum_pct"])


@query("agg20_top_geographies", f"WITH {ROUNDS}, c AS (SELECT segment, geography, count(*) AS rounds FROM rounds GROUP BY 1, 2), n AS (SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY rounds DESC, geography) AS INTEGER) AS place FROM c) SELECT segment, geography, rounds, place FROM n WHERE place <= 3")
def agg20_top(spark, sf):
    return agg.top_values(rounds(spark, sf), "segment", "geography")


STAGES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("agg21_stage_mix", f"WITH {ROUNDS} SELECT segment, " + ", ".join(f"count(*) FILTER (WHERE stage = '{s}') AS stage_{i}" for i, s in enumerate(STAGES)) + " FROM rounds GROUP BY 1")
def agg21(spark, sf):
    return agg.stage_mix(rounds(spark, sf), STAGES).select("segment", *(F.col(f"`{s}`").alias(f"stage_{i}") for i, s in enumerate(STAGES)))


@query("top8_recent_rounds", f"WITH {ROUNDS}, n AS (SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY announced_on DESC, round_uuid) AS INTEGER) AS place FROM rounds) SELECT segment, place, round_uuid FROM n WHERE place <= 500")
def top8(spark, sf):
    return briefing.top_n(rounds(spark, sf), ["segment"], [F.desc("announced_on"), F.asc("round_uuid")], 500).select("segment", "place", "round_uuid")


@query("top8_top_orgs", "WITH n AS (SELECT c_mktsegment AS segment, c_custkey, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS INTEGER) AS place FROM customer) SELECT segment, place, c_custkey FROM n WHERE place <= 200")
def top8_orgs(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "segment")
    return briefing.top_n(c, ["segment"], [F.asc("c_acctbal"), F.asc("c_custkey")], 200).select("segment", "place", "c_custkey")


@query("flt12_membership_filter", "WITH f AS (SELECT s_nationkey AS k, min(s_suppkey) AS first FROM supplier WHERE s_acctbal > 0 AND s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY first, k) AS place FROM f) SELECT CAST(k AS INTEGER) AS s_nationkey FROM n WHERE place <= 83")
def flt12(spark, sf):
    s = table(spark, sf, "supplier").where("s_acctbal > 0").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("first"))
    member = table(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"))
    kept = s.join(member, "s_nationkey", "left_semi").withColumn("all", F.lit(1))
    return briefing.top_n(kept, ["all"], [F.asc("first"), F.asc("s_nationkey")], 83).select("s_nationkey")
