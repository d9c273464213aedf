"""Queries over series: alignment, filters, joins, windows and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates, numeric, scoring
from tidemark.functions.numeric import fixed
from tidemark.operators import align, features, joins, scan
from tidemark.plans.catalog import DAILY, GAPPY, PANEL, daily, gappy, panel, query, r4, table

KEY = "series_id"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
END = "2001-12-01"


@query("cal1_month_start", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1", days=("month",))
def cal1(spark, sf):
    return table(spark, sf, "orders").groupBy(dates.month_start(F.to_date("o_orderdate")).alias("month")).agg(F.count("*").alias("n"))


@query("cal2_daily_to_monthly_mean", f"WITH {PANEL} SELECT series_id, month, {r4('value')} AS value FROM panel", days=("month",))
def cal2(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias(KEY), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"))
    return align.daily_to_monthly_mean(o, KEY).withColumn("value", fixed(F.col("value")))


@query("cal3_monthly_dedup_first", f"WITH {DAILY} SELECT series_id, CAST(date_trunc('month', day) AS DATE) AS month, {r4('arg_min(value, day)')} AS value FROM daily GROUP BY 1, 2", days=("month",))
def cal3(spark, sf):
    return align.monthly_first(daily(spark, sf), KEY, "day").withColumn("value", fixed(F.col("value")))


CHANGES = "changes AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value FROM orders WHERE o_totalprice > 400000 GROUP BY 1, 2)"
STEP_SQL = """
m AS (SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS month, arg_max(value, date) AS value FROM {0} GROUP BY 1, 2),
spine AS (SELECT series_id, CAST(unnest(generate_series(min(month), DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS month FROM m GROUP BY 1)
SELECT series_id, month, round(last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY month) + 1e-9, 4) AS value FROM spine LEFT JOIN m USING (series_id, month)
"""


@query("cal4_event_to_monthly_last", f"WITH {CHANGES}, " + STEP_SQL.format("changes"), days=("month",))
def cal4(spark, sf):
    o = table(spark, sf, "orders").where("o_totalprice > 400000")
    changes = o.groupBy(F.col("o_orderpriority").alias(KEY), F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("value"))
    return align.changes_to_monthly(changes, KEY, F.lit(END).cast("date")).withColumn("value", fixed(F.col("value")))


def lines(spark, sf, unit: str):
    day = F.to_date(F.date_trunc(unit, F.col("l_shipdate")))
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias(KEY), day.alias("date")).agg(F.avg("l_quantity").alias("value"))


def lines_sql(unit: str) -> str:
    return f"s AS (SELECT l_returnflag AS series_id, CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS date, avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"


@query("cal5_quarterly_to_monthly_ffill", f"WITH {lines_sql('quarter')}, " + STEP_SQL.format("s"), days=("month",))
def cal5(spark, sf):
    return align.sparse_to_monthly(lines(spark, sf, "quarter"), KEY, F.lit(END).cast("date")).withColumn("value", fixed(F.col("value")))


@query("cal6_annual_to_monthly_ffill", f"WITH {lines_sql('year')}, " + STEP_SQL.format("s"), days=("month",))
def cal6(spark, sf):
    return align.sparse_to_monthly(lines(spark, sf, "year"), KEY, F.lit(END).cast("date")).withColumn("value", fixed(F.col("value")))


WEEKS = "weeks AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS date, avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS a, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS b FROM orders GROUP BY 1, 2)"


@query(
    "cal7_weekly_to_monthly_last",
    f"WITH {WEEKS} SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS month, {r4('arg_max(a, date) FILTER (WHERE a IS NOT NULL)')} AS a, {r4('arg_max(b, date) FILTER (WHERE b IS NOT NULL)')} AS b FROM weeks GROUP BY 1, 2 HAVING count(a) + count(b) > 0",
    days=("month",)
)
def cal7(spark, sf):
    o = table(spark, sf, "orders")
    price = lambda s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))
    w = o.groupBy(F.col("o_orderpriority").alias(KEY), dates.week_monday(F.col("o_orderdate")).alias("date")).agg(F.avg(price("P")).alias("a"), F.max(price("F")).alias("b"))
    return align.monthly_last_valid(w, KEY, ["a", "b"]).withColumns({c: fixed(F.col(c)) for c in ("a", "b")})


@query("cal8_week_monday", "SELECT CAST(date_trunc('week', ts) AS DATE) AS monday, count(*) AS n FROM events GROUP BY 1", days=("monday",))
def cal8(spark, sf):
    return table(spark, sf, "events").groupBy(dates.week_monday(F.col("ts")).alias("monday")).agg(F.count("*").alias("n"))


@query("cal9_month_spine", "SELECT o_orderpriority AS series_id, CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS month FROM orders GROUP BY 1", days=("month",))
def cal9(spark, sf):
    b = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias(KEY)).agg(F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last"))
    return align.month_spine(b, KEY)


@query("cal10_ffill", f"WITH {GAPPY} SELECT series_id, month, {r4('last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY month)')} AS value FROM gappy", days=("month",))
def cal10(spark, sf):
    return rounded(scan.carried(gappy(spark, sf), KEY, "month", "value"), ["value"])


@query("cal11_ffill_limit", f"WITH {GAPPY} SELECT series_id, month, {r4('last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY month ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)')} AS value FROM gappy", days=("month",))
def cal11(spark, sf):
    return rounded(scan.carried(gappy(spark, sf), KEY, "month", "value", 3), ["value"])


@query(
    "cal12_interpolate_linear_limit",
    f"""WITH {GAPPY}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month) AS n FROM gappy),
e AS (SELECT *, last_value(value IGNORE NULLS) OVER b AS lv, first_value(value IGNORE NULLS) OVER a AS rv, max(CASE WHEN value IS NOT NULL THEN n END) OVER b AS ln, min(CASE WHEN value IS NOT NULL THEN n END) OVER a AS rn FROM r
 WINDOW b AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT series_id, month, {r4("CASE WHEN value IS NOT NULL THEN value WHEN n - ln > 2 OR ln IS NULL THEN NULL WHEN rv IS NULL THEN lv ELSE lv + (rv - lv) * (n - ln) / (rn - ln) END")} AS value FROM e""",
    days=("month",)
)
def cal12(spark, sf):
    return rounded(scan.interpolated(gappy(spark, sf), KEY, "month", "value", 2), ["value"])


@query("cal13_snapshot_rows_dated", "SELECT c_custkey, CAST(date_trunc('week', max(o_orderdate)) AS DATE) AS observation_date FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1", days=("observation_date",))
def cal13(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    j = c.join(o, c.c_custkey == o.o_custkey).groupBy("c_custkey").agg(F.max("o_orderdate").alias("day"))
    return align.stamped(j, F.col("day")).select("c_custkey", "observation_date")


FEATURE_COLUMNS = ["lag1", "lag2", "lag3", "lag6", "lag12", "roll3_mean", "roll3_std", "roll6_mean", "roll6_std", "roll12_mean", "roll12_std", "mom", "yoy"]


def feature_sql(source: str, relation: str) -> str:
    roll = ", ".join(
        f"CASE WHEN count(value) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) >= {max(1, n // 2)} THEN {fn}(value) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END AS roll{n}_{name}"
        for n in (3, 6, 12)
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"))
    )
    lag = ", ".join(f"lag(value, {k}) OVER w AS lag{k}" for k in (1, 2, 3, 6, 12))
    return (
        f"{source}, f AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY month) AS filled FROM {relation}), "
        f"feats AS (SELECT series_id, month, value, {lag}, {roll}, (lag(filled, 1) OVER w - lag(filled, 2) OVER w) / nullif(lag(filled, 2) OVER w, 0) * 100 AS mom, "
        "(lag(filled, 1) OVER w - lag(filled, 13) OVER w) / nullif(lag(filled, 13) OVER w, 0) * 100 AS yoy, CAST(month(month) AS INTEGER) AS month_of_year, CAST(quarter(month) AS INTEGER) AS quarter FROM f WINDOW w AS (PARTITION BY series_id ORDER BY month))"
    )


FEATS = feature_sql(PANEL, "panel")


def rounded(df, columns):
    return df.withColumns({c: fixed(F.col(c)) for c in columns})


def feats(spark, sf):
    return features.engineer_features(panel(spark, sf), KEY)


@query("fc1_engineer_features", f"WITH {FEATS} SELECT series_id, month, month_of_year, quarter, {', '.join(f'{r4(c)} AS {c}' for c in ['value', *FEATURE_COLUMNS])} FROM feats", days=("month",))
def fc1(spark, sf):
    return rounded(feats(spark, sf), ["value", *FEATURE_COLUMNS])


@query("win1_lags", f"WITH {FEATS} SELECT series_id, month, {', '.join(f'{r4(c)} AS {c}' for c in FEATURE_COLUMNS[:5])} FROM feats", days=("month",))
def win1(spark, sf):
    return rounded(panel(spark, sf).withColumns(features.lags(KEY, "month", "value")).drop("value"), FEATURE_COLUMNS[:5])


@query("win2_rolling_mean_std", f"WITH {feature_sql(GAPPY, 'gappy')} SELECT series_id, month, {', '.join(f'{r4(c)} AS {c}' for c in FEATURE_COLUMNS[5:11])} FROM feats", days=("month",))
def win2(spark, sf):
    return rounded(gappy(spark, sf).withColumns(features.rolling(KEY, "month", "value")).drop("value"), FEATURE_COLUMNS[5:11])


FULL = ", ".join(f"round(CASE WHEN count(value) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) >= {n} THEN {fn}(value) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END + 1e-9, 4) AS roll{n}_{name}" for n in (3, 6, 12) for name, fn in (("mean", "avg"), ("std", "stddev_samp")))


@query("win3_rolling_mean_std_full", f"WITH {GAPPY} SELECT series_id, month, {FULL} FROM gappy WINDOW w AS (PARTITION BY series_id ORDER BY month)", days=("month",))
def win3(spark, sf):
    return rounded(gappy(spark, sf).withColumns(features.rolling(KEY, "month", "value", full=True)).drop("value"), FEATURE_COLUMNS[5:11])


@query("win4_momentum", f"WITH {feature_sql(GAPPY, 'gappy')} SELECT series_id, month, {r4('mom')} AS mom, {r4('yoy')} AS yoy FROM feats", days=("month",))
def win4(spark, sf):
    filled = gappy(spark, sf).withColumn("filled", align.ffill("value", KEY, "month"))
    return rounded(filled.withColumns(features.momentum(KEY, "month", "filled")).select(KEY, "month", "mom", "yoy"), ["mom", "yoy"])


SMA = ", ".join(f"CASE WHEN count(value) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {n} THEN avg(value) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END AS sma{n}" for n in (9, 20, 50))
CROSS = ", ".join(f"CASE WHEN sma{a} > sma{b} THEN 'Y' WHEN sma{a} IS NOT NULL AND sma{b} IS NOT NULL THEN 'N' END AS sma{a}_over_{b}" for a, b in ((9, 20), (9, 50), (20, 50)))


@query(
    "win5_sma_crossover",
    f"WITH d AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2), s AS (SELECT series_id, day, {SMA} FROM d WINDOW w AS (PARTITION BY series_id ORDER BY day)) SELECT series_id, day, {r4('sma9')} AS sma9, {r4('sma20')} AS sma20, {r4('sma50')} AS sma50, {CROSS} FROM s",
    days=("day",)
)
def win5(spark, sf):
    d = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias(KEY), F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("value"))
    return rounded(features.crossover(d, KEY, "day", "value").drop("value"), ["sma9", "sma20", "sma50"])


def rank_sql(sign: str = "1") -> str:
    return (
        f"v AS (SELECT series_id, month, value * {sign} AS value FROM panel), k AS (SELECT a.series_id, a.month, count(*) AS n, sum(CASE WHEN b.value < a.value THEN 1 ELSE 0 END) AS l, sum(CASE WHEN b.value = a.value THEN 1 ELSE 0 END) AS e "
        "FROM v a JOIN v b ON a.series_id = b.series_id AND b.month <= a.month GROUP BY 1, 2), ranks AS (SELECT series_id, month, CASE WHEN n >= 12 THEN (l + (e + 1) / 2.0) / n END AS pct_rank FROM k)"
    )


@query("win6_expanding_pct_rank", f"WITH {PANEL}, {rank_sql()} SELECT series_id, month, {r4('pct_rank')} AS pct_rank FROM ranks", days=("month",))
def win6(spark, sf):
    return rounded(features.expanding_pct_rank(panel(spark, sf), KEY, "month", "value").drop("value"), ["pct_rank"])


@query("win7_trend_spread", f"WITH {FEATS} SELECT series_id, month, {r4('roll3_mean - roll12_mean')} AS spread FROM feats", days=("month",))
def win7(spark, sf):
    return feats(spark, sf).select(KEY, "month", fixed(F.col("roll3_mean") - F.col("roll12_mean")).alias("spread"))


@query("win8_shift_with_default", f"WITH {PANEL} SELECT series_id, month, {r4('coalesce(lag(value, 3) OVER (PARTITION BY series_id ORDER BY month), value)')} AS before FROM panel", days=("month",))
def win8(spark, sf):
    return panel(spark, sf).select(KEY, "month", fixed(features.shift_with_default(KEY, "month", "value")).alias("before"))


@query(
    "win9_first_last_momentum",
    f"WITH {DAILY}, l AS (SELECT *, max(day) OVER (PARTITION BY series_id) AS last FROM daily), e AS (SELECT series_id, count(*) AS n, arg_min(value, day) AS a, arg_max(value, day) AS b FROM l WHERE value IS NOT NULL AND last - day < 35 GROUP BY 1) SELECT series_id, {r4('(b - a) / (abs(a) + 1e-9) * 100')} AS momentum FROM e WHERE n >= 2",
)
def win9(spark, sf):
    return rounded(features.trailing_momentum(daily(spark, sf), KEY, "day", "value"), ["momentum"])


SIGNS = {"1-URGENT": 1, "2-HIGH": 1, "3-MEDIUM": 1, "4-NOT SPECIFIED": 1, "5-LOW": -1}
FSI = f"{PANEL}, {rank_sql("CASE WHEN series_id = '5-LOW' THEN -1 ELSE 1 END")}, fsi AS (SELECT month, avg(pct_rank) AS fsi FROM ranks WHERE pct_rank IS NOT NULL GROUP BY 1)"
REGIME = "CASE WHEN fsi > 0.65 THEN 'stress' WHEN fsi > 0.45 AND fsi >= before THEN 'contraction' WHEN fsi > 0.45 THEN 'recovery' WHEN fsi > 0.25 THEN 'slowdown' WHEN fsi IS NOT NULL THEN 'expansion' END"
REGIMES = f"{FSI}, before AS (SELECT *, coalesce(lag(fsi, 3) OVER (ORDER BY month), fsi) AS before FROM fsi), regimes AS (SELECT month, fsi, {REGIME} AS regime FROM before)"


def index(spark, sf):
    return features.stress_index(panel(spark, sf), "month", KEY, "value", SIGNS)


@query("ind1_financial_stress_index", f"WITH {FSI} SELECT month, {r4('fsi')} AS fsi FROM fsi", days=("month",))
def ind1(spark, sf):
    return rounded(index(spark, sf), ["fsi"])


@query("ind2_classify_regime", f"WITH {REGIMES} SELECT month, regime FROM regimes", days=("month",))
def ind2(spark, sf):
    return features.regime_history(index(spark, sf), months=1_000_000).select("month", "regime")


@query("ind3_regime_history", f"WITH {REGIMES} SELECT month, {r4('fsi')} AS fsi, regime FROM regimes ORDER BY month DESC LIMIT 120", days=("month",))
def ind3(spark, sf):
    return rounded(features.regime_history(index(spark, sf)).select("month", "fsi", "regime"), ["fsi"])


@query(
    "win10_regime_spans",
    f"WITH {REGIMES}, c AS (SELECT *, CASE WHEN regime IS NOT DISTINCT FROM lag(regime) OVER (ORDER BY month) AND row_number() OVER (ORDER BY month) > 1 THEN 0 ELSE 1 END AS new FROM regimes), g AS (SELECT *, sum(new) OVER (ORDER BY month) AS run FROM c), s AS (SELECT run, any_value(regime) AS regime, min(month) AS start, count(*) AS rows FROM g GROUP BY run) SELECT regime, start, rows, lead(start) OVER (ORDER BY run) AS until FROM s",
    days=("start", "until")
)
def win10(spark, sf):
    h = features.regime_history(index(spark, sf)).withColumn("index", F.lit("FSI"))
    return scan.spans(h, "index", "month", "regime").select("regime", "start", "rows", "until")


@query("win11_last_valid", f"WITH {GAPPY} SELECT series_id, max(month) AS last_date, {r4('arg_max(value, month)')} AS last_value FROM gappy WHERE value IS NOT NULL GROUP BY 1", days=("last_date",))
def win11(spark, sf):
    return rounded(features.last_valid(gappy(spark, sf), KEY, "month", "value"), ["last_value"])


@query("agg11_regime_distribution", f"WITH {REGIMES} SELECT r AS regime, {r4('(SELECT count(*) FROM regimes WHERE regime = r) / (SELECT count(*) FROM regimes)')} AS share FROM unnest(['expansion', 'slowdown', 'contraction', 'recovery', 'stress']) AS t(r)")
def agg11(spark, sf):
    from tidemark.operators.aggregates import regime_distribution

    return regime_distribution(features.regime_history(index(spark, sf)))


LAG1 = f"{FEATS}, p AS (SELECT month, " + ", ".join(f"max(CASE WHEN series_id = '{s}' THEN lag1 END) AS s{i}" for i, s in enumerate(PRIORITIES)) + " FROM feats GROUP BY 1)"


def lag1_wide(spark, sf):
    f = panel(spark, sf).withColumns(features.lags(KEY, "month", "value", (1,)))
    return joins.outer_merge(f, "month", KEY, "lag1", PRIORITIES)


def col(i: int):
    return F.col(f"`{PRIORITIES[i]}`")


@query("ind4_curve_features", f"WITH {LAG1} SELECT month, {r4('s4 - s1')} AS slope, {r4('2 * s2 - s0 - s4')} AS curvature, {r4('s4 - s0')} AS long_short, {r4('s1 - s0')} AS front FROM p", days=("month",))
def ind4(spark, sf):
    parts = {"slope": col(4) - col(1), "curvature": 2 * col(2) - col(0) - col(4), "long_short": col(4) - col(0), "front": col(1) - col(0)}
    return lag1_wide(spark, sf).select("month", *(fixed(c).alias(n) for n, c in parts.items()))


@query("ind5_market_cross_features", f"WITH {LAG1} SELECT month, {r4('s1 - s2')} AS credit_gap, {r4('s0 / 1000 * s1 / 1000')} AS stress_cross, {r4('s3 / (s4 + 1e-9)')} AS ratio FROM p", days=("month",))
def ind5(spark, sf):
    return lag1_wide(spark, sf).select("month", fixed(col(1) - col(2)).alias("credit_gap"), fixed(col(0) / 1000 * col(1) / 1000).alias("stress_cross"), fixed(col(3) / (col(4) + 1e-9)).alias("ratio"))


@query("ind6_risk_cross_features", f"WITH {LAG1} SELECT month, {r4('s0 / 1000 * s1 / 1000')} AS cross, {r4('s1 / (s0 + 1)')} AS ratio FROM p", days=("month",))
def ind6(spark, sf):
    return lag1_wide(spark, sf).select("month", fixed(col(0) / 1000 * col(1) / 1000).alias("cross"), fixed(col(1) / (col(0) + 1)).alias("ratio"))


@query("ind7_pair_cross", f"WITH {LAG1} SELECT month, round(s0 * s1, 0) AS cross FROM p", days=("month",))
def ind7(spark, sf):
    f = feats(spark, sf).withColumn("all", F.lit("all"))
    return features.pair_cross(f, "all", KEY, "month", (PRIORITIES[0], PRIORITIES[1])).select("month", F.round("cross", 0).alias("cross"))


@query("ind9_calendar_features", "SELECT CAST(month(o_orderdate) AS INTEGER) AS month_of_year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, count(*) AS n FROM orders GROUP BY 1, 2")
def ind9(spark, sf):
    return table(spark, sf, "orders").groupBy(F.month("o_orderdate").alias("month_of_year"), F.quarter("o_orderdate").alias("quarter")).agg(F.count("*").alias("n"))


@query("ind10_cyclical_month", f"WITH {FEATS} SELECT series_id, month, {r4('sin(2 * pi() * month(month) / 12)')} AS month_sin, {r4('cos(2 * pi() * month(month) / 12)')} AS month_cos FROM feats", days=("month",))
def ind10(spark, sf):
    return rounded(features.seasonal_features(feats(spark, sf)).select(KEY, "month", "month_sin", "month_cos"), ["month_sin", "month_cos"])


@query("fc2_engineer_weather_features", f"WITH {FEATS} SELECT series_id, month, {r4('sin(2 * pi() * month(month) / 12)')} AS month_sin, {r4('cos(2 * pi() * month(month) / 12)')} AS month_cos, {', '.join(f'{r4(c)} AS {c}' for c in ['value', *FEATURE_COLUMNS])} FROM feats", days=("month",))
def fc2(spark, sf):
    return rounded(features.seasonal_features(feats(spark, sf)), ["value", *FEATURE_COLUMNS, "month_sin", "month_cos"])


@query("ind11_signal_flags", f"WITH {LAG1} SELECT month, (s4 - s1) / 10000 < 0 AS curve_inverted, (s4 - s1) / 10000 < -0.5 AS deep_inversion, s0 / 10000 > 20 AS recession_high, s2 > lag(s2, 3) OVER (ORDER BY month) AS rate_rising FROM p", days=("month",))
def ind11(spark, sf):
    w = lag1_wide(spark, sf).withColumn("all", F.lit(1))
    before = F.lag(col(2), 3).over(align.ordered("all", "month"))
    return w.select("month", *(c.alias(n) for n, c in scoring.signal_flags((col(4) - col(1)) / 10000, col(0) / 10000, col(2), before).items()))


MOON = "CAST(floor(((date_diff('second', TIMESTAMP '2001-01-01', ts) / 86400.0 * 0.03386319269 + 0.20439731) % 1) * 8 + 0.5) AS INTEGER) & 7"


@query("ind12_moon_phase", f"SELECT ['New Moon', 'Waxing Crescent', 'First Quarter', 'Waxing Gibbous', 'Full Moon', 'Waning Gibbous', 'Last Quarter', 'Waning Crescent'][({MOON}) + 1] AS phase, count(*) AS n FROM events GROUP BY 1")
def ind12(spark, sf):
    return table(spark, sf, "events").groupBy(dates.moon_phase(F.col("ts")).alias("phase")).agg(F.count("*").alias("n"))


@query("ind23_threshold_breach", f"WITH {PANEL}, l AS (SELECT series_id, arg_max(value, month) AS v FROM panel GROUP BY 1), d AS (SELECT series_id, avg(value) AS thr FROM panel GROUP BY 1) SELECT series_id, CASE WHEN series_id < '3' THEN v > thr ELSE v < thr END AS breached FROM l JOIN d USING (series_id)")
def ind23(spark, sf):
    p = panel(spark, sf)
    dim = p.groupBy(KEY).agg(F.avg("value").alias("threshold")).withColumn("rule", F.when(F.col(KEY) < "3", "above").otherwise("below"))
    return joins.dimension(features.last_valid(p, KEY, "month", "value"), dim, KEY).select(KEY, scoring.breach(F.col("last_value"), F.col("threshold"), F.col("rule")).alias("breached"))


# Filters


@query("flt1_drop_any_null", f"WITH {FEATS} SELECT series_id, count(*) AS n FROM feats WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURE_COLUMNS)} GROUP BY 1")
def flt1(spark, sf):
    return feats(spark, sf).dropna("any", subset=FEATURE_COLUMNS).groupBy(KEY).agg(F.count("*").alias("n"))


@query("flt2_drop_all_null", f"WITH {FEATS} SELECT series_id, count(*) AS n FROM feats WHERE lag12 IS NOT NULL OR yoy IS NOT NULL GROUP BY 1")
def flt2(spark, sf):
    return feats(spark, sf).dropna("all", subset=["lag12", "yoy"]).groupBy(KEY).agg(F.count("*").alias("n"))


@query("flt3_min_non_null_threshold", f"WITH {GAPPY}, c AS (SELECT *, count(value) OVER (PARTITION BY month) AS k FROM gappy) SELECT series_id, month, {r4('value')} AS value FROM c WHERE k >= 3", days=("month",))
def flt3(spark, sf):
    g = gappy(spark, sf).withColumn("group_id", F.lit("orders"))
    return align.enough_series(g, "group_id", "month", "value", 5).select(KEY, "month", fixed(F.col("value")).alias("value"))


@query("flt4_series_min_rows", f"WITH {GAPPY} SELECT series_id, month, {r4('value')} AS value FROM gappy WHERE series_id IN (SELECT series_id FROM gappy GROUP BY 1 HAVING count(value) >= 40)", days=("month",))
def flt4(spark, sf):
    return rounded(align.enough_rows(gappy(spark, sf), KEY, "value", 40), ["value"])


@query("flt5_clip_window_fixed", f"WITH {PANEL} SELECT series_id, month, {r4('value')} AS value FROM panel WHERE month >= DATE '1996-01-01'", days=("month",))
def flt5(spark, sf):
    # On the day, before it is truncated, the filter reaches the scan.
    o = table(spark, sf, "orders").where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    days = o.select(F.col("o_orderpriority").alias(KEY), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"))
    return rounded(align.daily_to_monthly_mean(days, KEY), ["value"])


@query("flt6_clip_window_common_start", f"WITH {GAPPY}, s AS (SELECT max(f) AS s FROM (SELECT min(month) AS f FROM gappy WHERE value IS NOT NULL GROUP BY series_id)) SELECT series_id, month, {r4('value')} AS value FROM gappy, s WHERE month >= s", days=("month",))
def flt6(spark, sf):
    g = gappy(spark, sf).withColumn("group_id", F.lit("orders"))
    return rounded(align.from_common_start(g, "group_id", KEY, "month", "value").drop("group_id"), ["value"])


@query("flt7_clip_window_anchor", f"WITH {GAPPY} SELECT series_id, month, {r4('value')} AS value FROM gappy WHERE month >= (SELECT min(month) FROM gappy WHERE value IS NOT NULL AND series_id = '3-MEDIUM')", days=("month",))
def flt7(spark, sf):
    g = gappy(spark, sf).withColumn("group_id", F.lit("orders"))
    return rounded(align.from_anchor_start(g, "group_id", KEY, "3-MEDIUM", "month", "value").drop("group_id"), ["value"])


@query("flt8_drop_null_selected_features", f"WITH {FEATS} SELECT series_id, month, {r4('lag1')} AS lag1 FROM feats WHERE lag1 IS NOT NULL", days=("month",))
def flt8(spark, sf):
    return rounded(feats(spark, sf).dropna(subset=["lag1"]).select(KEY, "month", "lag1"), ["lag1"])


@query("flt9_date_prefix_filter", "SELECT event_id FROM events WHERE starts_with(strftime(ts, '%Y-%m-%d'), '2024-01-15')")
def flt9(spark, sf):
    return align.on_day(table(spark, sf, "events"), "ts", "2024-01-15").select("event_id")


@query("flt13_history_projection", f"WITH {GAPPY} SELECT strftime(month, '%Y-%m-%d') AS date, {r4('value', 6)} AS value FROM gappy WHERE series_id = '2-HIGH'")
def flt13(spark, sf):
    from tidemark.operators.views import series_history

    return series_history(gappy(spark, sf), "2-HIGH")


@query("flt14_lookback_window", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-29 12:00:00' - INTERVAL 168 HOUR AND ts <= TIMESTAMP '2024-01-29 12:00:00'")
def flt14(spark, sf):
    return align.lookback(table(spark, sf, "events"), "ts", F.lit("2024-01-29 12:00:00").cast("timestamp"), 168).select("event_id")


# Joins

WIDE = ", ".join(f"max(CASE WHEN series_id = '{s}' THEN value END) AS s{i}" for i, s in enumerate(PRIORITIES))


def renamed(df):
    return df.select("month", *(fixed(col(i)).alias(f"s{i}") for i in range(5)))


ROUND_WIDE = ", ".join(f"{r4(f's{i}')} AS s{i}" for i in range(5))


@query("jn1_outer_merge_series", f"WITH {GAPPY}, p AS (SELECT month, {WIDE} FROM gappy GROUP BY 1) SELECT month, {ROUND_WIDE} FROM p", days=("month",))
def jn1(spark, sf):
    return renamed(joins.outer_merge(gappy(spark, sf), "month", KEY, "value", PRIORITIES))


@query("jn2_inner_merge_series", f"WITH {GAPPY}, g AS (SELECT * FROM gappy WHERE value IS NOT NULL), p AS (SELECT month, {WIDE} FROM g GROUP BY 1 HAVING count(DISTINCT series_id) = 5) SELECT month, {ROUND_WIDE} FROM p", days=("month",))
def jn2(spark, sf):
    return renamed(joins.inner_merge(gappy(spark, sf).where("value IS NOT NULL"), "month", KEY, "value", PRIORITIES))


@query("jn3_mixed_merge", f"WITH {GAPPY}, m AS (SELECT month, value AS main FROM gappy WHERE series_id = '1-URGENT'), a AS (SELECT month, value AS aux FROM gappy WHERE series_id = '5-LOW' AND value IS NOT NULL) SELECT month, {r4('main')} AS main, {r4('aux')} AS aux FROM m LEFT JOIN a USING (month)", days=("month",))
def jn3(spark, sf):
    g = gappy(spark, sf)
    main = g.where("series_id = '1-URGENT'").select("month", F.col("value").alias("main"))
    aux = g.where("series_id = '5-LOW' AND value IS NOT NULL").select("month", F.col("value").alias("aux"))
    return rounded(joins.mixed_merge(main, aux, "month"), ["main", "aux"])


@query(
    "jn4_asof_backward",
    f"WITH r AS (SELECT user_id, ts, max(value) AS pv FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) SELECT e.event_id, {r4('r.pv')} AS last_purchase FROM events e ASOF LEFT JOIN r ON e.user_id = r.user_id AND e.ts >= r.ts",
)
def jn4(spark, sf):
    e = table(spark, sf, "events")
    right = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("pts"), F.col("value").alias("last_purchase"))
    return rounded(joins.asof_backward(e.select("event_id", "user_id", "ts"), right, "user_id", "ts", "pts", ["last_purchase"], 3 * 86_400).select("event_id", "last_purchase"), ["last_purchase"])


@query(
    "jn5_exact_merge_then_ffill",
    f"WITH w AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS price FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 3 GROUP BY 1), e AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem), d AS (SELECT day, last_value(price IGNORE NULLS) OVER (ORDER BY day) AS price FROM (SELECT DISTINCT day FROM e) LEFT JOIN w USING (day)) SELECT l_orderkey, l_linenumber, {r4('price')} AS price FROM e LEFT JOIN d USING (day)",
)
def jn5(spark, sf):
    o = table(spark, sf, "orders").where(F.dayofweek("o_orderdate").between(2, 4))
    prices = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("price"))
    e = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))
    return rounded(joins.exact_then_ffill(e, prices, "day", ["price"], ["l_orderkey", "l_linenumber"]).drop("day"), ["price"])


@query(
    "jn6_ticker_enrich",
    f"WITH p AS (SELECT upper(c_mktsegment) AS ticker, avg(c_acctbal) AS momentum, min(c_acctbal) AS low FROM customer GROUP BY 1), f AS (SELECT upper(c_mktsegment) AS ticker, max(c_acctbal) AS momentum FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING' GROUP BY 1) SELECT c_custkey, {r4('coalesce(f.momentum, p.momentum)')} AS momentum, {r4('low')} AS low FROM customer LEFT JOIN p ON upper(trim(c_mktsegment)) = p.ticker LEFT JOIN f ON upper(trim(c_mktsegment)) = f.ticker",
)
def jn6(spark, sf):
    c = table(spark, sf, "customer")
    by = c.withColumn("ticker", F.upper("c_mktsegment"))
    price = by.groupBy("ticker").agg(F.avg("c_acctbal").alias("momentum"), F.min("c_acctbal").alias("low"))
    fundamentals = by.where("c_acctbal > 0 AND c_mktsegment <> 'BUILDING'").groupBy("ticker").agg(F.max("c_acctbal").alias("momentum"))
    events = c.select("c_custkey", F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("ticker"))
    return rounded(joins.ticker_enrich(events, price, fundamentals, "ticker").select("c_custkey", "momentum", "low"), ["momentum", "low"])


@query("jn7_anti_existing", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def jn7(spark, sf):
    stored = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.not_stored(table(spark, sf, "customer"), stored, "c_custkey").select("c_custkey")


@query("jn8_series_without_model", f"WITH {PANEL}, {DAILY.replace('series_id', 'series_id')} SELECT DISTINCT series_id FROM daily WHERE series_id NOT IN (SELECT event_type FROM events WHERE value > 1e9) AND series_id NOT IN (SELECT series_id FROM panel)")
def jn8(spark, sf):
    models = panel(spark, sf).select(KEY)
    return joins.not_stored(daily(spark, sf).select(KEY).distinct(), models, KEY)


@query("jn9_dim_lookup", "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def jn9(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    dim = nation.join(table(spark, sf, "region"), "r_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return joins.dimension(table(spark, sf, "customer"), dim, "c_nationkey").select("c_custkey", "n_name", "r_name")


@query("jn10_baseline_by_calendar_month", f"WITH {PANEL}, b AS (SELECT series_id, month(month) AS moy, avg(value) AS baseline FROM panel GROUP BY 1, 2) SELECT series_id, month, {r4('value - baseline')} AS difference FROM panel JOIN b USING (series_id) WHERE b.moy = month(panel.month)", days=("month",))
def jn10(spark, sf):
    p = panel(spark, sf)
    base = p.groupBy(KEY, F.month("month").alias("moy")).agg(F.avg("value").alias("baseline"))
    return joins.by_calendar_month(p, base, KEY, F.month("month")).select(KEY, "month", fixed(F.col("value") - F.col("baseline")).alias("difference"))


@query("set1_union_sources", "SELECT kind, count(*) AS n FROM (SELECT 'customer' AS kind, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_name FROM supplier) GROUP BY 1")
def set1(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return c.unionByName(s).groupBy("kind").agg(F.count("*").alias("n"))


@query("set2_distinct_union", "SELECT n_name, min(k) AS place FROM (SELECT n_name, c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT n_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey) GROUP BY 1")
def set2(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", F.col("c_custkey").alias("place"))
    s = table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", F.col("s_suppkey").alias("place"))
    return joins.distinct_in_order(c.union(s), "n_name", "place")


@query("set3_difference_new", "SELECT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE url LIKE '%?%')")
def set3(spark, sf):
    p = table(spark, sf, "pages").select("url")
    return joins.not_stored(p, p.where(F.col("url").contains("?")), "url")


@query("ind21_clip_ordered_interval", f"WITH {PANEL}, {rank_sql()} SELECT series_id, month, {r4('least(greatest(pct_rank, 0.2), 0.8)')} AS mid, {r4('least(least(greatest(pct_rank - 0.3, 0.2), 0.8), least(greatest(pct_rank, 0.2), 0.8))')} AS lo, {r4('greatest(least(greatest(pct_rank + 0.3, 0.2), 0.8), least(greatest(pct_rank, 0.2), 0.8))')} AS hi FROM ranks WHERE pct_rank IS NOT NULL", days=("month",))
def ind21(spark, sf):
    r = features.expanding_pct_rank(panel(spark, sf), KEY, "month", "value").where("pct_rank IS NOT NULL")
    m, lo, hi = numeric.ordered_interval(F.col("pct_rank"), F.col("pct_rank") - 0.3, F.col("pct_rank") + 0.3, F.lit(0.2), F.lit(0.8))
    return rounded(r.select(KEY, "month", m.alias("mid"), lo.alias("lo"), hi.alias("hi")), ["mid", "lo", "hi"])
