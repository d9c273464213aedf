"""Queries of forecasts and of the views over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scoring
from tidemark.functions.numeric import fixed
from tidemark.operators import boosting, forecast, views
from tidemark.operators.briefing import top_n
from tidemark.operators.features import engineer_features
from tidemark.plans.catalog import ARTICLES, PANEL, articles, gappy, panel, query, r4, table
from tidemark.plans.news import cutter, folder
from tidemark.plans.series import FEATS, FSI, KEY, REGIME, feats, index
from tidemark.sources import files, sinks

TREND = (
    f"{PANEL}, x AS (SELECT series_id, month, year(month) * 12 + month(month) AS x, month(month) AS moy, value AS y FROM panel), line AS (SELECT series_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(month) AS last FROM x GROUP BY 1), "
    "res AS (SELECT x.*, y - a - b * x AS r FROM x JOIN line USING (series_id)), eff AS (SELECT series_id, moy, avg(r) AS e FROM res GROUP BY 1, 2), q AS (SELECT series_id, quantile_cont(r - e, 0.1) AS lo, quantile_cont(r - e, 0.9) AS hi FROM res JOIN eff USING (series_id, moy) GROUP BY 1), "
    "ahead AS (SELECT series_id, a, b, step, CAST(last + to_months(step) AS DATE) AS month FROM line, (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS step)), "
    "fc AS (SELECT a.series_id, a.month, step, a + b * (year(a.month) * 12 + month(a.month)) + coalesce(e, 0) AS mid, a + b * (year(a.month) * 12 + month(a.month)) + coalesce(e, 0) + q.lo AS lo, a + b * (year(a.month) * 12 + month(a.month)) + coalesce(e, 0) + q.hi AS hi "
    "FROM ahead a JOIN q USING (series_id) LEFT JOIN eff ON eff.series_id = a.series_id AND eff.moy = month(a.month))"
)


def trend(spark, sf):
    return forecast.seasonal_trend(panel(spark, sf), KEY)


@query("fc12_seasonal_trend_forecast", f"WITH {TREND} SELECT series_id, month, step, {r4('mid', 3)} AS mid, {r4('lo', 3)} AS lo, {r4('hi', 3)} AS hi FROM fc", days=("month",))
def fc12(spark, sf):
    return trend(spark, sf).withColumns({c: fixed(F.col(c), 3) for c in ("mid", "lo", "hi")})


@query("fc10_forecast_view", f"WITH {TREND} SELECT series_id, strftime(month, '%Y-%m') AS month, {r4(r4('mid'), 3)} AS mid FROM fc")
def fc10(spark, sf):
    return forecast.forecast_view(trend(spark, sf), KEY).select(KEY, "month", fixed(F.col("mid"), 3).alias("mid"))


@query("top4_horizon_pick", f"WITH {TREND} SELECT series_id, " + ", ".join(f"{r4(f'max(mid) FILTER (WHERE step = {k})', 3)} AS m{k}" for k in (1, 3, 6, 12)) + " FROM fc GROUP BY 1")
def top4(spark, sf):
    return forecast.horizon_pick(trend(spark, sf), KEY).withColumns({f"m{k}": fixed(F.col(f"m{k}"), 3) for k in (1, 3, 6, 12)})


@query("fc3_temporal_split", f"WITH {PANEL} SELECT series_id, month, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) <= 24 AS is_validation FROM panel", days=("month",))
def fc3(spark, sf):
    return forecast.temporal_split(panel(spark, sf), KEY, "month").select(KEY, "month", "is_validation")


@query("fc4_min_history_gate", f"WITH {FEATS}, g AS (SELECT series_id, count(value) AS n_before, count(value) FILTER (WHERE lag12 IS NOT NULL AND yoy IS NOT NULL) AS n_after FROM feats GROUP BY 1) SELECT *, n_before >= 54 AND n_after >= 54 AS enough FROM g")
def fc4(spark, sf):
    return forecast.history_gate(feats(spark, sf), KEY, "value", ["lag12", "yoy"])


@query("fc6_masked_training", "WITH counted AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice) AS v, count(*) AS n FROM orders GROUP BY 1, 2), gappy AS (SELECT series_id, month, CASE WHEN n >= avg(n) OVER (PARTITION BY series_id) THEN v END AS value FROM counted) SELECT series_id, count(*) AS n FROM gappy WHERE value IS NOT NULL GROUP BY 1 HAVING count(*) >= 24")
def fc6(spark, sf):
    return forecast.trainable(gappy(spark, sf), KEY, "value").groupBy(KEY).agg(F.count("*").alias("n"))


#: The seasonal forecast of the stress index, and regimes of its months.
FSI_AHEAD = (
    f"{FSI}, {TREND.replace(PANEL + ', ', '').replace('FROM panel', 'FROM (SELECT 1 AS series_id, month, fsi AS value FROM fsi)')}, "
    "path AS (SELECT month, fsi, FALSE AS ahead FROM fsi UNION ALL SELECT month, mid, TRUE FROM fc), "
    "shifted AS (SELECT *, coalesce(lag(fsi, 3) OVER (ORDER BY month), fsi) AS before FROM path)"
)


@query("fc11_forecast_regime", f"WITH {FSI_AHEAD} SELECT month, {r4('fsi')} AS fsi, {REGIME} AS regime FROM shifted WHERE ahead", days=("month",))
def fc11(spark, sf):
    i = index(spark, sf).select("month", "fsi").withColumn("one", F.lit("FSI"))
    ahead = forecast.seasonal_trend(i.withColumnRenamed("fsi", "value"), "one")
    return forecast.regime_ahead(i, ahead).select("month", fixed(F.col("fsi")).alias("fsi"), "regime")


def boosted(spark, sf):
    p = panel(spark, sf)
    return p, forecast.train_boosted(engineer_features(p, KEY), KEY, cutter(spark))


@query("fc5_train_interval_models")
def fc5(spark, sf):
    return boosted(spark, sf)[1].metrics


@query("fc5_conformal_interval_models")
def fc5_conformal(spark, sf):
    """One model of the middle, with residual quantiles of the calibration months."""
    trained = forecast.train_interval_models(engineer_features(panel(spark, sf), KEY), KEY, cutter(spark))
    return trained.metrics.join(trained.residuals, KEY, "left")


@query("fc9_evaluate")
def fc9(spark, sf):
    return boosted(spark, sf)[1].metrics.select(KEY, "mae", "rmse", "r2")


@query("fc7_joint_recursive_forecast", days=("month",))
def fc7(spark, sf):
    p, trained = boosted(spark, sf)
    return forecast.folded_forecast(p, trained, KEY)


@query("fc8_carry_aux_series", days=("month",))
def fc8(spark, sf):
    """Series with short history have no model and keep their last value."""
    p = panel(spark, sf)
    held = p.where("series_id < '4' OR month >= DATE '2000-06-01'")
    trained = forecast.train_boosted(engineer_features(held.where("series_id < '4'"), KEY), KEY, cutter(spark))
    return forecast.folded_forecast(held, trained, KEY, horizon=3)


@query("top6_feature_importance_topn")
def top6(spark, sf):
    gains = zip(forecast.INPUTS, boosted(spark, sf)[1].boosters["mid"].importance(len(forecast.INPUTS)), strict=True)
    rows = spark.createDataFrame([("orders", f, g) for f, g in gains], "group string, feature string, gain double")
    return top_n(rows, ["group"], [F.desc("gain"), F.asc("feature")], 12)


@query("fc13_model_registry", days=("month",))
def fc13(spark, sf):
    """What the registered models predict when they are read again."""
    p, trained = boosted(spark, sf)
    path = forecast.register_boosted(trained, folder(spark), "orders", KEY).select("path").first()[0]
    return forecast.predicted(forecast.model_rows(engineer_features(p, KEY)), boosting.load(spark, path)).select(KEY, "month", F.col("mid").alias("predicted"))


@query(
    "fc13_registry_rows",
    f"WITH {FEATS}, usable AS (SELECT series_id, month FROM feats WHERE lag1 IS NOT NULL AND value IS NOT NULL), long AS (SELECT series_id FROM usable GROUP BY 1 HAVING count(*) >= 24), "
    "placed AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS n FROM usable SEMI JOIN long USING (series_id)) "
    "SELECT 'orders' AS \"group\", series_id, max(month) AS trained_until, count(*) AS n_rows FROM placed WHERE n > 24 GROUP BY 2",
    days=("trained_until",),
)
def fc13_rows(spark, sf):
    """The registry table of the models."""
    return forecast.register_boosted(boosted(spark, sf)[1], folder(spark), "orders", KEY).select("group", "series_id", "trained_until", "n_rows")


@query("fc14_fault_classifier_benchmark")
def fc14(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = li.select((F.col("l_returnflag") == "R").cast("int").alias("label"), "l_quantity", "l_extendedprice", "l_discount", "l_tax", F.datediff("l_shipdate", F.lit("1995-01-01").cast("date")).cast("double").alias("age"), (F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(4)) == 0).alias("is_test"))
    return forecast.classifier_benchmark(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "age"], "label")


# Views over result documents of the seasonal forecast.

UNITS = {"1-URGENT": "%", "2-HIGH": "B $", "3-MEDIUM": "M $", "4-NOT SPECIFIED": "K persons", "5-LOW": "Index"}
GROUP = "CASE WHEN series_id < '3' THEN 'fast' ELSE 'slow' END"
UNIT = "CASE series_id WHEN '1-URGENT' THEN '%' WHEN '2-HIGH' THEN 'B $' WHEN '3-MEDIUM' THEN 'M $' WHEN '4-NOT SPECIFIED' THEN 'K persons' ELSE 'Index' END"
METRICS = "pv AS (SELECT series_id, month, value, lag(value, 12) OVER (PARTITION BY series_id ORDER BY month) AS g FROM panel), me AS (SELECT series_id, avg(abs(value - g)) AS mae, sqrt(avg((value - g) ** 2)) AS rmse, 1 - avg((value - g) ** 2) / nullif(var_pop(value), 0) AS r2 FROM pv WHERE g IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
FLAT = (
    f"{TREND}, {METRICS}, lastv AS (SELECT series_id, {r4('arg_max(value, month)')} AS last_value FROM panel GROUP BY 1), fr AS (SELECT series_id, step, {r4('mid')} AS mid FROM fc), "
    f"flat AS (SELECT {GROUP} AS grp, series_id, {UNIT} AS unit, last_value, {r4('mae')} AS mae, {r4('r2')} AS r2, " + ", ".join(f"(SELECT mid FROM fr WHERE fr.series_id = l.series_id AND step = {k}) AS m{k}" for k in (1, 3, 6, 12)) + " FROM lastv l LEFT JOIN me USING (series_id))"
)


def documents(spark, sf):
    group = F.when(F.col(KEY) < "3", "fast").otherwise("slow").alias("group_id")
    p = panel(spark, sf).select(group, "*")
    from tidemark.operators.aggregates import validation_metrics
    from tidemark.operators.align import ordered

    guess = p.withColumn("guess", F.lag("value", 12).over(ordered(KEY, "month")))
    metrics = validation_metrics(guess, ["group_id", KEY], "value", "guess")
    unit = F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv])[F.col(KEY)]
    labels = p.select(KEY).distinct().select(KEY, F.lower(KEY).alias("label"), unit.alias("unit"))
    return views.group_results(p, forecast.seasonal_trend(p, ["group_id", KEY]), metrics, labels, F.lit("2001-09-01T00:00:00"))


def flat(spark, sf):
    return views.flat_results(documents(spark, sf))


@query("snk8_write_group_results", f"WITH {FLAT} SELECT grp AS \"group\", count(*) AS n_series FROM flat GROUP BY 1")
def snk8(spark, sf):
    at = folder(spark)
    sinks.write_json(documents(spark, sf), at)
    return files.result_documents(spark, at).select("group", F.size("series").cast("long").alias("n_series"))


@query("src6_read_group_results", f"WITH {FLAT} SELECT grp AS \"group\", series_id, step, round(fr.mid, 2) AS mid FROM flat JOIN fr USING (series_id)")
def src6(spark, sf):
    at = folder(spark)
    sinks.write_json(documents(spark, sf), at)
    return views.flat_forecasts(files.result_documents(spark, at)).select("group", KEY, "step", F.round("mid", 2).alias("mid"))


TREND_CASE = "CASE WHEN m1 IS NULL OR m12 IS NULL THEN '—' WHEN abs(m12 - m1) / (abs(m1) + 1e-9) < 0.005 THEN '→' WHEN m12 > m1 THEN '↑' ELSE '↓' END"


@query("vw1_summary_rows", f"WITH {FLAT} SELECT grp AS \"group\", series_id, round(last_value, 2) AS last_value, round(mae, 2) AS mae, round(r2, 2) AS r2, " + ", ".join(f"round(m{k}, 2) AS m{k}" for k in (1, 3, 6, 12)) + f", {TREND_CASE} AS trend FROM flat")
def vw1(spark, sf):
    s = views.summary_rows(flat(spark, sf))
    return s.withColumns({c: F.round(c, 2) for c in ("last_value", "mae", "r2", "m1", "m3", "m6", "m12")})


@query("top7_sorted_summary", f"WITH {FLAT} SELECT grp AS \"group\", series_id FROM flat ORDER BY 1, 2")
def top7(spark, sf):
    return views.summary_rows(flat(spark, sf)).select("group", KEY).orderBy("group", KEY)


REPORT = "CASE WHEN last_value IS NULL OR m12 IS NULL OR last_value = 0 THEN '→ Stable' WHEN unit = '%' THEN CASE WHEN m12 - last_value < -0.10 THEN '↓ Declining' WHEN m12 - last_value > 0.10 THEN '↑ Rising' ELSE '→ Stable' END WHEN (m12 - last_value) / abs(last_value) * 100 < -2 THEN '↓ Declining' WHEN (m12 - last_value) / abs(last_value) * 100 > 2 THEN '↑ Rising' ELSE '→ Stable' END"


@query("vw2_report_rows", f"WITH {FLAT} SELECT grp AS \"group\", series_id, {REPORT} AS trend, coalesce(bool_or(r2 < -5) OVER (PARTITION BY grp), FALSE) AS low_confidence FROM flat")
def vw2(spark, sf):
    return views.report_rows(flat(spark, sf)).select("group", KEY, "trend", "low_confidence")


@query("ind17_trend_label_report", f"WITH {FLAT} SELECT series_id, {REPORT} AS trend FROM flat")
def ind17(spark, sf):
    return flat(spark, sf).select(KEY, scoring.trend_report(F.col("last_value"), F.try_element_at("forecast", F.lit(12))["mid"], F.col(KEY), F.col("unit")).alias("trend"))


@query("ind18_trend_label_summary", f"WITH {FLAT} SELECT series_id, {TREND_CASE} AS trend FROM flat")
def ind18(spark, sf):
    at = lambda k: F.try_element_at("forecast", F.lit(k))["mid"]
    return flat(spark, sf).select(KEY, scoring.trend_summary(at(1), at(12)).alias("trend"))


@query("ind19_low_confidence_flag", f"WITH {FLAT} SELECT grp AS \"group\", coalesce(bool_or(r2 < -5), FALSE) AS low_confidence FROM flat GROUP BY 1")
def ind19(spark, sf):
    return views.report_rows(flat(spark, sf)).select("group", "low_confidence").distinct()


@query(
    "vw3_signal_text",
    f"WITH {FLAT}, h AS (SELECT *, (m12 - last_value) / nullif(last_value, 0) * 100 AS pct FROM flat) SELECT grp AS \"group\", 'Values ' || max(CASE WHEN pct < -2 THEN 'decline' WHEN pct > 2 THEN 'rise' ELSE 'hold steady' END) FILTER (WHERE series_id IN ('2-HIGH', '5-LOW')) || '; missing —.' AS signal FROM h GROUP BY 1",
)
def vw3(spark, sf):
    f = flat(spark, sf)
    named = F.when(F.col("group") == "fast", "Values {2-high_dir}; missing {none_last}.").otherwise("Values {5-low_dir}; missing {none_last}.")
    return views.signal_text(f, f.select("group").distinct().select("group", named.alias("template")))


@query(
    "vw4_macro_narrative",
    f"WITH {FLAT}, v AS (SELECT max(m12) FILTER (WHERE series_id = '1-URGENT') / 10000 AS rec, max(last_value) FILTER (WHERE series_id = '2-HIGH') AS a, max(m12) FILTER (WHERE series_id = '2-HIGH') AS b, max(last_value) FILTER (WHERE series_id = '5-LOW') / 2000 AS cap FROM flat) "
    "SELECT 1 AS place, 'Recession risk is ' || CASE WHEN rec > 20 THEN 'serious' WHEN rec > 10 THEN 'elevated' ELSE 'low' END AS bullet FROM v WHERE rec IS NOT NULL UNION ALL SELECT 2, 'Production is forecast to ' || CASE WHEN b < a THEN 'fall' ELSE 'rise' END FROM v WHERE a IS NOT NULL AND b IS NOT NULL "
    "UNION ALL SELECT 3, 'Capacity use is ' || CASE WHEN cap < 80 THEN 'restraining' ELSE 'supporting' END || ' investment' FROM v WHERE cap IS NOT NULL UNION ALL SELECT 4, 'Orders are ' || CASE WHEN (b - a) / abs(a) * 100 < -2 THEN 'weakening' WHEN (b - a) / abs(a) * 100 > 2 THEN 'strengthening' ELSE 'stable' END FROM v WHERE a IS NOT NULL AND b IS NOT NULL "
    "UNION ALL SELECT 9, CASE WHEN rec > 20 THEN 'The window for a soft landing narrows' ELSE 'A moderate slowdown with low recession risk' END FROM v",
)
def vw4(spark, sf):
    f = flat(spark, sf).withColumn("m12", F.try_element_at("forecast", F.lit(12))["mid"])
    of = lambda c, s: F.max(F.when(F.col(KEY) == s, F.col(c)))
    v = f.agg((of("m12", "1-URGENT") / 10000).alias("rec"), of("last_value", "2-HIGH").alias("a"), of("m12", "2-HIGH").alias("b"), (of("last_value", "5-LOW") / 2000).alias("cap"))
    rec, a, b, cap = (F.col(c) for c in ("rec", "a", "b", "cap"))
    both, pct = a.isNotNull() & b.isNotNull(), (b - a) / F.abs(a) * 100
    rules = [
        (1, rec.isNotNull(), F.concat(F.lit("Recession risk is "), F.when(rec > 20, "serious").when(rec > 10, "elevated").otherwise("low"))),
        (2, both, F.concat(F.lit("Production is forecast to "), F.when(b < a, "fall").otherwise("rise"))),
        (3, cap.isNotNull(), F.concat(F.lit("Capacity use is "), F.when(cap < 80, "restraining").otherwise("supporting"), F.lit(" investment"))),
        (4, both, F.concat(F.lit("Orders are "), F.when(pct < -2, "weakening").when(pct > 2, "strengthening").otherwise("stable"))),
        (9, F.lit(True), F.when(rec > 20, "The window for a soft landing narrows").otherwise("A moderate slowdown with low recession risk")),
    ]
    return views.narrative(v, rules)


@query("vw5_catalogue", "SELECT lower(left(o_orderpriority, 1)) AS view, '[' || o_orderpriority || ']' AS ids, TRUE AS available FROM orders GROUP BY o_orderpriority UNION ALL SELECT 'events', '[' || string_agg(DISTINCT event_type, ', ' ORDER BY event_type) || ']', FALSE FROM events")
def vw5(spark, sf):
    p = table(spark, sf, "orders").select(F.lower(F.substring("o_orderpriority", 1, 1)).alias("view"), F.col("o_orderpriority").alias(KEY)).distinct()
    e = table(spark, sf, "events").select(F.lit("events").alias("view"), F.col("event_type").alias(KEY)).distinct()
    return views.catalogue(p.union(e), flat(spark, sf)).select("view", F.concat(F.lit("["), F.array_join("series_ids", ", "), F.lit("]")).alias("ids"), "available")


@query("vw6_group_view", f"WITH {FLAT} SELECT series_id, round(last_value, 2) AS last_value FROM flat WHERE grp = 'slow' AND series_id IN ('3-MEDIUM', '5-LOW')")
def vw6(spark, sf):
    return views.select_series(flat(spark, sf), "slow", ["3-MEDIUM", "5-LOW"]).select(KEY, F.round("last_value", 2).alias("last_value"))


@query("flt10_select_group", f"WITH {FLAT} SELECT series_id FROM flat WHERE grp = 'fast'")
def flt10(spark, sf):
    return views.select_series(flat(spark, sf), "fast").select(KEY)


@query("vw7_series_history", f"WITH {PANEL} SELECT strftime(month, '%Y-%m-%d') AS date, {r4('value', 6)} AS value FROM panel WHERE series_id = '1-URGENT'")
def vw7(spark, sf):
    return views.series_history(panel(spark, sf), "1-URGENT")


@query("vw10_news_forecast_view", f"WITH {ARTICLES}, g AS (SELECT count(DISTINCT day) AS d FROM articles) SELECT 'ok' AS status, d AS days_collected, count(DISTINCT series_id) AS n FROM g, (SELECT DISTINCT o_orderpriority AS series_id FROM orders) GROUP BY 1, 2 HAVING d >= 30 UNION ALL SELECT 'cold_start', d, 0 FROM g WHERE d < 30")
def vw10(spark, sf):
    from tidemark.operators.aggregates import cold_start

    v = views.with_cold_start(trend(spark, sf), cold_start(articles(spark, sf), "day"))
    return v.groupBy("status", "days_collected").agg(F.count_distinct(KEY).alias("n"))


@query("flt10_select_series", f"WITH {FLAT} SELECT grp AS \"group\", series_id, unit FROM flat WHERE series_id = '2-HIGH'")
def flt10_series(spark, sf):
    return views.select_series(flat(spark, sf), series=["2-HIGH"]).select("group", KEY, "unit")


@query("vw6_series_view", f"WITH {FLAT} SELECT series_id, step, round(fr.mid, 2) AS mid FROM flat JOIN fr USING (series_id) WHERE series_id = '4-NOT SPECIFIED'")
def vw6_series(spark, sf):
    chosen = views.select_series(documents(spark, sf).select("group", F.explode("series").alias("s")).select("group", "s.series_id", "s.forecast"), series=["4-NOT SPECIFIED"])
    return chosen.select(KEY, F.posexplode("forecast").alias("step", "p")).select(KEY, (F.col("step") + 1).alias("step"), F.round("p.mid", 2).alias("mid"))


@query("vw6_spreads_view", f"WITH {FLAT}, d AS (SELECT max(last_value) FILTER (WHERE series_id = '5-LOW') - max(last_value) FILTER (WHERE series_id = '2-HIGH') AS last, max(m12) FILTER (WHERE series_id = '5-LOW') - max(m12) FILTER (WHERE series_id = '2-HIGH') AS m12 FROM flat) SELECT 'low_high' AS spread, round(last, 2) AS last, round(m12, 2) AS m12 FROM d")
def vw6_spreads(spark, sf):
    f = flat(spark, sf).withColumn("m12", F.try_element_at("forecast", F.lit(12))["mid"])
    of = lambda c, s: F.max(F.when(F.col(KEY) == s, F.col(c)))
    return f.agg(*(F.round(of(c, "5-LOW") - of(c, "2-HIGH"), 2).alias(n) for c, n in (("last_value", "last"), ("m12", "m12")))).select(F.lit("low_high").alias("spread"), "last", "m12")


@query("vw6_yield_curve_view", f"WITH {FLAT} SELECT series_id, round(last_value, 2) AS last_value, round(m12, 2) AS m12 FROM flat WHERE grp = 'fast'")
def vw6_curve(spark, sf):
    f = views.select_series(flat(spark, sf), "fast", ["1-URGENT", "2-HIGH"])
    return f.select(KEY, F.round("last_value", 2).alias("last_value"), F.round(F.try_element_at("forecast", F.lit(12))["mid"], 2).alias("m12"))
