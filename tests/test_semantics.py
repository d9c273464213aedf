"""Worked values of operators on small frames."""

import datetime as dt
from datetime import date

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import dates, numeric, scoring, text
from tidemark.operators import aggregates, align, features, forecast, joins, scan, views
from tidemark.sources import sinks
from tidemark.streaming import news as streams


def day(n: int, start: str = "2010-01-01") -> dt.date:
    return dt.date.fromisoformat(start) + dt.timedelta(days=n)


def months(values, key="a"):
    return [(key, dt.date(2000 + i // 12, i % 12 + 1, 1), v) for i, v in enumerate(values)]


def series(spark, values):
    return spark.createDataFrame(months(values), "series_id string, month date, value double")


def values(df, column="value"):
    return [None if r[column] is None else round(r[column], 4) for r in df.orderBy("month").collect()]


def test_interpolation_stops_at_the_limit_and_carries_a_trailing_gap(spark):
    df = series(spark, [None, 1.0, None, None, None, 5.0, None, None, None])
    assert values(scan.interpolated(df, "series_id", "month", "value", 2)) == [None, 1, 2, 3, None, 5, 5, 5, None]


def test_ffill_limit(spark):
    df = series(spark, [1.0, None, None, None, None, 2.0])
    assert values(df.withColumn("value", align.ffill("value", "series_id", "month", 3))) == [1, 1, 1, 1, None, 2]


def test_expanding_rank_averages_ties(spark):
    df = features.expanding_pct_rank(series(spark, [3.0, 1.0, 2.0, 2.0, 5.0, 2.0]), "series_id", "month", "value", least=1)
    assert values(df, "pct_rank") == [1, 0.5, 0.6667, 0.625, 1, 0.5]


def test_rolling_deviation_of_one_value_is_null(spark):
    df = series(spark, [1.0, 2.0, 4.0]).withColumns(features.rolling("series_id", "month", "value", (3,)))
    assert values(df, "roll3_mean") == [None, 1, 1.5]
    assert values(df, "roll3_std") == [None, None, 0.7071]


def test_momentum_pads_nulls_and_zero_base_is_null(spark):
    df = series(spark, [1.0, None, 3.0, 4.0, 0.0, 1.0, 2.0])
    df = df.withColumn("f", align.ffill("value", "series_id", "month")).withColumns(features.momentum("series_id", "month", "f"))
    assert values(df, "mom") == [None, None, 0, 200, 33.3333, -100, None]


def test_clip_bounds_are_linear_percentiles(spark):
    row = aggregates.clip_bounds(series(spark, [1.0, 2.0, 10.0]), "series_id", "value").first()
    assert (round(row.lo, 3), round(row.hi, 3)) == (round(1.02 - 0.882, 3), round(9.84 + 0.882, 3))


def station(spark, n, **over):
    base = {"mean_temp": 55.0, "max_temp": 65.0, "min_temp": 45.0, "precip": 0.05, "snow_depth": 0.0, "wind_speed": 8.0, "cloud_cover": 40.0}
    rows = [("c", day(i), *(v[i] if isinstance(v, list) else v for v in (base | over).values())) for i in range(n)]
    return spark.createDataFrame(rows, "city string, date date, " + ", ".join(f"{k} double" for k in base))


@pytest.mark.parametrize(
    ("over", "column", "want"),
    [({}, "hdd", 310), ({"mean_temp": 75.0}, "cdd", 310), ({"mean_temp": 80.0}, "hdd", 0), ({"mean_temp": 50.0}, "cdd", 0), ({"max_temp": 95.0}, "extreme_heat_days", 31), ({"min_temp": 20.0}, "extreme_cold_days", 31), ({"precip": [2.0] * 5 + [0.0] * 26}, "extreme_precip_days", 5)],
)
def test_climate_month(spark, over, column, want):
    assert aggregates.climate_monthly(station(spark, 31, **over), "city").first()[column] == want


def test_short_month_is_dropped_and_missing_columns_left_out(spark):
    assert aggregates.climate_monthly(station(spark, 10), "city").isEmpty()
    assert "snow_total" not in aggregates.climate_monthly(station(spark, 31).drop("snow_depth"), "city").columns
    assert aggregates.climate_monthly(station(spark, 31).drop("mean_temp"), "city").isEmpty()


def test_region_mean_counts_states_with_data(spark):
    state = spark.createDataFrame([("A", day(0), 60.0), ("B", day(0), 40.0)], "state string, month date, temp_mean double")
    regions = spark.createDataFrame([("A", "r"), ("B", "r"), ("C", "r")], "state string, region string")
    out = {r["level"]: r for r in aggregates.geography_levels(state, regions, ["temp_mean"]).collect()}
    assert out["r"].temp_mean == 50 and out["r"].state_count == 2 and out["national"].temp_mean == 50


def test_anomaly_needs_ten_base_years(spark):
    def frame(years):
        rows = [("A", dt.date(2000 + y, m, 1), 55.0) for y in range(years) for m in range(1, 13)] + [("A", dt.date(2023, 1, 1), 65.0)]
        return spark.createDataFrame(rows, "state string, month date, temp_mean double")

    assert aggregates.anomaly(frame(20), "state", "temp_mean").where("year(month) = 2023").first().anomaly == 10
    assert aggregates.anomaly(frame(5), "state", "temp_mean").where("anomaly IS NOT NULL").isEmpty()


def test_asof_carries_over_missing_days_buckets_and_keys(spark):
    right = spark.createDataFrame([("k", dt.datetime(2025, 1, 1), 1.0), ("k", dt.datetime(2025, 1, 3), 3.0), (None, dt.datetime(2025, 1, 1), 9.0)], "key string, rts timestamp, v double")
    rows = [("k", dt.datetime(2024, 12, 31)), ("k", dt.datetime(2025, 1, 4)), ("k", dt.datetime(2025, 6, 1)), ("other", dt.datetime(2025, 1, 4)), ("k", None), ("k", dt.datetime(2025, 1, 3))]
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, key string, ts timestamp")
    got = [r.v for r in joins.asof_backward(left, right, "key", "ts", "rts", ["v"], 86_400).orderBy("id").collect()]
    assert got == [None, 3, 3, None, None, 3]


def test_exact_merge_carries_matched_events_only(spark):
    daily = spark.createDataFrame([(day(0), 1.0), (day(2), 2.0)], "day date, v double")
    events = spark.createDataFrame([(1, day(0)), (2, day(1)), (3, day(3))], "id int, day date")
    got = [r.v for r in joins.exact_then_ffill(events, daily, "day", ["v"], "id").orderBy("id").collect()]
    assert got == [1, 1, 1]


def test_upsert_new_wins_and_nothing_is_deleted(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, ingest_seq int, v double")
    new = spark.createDataFrame([("b", 1, 3.0), ("c", 1, 4.0)], "k string, ingest_seq int, v double")
    assert {r.k: r.v for r in sinks.upsert(old, new, "k").collect()} == {"a": 1, "b": 3, "c": 4}


def test_regimes_and_labels(spark):
    rows = [(0.7, 0.5, "stress"), (0.5, 0.4, "contraction"), (0.5, 0.6, "recovery"), (0.3, 0.9, "slowdown"), (0.1, 0.1, "expansion"), (0.65, 0.65, "contraction")]
    df = spark.createDataFrame(rows, "x double, b double, want string")
    assert all(r.got == r.want for r in df.withColumn("got", scoring.regime(F.col("x"), F.col("b"))).collect())
    labels = spark.createDataFrame([(0.06,), (-0.06,), (0.05,), (None,)], "x double").select(text.sentiment_label(F.col("x")).alias("l"))
    assert [r.l for r in labels.collect()] == ["positive", "negative", "neutral", None]


def test_urls_keywords_and_moon(spark):
    one = spark.range(1)
    url = one.select(text.normalize_url(F.lit(" HTTPS://Reuters.com/Article/Foo/?utm=x#y ")).alias("u"), text.normalize_url(F.lit("http://A.b/c;p=1"), True).alias("v")).first()
    assert (url.u, url.v) == ("https://reuters.com/Article/Foo", "a.b/c")
    tags = one.select(text.classify_sector(F.lit("Bank and OIL"), F.lit(""), F.array().cast("array<string>")).alias("s"), text.classify_macro_tag(F.lit("sector news")).alias("t"), text.classify_macro_tag(F.lit("sector news"), True).alias("w")).first()
    assert (tags.s, tags.t, tags.w) == ("energy", "regulation", None)
    phases = one.select(dates.moon_phase(F.lit("2024-01-25").cast("date")).alias("full"), dates.moon_phase(F.lit("2024-01-11").cast("date")).alias("new")).first()
    assert (phases.full, phases.new) == ("Full Moon", "New Moon")


def test_either_date_fails_on_other_text(spark):
    df = spark.createDataFrame([("2025-01-31",), ("01/31/2025",), (None,)], "t string").select(dates.either_date(F.col("t")).alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2025, 1, 31)] * 2 + [None]
    with pytest.raises(Exception, match="not a date"):
        spark.createDataFrame([("31.01.2025",)], "t string").select(dates.either_date(F.col("t"))).collect()


def test_numbers_in_units(spark):
    rows = [(1234.5, "K persons", "1,234K"), (12.34, "B $", "$12.3B"), (5.678, "%", "5.68%"), (12345.6, "Index", "12,346"), (234.567, "Index", "234.57"), (0.5, "Index", "0.5000"), (None, "%", "—")]
    df = spark.createDataFrame(rows, "x double, u string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", numeric.unit_number(F.col("x"), F.col("u"))).collect())
    assert spark.createDataFrame([(".",), ("1.5",), ("NaN",), (None,)], "t string").select(numeric.to_number(F.col("t")).alias("n")).collect()[1].n == 1.5


def test_seasonal_trend_extends_a_line(spark):
    df = series(spark, [float(i) for i in range(36)])
    out = forecast.seasonal_trend(df, "series_id").orderBy("step").collect()
    assert len(out) == 12 and [round(r.mid, 6) for r in out] == [36.0 + i for i in range(12)]


def test_missing_group_tells_what_there_is(spark):
    flat = spark.createDataFrame([("g", "s")], "group string, series_id string")
    with pytest.raises(LookupError, match="groups: g"):
        views.select_series(flat, "h")


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "series_id string, month date, value double")
    assert features.engineer_features(empty, "series_id").isEmpty()
    assert scan.interpolated(empty, "series_id", "month", "value", 2).isEmpty()
    assert aggregates.clip_bounds(empty, "series_id", "value").isEmpty()
    assert forecast.seasonal_trend(empty, "series_id").isEmpty()


@pytest.mark.parametrize("kind", ["random", "constant", "rising", "few values"])
def test_expanding_rank_equals_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    values = {"random": rng.normal(size=150), "constant": np.ones(150), "rising": np.arange(150.0), "few values": rng.integers(0, 4, 150).astype(float)}[kind]
    rows = [(k, i, None if (i * 7 + len(k or "")) % 11 == 0 else float(v)) for k in ("a", None, "") for i, v in enumerate(values)]
    got = features.expanding_pct_rank(spark.createDataFrame(rows, "k string, d int, v double"), "k", "d", "v").collect()
    assert len(got) == len(rows)
    for r in got:
        seen = [v for k, d, v in rows if k == r.k and d <= r.d and v is not None]
        want = None
        if r.v is not None and len(seen) >= 12:
            want = (sum(v < r.v for v in seen) + (sum(v == r.v for v in seen) + 1) / 2) / len(seen)
        assert r.pct_rank == want or abs(r.pct_rank - want) < 1e-12


def test_percentiles_equal_numpy_also_of_null_keys_and_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(k, float(v)) for k, n in (("a", 101), (None, 40), ("one", 1), ("tied", 30)) for v in (rng.integers(0, 3, n) if k == "tied" else rng.normal(size=n))]
    df = spark.createDataFrame([*rows, ("a", None), ("none", None)], "k string, v double")
    got = {r.k: r.quantiles for r in aggregates.percentiles(df, "k", "v", [0.01, 0.5, 0.9]).collect()}
    assert set(got) == {"a", None, "one", "tied"}
    for k, q in got.items():
        assert np.allclose(q, np.quantile([v for key, v in rows if key == k], [0.01, 0.5, 0.9]))


def test_percentiles_of_large_groups_are_exact_and_shuffle_little(spark):
    """Groups beyond the small ones: what is below a bracket is counted before the shuffle."""
    rng = np.random.default_rng(5)
    groups = {"normal": rng.normal(size=30_000), "tied": rng.integers(0, 5, 20_000).astype(float), "skewed": np.exp(rng.normal(size=25_000) * 9), "signed": np.r_[np.full(9000, -1.5), np.full(9000, 2.5)]}
    df = spark.createDataFrame([(k, float(x)) for k, v in groups.items() for x in v], "k string, v double").repartition(5).checkpoint()
    shares = [0.0, 0.01, 0.5, 0.9, 1.0]
    got = {r.k: r.quantiles for r in aggregates.percentiles(df, "k", "v", shares).collect()}
    for k, v in groups.items():
        assert np.allclose(got[k], np.quantile(v, shares), rtol=1e-12), k


def test_stream_upsert_rewrites_touched_partitions_alone(spark, tmp_path):
    made = []

    def cut(df):
        made.append(df.count())
        return spark.createDataFrame(df.collect(), df.schema)

    write = streams.upsert_into(str(tmp_path / "t"), ["k", "day"], "day", cut)
    batch = lambda *rows: spark.createDataFrame(list(rows), "k string, day string, v int")
    write(batch(("a", "d1", 1), ("a", "d2", 2)), 0)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=d1").iterdir()}
    for _ in range(2):  # a repeated batch gives the same table
        write(batch(("a", "d2", 3), ("b", "d2", 4)), 1)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=d1").iterdir()} == untouched
    got = spark.read.schema("k string, v int, ingest_seq long, day string").parquet(str(tmp_path / "t"))
    assert sorted((r.k, r.day, r.v) for r in got.collect()) == [("a", "d1", 1), ("a", "d2", 3), ("b", "d2", 4)]
    assert made == [2, 2, 2]


def test_stream_upsert_keeps_what_is_stored(spark, tmp_path):
    """STM5: over a filled table with a new writer nothing is lost, new rows win, and a repeated batch changes nothing."""
    from tidemark.streaming.news import upsert_into

    at = str(tmp_path / "table")
    rows = lambda *r: spark.createDataFrame(list(r), "series_id string, value double, day string")
    read = lambda: sorted((r.day, r.series_id, r.value) for r in spark.read.schema("series_id string, value double, ingest_seq long, day string").parquet(at).collect())
    first = upsert_into(at, ["series_id", "day"], "day", lambda df: df.checkpoint())
    first(rows(("a", 1.0, "d1"), ("b", 2.0, "d1"), ("c", 3.0, "d2")), 0)
    first(rows(("c", 4.0, "d2")), 7)
    second = upsert_into(at, ["series_id", "day"], "day", lambda df: df.checkpoint())
    for _ in range(2):
        second(rows(("a", 9.0, "d1"), ("c", 5.0, "d2")), 0)
        assert read() == [("d1", "a", 9.0), ("d1", "b", 2.0), ("d2", "c", 5.0)]
    second(rows(("e", 6.0, "d3")), 1)
    assert read() == [("d1", "a", 9.0), ("d1", "b", 2.0), ("d2", "c", 5.0), ("d3", "e", 6.0)]


@pytest.fixture(scope="module")
def trained(spark):
    """Forty series of a trend, a season and noise of a known size, and the model of them."""
    rng = np.random.default_rng(7)
    rows = [
        (f"s{k:02d}", date(2010 + m // 12, m % 12 + 1, 1), float((100 + 5 * k) * (1 + 0.002 * m + 0.1 * np.sin(m * np.pi / 6) + rng.normal(0, 0.03))))
        for k in range(40)
        for m in range(120)
    ]
    panel = spark.createDataFrame(rows, "series_id string, month date, value double").repartition(4).checkpoint()
    feats = features.engineer_features(panel, "series_id").checkpoint()
    return panel, feats, forecast.train_interval_models(feats, "series_id", lambda df: df.checkpoint(), max_iter=10, max_depth=3)


def test_forecast_metrics_equal_numpy_on_the_same_predictions(trained):
    """FC5, FC9."""
    _, feats, model = trained
    out = model.model.transform(forecast.scaled(feats.where("lag1 IS NOT NULL"))).selectExpr("series_id", "month", "value", "prediction * _scale AS p", "_scale").toPandas()
    got = {r.series_id: r for r in model.metrics.collect()}
    residuals = {r.series_id: r for r in model.residuals.collect()}
    assert len(got) == 40
    for k, g in out.sort_values("month").groupby("series_id"):
        test, before = g.tail(12), g.iloc[-24:-12]
        e = (test.value - test.p).to_numpy()
        assert abs(got[k].mae - np.abs(e).mean()) < 1e-3 and abs(got[k].rmse - np.sqrt((e**2).mean())) < 1e-3
        assert abs(got[k].r2 - (1 - (e**2).mean() / test.value.var(ddof=0))) < 1e-3
        q = np.quantile((before.value - before.p) / before._scale.abs(), [0.1, 0.9])
        assert np.allclose([residuals[k].q10, residuals[k].q90], q)


def test_intervals_cover_the_test_months(trained):
    """FC5: of months that neither training nor calibration has seen, about four fifths are within the interval."""
    _, feats, model = trained
    place = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("month")))
    out = model.model.transform(forecast.scaled(feats.withColumn("_n", place).where("_n <= 12"))).join(model.residuals, "series_id")
    p = F.col("prediction") * F.col("_scale")
    inside = out.select(F.avg(F.col("value").between(p + F.col("q10") * F.abs("_scale"), p + F.col("q90") * F.abs("_scale")).cast("int"))).first()[0]
    assert 0.6 < inside < 0.95


def test_recursive_forecast_feeds_predictions_back_and_carries_untrained_series(spark, trained):
    """FC7, FC8: each step's middle is the model's on history and the middles before it, in order and within bounds."""
    panel, _, model = trained
    short = spark.createDataFrame([("new", date(2019, m, 1), 7.0 + m) for m in range(1, 13)], panel.schema)
    both = panel.unionByName(short)
    got = {(r.series_id, r.step): r for r in forecast.recursive_forecast(both, model, "series_id", "month", "value", lambda df: df.checkpoint(), horizon=2).collect()}
    assert len(got) == 82 and all(r.lo <= r.mid <= r.hi for r in got.values())
    assert got["new", 1].mid == got["new", 2].mid == 19.0
    path = panel.unionByName(spark.createDataFrame([("s03", date(2020, 1, 1), got["s03", 1].mid), ("s03", date(2020, 2, 1), None)], panel.schema)).where("series_id = 's03'")
    row = model.model.transform(forecast.scaled(features.engineer_features(path, "series_id"))).where("month = DATE '2020-02-01'").selectExpr("prediction * _scale AS p").first()
    assert abs(row.p - got["s03", 2].mid) < 1e-6 * abs(row.p)


def test_a_registered_model_predicts_as_the_trained_one(trained, tmp_path):
    """FC13."""
    from pyspark.ml import PipelineModel

    _, feats, model = trained
    again = PipelineModel.load(forecast.register_model(model, str(tmp_path), "group"))
    rows = forecast.scaled(feats.where("series_id = 's07'"))
    both = model.model.transform(rows).select("month", "prediction").join(again.transform(rows).select("month", F.col("prediction").alias("again")), "month")
    assert both.count() == 120 and both.where("prediction <> again").isEmpty()


def test_feature_importances_are_shares_of_the_inputs(trained):
    """TOP6."""
    gains = forecast.feature_importance(trained[2].model)
    assert abs(sum(g for _, g in gains) - 1) < 1e-9 and all(g >= 0 for _, g in gains)
    assert [n for n, _ in gains] == forecast.LEVELS + forecast.RATIOS + ["missing"]
    assert sum(g for n, g in gains if n.startswith(("lag", "roll", "month"))) > 0.5


def test_classifier_benchmark_finds_a_plain_rule_and_no_rule_in_noise(spark):
    """FC14."""
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), int(a + b > 0), int(rng.integers(0, 2)), i % 4 == 0) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, rule int, noise int, is_test boolean")
    good = forecast.classifier_benchmark(df, ["a", "b"], "rule").collect()
    assert {r.model for r in good} == {"logistic_regression", "random_forest", "boosted_trees", "perceptron"}
    assert all(r.accuracy > 0.85 and r.auc > 0.9 and r.detection_rate > 0.8 and r.false_alarm_rate < 0.25 for r in good)
    assert all(abs(r.f1 - 2 * r.precision * r.detection_rate / (r.precision + r.detection_rate)) < 1e-9 for r in good)
    bad = forecast.classifier_benchmark(df, ["a", "b"], "noise").where("model = 'logistic_regression'").first()
    assert 0.35 < bad.auc < 0.65


def test_events_without_ticker_keep_nulls_and_others_their_signals(spark):
    """JN6."""
    events = spark.createDataFrame([(1, " aa "), (2, None), (3, " "), (4, "zz")], "id int, ticker string")
    prices = spark.createDataFrame([("AA", 1.0)], "ticker string, price double")
    facts = spark.createDataFrame([("AA", 2.0)], "ticker string, margin double")
    got = sorted((r.id, r.ticker, r.price, r.margin) for r in joins.ticker_enrich(events, prices, facts, "ticker").collect())
    assert got == [(1, " aa ", 1.0, 2.0), (2, None, None, None), (3, " ", None, None), (4, "zz", None, None)]


def test_stream_of_rolling_means_over_several_runs_equals_a_loop(spark, tmp_path):
    import random

    rng, rows = random.Random(5), []
    for n in range(3):
        part = [(rng.choice("ab"), dt.datetime(2024, 1, 1 + 2 * n) + dt.timedelta(minutes=rng.randrange(60 * 48)), rng.choice([None, 1.0, 2.0, 5.0])) for _ in range(60)]
        rows += part
        spark.createDataFrame(part, "k string, at timestamp, v double").coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
        stream = spark.readStream.schema("k string, at timestamp, v double").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        out = streams.run_to_table(streams.rolling_mean(stream, "at", "k", "v"), str(tmp_path / "out"), str(tmp_path / "state"))
    end, want = max(at for _, at, _ in rows) - dt.timedelta(days=1), {}
    for k, at, v in rows:
        hour = at.replace(minute=0)
        for h in range(1, 25):
            if hour + dt.timedelta(hours=h) <= end:
                want.setdefault((k, hour + dt.timedelta(hours=h)), []).append(v)
    mean = lambda vs: sum(vs) / len(vs) if vs else None
    got = {(r.k, r.until): r.mood for r in out.withColumn("until", F.col("until").cast("timestamp_ntz")).collect()}
    assert got.keys() == want.keys()
    assert all(got[x] == pytest.approx(mean([v for v in want[x] if v is not None])) for x in want)


def test_a_mean_on_the_edge_of_a_label_falls_as_in_the_sql(spark, tmp_path):
    """Conversations of the given tables at scale 0.1 and on check_s, whose weighted means are 0.05 and -0.05 but for the last bit."""
    import duckdb
    from compare import assert_same
    from tidemark.plans.registry import ORACLES, QUERIES

    turns = {
        43: [("user", 119), ("assistant", 886), ("user", 254), ("assistant", 1614)],
        1319: [("system", 103), ("user", 60), ("assistant", 1440), ("user", 46), ("assistant", 568), ("user", 136)],
        4632: [("user", 171), ("assistant", 890), ("user", 216), ("assistant", 1419), ("user", 101), ("assistant", 667), ("user", 285)],
    }
    rows = [(c, t, role, "x" * n) for c, lengths in turns.items() for t, (role, n) in enumerate(lengths)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    name = "src13_normalize_marketaux"
    assert_same(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name])


def test_articles_are_scored_where_they_are(spark, sf):
    """Articles aren't dealt by sector, which would bring all of a language into one task."""
    from tidemark.operators import briefing
    from tidemark.plans.catalog import articles

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = briefing.score_impact(articles(spark, sf), "day")
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [sector" not in plan and "BroadcastHashJoin [sector" in plan
        assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_classifier_benchmark_trains_on_all_cores(spark, monkeypatch):
    """Rows that come in one row group are dealt to all cores before training."""
    from pyspark.ml.classification import LogisticRegression
    from tidemark.operators import forecast

    parts, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df))
    df = spark.range(400).coalesce(1).selectExpr("cast(id % 2 as int) AS y", "cast(id % 7 as double) AS a", "id % 4 = 0 OR id % 4 = 3 AS is_test")
    assert forecast.classifier_benchmark(df, ["a"], "y").count() == 4
    assert parts[0] >= spark.sparkContext.defaultParallelism
