"""Boosted quantile models, forecasts in one pass, and the registry."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tidemark.operators import aggregates, boosting, features, forecast


def cut(df):
    return df.checkpoint()


@pytest.fixture(scope="module")
def panel(spark):
    """Forty series of a trend, a season, and noise that grows in winter."""
    rng = np.random.default_rng(7)
    rows = [
        (f"s{k:02d}", date(2010 + m // 12, m % 12 + 1, 1), float((100 + 5 * k) * (1 + 0.002 * m + 0.1 * np.sin(m * np.pi / 6) + rng.normal(0, 0.06 if m % 12 in (0, 1, 11) else 0.01))))
        for k in range(40)
        for m in range(120)
    ]
    return spark.createDataFrame(rows, "series_id string, month date, value double").repartition(4).checkpoint()


@pytest.fixture(scope="module")
def trained(panel):
    return forecast.train_boosted(features.engineer_features(panel, "series_id").checkpoint(), "series_id", cut)


@pytest.fixture(scope="module")
def stepped(spark):
    """y is 10 above 0.5 of the first input, else 0, plus noise up to 1; the second input is null or noise."""
    rng = np.random.default_rng(1)
    rows = [([float(a), None if i % 3 == 0 else float(b)], float(10 * (a > 0.5) + e), bool(i % 5 == 0)) for i, (a, b, e) in enumerate(rng.random((4000, 3)))]
    return rows, spark.createDataFrame(rows, "x array<double>, y double, held boolean").repartition(3).checkpoint()


def test_trees_find_a_step_and_leaves_are_quantiles(stepped):
    rows, df = stepped
    models = boosting.boost(df, {"mean": None, "low": 0.1, "high": 0.9}, cut, 2, rate=1.0)
    got = df.select("x", *(b.predict().alias(m) for m, b in models.items())).toPandas()
    up = got.x.map(lambda x: x[0] > 0.55)
    down = got.x.map(lambda x: x[0] < 0.45)
    for name, want in (("mean", 0.5), ("low", 0.1), ("high", 0.9)):
        assert abs(got[name][up] - 10 - want).mean() < 0.1 and abs(got[name][down] - want).mean() < 0.1
    assert models["mean"].importance(2)[0] > 0.95
    assert abs(sum(models["mean"].importance(2)) - 1) < 1e-9


def test_noise_stops_early(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([([float(a)], float(b), i % 2 == 0) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))], "x array<double>, y double, held boolean")
    models = boosting.boost(df, {"mean": None}, cut, 1, rounds=12)
    assert len(models["mean"].trees) < 6


def test_boosting_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([([1.0], None, False), ([None], 7.0, None)], "x array<double>, y double, held boolean")
    assert boosting.boost(df.where("y IS NULL"), {"mean": None}, cut, 1)["mean"] == boosting.Booster(None, 0.0)
    model = boosting.boost(df, {"mean": None, "q": 0.9}, cut, 1, rounds=2)
    assert df.select(*(b.predict().alias(m) for m, b in model.items())).distinct().collect() == [(7.0, 7.0)]


def test_intervals_dont_cross_and_cover_unseen_months(panel, trained):
    """FC5: of the test months, which neither training nor early stopping has seen, about four fifths are within."""
    place = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("month")))
    out = forecast.predicted(forecast.model_rows(features.engineer_features(panel, "series_id").withColumn("_n", place).where("_n <= 12")), trained.boosters)
    assert out.where("lo > mid OR mid > hi").isEmpty()
    assert 0.65 < out.select(F.avg(F.expr("CAST(value BETWEEN lo AND hi AS INT)"))).first()[0] < 0.95


def test_pinball_losses_are_below_those_of_conformal_intervals(panel, trained):
    """FC5: the noise depends on the month, which one width for a series can't follow."""
    feats = features.engineer_features(panel, "series_id").checkpoint()
    one = forecast.train_interval_models(feats, "series_id", cut, max_iter=10, max_depth=3)
    place = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("month")))
    rows = one.model.transform(forecast.scaled(feats.withColumn("_n", place).where("_n <= 12"))).join(one.residuals, "series_id")
    y = F.col("value") / F.col("_scale")
    conformal = rows.select(*(F.avg(boosting.pinball(y, F.col("prediction") + F.col(q), s)) for q, s in (("q10", 0.1), ("q90", 0.9)))).first()
    boosted = trained.metrics.agg(F.avg("pinball_q10"), F.avg("pinball_q90")).first()
    assert sum(boosted) < sum(conformal)


def test_metrics_equal_numpy_on_the_same_predictions(panel, trained):
    """FC9."""
    out = forecast.predicted(forecast.model_rows(features.engineer_features(panel, "series_id")), trained.boosters).select("series_id", "month", "value", "mid", "lo", "hi").toPandas()
    got = {r.series_id: r for r in trained.metrics.collect()}
    assert len(got) == 40
    for k, g in out.sort_values("month").groupby("series_id"):
        test = g.tail(12)
        e = (test.value - test.mid).to_numpy()
        assert abs(got[k].mae - np.abs(e).mean()) < 1e-3 and abs(got[k].rmse - np.sqrt((e**2).mean())) < 1e-3
        assert abs(got[k].coverage - ((test.lo <= test.value) & (test.value <= test.hi)).mean()) < 1e-9


def test_one_pass_equals_a_recursion_over_the_feature_table(spark, panel, trained):
    """FC7, FC8: each step is the models' on the feature table of history and the middles before it; gaps stay gaps."""
    holes = panel.where("series_id IN ('s03', 's11')").withColumn("value", F.expr("IF(series_id = 's11' AND month(month) IN (9, 12) AND year(month) = 2019, NULL, value)"))
    short = spark.createDataFrame([("new", date(2019, m, 1), 7.0 + m if m < 12 else None) for m in range(1, 13)], panel.schema)
    empty = spark.createDataFrame([("void", date(2019, 1, 1), None)], panel.schema)
    both = holes.unionByName(short).unionByName(empty)
    got = {(r.series_id, r.step): r for r in forecast.folded_forecast(both, trained, "series_id", horizon=4).collect()}
    assert len(got) == 16 and [got["new", k].mid for k in (1, 2, 3, 4)] == [18.0] * 4 and got["void", 2].mid is None
    assert got["s03", 3].month == date(2020, 3, 1) and got["void", 1].month == date(2019, 2, 1)
    path = holes
    bounds = {r.series_id: (r.lo, r.hi) for r in aggregates.clip_bounds(both, "series_id", "value").collect()}
    for step in range(1, 5):
        path = path.unionByName(spark.createDataFrame([(s, date(2020, step, 1), None) for s in ("s03", "s11")], panel.schema))
        rows = forecast.predicted(forecast.model_rows(features.engineer_features(path, "series_id")), trained.boosters).where(F.col("month") == date(2020, step, 1))
        want = {r.series_id: r for r in rows.select("series_id", "mid", "lo", "hi").collect()}
        for s, r in want.items():
            assert np.allclose([got[s, step][c] for c in ("mid", "lo", "hi")], np.clip([r.mid, r.lo, r.hi], *bounds[s]), rtol=1e-9), (s, step)
            path = path.withColumn("value", F.when((F.col("series_id") == s) & (F.col("month") == date(2020, step, 1)), got[s, step].mid).otherwise(F.col("value")))


def test_the_forecast_is_one_pass(panel, trained):
    plan = forecast.folded_forecast(panel, trained, "series_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1


def test_registered_models_predict_as_trained_and_replace_their_group(spark, panel, trained, tmp_path):
    """FC13."""
    at = str(tmp_path)
    rows = forecast.register_boosted(trained, at, "orders", "series_id").collect()
    forecast.register_boosted(trained, at, "other", "series_id")
    forecast.register_boosted(trained, at, "orders", "series_id")
    assert len(rows) == 40 and {(r.trained_until, r.n_rows) for r in rows} == {(date(2017, 12, 1), 95)}
    assert sorted(map(tuple, spark.read.parquet(f"{at}/registry").groupBy("group").count().collect())) == [("orders", 40), ("other", 40)]
    again = boosting.load(spark, rows[0].path)
    assert again == trained.boosters
