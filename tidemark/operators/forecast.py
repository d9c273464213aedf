"""Monthly forecasts: splits and gates, a closed-form baseline, and boosted trees with intervals.

Boosted trees are one MLlib model for all series of a panel: features are scaled by each series' own
level, so that series of any size share a model. Intervals are split-conformal: residual quantiles of a
calibration window that neither training nor the metrics use.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import fixed, ordered_interval
from tidemark.operators import boosting
from tidemark.operators.aggregates import clip_bounds, percentiles, validation_metrics
from tidemark.operators.align import Names, names
from tidemark.operators.features import LAGS, WINDOWS, engineer_features

#: Months ahead, of calibration and of test, least rows of a series, and rows of history that a step needs.
HORIZON, CALIBRATION, TEST, LEAST_ROWS, TAIL = 12, 12, 12, 54, 14

#: Tasks a core to which a benchmark's rows are dealt.
DEALT = 2

#: Feature columns that are levels of the series, and those that are ratios.
LEVELS = [f"lag{k}" for k in LAGS] + [f"roll{w}_{s}" for w in WINDOWS for s in ("mean", "std")]
RATIOS = ["mom", "yoy", "month_of_year", "quarter"]

Step = Callable[[DataFrame], DataFrame]


def temporal_split(df: DataFrame, key: Names, date: str, held: int | None = 24) -> DataFrame:
    """FC3: `is_validation` marks each series' last `held` rows; None: a quarter of them, 1 to 24, none if that leaves one row or less."""
    keys = names(key)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date)))
    if held is not None:
        return df.withColumn("is_validation", place <= held)
    n = F.count("*").over(Window.partitionBy(*keys))
    k = F.least(F.lit(24), F.greatest(F.lit(1), F.floor(n / 4)))
    return df.withColumn("is_validation", (place <= k) & (n > k + 1))


def history_gate(df: DataFrame, key: Names, value: str, features: list[str], least: int = LEAST_ROWS) -> DataFrame:
    """FC4: for each series the rows with a value before and after rows with null features go, and whether both reach `least`."""
    complete = F.lit(True)
    for f in features:
        complete = complete & F.col(f).isNotNull()
    out = df.groupBy(*names(key)).agg(F.count(value).alias("n_before"), F.count(F.when(complete, F.col(value))).alias("n_after"))
    return out.withColumn("enough", (F.col("n_before") >= least) & (F.col("n_after") >= least))


def trainable(df: DataFrame, key: Names, target: str, least: int = 24) -> DataFrame:
    """FC6: rows with a target, of series with `least` of them."""
    known = df.where(F.col(target).isNotNull())
    long = known.groupBy(*names(key)).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return known.join(long.drop("_n"), names(key), "left_semi")


def seasonal_trend(panel: DataFrame, key: Names, date: str = "month", value: str = "value", horizon: int = HORIZON) -> DataFrame:
    """FC12: least-squares trend by month number plus the mean residual of the calendar month; lo and hi add the residuals' 10 % and 90 % quantiles."""
    keys = names(key)
    number = F.year(date) * 12 + F.month(date)
    rows = panel.where(F.col(value).isNotNull()).select(*keys, F.col(date).alias("_d"), number.cast("double").alias("_x"), F.month(date).alias("moy"), F.col(value).alias("_y"))
    line = rows.groupBy(*keys).agg(F.regr_slope("_y", "_x").alias("_b"), F.regr_intercept("_y", "_x").alias("_a"), F.max("_d").alias("_last"))
    residual = rows.join(line, keys).withColumn("_r", F.col("_y") - F.col("_a") - F.col("_b") * F.col("_x"))
    effects = residual.groupBy(*keys, "moy").agg(F.avg("_r").alias("_e"))
    spread = percentiles(residual.join(effects, [*keys, "moy"]).withColumn("_left", F.col("_r") - F.col("_e")), keys, "_left", [0.1, 0.9], "_q")
    ahead = line.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("month", F.add_months("_last", F.col("step")))
    x = (F.year("month") * 12 + F.month("month")).cast("double")
    joined = ahead.withColumn("moy", F.month("month")).join(effects, [*keys, "moy"], "left").join(spread, keys)
    mid = F.col("_a") + F.col("_b") * x + F.coalesce("_e", F.lit(0.0))
    return joined.select(*keys, "month", "step", mid.alias("mid"), (mid + F.col("_q")[0]).alias("lo"), (mid + F.col("_q")[1]).alias("hi"))


def scaled(features: DataFrame) -> DataFrame:
    """Levels as parts of the row's twelve-month mean, or else of its last value; ratios as they are; missing marks."""
    scale = F.coalesce(F.nullif("roll12_mean", F.lit(0.0)), F.nullif("lag1", F.lit(0.0)), F.lit(1.0))
    out = features.withColumn("_scale", scale)
    return out.withColumns({f"x_{c}": F.col(c) / F.col("_scale") for c in LEVELS} | {f"x_{c}": F.col(c).cast("double") for c in RATIOS} | {"x_missing": F.col("yoy").isNull().cast("double")})


@dataclass
class IntervalModel:
    """FC5: the model of the middle, and each series' residual quantiles (key, q10, q90) from the calibration window."""

    model: PipelineModel
    residuals: DataFrame
    metrics: DataFrame
    trained: DataFrame


def train_interval_models(features: DataFrame, key: str, cut: Step, date: str = "month", value: str = "value", max_iter: int = 20, max_depth: int = 4) -> IntervalModel:
    """FC5, FC9: trains on all but the last months, takes intervals from the calibration months and metrics from the test
    months. `cut` writes the prepared rows to the shared checkpoint folder, as training reads them many times."""
    usable = trainable(features.where(F.col("lag1").isNotNull()), key, value)
    rows = scaled(usable)
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date)))
    parts = cut(rows.withColumn("y", F.col(value) / F.col("_scale")).withColumn("_place", place))
    inputs = [f"x_{c}" for c in LEVELS + RATIOS] + ["x_missing"]
    clean = [f"{c}_filled" for c in inputs]
    stages = [Imputer(inputCols=inputs, outputCols=clean), VectorAssembler(inputCols=clean, outputCol="features"), GBTRegressor(labelCol="y", maxIter=max_iter, maxDepth=max_depth, seed=1)]
    model = Pipeline(stages=stages).fit(parts.where(F.col("_place") > CALIBRATION + TEST))
    out = model.transform(parts).withColumn("predicted", F.col("prediction") * F.col("_scale"))
    calibration = out.where(F.col("_place").between(TEST + 1, TEST + CALIBRATION))
    error = (F.col(value) - F.col("predicted")) / F.abs("_scale")
    residuals = calibration.groupBy(key).agg(F.percentile(error, 0.1).alias("q10"), F.percentile(error, 0.9).alias("q90"))
    metrics = validation_metrics(out.where(F.col("_place") <= TEST), key, value, "predicted")
    return IntervalModel(model, residuals, metrics, out.where(F.col("_place") > CALIBRATION + TEST).select(key).distinct())


def recursive_forecast(panel: DataFrame, trained: IntervalModel, key: str, date: str, value: str, cut: Step, features: Step | None = None, horizon: int = HORIZON) -> DataFrame:
    """FC7, FC8: `horizon` steps; each predicts the next month of all series from history and predictions, clips and orders the interval, and feeds the middle back.

    Only the last TAIL rows of each series are kept between steps; `cut` writes them to the shared
    checkpoint folder. Series that the model was not trained on carry their last value.
    """
    make = features or (lambda df: engineer_features(df, key, date, value))
    # Each is read in every step.
    bounds, residuals, known = cut(clip_bounds(panel, key, value)), cut(trained.residuals), cut(trained.trained.withColumn("_known", F.lit(True)))
    newest = Window.partitionBy(key).orderBy(F.desc(date))
    tail = panel.select(key, date, value).withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= TAIL).drop("_n")
    tail = cut(tail)
    steps: list[DataFrame] = []
    for step in range(1, horizon + 1):
        last = tail.groupBy(key).agg(F.max(date).alias("_d"), F.expr(f"max_by({value}, {date}) FILTER (WHERE {value} IS NOT NULL)").alias("_last"))
        following = last.select(key, F.add_months("_d", 1).alias(date), F.lit(None).cast("double").alias(value), "_last")
        rows = make(tail.unionByName(following.drop("_last"))).join(following.select(key, date, "_last"), [key, date])
        predicted = trained.model.transform(scaled(rows)).join(residuals, key, "left").join(bounds, key, "left").join(known, key, "left")
        middle = F.when(F.col("_known"), F.col("prediction") * F.col("_scale")).otherwise(F.col("_last"))
        size = F.abs("_scale")
        mid, lo, hi = ordered_interval(middle, middle + F.coalesce("q10", F.lit(0.0)) * size, middle + F.coalesce("q90", F.lit(0.0)) * size, F.col("lo"), F.col("hi"))
        done = cut(predicted.select(key, date, F.lit(step).alias("step"), mid.alias("mid"), lo.alias("low"), hi.alias("high")))
        steps.append(done)
        longer = tail.unionByName(done.select(key, date, F.col("mid").alias(value)))
        tail = cut(longer.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= TAIL).drop("_n"))
    out = steps[0]
    for more in steps[1:]:
        out = out.unionByName(more)
    return out.select(key, date, "step", "mid", F.col("low").alias("lo"), F.col("high").alias("hi"))


def forecast_view(forecasts: DataFrame, key: Names, date: str = "month") -> DataFrame:
    """FC10: month as text, middle and interval, four digits."""
    return forecasts.select(*names(key), F.date_format(date, "yyyy-MM").alias("month"), *(fixed(F.col(c)).alias(c) for c in ("mid", "lo", "hi")))


def horizon_pick(forecasts: DataFrame, key: Names, steps: tuple[int, ...] = (1, 3, 6, 12)) -> DataFrame:
    """TOP4: the middle at some steps, one column each."""
    return forecasts.groupBy(*names(key)).agg(*(F.max(F.when(F.col("step") == k, F.col("mid"))).alias(f"m{k}") for k in steps))


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """TOP6: the trees' gain by feature, for top_n."""
    assembler, trees = model.stages[-2], model.stages[-1]
    return [(name.removeprefix("x_").removesuffix("_filled"), float(gain)) for name, gain in zip(assembler.getInputCols(), trees.featureImportances.toArray().tolist(), strict=True)]


def register_model(trained: IntervalModel, folder: str, group: str) -> str:
    """FC13: writes the model of a group under `folder`; load with PipelineModel.load."""
    path = f"{folder}/{group}"
    trained.model.write().overwrite().save(path)
    return path


def regime_ahead(history: DataFrame, forecasts: DataFrame, date: str = "month") -> DataFrame:
    """FC11: regimes of forecast months, compared with realised and predicted values three months before."""
    from tidemark.functions.scoring import regime

    path = history.select(date, F.col("fsi")).withColumn("ahead", F.lit(False)).unionByName(forecasts.select(date, F.col("mid").alias("fsi")).withColumn("ahead", F.lit(True)))
    w = Window.partitionBy(F.lit(1)).orderBy(date)
    labelled = path.withColumn("regime", regime(F.col("fsi"), F.coalesce(F.lag("fsi", 3).over(w), F.col("fsi"))))
    return labelled.where("ahead").drop("ahead")


def classifier_benchmark(rows: DataFrame, inputs: list[str], label: str, seed: int = 1) -> DataFrame:
    """FC14: logistic regression, random forest, boosted trees and a perceptron on labelled rows (0, 1): accuracy, detection and false alarm rates, precision, F1 and AUC on held-out rows.

    `rows` has a column is_test. They are dealt evenly to all cores once, whatever files and row groups they come in, and held
    as label and features alone; each model's held-out rows are predicted once.
    """
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import StandardScaler

    prepared = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="raw", handleInvalid="skip"), StandardScaler(inputCol="raw", outputCol="features", withMean=True)])
    spark = rows.sparkSession
    dealt = rows.select(*inputs, label, "is_test").repartition(DEALT * spark.sparkContext.defaultParallelism)
    fitted = prepared.fit(rows.where("not is_test"))
    held = fitted.transform(dealt).select(F.col(label).cast("double").alias(label), "features", "is_test").persist(StorageLevel.MEMORY_AND_DISK)
    train, test = held.where("not is_test").drop("is_test"), held.where("is_test").drop("is_test")
    models = {
        "logistic_regression": LogisticRegression(labelCol=label, maxIter=20),
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=10, maxDepth=4, seed=seed),
        "boosted_trees": GBTClassifier(labelCol=label, maxIter=5, maxDepth=3, seed=seed),
        "perceptron": MultilayerPerceptronClassifier(labelCol=label, layers=[len(inputs), 4, 2], maxIter=20, seed=seed),
    }
    out = []
    for name, model in models.items():
        scored = model.fit(train).transform(test).select(label, "rawPrediction", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
        auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction").evaluate(scored)
        n = lambda p, y: F.count_if((F.col("prediction") == p) & (F.col(label) == y))
        tp, fp, fn, tn = n(1, 1), n(1, 0), n(0, 1), n(0, 0)
        row = scored.agg(
            F.try_divide(tp + tn, F.count("*")).alias("accuracy"),
            F.try_divide(tp, tp + fn).alias("detection_rate"),
            F.try_divide(fp, fp + tn).alias("false_alarm_rate"),
            F.try_divide(tp, tp + fp).alias("precision"),
            F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ).first()
        scored.unpersist()
        out.append((name, *row, auc))
    held.unpersist()
    return spark.createDataFrame(out, "model string, accuracy double, detection_rate double, false_alarm_rate double, precision double, f1 double, auc double")


def interval(mid: Column, lo: Column, hi: Column, floor: Column, ceiling: Column) -> Column:
    m, a, b = ordered_interval(mid, lo, hi, floor, ceiling)
    return F.struct(m.alias("mid"), a.alias("lo"), b.alias("hi"))


#: Inputs of the boosted models, in the order of the array `x`, and the models' losses.
INPUTS = [*LEVELS, *RATIOS, "missing"]
SHARES = {"mid": None, "q10": 0.1, "q90": 0.9}


@dataclass
class BoostedModels:
    """FC5: boosted trees of the middle and of two quantiles; of each series the metrics over its last months, and the months
    and rows that it was trained on."""

    boosters: dict[str, boosting.Booster]
    metrics: DataFrame
    trained: DataFrame


def model_rows(features: DataFrame) -> DataFrame:
    """Feature rows with their inputs as an array `x`, on the scale of `_scale`."""
    return scaled(features).withColumn("x", F.array(*(F.col(f"x_{c}") for c in INPUTS)))


def predicted(rows: DataFrame, boosters: dict[str, boosting.Booster]) -> DataFrame:
    """model_rows() with mid, lo and hi; the quantiles never cross the middle."""
    mid, lo, hi = (b.predict() * F.col("_scale") for b in (boosters["mid"], boosters["q10"], boosters["q90"]))
    out = rows.withColumns({"mid": mid, "_a": lo, "_b": hi})
    return out.withColumns({"lo": F.least("_a", "_b", "mid"), "hi": F.greatest("_a", "_b", "mid")}).drop("_a", "_b")


def train_boosted(features: DataFrame, key: str, cut: Step, date: str = "month", value: str = "value", **limits) -> BoostedModels:
    """FC5, FC9: trees for the mean and the 10 % and 90 % quantiles of all series, grown on all but the last CALIBRATION + TEST
    months; the calibration months stop them early, and the test months give the metrics: those of the middle, the pinball
    losses of both quantiles on the row's scale, and the share of values within the interval."""
    rows = model_rows(trainable(features.where(F.col("lag1").isNotNull()), key, value))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date)))
    parts = cut(rows.select(key, date, value, "_scale", "x", (F.col(value) / F.abs("_scale")).alias("y"), place.alias("_place")))
    # The slope of a negative scale would turn quantiles round.
    signed = parts.withColumn("_scale", F.abs("_scale"))
    seen = signed.where(F.col("_place") > TEST).withColumn("held", F.col("_place") <= CALIBRATION + TEST)
    boosters = boosting.boost(seen, SHARES, cut, len(INPUTS), **limits)
    test = predicted(signed.where(F.col("_place") <= TEST), boosters)
    y = F.col(value) / F.col("_scale")
    losses = {f"pinball_{n}": F.avg(boosting.pinball(y, F.col(c) / F.col("_scale"), s)) for n, c, s in (("q10", "lo", 0.1), ("q90", "hi", 0.9))}
    extra = test.groupBy(F.col(key).alias("_key")).agg(F.avg(F.col(value).between(F.col("lo"), F.col("hi")).cast("double")).alias("coverage"), *(c.alias(n) for n, c in losses.items()))
    metrics = validation_metrics(test, key, value, "mid").join(extra, F.col(key) == F.col("_key"), "left").drop("_key")
    trained = signed.where(F.col("_place") > CALIBRATION + TEST).groupBy(key).agg(F.max(date).alias("trained_until"), F.count("*").alias("n_rows"))
    return BoostedModels(boosters, metrics, trained)


def next_inputs(v: str, f: str, d: str) -> str:
    """SQL of the inputs and the scale of the month `d` that follows the values `v`, filled forward as `f` (arrays, at most
    TAIL long): what scaled() makes of engineer_features() for that row."""
    at = lambda a, k: f"try_element_at({a}, -{k})"
    cols = {f"lag{k}": at(v, k) for k in LAGS}
    for w in WINDOWS:
        part = f"filter(slice({v}, greatest(1, size({v}) - {w - 1}), {w}), e -> e IS NOT NULL)"
        mean = f"(aggregate({part}, 0D, (t, e) -> t + e) / nullif(size({part}), 0))"
        enough = f"size({part}) >= {max(1, w // 2)}"
        # Deviations are taken from the mean, which is bound once.
        spread = f"transform(array({mean}), m -> sqrt(aggregate({part}, 0D, (t, e) -> t + (e - m) * (e - m)) / nullif(size({part}) - 1, 0)))[0]"
        cols |= {f"roll{w}_mean": f"CASE WHEN {enough} THEN {mean} END", f"roll{w}_std": f"CASE WHEN {enough} THEN {spread} END"}
    change = lambda a, b: f"try_divide({a} - {b}, {b}) * 100"
    ratios = {"mom": change(at(f, 1), at(f, 2)), "yoy": change(at(f, 1), at(f, 13)), "month_of_year": f"CAST(month({d}) AS DOUBLE)", "quarter": f"CAST(quarter({d}) AS DOUBLE)"}
    scale = f"coalesce(nullif({cols['roll12_mean']}, 0D), nullif({cols['lag1']}, 0D), 1D)"
    levels = ", ".join(f"({cols[c]}) / z.scale" for c in LEVELS)
    others = ", ".join(f"z.{c}" for c in RATIOS)
    bound = f"named_struct('scale', {scale}, {', '.join(f"'{c}', {e}" for c, e in ratios.items())})"
    return f"transform(array({bound}), z -> named_struct('scale', z.scale, 'x', array({levels}, {others}, CAST(z.yoy IS NULL AS DOUBLE))))[0]"


def folded_forecast(panel: DataFrame, trained: BoostedModels, key: str, date: str = "month", value: str = "value", horizon: int = HORIZON) -> DataFrame:
    """FC7, FC8: the whole horizon in one pass. The last TAIL rows of a series are one array; a fold over the steps makes the
    next month's inputs from it, predicts, clips and orders the interval, and appends the middle for the steps behind.

    Series that the models were not trained on carry their last value. A series without values has null middles.
    """
    newest = Window.partitionBy(key).orderBy(F.desc(date))
    tail = panel.select(key, F.col(date).alias("_d"), F.col(value).cast("double").alias("_v"), F.row_number().over(newest).alias("_n")).where(F.col("_n") <= TAIL)
    series = tail.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_d", "_v"))).alias("_t"))  # TAIL rows a series
    known = trained.trained.select(F.col(key).alias("_key"), F.lit(True).alias("_known"))
    bounds = clip_bounds(panel, key, value).select(F.col(key).alias("_bound_key"), F.col("lo").alias("_floor"), F.col("hi").alias("_ceiling"))
    rows = series.join(known, F.col(key) == F.col("_key"), "left").join(bounds, F.col(key) == F.col("_bound_key"), "left")
    filled = "aggregate(_t._v, CAST(array() AS ARRAY<DOUBLE>), (f, e) -> array_append(f, coalesce(e, try_element_at(f, -1))))"
    start = f"named_struct('v', _t._v, 'f', {filled}, 'out', CAST(array() AS ARRAY<STRUCT<step: INT, mid: DOUBLE, lo: DOUBLE, hi: DOUBLE>>))"
    inputs = next_inputs("s.v", "s.f", "add_months(element_at(_t._d, -1), k)")
    raw = ", ".join(f"'{m}', {b.sql('i.x')} * abs(i.scale)" for m, b in trained.boosters.items())
    last = "try_element_at(filter(s.v, e -> e IS NOT NULL), -1)"
    # Null where the series has no model, then its last value stands for all three.
    asked = f"named_struct('mid', CASE WHEN _known THEN p.mid ELSE {last} END, 'lo', CASE WHEN _known THEN least(p.q10, p.q90, p.mid) ELSE {last} END, 'hi', CASE WHEN _known THEN greatest(p.q10, p.q90, p.mid) ELSE {last} END)"
    clip = lambda e: f"CASE WHEN {e} IS NOT NULL THEN least(greatest({e}, _floor), _ceiling) END"
    held = f"named_struct('mid', {clip('a.mid')}, 'lo', {clip('a.lo')}, 'hi', {clip('a.hi')})"
    keep = lambda name, e: f"slice(array_append(s.{name}, {e}), greatest(1, size(s.{name}) + 2 - {TAIL}), {TAIL})"
    done = f"named_struct('v', {keep('v', 'c.mid')}, 'f', {keep('f', 'coalesce(c.mid, try_element_at(s.f, -1))')}, 'out', array_append(s.out, named_struct('step', k, 'mid', c.mid, 'lo', least(c.lo, c.mid), 'hi', greatest(c.hi, c.mid))))"
    step = f"transform(transform(transform(transform(array({inputs}), i -> named_struct({raw})), p -> {asked}), a -> {held}), c -> {done})[0]"
    path = F.expr(f"aggregate(sequence(1, {int(horizon)}), {start}, (s, k) -> {step}).out")
    out = rows.select(key, F.element_at("_t._d", -1).alias("_last"), F.explode(path).alias("_o")).select(key, "_last", "_o.*")
    return out.select(key, F.add_months("_last", F.col("step")).alias(date), "step", "mid", "lo", "hi")


def register_boosted(trained: BoostedModels, folder: str, group: str, key: str) -> DataFrame:
    """FC13: writes a group's models under `folder` and adds its series to the registry table there: group, series, path of the
    models, last month and rows of training, and the metrics. Gives the group's rows of the registry; boosting.load(path)
    gives the models back."""
    spark = trained.metrics.sparkSession
    path = f"{folder}/models/{group}"
    boosting.save(spark, trained.boosters, path)
    rows = trained.trained.join(trained.metrics, key, "left").select(F.lit(group).alias("group"), F.col(key).alias("series_id"), F.lit(path).alias("path"), "trained_until", "n_rows", "mae", "rmse", "r2", "coverage")
    # A group's rows are a partition of the table, so a group that is trained again replaces its own.
    rows.withColumn("part", F.lit(group)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{folder}/registry")
    return spark.read.parquet(f"{folder}/registry").where(F.col("part") == group).drop("part")
