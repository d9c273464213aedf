"""Serving views over results, forecasts and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import fixed, pct_change, unit_number
from tidemark.functions.scoring import direction_word, trend_report, trend_summary
from tidemark.operators.align import with_row
from tidemark.operators.forecast import horizon_pick

#: Fixed value: ids of series, in capitals.
SERIES_ID = r"^[A-Z0-9_]{1,30}\z"


def group_results(panel: DataFrame, forecasts: DataFrame, metrics: DataFrame, labels: DataFrame, run_at: Column) -> DataFrame:
    """SNK8: one nested document for each group: series with last valid value, validation and forecast, four digits.

    panel: group_id, series_id, month, value; forecasts: group_id, series_id, month, step, mid, lo, hi;
    metrics: group_id, series_id, mae, rmse, r2; labels: series_id, label, unit.
    """
    keys = ["group_id", "series_id"]
    last = panel.where("value IS NOT NULL").groupBy(*keys).agg(F.date_format(F.max("month"), "yyyy-MM").alias("last_date"), fixed(F.max_by("value", "month")).alias("last_value"))
    point = F.struct("step", F.struct(F.date_format("month", "yyyy-MM").alias("month"), *(fixed(F.col(c)).alias(c) for c in ("mid", "lo", "hi"))).alias("p"))
    ahead = forecasts.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(point)), lambda x: x["p"]).alias("forecast"))
    checked = metrics.select(*keys, F.struct("mae", "rmse", "r2").alias("validation"))
    series = last.join(ahead, keys, "left").join(checked, keys, "left").join(labels, "series_id", "left")
    item = F.struct("series_id", "label", "unit", "last_date", "last_value", "validation", "forecast")
    return series.groupBy(F.col("group_id").alias("group")).agg(F.sort_array(F.collect_list(item)).alias("series")).select("group", run_at.alias("run_at"), "series")


def flat_results(documents: DataFrame) -> DataFrame:
    """SRC6: a row for each series of result documents."""
    return documents.select("group", F.explode("series").alias("s")).select("group", "s.*")


def flat_forecasts(documents: DataFrame) -> DataFrame:
    """SRC6: a row for each forecast point of result documents."""
    return flat_results(documents).select("group", "series_id", F.posexplode("forecast").alias("step", "p")).select("group", "series_id", (F.col("step") + 1).alias("step"), "p.*")


def summary_rows(flat: DataFrame) -> DataFrame:
    """VW1, TOP7: a row for each series: last value, errors, horizons, trend; ordered by group and series."""
    f = flat.withColumn("points", F.coalesce("forecast", F.array().cast(flat.schema["forecast"].dataType)))
    at = lambda k: F.try_element_at(F.col("points"), F.lit(k))["mid"]
    ends = F.when(F.size("points") >= 2, at(1)), F.when(F.size("points") >= 2, at(-1))
    return f.select("group", "series_id", "last_value", F.col("validation.mae").alias("mae"), F.col("validation.r2").alias("r2"), *(at(k).alias(f"m{k}") for k in (1, 3, 6, 12)), trend_summary(*ends).alias("trend")).orderBy("group", "series_id")


def report_rows(flat: DataFrame) -> DataFrame:
    """VW2, IND19: last value, horizons as text, trend with its series' thresholds, and whether the group has an R2 below -5."""
    low = F.bool_or(F.col("validation.r2") < -5).over(Window.partitionBy("group"))
    at = lambda k: F.try_element_at("forecast", F.lit(k))["mid"]
    return flat.select(
        "group",
        "series_id",
        unit_number(F.col("last_value"), F.col("unit")).alias("last_text"),
        unit_number(at(6), F.col("unit")).alias("m6_text"),
        unit_number(at(12), F.col("unit")).alias("m12_text"),
        trend_report(F.col("last_value"), at(12), F.col("series_id"), F.col("unit")).alias("trend"),
        F.coalesce(low, F.lit(False)).alias("low_confidence"),
    )


def signal_text(flat: DataFrame, templates: DataFrame) -> DataFrame:
    """VW3: each group's template with {series_last}, {series_12m} and {series_dir} filled in; what is missing is a dash.

    templates: group, template. Series names in templates are ids in lower case.
    """
    ahead = F.try_element_at("forecast", F.lit(12))["mid"]
    pct = pct_change(ahead, F.col("last_value"))
    name = F.lower("series_id")
    facts = flat.select(
        "group",
        F.explode(
            F.array(
                F.struct(F.concat(name, F.lit("_last")).alias("k"), unit_number(F.col("last_value"), F.col("unit")).alias("v")),
                F.struct(F.concat(name, F.lit("_12m")).alias("k"), unit_number(ahead, F.col("unit")).alias("v")),
                F.struct(F.concat(name, F.lit("_dir")).alias("k"), F.coalesce(direction_word(pct), F.lit("—")).alias("v")),
            )
        ).alias("fact"),
    )
    held = facts.groupBy("group").agg(F.sort_array(F.collect_list("fact")).alias("facts"))
    joined = templates.join(held, "group", "left")
    filled = F.aggregate(F.coalesce("facts", F.array().cast("array<struct<k:string,v:string>>")), F.col("template"), lambda acc, x: F.replace(acc, F.concat(F.lit("{"), x["k"], F.lit("}")), F.coalesce(x["v"], F.lit("—"))))
    return joined.select("group", F.regexp_replace(filled, r"\{[a-z0-9_.\-]+\}", "—").alias("signal"))


def narrative(values: DataFrame, rules: list[tuple[int, Column, Column]]) -> DataFrame:
    """VW4: one bullet for each rule (order, condition, text) that holds on a row of named values."""
    bullets = F.array(*(F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(n).alias("place"), t.alias("bullet"))) for n, c, t in rules))
    return values.select(F.explode(F.filter(bullets, lambda b: b.isNotNull())).alias("b")).select("b.*")


def catalogue(views: DataFrame, flat: DataFrame) -> DataFrame:
    """VW5: every view (view, series_id) with whether all its series have results."""
    joined = views.join(flat.select("series_id").distinct().withColumn("_there", F.lit(True)), "series_id", "left")
    return joined.groupBy("view").agg(F.sort_array(F.collect_list("series_id")).alias("series_ids"), F.bool_and(F.coalesce("_there", F.lit(False))).alias("available"))


def select_series(flat: DataFrame, group: str | None = None, series: list[str] | None = None) -> DataFrame:
    """FLT10, VW6: rows of a group and of some series; asking for what isn't there fails with what is."""
    out = flat if group is None else flat.where(F.col("group") == group)
    out = out if series is None else out.where(F.col("series_id").isin(series))
    if out.isEmpty():
        there = flat.select("group").distinct().orderBy("group").limit(100)
        raise LookupError("no such group or series; groups: " + ", ".join(str(r["group"]) for r in there.collect()))
    return out


def valid_id(series_id: Column) -> Column:
    """FLT11: whether an id has the form of one."""
    return F.upper(series_id).rlike(SERIES_ID)


def series_history(panel: DataFrame, series_id: str, key: str = "series_id", date: str = "month", value: str = "value") -> DataFrame:
    """VW7, FLT13: dates as text and values with six digits, in order."""
    return panel.where(F.col(key) == series_id).select(F.date_format(date, "yyyy-MM-dd").alias("date"), fixed(F.col(value), 6).alias("value")).orderBy("date")


def latest_briefing(briefings: DataFrame, now: Column, stale_hours: int = 36) -> DataFrame:
    """VW8: the newest briefing and whether it is older than 36 hours."""
    newest = briefings.agg(F.max_by(F.struct(*briefings.columns), "generated_at").alias("b")).select("b.*")
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds("generated_at")
    return newest.withColumn("is_stale", age > stale_hours * 3600)


def with_cold_start(forecasts: DataFrame, gate: DataFrame) -> DataFrame:
    """VW10: the news forecasts, or none of them but the gate's status row while it is cold."""
    rows = with_row(forecasts, gate.select("cold_start", "days_collected", "min_required"))
    warm = rows.where("NOT cold_start").withColumn("status", F.lit("ok")).drop("cold_start")
    cold = gate.where("cold_start").select("days_collected", "min_required", F.lit("cold_start").alias("status"))
    return warm.unionByName(cold, allowMissingColumns=True)


def pipeline_status(status: DataFrame) -> DataFrame:
    """VW11: component, status and detail of each source prefix."""
    hint = F.when(F.coalesce("first_error", F.lit("")) != "", F.concat(F.lit(" — "), F.col("first_error"))).otherwise(F.lit(""))
    detail = F.concat(F.col("n_ok"), F.lit(" ok, "), F.col("n_error"), F.lit(" errors"), hint)
    return status.select(F.concat(F.lit("Sector data: "), F.col("prefix")).alias("component"), F.col("state").alias("status"), detail.alias("detail"))


def horizons(forecasts: DataFrame) -> DataFrame:
    return horizon_pick(forecasts, "series_id")
