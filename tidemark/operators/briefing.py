"""News scores, rankings and the daily briefing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import fixed
from tidemark.functions.scoring import impact
from tidemark.operators.aggregates import sector_mood, tag_volume, volume_spike
from tidemark.operators.align import with_row

#: An alert's least score, sentiment that makes a signal, and bullets of a briefing.
ALERT, OUTLIER, BULLETS = 0.75, 0.3, 6


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int, place: str = "place") -> DataFrame:
    """TOP1, TOP5, TOP6, TOP8: the first n rows of each group in a total order, numbered."""
    return df.withColumn(place, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(place) <= n)


def score_impact(articles: DataFrame, day: str) -> DataFrame:
    """IND13 over all articles, with volume spikes from their whole history.

    Spikes are a row a sector and are broadcast: dealt by sector, whole articles of a language would meet in one task.
    """
    spikes = volume_spike(articles, "sector", day)
    joined = articles.join(F.broadcast(spikes), "sector", "left")
    return joined.withColumn("impact", fixed(impact(F.col("sentiment"), F.col("source_name"), F.col("ticker"), F.col("macro_tag"), F.col("spike")))).drop("spike")


def top_stories(scored: DataFrame, day: str, n: int = 10) -> DataFrame:
    """TOP1: each day's stories of the highest impact; ties by url, then id."""
    return top_n(scored.where(F.col("impact").isNotNull()), [day], [F.desc("impact"), F.asc("url"), F.asc("article_id")], n)


def alerts(scored: DataFrame, day: str, least: float = ALERT, n: int = 5) -> DataFrame:
    """TOP2: each day's highest impacts from `least` on as 'source: headline'; rows without headline go after the limit."""
    high = top_n(scored.where(F.col("impact") >= least), [day], [F.desc("impact"), F.asc("url"), F.asc("article_id")], n)
    source, headline = F.trim(F.coalesce("source_name", F.lit(""))), F.trim(F.coalesce("headline", F.lit("")))
    text = F.when(source == "", headline).otherwise(F.concat(source, F.lit(": "), headline))
    return high.where(headline != "").select(day, "place", text.alias("alert"))


def macro_signals(articles: DataFrame, regime: DataFrame, most: int = BULLETS) -> DataFrame:
    """TOP3: regime first, then tags with three articles or more, leaving a place free, then sectors of strong mood.

    `regime` has one row or none: current_regime, current_fsi.
    """
    first = regime.where("current_regime IS NOT NULL AND current_fsi IS NOT NULL").select(
        F.lit(1).alias("kind"), F.lit(0.0).alias("rank"), F.lit("").alias("name"),
        F.format_string("Market regime: %s (FSI=%.3f)", F.initcap("current_regime"), F.col("current_fsi").cast("double")).alias("bullet"),
    )
    tags = tag_volume(articles).select(
        F.lit(2).alias("kind"), (-F.col("articles")).cast("double").alias("rank"), F.col("macro_tag").alias("name"),
        F.format_string("%d %s articles today", F.col("articles"), F.replace(F.col("macro_tag"), F.lit("_"), F.lit(" "))).alias("bullet"),
    )
    mood = sector_mood(articles).where(F.abs("mood") > OUTLIER).select(
        F.lit(3).alias("kind"), (-F.abs("mood")).alias("rank"), F.col("sector").alias("name"),
        F.format_string("%s sentiment %s (%+.3f)", F.initcap("sector"), F.when(F.col("mood") > 0, "positive").otherwise("negative"), F.col("mood")).alias("bullet"),
    )
    # Tags fill the places up to the last but one; what is over goes before moods are numbered.
    early = first.union(tags).withColumn("place", F.row_number().over(Window.orderBy("kind", "rank", "name"))).where(F.col("place") < most)
    rows = early.drop("place").union(mood)
    return rows.withColumn("place", F.row_number().over(Window.orderBy("kind", "rank", "name"))).where(F.col("place") <= most).select("place", "bullet")


def daily_briefing(scored: DataFrame, day: str, regime: DataFrame, on: Column, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """VW9: one row: count, stories, mood, signals and alerts of one day. `cut` writes the day's scored articles to the
    shared checkpoint folder, so that each is scored once."""
    today = cut(scored.where(F.col(day) == on))
    stories = top_stories(today, day).agg(F.sort_array(F.collect_list(F.struct("place", "headline", "impact"))).alias("top_stories"))
    mood = sector_mood(today).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("sector", "mood")))).alias("sector_mood"))
    signals = macro_signals(today, regime).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "bullet"))), lambda x: x["bullet"]).alias("macro_signals"))
    alarm = alerts(today, day).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "alert"))), lambda x: x["alert"]).alias("alerts"))
    count = today.agg(F.count("*").alias("article_count"))
    out = count
    for part in (stories, mood, signals, alarm):
        out = with_row(out, part)
    return out.select(on.alias("date"), "*")
