"""Landed provider payloads to rows: explicit schemas, coerced numbers, no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start, quarter_month
from tidemark.functions.numeric import to_number, without_commas
from tidemark.functions.text import by_match, classify_macro_tag, classify_sector, entity_symbols, primary_entity, sentiment_label, summary, weighted_sentiment

ENTITIES = "array<struct<symbol:string,match_score:double,sentiment_score:double>>"


def fred_observations(payloads: DataFrame, key: str, body: str) -> DataFrame:
    """SRC7: observations; a dot is a missing value."""
    o = F.from_json(body, "observations array<struct<date:string,value:string>>")["observations"]
    rows = payloads.select(key, F.explode(o).alias("o"))
    return rows.select(key, F.try_to_date(F.col("o.date"), "yyyy-MM-dd").alias("observation_date"), to_number(F.col("o.value")).alias("value"))


def bls_series(payloads: DataFrame, body: str) -> DataFrame:
    """SRC8: months M01 to M12 of each series; annual means are left out."""
    schema = "Results struct<series:array<struct<seriesID:string,data:array<struct<year:string,period:string,value:string>>>>>"
    series = payloads.select(F.explode(F.from_json(body, schema)["Results"]["series"]).alias("s"))
    rows = series.select(F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("d")).where(F.col("d.period").rlike("^M(0[1-9]|1[0-2])$"))
    day = F.make_date(F.col("d.year").cast("int"), F.substring("d.period", 2, 2).cast("int"), F.lit(1))
    return rows.select("series_id", day.alias("observation_date"), to_number(without_commas(F.col("d.value"))).alias("value"))


def bea_industries(rows: DataFrame, industries: DataFrame) -> DataFrame:
    """SRC9: quarters of the mapped industries (IndustryID, series_id); the first of repeated dates, by seq, counts."""
    month = quarter_month(F.col("Quarter"))
    known = rows.join(industries, "IndustryID").where(month.isNotNull())
    dated = known.withColumn("observation_date", F.make_date(F.col("Year").cast("int"), month, F.lit(1)))
    first = F.row_number().over(Window.partitionBy("series_id", "observation_date").orderBy("seq"))
    return dated.withColumn("_n", first).where("_n = 1").select("series_id", "observation_date", to_number(without_commas(F.col("DataValue"))).alias("value"))


def worldbank(payloads: DataFrame, key: str, body: str) -> DataFrame:
    """SRC10: the second element of a payload has the years; null values are left out."""
    rows = F.from_json(F.get_json_object(body, "$[1]"), "array<struct<date:string,value:double>>")
    r = payloads.select(key, F.explode(rows).alias("r")).where("r.value IS NOT NULL")
    return r.select(key, F.make_date(F.col("r.date").cast("int"), F.lit(1), F.lit(1)).alias("observation_date"), F.col("r.value").alias("value"))


def price_history(prices: DataFrame, monthly: bool) -> DataFrame:
    """SRC11: closes by month start or by day."""
    day = F.to_date("ts")
    return prices.select("symbol", (month_start(day) if monthly else day).alias("date"), F.col("close"))


def newsapi(articles: DataFrame) -> DataFrame:
    """SRC12: no ticker and no sentiment."""
    return articles.select(
        F.col("publishedAt").alias("timestamp"), F.lit("newsapi").alias("source_api"), F.col("source.name").alias("source_name"), "url", F.col("title").alias("headline"),
        summary(F.coalesce("description", F.lit(""))).alias("summary"), F.lit("").alias("ticker"), F.array().cast("array<string>").alias("entities"),
        F.lit(None).cast("double").alias("sentiment"), F.lit(None).cast("string").alias("sentiment_label"),
    )


def marketaux(articles: DataFrame) -> DataFrame:
    """SRC13: primary ticker, symbols and weighted sentiment of the entities.

    The sentiment is summed from the highest match on: a mean on the edge of a label's band falls to a side by its last bit,
    which the order of the sum decides.
    """
    e = F.coalesce("entities", F.array().cast(ENTITIES))
    s = weighted_sentiment(by_match(e))
    return articles.select(
        F.col("published_at").alias("timestamp"), F.lit("marketaux").alias("source_api"), F.col("source").alias("source_name"), "url", F.col("title").alias("headline"),
        summary(F.coalesce("description", F.lit(""))).alias("summary"), F.coalesce(primary_entity(e), F.lit("")).alias("ticker"), entity_symbols(e).alias("entities"), s.alias("sentiment"), sentiment_label(s).alias("sentiment_label"),
    )


def finnhub(articles: DataFrame) -> DataFrame:
    """SRC14: epoch seconds as UTC text; the related ticker is the only entity."""
    t = F.coalesce("related", F.lit(""))
    return articles.select(
        F.date_format(F.timestamp_seconds("datetime"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.lit("finnhub").alias("source_api"), F.col("source").alias("source_name"), "url", "headline",
        summary(F.coalesce("summary", F.lit(""))).alias("summary"), t.alias("ticker"), F.when(t == "", F.array().cast("array<string>")).otherwise(F.array(t)).alias("entities"),
        F.lit(None).cast("double").alias("sentiment"), F.lit(None).cast("string").alias("sentiment_label"),
    )


def article_contract(articles: DataFrame, ingested_at: Column) -> DataFrame:
    """SRC15: rows with headline and url, with sector, macro tag and ingestion time."""
    there = (F.trim("headline") != "") & (F.trim("url") != "")
    return articles.where(there).withColumns({"sector": classify_sector(F.col("headline"), F.col("ticker"), F.col("entities")), "macro_tag": classify_macro_tag(F.col("headline")), "ingested_at": ingested_at})


def symbol_sentiment(payloads: DataFrame, body: str) -> DataFrame:
    """SRC16: nested sentiment and buzz as one row."""
    p = F.from_json(body, "symbol string, sentiment struct<bullishPercent:string,bearishPercent:string>, companyNewsScore string, sectorAverageNewsScore string, buzz struct<articlesInLastWeek:string,weeklyAverage:string>")
    rows = payloads.select(p.alias("p"))
    return rows.select(
        F.col("p.symbol").alias("symbol"), to_number(F.col("p.sentiment.bullishPercent")).alias("bullish"), to_number(F.col("p.sentiment.bearishPercent")).alias("bearish"),
        to_number(F.col("p.companyNewsScore")).alias("company_score"), to_number(F.col("p.sectorAverageNewsScore")).alias("sector_score"),
        to_number(F.col("p.buzz.articlesInLastWeek")).cast("int").alias("articles_last_week"), to_number(F.col("p.buzz.weeklyAverage")).alias("weekly_average"),
    )


def sentiment_aggregate(payloads: DataFrame, body: str) -> DataFrame:
    """SRC17: documents (null: 0), mean sentiment and label of each key."""
    rows = payloads.select(F.explode(F.from_json(body, "data array<struct<key:string,total_documents:bigint,sentiment_avg:double>>")["data"]).alias("d"))
    return rows.select("d.key", F.coalesce("d.total_documents", F.lit(0)).alias("total_documents"), F.col("d.sentiment_avg").alias("sentiment_avg"), sentiment_label(F.col("d.sentiment_avg")).alias("label"))


ROUND = (
    "identifier struct<uuid:string>, properties struct<identifier:struct<uuid:string>,funded_organization_identifier:struct<uuid:string>,announced_on:string,"
    "money_raised:string,investment_type:string,num_investors:string,lead_investor_identifiers:array<struct<uuid:string>>>"
)


def funding_rounds(payloads: DataFrame, body: str) -> DataFrame:
    """SRC18: money counts only from an object with value_usd; a lead investor is a list that isn't empty."""
    p = payloads.select(F.from_json(body, ROUND).alias("e"))
    q = F.col("e.properties")
    return p.select(
        F.coalesce(q["identifier"]["uuid"], F.col("e.identifier.uuid")).alias("round_uuid"), q["funded_organization_identifier"]["uuid"].alias("org_uuid"), F.try_to_date(q["announced_on"], "yyyy-MM-dd").alias("announced_on"),
        F.get_json_object(q["money_raised"], "$.value_usd").try_cast("double").alias("money"), q["investment_type"].alias("investment_type"), q["num_investors"].try_cast("int").alias("num_investors"),
        F.coalesce((F.size(q["lead_investor_identifiers"]) > 0).cast("int"), F.lit(0)).alias("lead"),
    )


def organizations(payloads: DataFrame, body: str) -> DataFrame:
    """SRC19."""
    p = payloads.select(F.from_json(body, "uuid string, properties struct<name:string,rank_org_company:string,funding_total:struct<value_usd:double>,last_funding_at:string,status:string>").alias("e"))
    q = F.col("e.properties")
    return p.select(
        F.col("e.uuid").alias("org_uuid"), q["name"].alias("org_name"), q["rank_org_company"].try_cast("double").alias("rank_org_company"),
        q["funding_total"]["value_usd"].alias("funding_total"), F.try_to_date(q["last_funding_at"], "yyyy-MM-dd").alias("last_funding_at"), q["status"].alias("status"),
    )


def category_dimension(hits: DataFrame, existing: DataFrame) -> DataFrame:
    """SRC20: the first hit of each category uuid in a segment, by seq, of those not known in any segment."""
    named = hits.where(F.coalesce("category_uuid", F.lit("")) != "")
    first = named.groupBy("segment", "category_uuid").agg(F.min_by("category_name", "seq").alias("category_name"))
    return first.join(existing.select("category_uuid").distinct(), "category_uuid", "left_anti").select("segment", "category_uuid", "category_name")
