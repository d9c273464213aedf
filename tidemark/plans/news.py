"""Queries over articles: text functions, normalisation, scores, briefing and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import numeric, scoring, text
from tidemark.functions.numeric import fixed
from tidemark.operators import briefing, features
from tidemark.plans.catalog import ARTICLES, SECTOR_CASE, articles, panel, query, r4, table
from tidemark.plans.rollups import SPIKE
from tidemark.plans.series import REGIMES, SIGNS
from tidemark.sources import filters, payloads, sinks
from tidemark.streaming import news as streams

URL_SQL = r"lower(regexp_extract(regexp_replace(trim(url), '[?#].*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1)) || regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(url), '[?#].*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', ''), ';[^/]*$', ''), '/+$', '')"


@query("str1_normalize_url", f"SELECT page_id, {URL_SQL} AS url_norm FROM pages")
def str1(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.normalize_url(F.col("url")).alias("url_norm"))


@query("str2_classify_sector", f"SELECT doc_id, {SECTOR_CASE} AS sector FROM (SELECT doc_id, text || ' ' || upper(source) || ' ' || lang AS text FROM documents)")
def str2(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.classify_sector(F.col("text"), F.upper("source"), F.array("lang")).alias("sector"))


@query("str3_classify_macro_tag", f"WITH {ARTICLES} SELECT article_id, macro_tag FROM articles")
def str3(spark, sf):
    return articles(spark, sf).select("article_id", "macro_tag")


LABEL = "CASE WHEN {0} > 0.05 THEN 'positive' WHEN {0} < -0.05 THEN 'negative' WHEN {0} IS NOT NULL THEN 'neutral' END"


@query("str4_sentiment_label", f"WITH {ARTICLES} SELECT article_id, {LABEL.format('sentiment')} AS label FROM articles")
def str4(spark, sf):
    return articles(spark, sf).select("article_id", text.sentiment_label(F.col("sentiment")).alias("label"))


def entities(spark, sf):
    """Conversations as articles whose turns are entities."""
    c = table(spark, sf, "conversations")
    score = F.when(F.col("role") == "user", None).otherwise(F.char_length("text") % 7 / 4)
    mood = F.when(F.col("role") == "system", None).otherwise(F.char_length("text") % 21 / 10 - 1)
    e = F.struct("turn", F.when(F.col("turn") == 1, "").otherwise(F.concat(F.upper("role"), F.col("turn").cast("string"))).alias("symbol"), score.cast("double").alias("match_score"), mood.cast("double").alias("sentiment_score"))
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(e)).alias("e"))
    return g.select("conv_id", F.transform("e", lambda x: F.struct(x["symbol"].alias("symbol"), x["match_score"].alias("match_score"), x["sentiment_score"].alias("sentiment_score"))).alias("entities"))


ENTITIES = (
    "e AS (SELECT conv_id, turn, CASE WHEN turn = 1 THEN '' ELSE upper(role) || turn END AS symbol, CASE WHEN role = 'user' THEN NULL ELSE length(text) % 7 / 4.0 END AS ms, "
    "CASE WHEN role = 'system' THEN NULL ELSE length(text) % 21 / 10.0 - 1 END AS ss FROM conversations)"
)


@query("str5_primary_entity", f"WITH {ENTITIES}, n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(ms, 0) DESC, turn) AS k FROM e) SELECT conv_id, symbol AS primary FROM n WHERE k = 1".replace("AS primary", 'AS "primary"'))
def str5(spark, sf):
    return entities(spark, sf).select("conv_id", text.primary_entity(F.col("entities")).alias("primary"))


@query("str6_entity_symbols", f"WITH {ENTITIES} SELECT conv_id, coalesce('[' || string_agg('\"' || symbol || '\"', ',' ORDER BY turn) FILTER (WHERE symbol <> '') || ']', '[]') AS symbols FROM e GROUP BY 1")
def str6(spark, sf):
    return entities(spark, sf).select("conv_id", F.to_json(text.entity_symbols(F.col("entities"))).alias("symbols"))


WEIGHTED = "sum(CASE WHEN ss IS NOT NULL THEN ss * CASE WHEN coalesce(ms, 0) = 0 THEN 1 ELSE ms END END) / sum(CASE WHEN ss IS NOT NULL THEN CASE WHEN coalesce(ms, 0) = 0 THEN 1 ELSE ms END END)"


@query("str7_weighted_sentiment", f"WITH {ENTITIES} SELECT conv_id, {r4(WEIGHTED)} AS sentiment FROM e GROUP BY 1")
def str7(spark, sf):
    return entities(spark, sf).select("conv_id", fixed(text.weighted_sentiment(F.col("entities"))).alias("sentiment"))


@query("str8_summary_truncate", "SELECT doc_id, left(text, 500) AS summary FROM documents")
def str8(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.summary(F.col("text")).alias("summary"))


@query("str9_label_fallback", "SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_name END, replace(replace(p_brand, '#', '_'), '_', ' ')) AS label FROM part")
def str9(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.label_or_id(F.when(F.col("p_size") > 25, F.col("p_name")), F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("label"))


@query("src12_normalize_newsapi", "SELECT url, text AS headline, left(html, 500) AS summary, '' AS ticker FROM (SELECT url, 'Page ' || page_id AS text, html FROM pages)")
def src12(spark, sf):
    p = table(spark, sf, "pages")
    raw = p.select(F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"), "url", F.col("html").alias("description"), F.lit("2024-01-01T00:00:00Z").alias("publishedAt"), F.struct(F.lit("web").alias("name")).alias("source"))
    return payloads.newsapi(raw).select("url", "headline", "summary", "ticker")


@query("src13_normalize_marketaux", f"WITH {ENTITIES}, n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(ms, 0) DESC, turn) AS k FROM e), a AS (SELECT conv_id, max(symbol) FILTER (WHERE k = 1) AS ticker, count(*) FILTER (WHERE symbol <> '') AS n, {WEIGHTED} AS s FROM n GROUP BY 1) SELECT 'conv/' || conv_id AS url, coalesce(ticker, '') AS ticker, n AS n_entities, {r4('s')} AS sentiment, {LABEL.format('s')} AS sentiment_label FROM a")
def src13(spark, sf):
    raw = entities(spark, sf).select(F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("url"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("description"), F.lit("").alias("published_at"), F.lit("s").alias("source"), "entities")
    return payloads.marketaux(raw).select("url", "ticker", F.size("entities").cast("long").alias("n_entities"), fixed(F.col("sentiment")).alias("sentiment"), "sentiment_label")


@query("src14_normalize_finnhub", "SELECT CAST(event_id AS VARCHAR) AS url, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS timestamp, CASE WHEN event_type = 'view' THEN '' ELSE upper(event_type) END AS ticker, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS n_entities FROM events")
def src14(spark, sf):
    e = table(spark, sf, "events")
    raw = e.select(F.lit("h").alias("headline"), F.col("event_id").cast("string").alias("url"), F.lit("").alias("summary"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("datetime"), F.lit("s").alias("source"), F.when(F.col("event_type") == "view", F.lit(None).cast("string")).otherwise(F.upper("event_type")).alias("related"))
    return payloads.finnhub(raw).select("url", "timestamp", "ticker", F.size("entities").alias("n_entities"))


@query("src15_article_contract", f"WITH {ARTICLES}, a AS (SELECT *, headline || ' ' || ticker AS text FROM articles WHERE trim(headline) <> '' AND trim(url) <> '') SELECT article_id, {SECTOR_CASE} AS sector, macro_tag FROM a")
def src15(spark, sf):
    a = articles(spark, sf).withColumn("entities", F.array().cast("array<string>")).drop("sector", "macro_tag")
    return payloads.article_contract(a, F.lit("2024-02-01T00:00:00Z")).select("article_id", "sector", "macro_tag")


@query("src16_parse_symbol_sentiment", f"SELECT event_type AS symbol, {r4('avg(value)')} AS bullish, CAST(count(*) AS INTEGER) AS articles_last_week FROM events GROUP BY 1")
def src16(spark, sf):
    e = table(spark, sf, "events").groupBy("event_type").agg(F.avg("value").alias("v"), F.count("*").alias("n"))
    body = F.to_json(F.struct(F.col("event_type").alias("symbol"), F.struct(F.col("v").cast("string").alias("bullishPercent"), F.lit("n/a").alias("bearishPercent")).alias("sentiment"), F.struct(F.col("n").alias("articlesInLastWeek")).alias("buzz")))
    return payloads.symbol_sentiment(e.select(body.alias("body")), "body").select("symbol", fixed(F.col("bullish")).alias("bullish"), "articles_last_week")


@query("src17_parse_sentiment_agg", f"WITH s AS (SELECT lang, source, CASE WHEN lang = 'es' THEN 0 ELSE count(*) END AS n, avg(n_chars) / 2500 - 1 AS s FROM documents GROUP BY 1, 2) SELECT lang || '/' || source AS key, n AS total_documents, {r4('s')} AS sentiment_avg, {LABEL.format('s')} AS label FROM s")
def src17(spark, sf):
    d = table(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), (F.avg("n_chars") / 2500 - 1).alias("s"))
    item = F.struct(F.concat("lang", F.lit("/"), "source").alias("key"), F.when(F.col("lang") != "es", F.col("n")).alias("total_documents"), F.col("s").alias("sentiment_avg"))
    bodies = d.groupBy("lang").agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("body"))
    return payloads.sentiment_aggregate(bodies, "body").withColumn("sentiment_avg", fixed(F.col("sentiment_avg")))


NEW_ARTICLES_SQL = f"WITH n AS (SELECT page_id, {URL_SQL} AS u, url LIKE '%?%' AS stored FROM pages), f AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY page_id) AS k FROM n WHERE u NOT IN (SELECT u FROM n WHERE stored)) SELECT page_id FROM f WHERE k = 1"


@query("snk5_append_new_articles", NEW_ARTICLES_SQL)
def snk5(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return sinks.new_articles(p, p.where(F.col("url").contains("?")), [F.asc("page_id")]).select("page_id")


@query("snk5_append_by_day_filters", NEW_ARTICLES_SQL)
def snk5_filters(spark, sf):
    """The batch is appended to a table of day partitions with a filter beside each."""
    day = F.concat(F.lit("2024-01-"), F.lpad((F.pmod("page_id", F.lit(28)) + 1).cast("string"), 2, "0"))
    p = table(spark, sf, "pages").select("page_id", "url", day.alias("day"))
    at, cut, order = f"{folder(spark)}/articles", cutter(spark), [F.asc("page_id")]
    filters.append_articles(p.where(F.col("url").contains("?")), at, "day", order, cut)
    return filters.append_articles(p, at, "day", order, cut).select("page_id")


# Scores and briefing

AUTHORITY = "CASE WHEN contains(lower(s), 'reuters') THEN 1.0 WHEN contains(lower(s), 'bloomberg') THEN 1.0 WHEN contains(lower(s), 'wall street journal') THEN 0.95 WHEN contains(lower(s), 'financial times') THEN 0.95 WHEN contains(lower(s), 'cnbc') THEN 0.85 WHEN contains(lower(s), 'associated press') THEN 0.85 WHEN contains(lower(s), 'marketwatch') THEN 0.75 WHEN contains(lower(s), 'seeking alpha') THEN 0.55 ELSE 0.5 END"
NAMED = "CASE source WHEN 'src0' THEN 'Reuters UK' WHEN 'src1' THEN 'CNBC' WHEN 'src2' THEN 'Seeking Alpha' ELSE source END"


@query("ind14_source_authority", f"SELECT doc_id, CAST({AUTHORITY} AS DOUBLE) AS authority FROM (SELECT doc_id, {NAMED} AS s FROM documents)")
def ind14(spark, sf):
    name = F.when(F.col("source") == "src0", "Reuters UK").when(F.col("source") == "src1", "CNBC").when(F.col("source") == "src2", "Seeking Alpha").otherwise(F.col("source"))
    return table(spark, sf, "documents").select("doc_id", scoring.source_authority(name).alias("authority"))


#: Tickers of articles, known and unknown, in several spellings.
TICKERS = [" spy ", " ", "AAPL", "ZZZZ", "msft", "BRK.B", "Ge", "QQQ ", None, "A", "meta", "GOOGL1"]


@query("ind15_ticker_prominence", "SELECT doc_id, CAST(CASE WHEN doc_id % 12 IN (0, 2, 4, 6, 7, 10) THEN 1.0 WHEN doc_id % 12 IN (1, 8) THEN 0.2 ELSE 0.5 END AS DOUBLE) AS prominence FROM documents")
def ind15(spark, sf):
    ticker = F.array(*map(F.lit, TICKERS))[F.pmod("doc_id", F.lit(len(TICKERS))).cast("int")]
    return table(spark, sf, "documents").select("doc_id", scoring.ticker_prominence(ticker).alias("prominence"))


TAG = "CASE macro_tag WHEN 'rate_cuts' THEN 1.0 WHEN 'earnings' THEN 1.0 WHEN 'ipo' THEN 0.8 WHEN 'gdp' THEN 0.7 WHEN 'inflation' THEN 0.7 WHEN 'funding_round' THEN 0.7 WHEN 'layoffs' THEN 0.6 WHEN 'regulation' THEN 0.6 ELSE 0.4 END"


@query("ind16_macro_tag_weight", f"WITH {ARTICLES} SELECT article_id, CAST({TAG} AS DOUBLE) AS weight FROM articles")
def ind16(spark, sf):
    return articles(spark, sf).select("article_id", scoring.tag_weight(F.col("macro_tag")).alias("weight"))


SCORED = f"{ARTICLES}, {SPIKE}, scored AS (SELECT a.*, {r4(f'least(0.25 * least(abs(coalesce(sentiment, 0)), 1) + 0.2 * 0.5 + 0.2 * 0.5 + 0.2 * coalesce(spike, 0.5) + 0.15 * {TAG}, 1)')} AS impact FROM articles a LEFT JOIN spikes USING (sector))"


def scored(spark, sf):
    return briefing.score_impact(articles(spark, sf), "day")


@query("ind13_impact_score", f"WITH {SCORED} SELECT article_id, impact FROM scored")
def ind13(spark, sf):
    return scored(spark, sf).select("article_id", "impact")


PLACES = "places AS (SELECT *, CAST(row_number() OVER (PARTITION BY day ORDER BY impact DESC, url, article_id) AS INTEGER) AS place FROM scored)"


@query("top1_top_stories", f"WITH {SCORED}, {PLACES} SELECT day, place, article_id, impact FROM places WHERE place <= 10", days=("day",))
def top1(spark, sf):
    return briefing.top_stories(scored(spark, sf), "day").select("day", "place", "article_id", "impact")


@query("top2_alerts", f"WITH {SCORED}, {PLACES.replace('FROM scored', 'FROM scored WHERE impact >= 0.4')} SELECT day, place, CASE WHEN trim(source_name) = '' THEN trim(headline) ELSE trim(source_name) || ': ' || trim(headline) END AS alert FROM places WHERE place <= 5 AND trim(headline) <> ''", days=("day",))
def top2(spark, sf):
    return briefing.alerts(scored(spark, sf), "day", 0.4)


SIGNAL_ROWS = (
    "one AS (SELECT 1 AS kind, 0.0 AS rank, '' AS name, 'Market regime: ' || upper(left(regime, 1)) || substr(regime, 2) || ' (FSI=' || printf('%.3f', fsi) || ')' AS bullet FROM regimes ORDER BY month DESC LIMIT 1), "
    "two AS (SELECT 2 AS kind, -count(*) AS rank, macro_tag AS name, count(*) || ' ' || replace(macro_tag, '_', ' ') || ' articles today' AS bullet FROM articles WHERE macro_tag IS NOT NULL GROUP BY macro_tag HAVING count(*) >= 3), "
    "early AS (SELECT *, row_number() OVER (ORDER BY kind, rank, name) AS k FROM (SELECT * FROM one UNION ALL SELECT * FROM two)), "
    f"mood AS (SELECT sector, {r4('avg(sentiment)', 3)} AS m FROM articles WHERE sentiment IS NOT NULL AND sector <> '' GROUP BY 1), "
    "three AS (SELECT 3 AS kind, -abs(m) AS rank, sector AS name, upper(left(sector, 1)) || substr(sector, 2) || ' sentiment ' || CASE WHEN m > 0 THEN 'positive' ELSE 'negative' END || ' (' || CASE WHEN m > 0 THEN '+' ELSE '' END || printf('%.3f', m) || ')' AS bullet FROM mood WHERE abs(m) > 0.3), "
    "bullets AS (SELECT CAST(row_number() OVER (ORDER BY kind, rank, name) AS INTEGER) AS place, bullet FROM (SELECT kind, rank, name, bullet FROM early WHERE k < 6 UNION ALL SELECT * FROM three))"
)


def current_regime(spark, sf):
    h = features.regime_history(features.stress_index(panel(spark, sf), "month", "series_id", "value", SIGNS))
    return h.agg(F.max_by("regime", "month").alias("current_regime"), F.max_by("fsi", "month").alias("current_fsi"))


@query("top3_macro_signals", f"WITH {ARTICLES}, {REGIMES}, {SIGNAL_ROWS} SELECT place, bullet FROM bullets WHERE place <= 6")
def top3(spark, sf):
    return briefing.macro_signals(articles(spark, sf), current_regime(spark, sf))


@query(
    "vw9_daily_briefing",
    f"WITH {SCORED}, {PLACES}, t AS (SELECT * FROM places WHERE day = DATE '2024-01-30') SELECT DATE '2024-01-30' AS date, count(*) AS article_count, string_agg(CAST(article_id AS VARCHAR), ',' ORDER BY place) FILTER (WHERE place <= 10) AS stories, (SELECT string_agg(sector || '=' || printf('%.3f', m), ',' ORDER BY sector) FROM (SELECT sector, {r4('avg(sentiment)', 3)} AS m FROM t WHERE sentiment IS NOT NULL GROUP BY 1)) AS mood FROM t",
    days=("date",)
)
def vw9(spark, sf):
    b = briefing.daily_briefing(scored(spark, sf).withColumn("headline", F.col("article_id").cast("string")), "day", current_regime(spark, sf), F.lit("2024-01-30").cast("date"), cutter(spark))
    mood = F.array_join(F.transform(F.map_entries("sector_mood"), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.3f", e["value"]))), ",")
    return b.select("date", "article_count", F.array_join(F.transform("top_stories", lambda s: s["headline"]), ",").alias("stories"), mood.alias("mood"))


@query("vw8_latest_briefing", "SELECT max(ts) AS generated_at, date_diff('second', max(ts), TIMESTAMP '2024-02-02 00:00:00') > 36 * 3600 AS is_stale FROM events WHERE event_type = 'signup'", days=("generated_at",))
def vw8(spark, sf):
    from tidemark.operators.views import latest_briefing

    b = table(spark, sf, "events").where("event_type = 'signup'").select(F.col("ts").cast("timestamp").alias("generated_at"))
    return latest_briefing(b, F.lit("2024-02-02 00:00:00").cast("timestamp"))


# Streams: each must equal its batch twin.


def folder(spark) -> str:
    """A fresh folder in the shared place that the session names; a local one only where that is unset and the master is local."""
    import tempfile

    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{base or tempfile.mkdtemp(prefix='tidemark-stream-')}/stream-{uuid.uuid4().hex}"


def cutter(spark):
    """Writes rows to the shared folder and reads them again."""
    at = folder(spark)

    def cut(df):
        path = f"{at}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return cut


def events(spark, sf):
    return streams.event_stream(spark, sf, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query("stm1_stream_dedup_articles", "SELECT DISTINCT 'https://x/' || user_id || '/' || event_type AS url_norm FROM events")
def stm1(spark, sf):
    at = folder(spark)
    s = events(spark, sf).select("ts", F.concat(F.lit("HTTPS://X/"), F.col("user_id").cast("string"), F.lit("/"), "event_type", F.lit("/?u="), F.col("event_id").cast("string")).alias("url"))
    return streams.run_to_table(streams.dedup_articles(s, "ts", "60 days").select("url_norm"), f"{at}/out", f"{at}/state")


@query("stm2_stream_sector_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY", days=("day",))
def stm2(spark, sf):
    at = folder(spark)
    return streams.run_to_table(streams.daily_counts(events(spark, sf), "ts", "event_type"), f"{at}/out", f"{at}/state").select(F.to_date("day").alias("day"), "event_type", "n")


@query(
    "stm3_stream_rolling_mood",
    f"WITH h AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR * k AS until, event_type, value FROM events, range(1, 25) AS r(k)) SELECT until, event_type, {r4('avg(value)')} AS mood FROM h GROUP BY 1, 2 HAVING until <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY",
    days=("until",)
)
def stm3(spark, sf):
    at = folder(spark)
    s = streams.rolling_mean(events(spark, sf), "ts", "event_type", "value").select("until", "event_type", fixed(F.col("mood")).alias("mood"))
    return streams.run_to_table(s, f"{at}/out", f"{at}/state")


@query("stm4_stream_alerts", "SELECT event_id, value FROM events WHERE value >= 90")
def stm4(spark, sf):
    at = folder(spark)
    streams.run_batches(streams.alerts(events(spark, sf), "value", 90.0).select("event_id", "value"), f"{at}/state", lambda batch, n: batch.write.mode("overwrite").parquet(f"{at}/out/{n}"))
    return spark.read.option("recursiveFileLookup", True).schema("event_id long, value double").parquet(f"{at}/out")


@query("stm5_stream_upsert_series", f"WITH l AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS day, max(value) AS value FROM events GROUP BY 1, 2) SELECT series_id, day, {r4('value')} AS value FROM l", days=("day",))
def stm5(spark, sf):
    at = folder(spark)
    write = streams.upsert_into(f"{at}/table", ["series_id", "day"], "day", cutter(spark))

    def each(batch, n):
        write(batch.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("day")).agg(F.max("value").alias("value")), n)

    streams.run_batches(events(spark, sf), f"{at}/state", each)
    return spark.read.schema("series_id string, value double, ingest_seq long, day date").parquet(f"{at}/table").select("series_id", "day", fixed(F.col("value")).alias("value"))


@query("ind22_direction_word", "SELECT event_id, CASE WHEN value - 50 < -2 THEN 'decline' WHEN value - 50 > 2 THEN 'rise' WHEN value IS NOT NULL THEN 'hold steady' END AS word FROM events")
def ind22(spark, sf):
    return table(spark, sf, "events").select("event_id", scoring.direction_word(F.col("value") - 50).alias("word"))


@query("ind20_format_value", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN format('{:,.0f}K', o_totalprice) WHEN '2-HIGH' THEN format('${:,.1f}B', o_totalprice) WHEN '3-MEDIUM' THEN format('${:,.0f}M', o_totalprice) WHEN '4-NOT SPECIFIED' THEN format('{:.2f}%', o_totalprice) ELSE CASE WHEN o_totalprice >= 10000 THEN format('{:,.0f}', o_totalprice) WHEN o_totalprice >= 100 THEN format('{:.2f}', o_totalprice) ELSE format('{:.4f}', o_totalprice) END END AS text FROM orders")
def ind20(spark, sf):
    p = F.col("o_orderpriority")
    unit = F.when(p == "1-URGENT", "K Persons").when(p == "2-HIGH", "B $").when(p == "3-MEDIUM", "M $").when(p == "4-NOT SPECIFIED", "%").otherwise("Index")
    return table(spark, sf, "orders").select("o_orderkey", numeric.unit_number(F.col("o_totalprice"), unit).alias("text"))
