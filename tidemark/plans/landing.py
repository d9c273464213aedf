"""Queries over landed payloads and incremental maintenance; payloads are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.functions.numeric import fixed
from tidemark.plans.catalog import DAILY, PANEL, ROUNDS, daily, panel, query, r4, rounds, table
from tidemark.plans.news import folder
from tidemark.sources import files, payloads, sinks


def months(spark, sf):
    """The panel with rounded values as text; every series' first month is missing."""
    p = panel(spark, sf)
    first = p.groupBy("series_id").agg(F.min("month").alias("first"))
    j = p.join(first, "series_id")
    return j.select("series_id", "month", F.when(F.col("month") == F.col("first"), ".").otherwise(fixed(F.col("value"), 2).cast("string")).alias("value"))


MONTHS = f"{PANEL}, mo AS (SELECT series_id, month, CASE WHEN month > min(month) OVER (PARTITION BY series_id) THEN {r4('value', 2)} END AS value FROM panel)"


@query("src7_parse_fred_obs", f"WITH {MONTHS} SELECT series_id, month AS observation_date, value FROM mo", days=("observation_date",))
def src7(spark, sf):
    body = F.to_json(F.struct(F.collect_list(F.struct(F.col("month").cast("string").alias("date"), "value")).alias("observations")))
    return payloads.fred_observations(months(spark, sf).groupBy("series_id").agg(body.alias("body")), "series_id", "body")


@query("src8_parse_bls_series", f"WITH {MONTHS} SELECT series_id, month AS observation_date, value FROM mo", days=("observation_date",))
def src8(spark, sf):
    m = months(spark, sf)
    period = F.concat(F.lit("M"), F.date_format("month", "MM"))
    mean = m.groupBy("series_id", F.year("month").alias("y")).agg(F.lit("1").alias("value")).select("series_id", F.col("y").cast("string").alias("year"), F.lit("M13").alias("period"), "value")
    rows = m.select("series_id", F.date_format("month", "yyyy").alias("year"), period.alias("period"), "value").union(mean)
    one = rows.groupBy("series_id").agg(F.struct(F.col("series_id").alias("seriesID"), F.collect_list(F.struct("year", "period", "value")).alias("data")).alias("s"))
    return payloads.bls_series(one.select(F.to_json(F.struct(F.struct(F.array("s").alias("series")).alias("Results"))).alias("body")), "body")


@query("src9_parse_bea_industry", f"WITH q AS (SELECT o_orderpriority AS id, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS d, {r4('sum(o_totalprice)', 1)} AS v FROM orders GROUP BY 1, 2) SELECT 'bea_' || left(id, 1) AS series_id, d AS observation_date, v AS value FROM q WHERE id < '4'", days=("observation_date",))
def src9(spark, sf):
    o = table(spark, sf, "orders")
    q = o.groupBy(F.col("o_orderpriority").alias("IndustryID"), F.date_trunc("quarter", F.col("o_orderdate")).cast("date").alias("d")).agg(F.sum("o_totalprice").alias("v"))
    roman = F.element_at(F.array(F.lit("I"), F.lit("II"), F.lit("III"), F.lit("IV")), F.quarter("d"))
    rows = q.select("IndustryID", F.year("d").cast("string").alias("Year"), roman.alias("Quarter"), F.format_number(fixed(F.col("v"), 1), 1).alias("DataValue"), F.lit(1).alias("seq"))
    again = rows.withColumns({"DataValue": F.lit("0.0"), "seq": F.lit(2)}).unionByName(rows.withColumns({"Quarter": F.lit("A"), "seq": F.lit(0)}))
    industries = q.select("IndustryID").distinct().where("IndustryID < '4'").withColumn("series_id", F.concat(F.lit("bea_"), F.substring("IndustryID", 1, 1)))
    return payloads.bea_industries(rows.unionByName(again), industries)


@query("src10_parse_worldbank", f"WITH y AS (SELECT l_returnflag AS series_id, CAST(date_trunc('year', l_shipdate) AS DATE) AS observation_date, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2) SELECT series_id, observation_date, {r4('v')} AS value FROM y WHERE year(observation_date) <> 1999", days=("observation_date",))
def src10(spark, sf):
    y = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("series_id"), F.year("l_shipdate").alias("y")).agg(F.avg("l_quantity").alias("v"))
    item = F.struct(F.col("y").cast("string").alias("date"), F.when(F.col("y") != 1999, F.col("v")).alias("value"))
    g = y.groupBy("series_id").agg(F.collect_list(item).alias("r"))
    body = F.concat(F.lit('[{"pages":1},'), F.to_json("r"), F.lit("]"))
    return payloads.worldbank(g.select("series_id", body.alias("body")), "series_id", "body").withColumn("value", fixed(F.col("value")))


@query("src11_parse_price_history", f"WITH d AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, arg_max(value, struct_pack(ts, event_id)) AS close FROM events GROUP BY 1, 2) SELECT symbol, date, {r4('close')} AS close FROM d", days=("date",))
def src11(spark, sf):
    e = table(spark, sf, "events").groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("d")).agg(F.max("ts").alias("ts"), F.max_by("value", F.struct("ts", "event_id")).alias("close"))
    return payloads.price_history(e, monthly=False).withColumn("close", fixed(F.col("close")))


@query("src18_flatten_funding_rounds", "SELECT o_orderkey AS round_uuid, o_custkey AS org_uuid, CAST(o_orderdate AS DATE) AS announced_on, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS money, CAST(o_orderstatus = 'F' AS INTEGER) AS lead FROM orders", days=("announced_on",))
def src18(spark, sf):
    o = table(spark, sf, "orders")
    money = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit('{"value_usd":'), F.format_string("%.2f", "o_totalprice"), F.lit("}"))).otherwise(F.lit('"undisclosed"'))
    leads = F.when(F.col("o_orderstatus") == "F", '[{"uuid":"x"}]').otherwise("[]")
    body = F.format_string(
        '{"identifier":{"uuid":"%d"},"properties":{"funded_organization_identifier":{"uuid":"%d"},"announced_on":"%s","money_raised":%s,"lead_investor_identifiers":%s}}',
        F.col("o_orderkey"), F.col("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd"), money, leads,
    )
    r = payloads.funding_rounds(o.select(body.alias("body")), "body")
    return r.select(F.col("round_uuid").cast("long").alias("round_uuid"), F.col("org_uuid").cast("long").alias("org_uuid"), "announced_on", "money", "lead")


@query("src19_flatten_organizations", "SELECT CAST(c_custkey AS VARCHAR) AS org_uuid, c_name AS org_name, CAST(c_nationkey AS DOUBLE) AS rank_org_company, c_acctbal AS funding_total FROM customer")
def src19(spark, sf):
    c = table(spark, sf, "customer")
    body = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("uuid"), F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("rank_org_company"), F.struct(F.col("c_acctbal").alias("value_usd")).alias("funding_total")).alias("properties")))
    return payloads.organizations(c.select(body.alias("body")), "body").select("org_uuid", "org_name", "rank_org_company", "funding_total")


@query("src20_build_category_dim", "WITH h AS (SELECT p_brand AS segment, p_type AS category_uuid, p_name AS category_name, p_partkey AS seq FROM part WHERE p_type <> ''), old AS (SELECT DISTINCT p_type FROM part WHERE p_type < 'M') SELECT segment, category_uuid, arg_min(category_name, seq) AS category_name FROM h WHERE category_uuid NOT IN (FROM old) GROUP BY 1, 2")
def src20(spark, sf):
    p = table(spark, sf, "part")
    hits = p.select(F.col("p_brand").alias("segment"), F.col("p_type").alias("category_uuid"), F.col("p_name").alias("category_name"), F.col("p_partkey").alias("seq"))
    return payloads.category_dimension(hits, p.where("p_type < 'M'").select(F.col("p_type").alias("category_uuid")))


@query("src21_parse_multi_format_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders", days=("date",))
def src21(spark, sf):
    o = table(spark, sf, "orders")
    t = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", dates.either_date(t).alias("date"))


@query("src22_station_key", "SELECT c_custkey, replace(c_name, ' ', '') || upper(c_mktsegment) AS key FROM customer")
def src22(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.station_key(F.col("c_name"), F.lower("c_mktsegment")).alias("key"))


@query("src1_read_series_csv", f"WITH {MONTHS} SELECT left(series_id, 1) AS series_id, month AS observation_date, value FROM mo", days=("observation_date",))
def src1(spark, sf):
    at = folder(spark)
    m = months(spark, sf).select(F.substring("series_id", 1, 1).alias("file"), F.col("month").cast("string").alias("observation_date"), "value")
    m.write.option("header", True).partitionBy("file").csv(at)
    return files.series_csv(spark, at).withColumn("series_id", F.regexp_extract("series_id", r"([^=]+)$", 1))


@query("src2_discover_series", "SELECT DISTINCT left(o_orderpriority, 1) AS series_id FROM orders")
def src2(spark, sf):
    return src1(spark, sf).select("series_id").distinct()


READINGS = f"{DAILY}, t AS (SELECT day AS date, {r4('max(value)', 2)} AS max_temp, {r4('min(value)', 2)} AS min_temp, {r4('avg(value)', 2)} AS mean_temp FROM daily GROUP BY 1)"


def station_files(spark, sf, conditions: bool):
    """Two vintages of station files of the events' days: one with precipitation, one without; the second repeats the first's last days."""
    at = folder(spark)
    d = daily(spark, sf).groupBy("day").agg(*(fixed(f("value"), 2).alias(n) for n, f in (("Maximum Temperature", F.max), ("Minimum Temperature", F.min), ("Temperature", F.avg))))
    d = d.withColumns({"Date time": F.date_format("day", "MM/dd/yyyy"), "Conditions": F.when(F.dayofmonth("day") > 15, "Rain").otherwise("Clear")})
    old = d.where("day < '2024-01-20'").select("Date time", "Maximum Temperature", "Minimum Temperature", "Temperature", F.lit("bad").alias("Precipitation"), "Conditions")
    new = d.where("day >= '2024-01-15'").select("Conditions", "Temperature", "Date time", "Minimum Temperature", "Maximum Temperature")
    old.unionByName(old.limit(1).withColumn("Date time", F.lit("not a date"))).write.option("header", True).csv(f"{at}/1")
    new.write.option("header", True).csv(f"{at}/2")
    columns = {"Date time": "date", "Temperature": "mean_temp", "Conditions": "conditions"} if conditions else None
    return files.station_csv(spark, [f"{at}/1", f"{at}/2"], columns)


@query("src3_read_station_daily", f"WITH {READINGS} SELECT date, max_temp, min_temp, mean_temp FROM t", days=("date",))
def src3(spark, sf):
    return station_files(spark, sf, False).select("date", "max_temp", "min_temp", "mean_temp")


@query("src4_read_station_daily_5col", f"WITH {READINGS} SELECT date, mean_temp, CASE WHEN day(date) > 15 THEN 'Rain' ELSE 'Clear' END AS conditions FROM t", days=("date",))
def src4(spark, sf):
    return station_files(spark, sf, True).select("date", "mean_temp", "conditions")


@query("src5_read_articles", "SELECT 'https://a/' || doc_id AS url, text AS headline, CASE WHEN quality = 1 THEN 0.5 END AS sentiment, '' AS ticker FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 30 = 4")
def src5(spark, sf):
    return stored_articles(spark, sf, "2024-01-05")


@query("src5_read_all_articles", "SELECT 'https://a/' || doc_id AS url, text AS headline, CASE WHEN quality = 1 THEN 0.5 END AS sentiment, '' AS ticker FROM documents LEFT JOIN labels USING (doc_id)")
def src5_all(spark, sf):
    return stored_articles(spark, sf)


def stored_articles(spark, sf, on=None):
    """Articles written as files and read again, of one day if asked."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(30)).cast("int"))
    at = folder(spark)
    rows = d.select(F.concat(day.cast("string"), F.lit("T08:00:00Z")).alias("timestamp"), F.concat(F.lit("https://a/"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("headline"), F.when(F.col("quality") == 1, "0.5").otherwise("none").alias("sentiment"))
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(at)
    return files.articles_csv(spark, at, on).select("url", "headline", "sentiment", "ticker")


# Sinks


@query("snk1_upsert_series", f"WITH {PANEL} SELECT series_id, month, {r4("CASE WHEN month >= DATE '2000-01-01' THEN value * 2 ELSE value END")} AS value FROM panel", days=("month",))
def snk1(spark, sf):
    p = panel(spark, sf).withColumn("ingest_seq", F.lit(1))
    new = p.where("month >= DATE '2000-01-01'").select("series_id", "month", (F.col("value") * 2).alias("value"), F.lit(2).alias("ingest_seq"))
    return sinks.upsert(p, new, ["series_id", "month"]).select("series_id", "month", fixed(F.col("value")).alias("value"))


@query("snk2_upsert_by_key", "SELECT o_custkey AS org_uuid, max(o_orderkey) AS round_uuid FROM orders GROUP BY 1")
def snk2(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("org_uuid"), F.col("o_orderkey").alias("round_uuid"))
    cut = F.col("round_uuid") > 3000
    return sinks.upsert(o.where(~cut), o.where(cut), "org_uuid", "round_uuid").select("org_uuid", "round_uuid")


@query("snk3_refresh_window_start", "WITH s AS (SELECT o_orderpriority AS series_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'fred' WHEN '2-HIGH' THEN 'etf' WHEN '3-MEDIUM' THEN 'bls' ELSE 'spy' END AS source, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1) SELECT series_id, source, CAST(CASE source WHEN 'etf' THEN last - INTERVAL 2 MONTH WHEN 'bls' THEN make_date(greatest(year(last), 1990), 1, 1) ELSE last - 30 END AS DATE) AS start FROM s", days=("start",))
def snk3(spark, sf):
    p = F.col("o_orderpriority")
    s = table(spark, sf, "orders").select(p.alias("series_id"), F.to_date("o_orderdate").alias("day"), F.when(p == "1-URGENT", "fred").when(p == "2-HIGH", "etf").when(p == "3-MEDIUM", "bls").otherwise("spy").alias("source"))
    return sinks.refresh_start(s, "series_id", "day", "source")


@query("snk4_skip_if_not_newer", f"WITH {PANEL} SELECT series_id, month FROM panel WHERE series_id > '3'", days=("month",))
def snk4(spark, sf):
    p = panel(spark, sf)
    stored = p.where("series_id <= '3' OR month < DATE '2000-01-01'")
    return sinks.newer_only(p, stored, "series_id", "month").select("series_id", "month")


@query("snk6_write_daily_partition", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1", days=("day",))
def snk6(spark, sf):
    at = folder(spark)
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))
    sinks.write_days(e.where("day < '2024-01-20'").limit(10), at, "day")
    sinks.write_days(e, at, "day")
    return spark.read.parquet(at).groupBy("day").agg(F.count("*").alias("n"))


@query("snk7_write_state_aggregate", "SELECT n_name AS state, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def snk7(spark, sf):
    at = folder(spark)
    n = table(spark, sf, "nation")
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("state")).agg(F.count("*").alias("n"))
    sinks.write_states(c.where(F.ascii(F.substring(F.reverse("state"), 1, 1)) % 2 == 0), at)
    sinks.write_states(sinks.missing_states(c, spark.read.schema(c.schema).parquet(at)), at)
    return spark.read.schema(c.schema).parquet(at).select("state", "n")


@query("snk9_write_enriched", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def snk9(spark, sf):
    at = folder(spark)
    n = table(spark, sf, "nation")
    out = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    sinks.write_table(out.where("c_custkey < 10"), at)
    sinks.write_table(out, at)
    return spark.read.parquet(at)


@query("snk10_fan_out_copies", f"WITH {ROUNDS} SELECT g, count(*) AS n FROM (SELECT segment AS g FROM rounds UNION ALL SELECT geography FROM rounds) GROUP BY 1")
def snk10(spark, sf):
    r = rounds(spark, sf)
    pairs = r.select("segment", "geography").distinct()
    members = pairs.select("segment", "geography", F.explode(F.array("segment", "geography")).alias("g"))
    return sinks.fan_out(r, members, ["segment", "geography"]).groupBy("g").agg(F.count("*").alias("n"))


@query("snk11_append_run_log", "SELECT event_id AS run_id FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 52)")
def snk11(spark, sf):
    e = table(spark, sf, "events").select(F.col("ts").alias("run_at"), F.col("event_id").alias("run_id"))
    return sinks.recent_runs(e).select("run_id")


@query("top5_last_n", "SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k <= 120")
def top5(spark, sf):
    from tidemark.operators.briefing import top_n

    return top_n(table(spark, sf, "events"), ["event_type"], [F.desc("ts"), F.desc("event_id")], 120).select("event_type", "event_id")


@query("flt11_validate_series_id", "SELECT p_partkey, regexp_full_match(upper(CASE WHEN p_size < 15 THEN replace(p_brand, '#', '_') WHEN p_size < 25 THEN replace(p_brand, '#', '.') WHEN p_size < 35 THEN replace(p_brand, '#', '_') || chr(10) ELSE p_name END), '[A-Z0-9_]{1,30}') AS valid FROM part")
def flt11(spark, sf):
    from tidemark.operators.views import valid_id

    size, brand = F.col("p_size"), lambda mark: F.replace("p_brand", F.lit("#"), F.lit(mark))
    series_id = F.when(size < 15, brand("_")).when(size < 25, brand(".")).when(size < 35, F.concat(brand("_"), F.lit("\n"))).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", valid_id(series_id).alias("valid"))


