"""Registration of queries and the tables they are bound to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start
from tidemark.functions.text import MACRO_TAG_KEYWORDS, SECTOR_KEYWORDS, classify_macro_tag

Query = Callable[[SparkSession, str], DataFrame]

DAY = "yyyy-MM-dd"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, days: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under its name, with SQL that gives its rows if SQL can.

    Dates and times in the columns `days` are registered as text, so that every reader compares them alike.
    """

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            kinds = dict(df.dtypes)
            return df.withColumns({c: F.date_format(c, DAY if kinds[c] == "date" else DAY + " HH:mm:ss") for c in days})

        QUERIES[name] = run if days else f
        if sql is not None:
            text = ", ".join(f"""left(CAST("{c}" AS VARCHAR), 19) AS "{c}\"""" for c in days)
            ORACLES[name] = f"SELECT * REPLACE ({text}) FROM ({sql})" if days else sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r4(expression: str, digits: int = 4) -> str:
    """SQL of numeric.fixed()."""
    return f"round({expression} + 1e-9, {digits})"


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly mean order value by priority: series_id, month, value."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("series_id"), month_start(F.to_date("o_orderdate")).alias("month")).agg(F.avg("o_totalprice").alias("value"))


PANEL = "panel AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2)"


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with months of fewer orders than the series' mean as missing values."""
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders")
    n = o.groupBy(F.col("o_orderpriority").alias("series_id"), month_start(F.to_date("o_orderdate")).alias("month")).agg(F.avg("o_totalprice").alias("v"), F.count("*").alias("n"))
    return n.select("series_id", "month", F.when(F.col("n") >= F.avg("n").over(Window.partitionBy("series_id")), F.col("v")).alias("value"))


GAPPY = (
    "counted AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice) AS v, count(*) AS n FROM orders GROUP BY 1, 2), "
    "gappy AS (SELECT series_id, month, CASE WHEN n >= avg(n) OVER (PARTITION BY series_id) THEN v END AS value FROM counted)"
)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean event value by type: series_id, day, value."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("day")).agg(F.avg("value").alias("value"))


DAILY = "daily AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS day, avg(value) AS value FROM events GROUP BY 1, 2)"


def station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as daily readings: region, state (nation), city (segment), date and measures."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    t = F.col("o_totalprice") / 2500
    return j.select(
        F.col("r_name").alias("region"), F.col("n_name").alias("state"), F.col("c_mktsegment").alias("city"), F.to_date("o_orderdate").alias("date"), t.alias("mean_temp"),
        (t + 10).alias("max_temp"), (t - 20).alias("min_temp"), (F.col("c_acctbal") / 5000).alias("precip"), (F.col("c_acctbal") / 1000).alias("snow_depth"), (t / 7).alias("wind_speed"), (t / 3).alias("cloud_cover"),
    )


STATION = (
    "station AS (SELECT r_name AS region, n_name AS state, c_mktsegment AS city, CAST(o_orderdate AS DATE) AS date, o_totalprice / 2500 AS mean_temp, o_totalprice / 2500 + 10 AS max_temp, "
    "o_totalprice / 2500 - 20 AS min_temp, c_acctbal / 5000 AS precip, c_acctbal / 1000 AS snow_depth, o_totalprice / 2500 / 7 AS wind_speed, o_totalprice / 2500 / 3 AS cloud_cover "
    "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as funding rounds: round_uuid, org_uuid, announced_on, money, lead, stage, segment, geography."""
    o, c, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        F.col("o_orderkey").alias("round_uuid"), F.col("o_custkey").alias("org_uuid"), F.to_date("o_orderdate").alias("announced_on"), F.col("o_totalprice").alias("money"),
        (F.col("o_orderstatus") == "F").cast("int").alias("lead"), F.col("o_orderpriority").alias("stage"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("geography"),
    )


ROUNDS = (
    "rounds AS (SELECT o_orderkey AS round_uuid, o_custkey AS org_uuid, CAST(o_orderdate AS DATE) AS announced_on, o_totalprice AS money, CAST(o_orderstatus = 'F' AS INTEGER) AS lead, "
    "o_orderpriority AS stage, c_mktsegment AS segment, n_name AS geography FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles of 75 days; labels stand for sentiment."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("article_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(75)).cast("int")).alias("day"), F.col("source").alias("source_name"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/a/"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("headline"), F.col("lang").alias("sector"), F.upper("source").alias("ticker"),
        (F.col("quality") * 0.75 - F.col("toxic") * 1.5 - 0.25).alias("sentiment"), classify_macro_tag(F.col("text")).alias("macro_tag"),
    )


def keyword_case(text: str, keywords: dict[str, list[str]], default: str) -> str:
    """SQL of text.first_keyword()."""
    cases = " ".join(f"WHEN {' OR '.join(f"contains(lower({text}), '{w}')" for w in words)} THEN '{key}'" for key, words in keywords.items())
    return f"CASE {cases} ELSE {default} END"


ARTICLES = (
    "articles AS (SELECT d.doc_id AS article_id, CAST(DATE '2024-01-01' + CAST(d.doc_id % 75 AS INTEGER) AS DATE) AS day, source AS source_name, 'https://' || source || '.example.com/a/' || d.doc_id AS url, text AS headline, "
    f"lang AS sector, upper(source) AS ticker, quality * 0.75 - toxic * 1.5 - 0.25 AS sentiment, {keyword_case('text', MACRO_TAG_KEYWORDS, 'NULL')} AS macro_tag "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)
SECTOR_CASE = keyword_case("text", SECTOR_KEYWORDS, "'macro'")
