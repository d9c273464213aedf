"""Landed CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import either_date
from tidemark.functions.numeric import to_number
from tidemark.sources import quoted

#: Columns of station files and their names here.
STATION_COLUMNS = {
    "Date time": "date",
    "Maximum Temperature": "max_temp",
    "Minimum Temperature": "min_temp",
    "Temperature": "mean_temp",
    "Precipitation": "precip",
    "Snow Depth": "snow_depth",
    "Wind Speed": "wind_speed",
    "Cloud Cover": "cloud_cover",
}

#: Columns of stored articles.
ARTICLE_COLUMNS = ["timestamp", "ingested_at", "source_api", "source_name", "url", "headline", "summary", "sector", "ticker", "entities", "sentiment", "sentiment_label", "macro_tag", "market_impact_score"]


def series_csv(spark: SparkSession, folder: str) -> DataFrame:
    """SRC1, SRC2: every CSV file of a folder is a series named like the file; two columns by place; bad numbers are null."""
    raw = spark.read.schema("observation_date string, value string").option("header", True).option("enforceSchema", True).option("recursiveFileLookup", True).csv(folder)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.csv)?(?:/part-[^/]*)?$", 1)
    day = F.coalesce(F.try_to_date(F.substring("observation_date", 1, 10), "yyyy-MM-dd"))
    return raw.select(name.alias("series_id"), day.alias("observation_date"), to_number(F.col("value")).alias("value")).where("observation_date IS NOT NULL")


def station_csv(spark: SparkSession, paths: list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """SRC3, SRC4: files read by header vintage, columns by name, bad dates dropped, the last file of a date counts.

    Each path holds files of one header; CSV binds by place, so vintages are read apart and united by name.
    """
    wanted = columns or STATION_COLUMNS
    parts = []
    for path in paths:
        raw = spark.read.option("header", True).option("recursiveFileLookup", True).csv(path).withColumn("_file", F.col("_metadata.file_name"))
        have = {c: n for c, n in wanted.items() if c in raw.columns}
        cols = [F.try_to_date(F.col(f"`{c}`"), "MM/dd/yyyy").alias(n) if n == "date" else (F.col(f"`{c}`").alias(n) if n == "conditions" else to_number(F.col(f"`{c}`")).alias(n)) for c, n in have.items()]
        parts.append(raw.select("_file", *cols))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    newest = F.row_number().over(Window.partitionBy("date").orderBy(F.desc("_file")))
    return out.where("date IS NOT NULL").withColumn("_n", newest).where("_n = 1").drop("_n", "_file")


def articles_csv(spark: SparkSession, path: str, on: str | None = None) -> DataFrame:
    """SRC5: stored articles as text, sentiment and score coerced, missing columns empty; FLT9: of one day if asked.

    Texts hold line breaks; files are split all the same, and lines joined to records by the state of the quotes.
    """
    raw = quoted.read(spark, path)
    have = set(raw.columns)
    out = raw.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in ARTICLE_COLUMNS))
    out = out.withColumns({c: to_number(F.col(c)) for c in ("sentiment", "market_impact_score")})
    return out if on is None else out.where(F.try_to_date(F.substring("timestamp", 1, 10), "yyyy-MM-dd") == F.lit(on).cast("date"))


def result_documents(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: nested result documents."""
    schema = (
        "group string, run_at string, series array<struct<series_id:string,label:string,unit:string,last_date:string,last_value:double,"
        "validation:struct<mae:double,rmse:double,r2:double>,forecast:array<struct<month:string,mid:double,lo:double,hi:double>>>>"
    )
    return spark.read.schema(schema).json(path)


def dated(df: DataFrame, text: str, name: str = "date") -> DataFrame:
    """SRC21 over a column."""
    return df.withColumn(name, either_date(F.col(text)))
