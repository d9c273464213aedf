"""CSV files whose quoted texts hold line breaks, read by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Options of the CSV parser: quotes inside texts are doubled.
OPTIONS = {"multiLine": "true", "escape": '"'}

#: Marks of quotes in a line: one that opens a text, one that closes it, one that does either.
OPENS, CLOSES, EITHER = "\x01", "\x02", "\x03"


def marks(line: Column) -> Column:
    """The single quotes of a line, in order, as marks. Doubled quotes leave the state as it is.

    A quote behind a delimiter opens a text and one before a delimiter closes it, whatever was before; one between two
    delimiters, as in `,",`, does what the state calls for; one inside an unquoted field is a character like others.
    """
    bare = F.regexp_replace(F.regexp_replace(line, r"[\x01-\x03]|\r$", ""), '""', "")
    text = F.concat(F.lit(","), bare, F.lit(","))
    for pattern, mark in (('(?<=,)"(?=,)', EITHER), ('(?<=,)"', OPENS), ('"(?=,)', CLOSES)):
        text = F.regexp_replace(text, pattern, mark)
    return F.when(F.contains(line, F.lit('"')), F.regexp_replace(text, r"[^\x01-\x03]", "")).otherwise("")


def followed(df: DataFrame, within: list[str], order: str, sets: Column, flips: Column, entered: Column) -> DataFrame:
    """The state behind each row as `_after`, and as `_base` what the last row that sets the state made of it.

    A row either sets the state (`sets` 0 or 1) and then flips it or not (`flips` 0 or 1), or only flips it. Flips add
    up, and what was set is kept with the flips until then, so that rows compose by a sum and a last value.
    """
    so_far = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = df.withColumn("_flips", F.sum(flips).over(so_far) % 2)
    base = F.last((sets + flips + F.col("_flips")) % 2, ignorenulls=True).over(so_far)
    summed = summed.withColumn("_base", base)
    return summed.withColumn("_after", (F.col("_flips") + F.coalesce("_base", entered)) % 2)


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the offset of its split, its order in it, and what its quotes do."""
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    # Rows of a split come in order from one task, so that the number orders lines of a split.
    lines = raw.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("_line"))
    found = marks(F.col("_line"))
    settled = F.replace(F.col("_marks"), F.lit(EITHER), F.lit(""))
    sets = F.when(F.endswith(settled, F.lit(OPENS)), 1).when(F.endswith(settled, F.lit(CLOSES)), 0)
    flips = (F.length("_marks") - F.length(F.rtrim(F.col("_marks"), F.lit(EITHER)))) % 2
    return lines.withColumn("_marks", found).withColumns({"_sets": sets, "_flip": flips, "_return": F.endswith("_line", F.lit("\r"))}).drop("_marks")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files as texts: `_file`, `_first` (whether it is the file's first), `_text`.

    Files are split as Spark splits text. Whether a line begins inside a quoted text follows from the quotes before it:
    each split sums up what its lines do to that state, splits of a file are composed, one row a split, and then each
    line knows its state and the line that its record began with. Lines are grouped by that line. Empty lines between
    records are dropped. In a file whose first line ends in a carriage return, line ends are one line feed in texts too.
    A quote that is never closed makes one record of the rest of its file, as for any reader.
    """
    lines, split = lines_of(spark, path), ["_file", "_split"]
    inside = followed(lines.drop("_line"), split, "_id", F.col("_sets"), F.col("_flip"), F.lit(0))
    ends = inside.groupBy(*split).agg(F.max_by("_flips", "_id").alias("_total"), F.max_by("_base", "_id").alias("_made"), F.max("_id").alias("_to"))
    # A split whose lines set the state leaves it as they made it, else it flips what entered it.
    made = (F.col("_made") + F.col("_total")) % 2
    ends = followed(ends, ["_file"], "_split", made, F.when(F.col("_made").isNull(), F.col("_total")).otherwise(0), F.lit(0))
    by_split = Window.partitionBy("_file").orderBy("_split")
    enters = ends.select(*split, F.coalesce(F.lag("_after").over(by_split), F.lit(0)).alias("_enters"))

    def begun(rows: DataFrame) -> DataFrame:
        """Marks each line that begins a record, by what is behind the line before it."""
        placed = followed(rows.join(enters, split), split, "_id", F.col("_sets"), F.col("_flip"), F.col("_enters"))
        before = F.coalesce(F.lag("_after").over(Window.partitionBy(*split).orderBy("_id")), F.col("_enters"))
        return placed.withColumn("_start", F.when(before == 0, F.struct("_split", "_id")))

    last = begun(lines.drop("_line")).groupBy(*split).agg(F.max("_start").alias("_last"), F.min_by("_return", "_id").alias("_return"))
    earlier = by_split.rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*split, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"), (F.row_number().over(by_split) == 1).alias("_head"), F.first("_return").over(by_split).alias("_returns"))
    so_far = Window.partitionBy(*split).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = begun(lines.drop("_return")).withColumn("_own", F.last("_start", ignorenulls=True).over(so_far)).withColumn("_n", F.row_number().over(Window.partitionBy(*split).orderBy("_id")))
    keyed = placed.join(carried, split).withColumn("_record", F.coalesce("_own", "_carried"))
    parts = F.sort_array(F.collect_list(F.struct("_split", "_id", "_line")))
    whole = keyed.groupBy("_file", "_record").agg(parts.alias("_parts"), F.max(F.col("_head") & (F.col("_n") == 1)).alias("_first"), F.max("_returns").alias("_returns"))
    joined = F.array_join(F.col("_parts._line"), "\n")
    text = F.when(F.col("_returns"), F.regexp_replace(F.replace(joined, F.lit("\r\n"), F.lit("\n")), r"\r$", "")).otherwise(joined)
    return whole.select("_file", "_first", text.alias("_text")).where(F.col("_text") != "")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of CSV files with headers, as text columns of the first file's header, bound by place.

    Equal to Spark's reader with `multiLine`, which gives a file to one task, for files in which texts with quotes,
    delimiters or line breaks are quoted and quotes doubled.
    """
    names = spark.read.options(header="true", **OPTIONS).csv(path).columns
    if not names:
        return spark.createDataFrame([], "_empty string").drop("_empty")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = records(spark, path).where(~F.col("_first"))
    return rows.select(F.from_csv("_text", schema, OPTIONS).alias("_row")).select("_row.*")
