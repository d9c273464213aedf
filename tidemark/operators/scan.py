"""Scans along series in two levels, so that one long series spreads over tasks.

A series is cut into segments of time. What a segment hands on is one row (its row count, its last and first known
values, its last state); a window over segments composes these, and a window inside each segment applies them. No
window holds a whole series, but for its segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.align import Names, names

#: Rows that a segment has on average; a series of fewer is one segment.
SEGMENT_ROWS = 100_000


def segmented(df: DataFrame, key: Names, date: str, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Adds `_key`, the series as a struct, and `_seg`, the segment of time that the row is in.

    Segments of a series are equally long, as many as its rows ask for: a series with bursts has segments of unequal
    counts. Rows without a date are the segment before all others. Dates are dates or timestamps.
    """
    at = F.col(date).cast("timestamp").cast("double")
    keyed = df.withColumn("_key", F.struct(*names(key)))
    ends = keyed.groupBy("_key").agg(F.min(at).alias("_from"), F.max(at).alias("_to"), F.ceil(F.count("*") / rows).alias("_of"))
    place = F.floor((at - F.col("_from")) / (F.col("_to") - F.col("_from") + 1) * F.col("_of"))
    return keyed.join(ends, "_key").withColumn("_seg", F.coalesce(place, F.lit(-1))).drop("_from", "_to", "_of")


def inside(date: str):
    return Window.partitionBy("_key", "_seg").orderBy(date)


def along():
    """The segments of a series in order."""
    return Window.partitionBy("_key").orderBy("_seg")


def earlier():
    return along().rowsBetween(Window.unboundedPreceding, -1)


def later():
    return along().rowsBetween(1, Window.unboundedFollowing)


def known_beside(df: DataFrame, key: Names, date: str, value: str, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Adds `_row`, the row's number in its series, and `_left` and `_right`, the number and value of the nearest known value at or before and at or after it.

    Dates of a series are distinct.
    """
    cut = segmented(df, key, date, rows)
    at = inside(date)
    placed = cut.withColumn("_own", F.row_number().over(at))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_own").alias("row"), F.col(value).alias("value")))
    sums = placed.select("_key", "_seg", "_own", known.alias("_known")).groupBy("_key", "_seg")
    sums = sums.agg(F.count("*").alias("_n"), F.max_by("_known", F.col("_known.row")).alias("_last"), F.min_by("_known", F.col("_known.row")).alias("_first"))
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier()), F.lit(0)))
    moved = lambda c: F.when(F.col(c).isNotNull(), F.struct((F.col(f"{c}.row") + F.col("_ahead")).alias("row"), F.col(f"{c}.value").alias("value")))
    sums = sums.withColumns({"_last": moved("_last"), "_first": moved("_first")})
    handed = sums.select("_key", "_seg", "_ahead", F.last("_last", ignorenulls=True).over(earlier()).alias("_prior"), F.first("_first", ignorenulls=True).over(later()).alias("_next"))
    full = placed.join(handed, ["_key", "_seg"]).withColumn("_row", F.col("_own") + F.col("_ahead"))
    here = F.when(F.col(value).isNotNull(), F.struct(F.col("_row").alias("row"), F.col(value).alias("value")))
    left = F.coalesce(F.last(here, ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, 0)), F.col("_prior"))
    right = F.coalesce(F.first(here, ignorenulls=True).over(at.rowsBetween(0, Window.unboundedFollowing)), F.col("_next"))
    return full.withColumns({"_left": left, "_right": right})


def carried(df: DataFrame, key: Names, date: str, value: str, limit: int | None = None, rows: int = SEGMENT_ROWS) -> DataFrame:
    """CAL10, CAL11: the last value that isn't null, at most `limit` rows back."""
    beside = known_beside(df, key, date, value, rows)
    near = F.lit(True) if limit is None else F.col("_row") - F.col("_left.row") <= limit
    return beside.withColumn(value, F.when(near, F.col("_left.value"))).select(*df.columns)


def interpolated(df: DataFrame, key: Names, date: str, value: str, limit: int, rows: int = SEGMENT_ROWS) -> DataFrame:
    """CAL12: linear by row, at most `limit` cells of each gap from the left; leading gaps stay null, a trailing gap takes the last value."""
    beside = known_beside(df, key, date, value, rows)
    since = F.col("_row") - F.col("_left.row")
    inner = F.col("_left.value") + (F.col("_right.value") - F.col("_left.value")) * since / (F.col("_right.row") - F.col("_left.row"))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(since > limit, F.lit(None)).when(F.col("_right").isNull(), F.col("_left.value")).otherwise(inner)
    return beside.withColumn(value, filled).select(*df.columns)


def spans(df: DataFrame, key: Names, date: str, state: str, rows: int = SEGMENT_ROWS) -> DataFrame:
    """WIN10: runs of equal states, null a state like others: first date, date of the next run (null for the last), rows.

    Dates of a series are distinct and not null.
    """
    cut = segmented(df.select(*names(key), date, state), key, date, rows)
    row = F.struct(F.col(date).alias("at"), F.col(state).alias("state"))
    sums = cut.groupBy("_key", "_seg").agg(F.max_by(row, date).alias("_last"), F.min(date).alias("_first"))
    handed = sums.select("_key", "_seg", F.lag("_last").over(along()).alias("_prior"), F.lead("_first").over(along()).alias("_next"))
    at = inside(date)
    joined = cut.join(handed, ["_key", "_seg"])
    before = F.coalesce(F.lag(row).over(at), F.col("_prior"))
    after = F.coalesce(F.lead(date).over(at), F.col("_next"))
    new = before.isNull() | ~F.col(state).eqNullSafe(before["state"])
    marked = joined.withColumns({"_new": new.cast("int"), "_after": after})
    # Runs are numbered as rows are: inside a segment, behind what earlier segments began.
    begun = marked.groupBy("_key", "_seg").agg(F.sum("_new").alias("_n")).select("_key", "_seg", F.coalesce(F.sum("_n").over(earlier()), F.lit(0)).alias("_runs"))
    numbered = marked.join(begun, ["_key", "_seg"]).withColumn("_run", F.sum("_new").over(at.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_runs"))
    out = numbered.groupBy("_key", "_run").agg(F.any_value(state).alias(state), F.min(date).alias("start"), F.count("*").alias("rows"), F.max_by("_after", date).alias("until"))
    return out.select(*(F.col(f"_key.{k}").alias(k) for k in names(key)), state, "start", "rows", "until")
