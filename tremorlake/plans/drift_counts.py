"""Drift from kept counts: a check reads counts per day, and events of the days in which a window begins or ends.

Counts per (day, column, value) add up over any window of whole days. New events touch the counts of their days only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tremorlake.operators import drift
from tremorlake.operators.ranking import value_counts
from tremorlake.sources import daily

# ``n_complete`` counts rows in which no watched column is missing. A row of the feature ``time_utc`` stands for all
# dated rows of a day.
COUNTS = StructType(
    [
        StructField("feature", StringType()),
        StructField("value", DoubleType()),
        StructField("n", LongType()),
        StructField("n_complete", LongType()),
    ]
)
_DAY = 24 * 3600 * 1_000_000


def count_days(table: str, events: DataFrame, days: DataFrame, mark: str | None = None) -> int:
    """Count the events of ``days`` anew; ``events`` may hold other days as well. Returns the commit's number."""
    present = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    complete = F.lit(True)
    for c in drift.WATCHED:
        complete = complete & present(c)
    cells = [(c, F.col(c).cast("double")) for c in drift.WATCHED]
    cells.append(("time_utc", F.unix_date("day").cast("double")))
    pairs = F.array(*[F.struct(F.lit(name).alias("feature"), value.alias("value")) for name, value in cells])
    placed = events.withColumn("day", F.to_date("time_utc")).join(days.select("day").distinct(), "day", "left_semi")
    long = placed.select("day", complete.alias("complete"), F.inline(pairs))
    counted = (
        long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("day", "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("complete").alias("n_complete"))
    )
    return daily.replace_days(table, counted, days, mark)


def refresh_counts(spark: SparkSession, events: str, schema: StructType, table: str) -> None:
    """Bring the counts up to a table of events by day: count the days that its commits replaced since."""
    log = daily.read_log(spark, events)
    newest, done = log.agg(F.max("number")).first()[0], int(daily.last_mark(spark, table) or 0)
    if newest is not None and newest > done:
        days = log.filter((F.col("number") > done) & F.col("day").isNotNull()).select("day").distinct()
        rows = daily.read_days(spark, events, schema).join(days, "day", "left_semi")
        count_days(table, rows, days, str(newest))


def _between(time: Column, first: int, end: int) -> Column:
    return (time >= F.timestamp_micros(F.lit(first))) & (time < F.timestamp_micros(F.lit(end)))


def _window_counts(
    spark: SparkSession, table: str, events: DataFrame, columns: list[str], complete: bool, reference_days: int | None
) -> DataFrame:
    """Counts of both windows, as from a scan of all events: whole days from the table, the rest from the events."""
    kept, time = daily.read_days(spark, table, COUNTS), F.col("time_utc")
    last_day = kept.filter("feature = 'time_utc'").agg(F.max(F.unix_date("day"))).first()[0]
    if last_day is None:
        return drift.levelled(value_counts(events.filter(F.lit(False)), columns, dict.fromkeys(drift.SIDES, F.lit(True))))
    newest = events.filter(_between(time, last_day * _DAY, (last_day + 1) * _DAY)).agg(F.max(F.unix_micros(time))).first()[0]
    recent = newest - drift.RECENT_DAYS * _DAY
    oldest = None if reference_days is None else recent - reference_days * _DAY
    cut = recent // _DAY
    date = lambda n: F.date_from_unix_date(F.lit(n))
    inside = F.col("day") != date(cut)
    if oldest is not None:
        inside = inside & (F.col("day") > date(oldest // _DAY))
    n = F.col("n_complete" if complete else "n")
    before = F.col("day") < date(cut)
    whole = kept.filter(inside & F.col("feature").isin(columns)).select(
        "feature", "value", F.when(before, n).otherwise(0).alias("reference"), F.when(before, 0).otherwise(n).alias("current")
    )
    edges = sorted({cut} if oldest is None else {cut, oldest // _DAY})
    at_edge = _between(time, edges[0] * _DAY, (edges[0] + 1) * _DAY)
    for day in edges[1:]:
        at_edge = at_edge | _between(time, day * _DAY, (day + 1) * _DAY)
    current = time >= F.timestamp_micros(F.lit(recent))
    reference = ~current if oldest is None else ~current & (time >= F.timestamp_micros(F.lit(oldest)))
    rest = events.filter(at_edge).select("time_utc", *columns)
    rest = value_counts(rest.na.drop(subset=columns) if complete else rest, columns, {"reference": reference, "current": current})
    added = whole.unionByName(rest).groupBy("feature", "value").agg(*[F.sum(s).alias(s) for s in drift.SIDES])
    return drift.levelled(added)


def drift_quick_check(spark: SparkSession, table: str, events: DataFrame) -> DataFrame:
    """The quick check of ``operators.drift``, from kept counts that are up to ``events``."""
    return drift.quick_verdict(_window_counts(spark, table, events, ["magnitude"], False, drift.REFERENCE_DAYS))


def drift_report(spark: SparkSession, table: str, events: DataFrame, method: str = "distance") -> DataFrame:
    """The report of ``operators.drift``, from kept counts that are up to ``events``."""
    return drift.report_from_counts(_window_counts(spark, table, events, list(drift.WATCHED), True, None), method)
