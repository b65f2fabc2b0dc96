"""One row per event. Each rule is a row number of 1 over the event id.

Spark trims every map partition to its first row per key before the shuffle
(a partial window group limit), so an id that holds a third of all rows sends
at most one row per input split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the source whose rows win.
PREFERRED_SOURCE = "USGS"
# Feeds in the order they are fetched.
FEED_ORDER = ("USGS", "BMKG-terkini", "BMKG-dirasakan")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; ties fall to the remaining columns."""
    rest = [F.col(c) for c in sorted(df.columns) if c not in keys]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn("_number", number).filter("_number = 1").drop("_number")


def dedup_source_priority(df: DataFrame, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Rows of the preferred source first, then the earliest time."""
    preferred = F.coalesce(F.startswith("source", F.lit(PREFERRED_SOURCE)), F.lit(False))
    order = [F.when(preferred, 0).otherwise(1), F.col("time_utc"), F.col("source")]
    if "ingested_at" in df.columns:
        order.append(F.col("ingested_at"))
    return first_per_key(df, keys, order)


def feed_rank(source: Column) -> Column:
    chain = F.when(source == FEED_ORDER[0], 0)
    for rank, name in enumerate(FEED_ORDER[1:], start=1):
        chain = chain.when(source == name, rank)
    return chain.otherwise(len(FEED_ORDER))


def dedup_feed_order(df: DataFrame, position: str = "feed_position") -> DataFrame:
    """The first row per event as the feeds were fetched, then as they list it."""
    return first_per_key(df, ["event_id"], [feed_rank(F.col("source")), F.col(position)])


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Concatenate by column name; a column one feed lacks is null there."""
    combined = feeds[0]
    for feed in feeds[1:]:
        combined = combined.unionByName(feed, allowMissingColumns=True)
    return combined
