"""Merge rows into a table by day that holds one row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremorlake.session import cut_lineage
from tremorlake.sources import daily


def merge_days(
    table: str,
    rows: DataFrame,
    schema: StructType,
    pick: Callable[[DataFrame], DataFrame],
    mark: str | None = None,
    key: str = "event_id",
    time: str = "time_utc",
) -> int:
    """Merge ``rows`` into the table; returns the commit's number.

    ``pick`` takes one row per key by an order of all columns, so that picking from picked rows gives the same.
    Then rows may come in any order, late or again, and the table is always the pick of all that came. Only days
    in which a row is new, replaced or gone are written. Of the stored rows only the keys are read, beside those
    days, and they are not shuffled as long as Spark finds the merged keys small enough to send; the table itself
    never is. Rows need a key and a time.
    """
    new = cut_lineage(pick(rows.select(*schema.names).withColumn("day", F.to_date(time))), "merge-new")
    stored = daily.read_days(rows.sparkSession, table, schema)
    columns = [*schema.names, "day"]
    held = cut_lineage(stored.join(new.select(key), key, "left_semi").select(*columns), "merge-held")
    best = cut_lineage(pick(held.unionByName(new)).select(*columns), "merge-best")
    changed = best.exceptAll(held).unionByName(held.exceptAll(best))
    days = cut_lineage(changed.select("day").distinct(), "merge-days")
    untouched = stored.join(days, "day", "left_semi").join(best.select(key), key, "left_anti").select(*columns)
    return daily.replace_days(table, untouched.unionByName(best.join(days, "day", "left_semi")), days, mark)
