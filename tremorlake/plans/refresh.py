"""The feature table kept up to date: only what new events can change is computed anew.

An event decides on the mainshocks within the radius of it: on those up to seven days after it, which it may
suppress, and on those up to 96 hours before it, whose windows may hold it. These cells and days are touched. The
strong events there are judged again, from the events around them only, and their rows replace the touched ones;
the table is kept by day, so no other day is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tremorlake.functions.geo import Grid
from tremorlake.operators.isolation import find_mainshocks
from tremorlake.plans.features import feature_rows
from tremorlake.schema import (
    FEATURE_TABLE,
    ISOLATION_DAYS,
    LABEL_WINDOW_HOURS,
    MAINSHOCK_MAGNITUDE,
    RADIUS_KM,
    SNAPSHOT_HOURS,
)
from tremorlake.session import cut_lineage
from tremorlake.sources import daily

PLACE = ("day", "cell_row", "cell_col")
# Features and the home cell of their mainshock.
KEPT = StructType(FEATURE_TABLE.fields + [StructField(c, LongType()) for c in PLACE[1:]])


def _placed(events: DataFrame, grid: Grid) -> DataFrame:
    return events.withColumns(
        {
            "day": F.to_date("time_utc"),
            "cell_row": grid.row(F.col("latitude")),
            "cell_col": grid.column(F.col("longitude")),
        }
    )


def _in_reach(events: DataFrame, grid: Grid, before: Column, after: Column) -> DataFrame:
    """Cells and days within the radius of an event and from ``before`` to ``after`` it.

    Events of one place and day reach the same cells, so they are folded before the copies are made.
    """
    reach = events.select(
        F.sequence(F.to_date(F.col("time_utc") - before), F.to_date(F.col("time_utc") + after)).alias("days"),
        grid.rows_in_reach(F.col("latitude")).alias("rows"),
        grid.columns_in_reach(F.col("latitude"), F.col("longitude")).alias("columns"),
    ).distinct()
    cells = reach.withColumn("day", F.explode("days")).withColumn("cell_row", F.explode("rows"))
    return cells.withColumn("cell_col", F.explode("columns")).select(*PLACE).distinct()


def _between(events: DataFrame, reached: DataFrame) -> DataFrame:
    """A filter on plain times, which reaches the scan, where the join alone would read the whole catalogue."""
    first, last = reached.agg(F.min("day"), F.date_add(F.max("day"), 1)).first()
    if first is None:
        return events.filter(F.lit(False))
    start, end = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
    return events.filter((F.col("time_utc") >= start) & (F.col("time_utc") < end))


def read_kept_features(spark: SparkSession, table: str) -> DataFrame:
    """The feature table as it stands."""
    return daily.read_days(spark, table, KEPT).select(*FEATURE_TABLE.names)


def rebuild_features(
    table: str, events: DataFrame, mark: str | None = None, snapshots: Sequence[int] = SNAPSHOT_HOURS
) -> int:
    """Build the whole table; whatever it held is replaced. Returns the commit's number."""
    grid = Grid.about_one_radius(RADIUS_KM)
    mainshocks = cut_lineage(_placed(find_mainshocks(events), grid), "mainshocks")
    rows = cut_lineage(feature_rows(mainshocks, events, snapshots, PLACE), "features")
    return daily.replace_all(table, rows, mark)


def refresh_features(
    table: str,
    events: DataFrame,
    changed: DataFrame,
    mark: str | None = None,
    snapshots: Sequence[int] = SNAPSHOT_HOURS,
) -> int:
    """Bring the table to what ``events``, the whole catalogue as it now is, would give.

    ``changed`` are the events that were added since; of a row that was corrected or taken out, its former version
    belongs there too. Rows that are named without need do no harm. Events without time or place change nothing.
    Returns the commit's number.
    """
    grid = Grid.about_one_radius(RADIUS_KM)
    hours = lambda n: F.make_dt_interval(hours=F.lit(n))
    quiet, horizon = hours(24 * ISOLATION_DAYS), hours(max(snapshots) + LABEL_WINDOW_HOURS)
    dated = changed.dropna(subset=["time_utc", "latitude", "longitude"])
    touched = cut_lineage(_in_reach(dated, grid, before=horizon, after=quiet), "touched")

    strong = _placed(_between(events, touched).filter(F.col("magnitude") >= MAINSHOCK_MAGNITUDE), grid)
    judged = cut_lineage(strong.join(touched, list(PLACE), "left_semi"), "judged")
    around = cut_lineage(_in_reach(judged, grid, before=quiet, after=horizon), "around")
    near = _placed(_between(events, around), grid).join(around, list(PLACE), "left_semi")
    near = cut_lineage(near.select(*events.columns), "near")

    found = _placed(find_mainshocks(near), grid).join(touched, list(PLACE), "left_semi")
    rows = feature_rows(cut_lineage(found, "mainshocks"), near, snapshots, PLACE)
    days = touched.select("day").distinct()
    stored = daily.read_days(events.sparkSession, table, KEPT).join(days, "day", "left_semi")
    others = stored.join(touched, list(PLACE), "left_anti")
    return daily.replace_days(table, others.unionByName(rows), days, mark)
