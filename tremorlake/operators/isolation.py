"""Mainshock detection: a space-time "not exists" with linear work.

A strong event is a mainshock when no other strong event struck nearer than
the radius in the days before it. The join has no equality key, so three facts
stand in for one:

* Events in one grid cell whose diagonal is below the radius are all neighbours.
  Inside a cell the question needs only the first and last time of each day, so
  a cell that holds a third of the catalogue shrinks to one row per day.
* What survives its own cell is at most one instant per cell and window, so the
  check against the cells around meets each earlier event a bounded number of times.
* Strong events at the same place on the same day matter only through their
  first and last time, so copies collapse before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.functions.geo import Grid, haversine_km
from tremorlake.schema import ISOLATION_DAYS, MAINSHOCK_MAGNITUDE, RADIUS_KM
from tremorlake.session import cut_lineage

EPICENTRE = ("time_utc", "latitude", "longitude")


def _strong(events: DataFrame, min_magnitude: float) -> DataFrame:
    return events.filter(F.col("magnitude") >= min_magnitude)


def _day(time: Column) -> Column:
    return F.to_date(time)


def isolated_epicentres(
    events: DataFrame,
    radius_km: float = RADIUS_KM,
    days: int = ISOLATION_DAYS,
    min_magnitude: float = MAINSHOCK_MAGNITUDE,
) -> DataFrame:
    """Distinct (time, latitude, longitude) of the mainshocks.

    The strong sites are written once: three steps read them, and the events
    must not be scanned for each.
    """
    grid = Grid.with_close_cells(radius_km)
    window = F.make_dt_interval(F.lit(days))

    # Strong events by place and day. Partial aggregation folds copies and hot sites.
    sites = cut_lineage(
        _strong(events, min_magnitude)
        .select(
            grid.row(F.col("latitude")).alias("cell_row"),
            grid.column(F.col("longitude")).alias("cell_col"),
            _day(F.col("time_utc")).alias("day"),
            *EPICENTRE,
        )
        .groupBy("cell_row", "cell_col", "day", "latitude", "longitude")
        .agg(F.min("time_utc").alias("first"), F.max("time_utc").alias("last")),
        "sites",
    )

    # Inside a cell: only the first instant of a day can be free of earlier events,
    # and only if the cell was silent for the whole window before it.
    cell_days = sites.groupBy("cell_row", "cell_col", "day").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    # One cell's days: bounded by the calendar, not by the data.
    earlier_days = (
        Window.partitionBy("cell_row", "cell_col")
        .orderBy(F.unix_date("day"))
        .rangeBetween(-days, -1)
    )
    leading = (
        cell_days.withColumn("previous", F.max("last").over(earlier_days))
        .filter(F.col("previous").isNull() | (F.col("previous") < F.col("first") - window))
        .select("cell_row", "cell_col", "day", "first")
    )
    leaders = sites.join(leading, ["cell_row", "cell_col", "day", "first"]).select(
        F.col("first").alias("time_utc"), "latitude", "longitude", "cell_row", "cell_col", "day"
    )

    # Around a cell: send each leader to the neighbour cells and days in its reach,
    # and to its own site, which is the row that keeps an undisturbed leader.
    away = (F.col("cell_row") != F.col("home_row")) | (F.col("cell_col") != F.col("home_col"))
    probes = (
        leaders.select(
            *EPICENTRE,
            F.col("cell_row").alias("home_row"),
            F.col("cell_col").alias("home_col"),
            F.col("day").alias("home_day"),
            F.explode(F.sequence(F.date_sub("day", days), F.col("day"))).alias("day"),
        )
        .withColumn("cell_row", F.explode(grid.rows_in_reach(F.col("latitude"))))
        .withColumn(
            "cell_col", F.explode(grid.columns_in_reach(F.col("latitude"), F.col("longitude")))
        )
        .withColumn("away", away)
        .filter(F.col("away") | (F.col("day") == F.col("home_day")))
        .drop("home_row", "home_col", "home_day")
        .alias("probe")
    )
    prior = sites.alias("prior")
    near = (
        haversine_km(
            F.col("probe.latitude"), F.col("probe.longitude"),
            F.col("prior.latitude"), F.col("prior.longitude"),
        )
        < radius_km
    )
    # A day's first and last time decide the window test exactly, because the
    # window is at least a day long and its two ends fall on different days.
    in_window = (F.col("prior.last") >= F.col("probe.time_utc") - window) & (
        F.col("prior.first") < F.col("probe.time_utc")
    )
    own_site = (
        (F.col("prior.first") == F.col("probe.time_utc"))
        & (F.col("prior.latitude") == F.col("probe.latitude"))
        & (F.col("prior.longitude") == F.col("probe.longitude"))
    )
    same_cell = [F.col(f"probe.{k}") == F.col(f"prior.{k}") for k in ("cell_row", "cell_col", "day")]
    met = F.when(F.col("probe.away"), in_window & near).otherwise(own_site)
    return (
        probes.join(prior, [*same_cell, met])
        .groupBy(*[F.col(f"probe.{c}") for c in EPICENTRE])
        .agg(F.bool_or("probe.away").alias("suppressed"))
        .filter(~F.col("suppressed"))
        .select(*EPICENTRE)
    )


def find_mainshocks(
    events: DataFrame,
    radius_km: float = RADIUS_KM,
    days: int = ISOLATION_DAYS,
    min_magnitude: float = MAINSHOCK_MAGNITUDE,
) -> DataFrame:
    """The event rows of all mainshocks; events that share an epicentre stay together.

    Events are scanned once: the strong ones, a few in a hundred, are written
    and everything after works on them.
    """
    strong = cut_lineage(_strong(events, min_magnitude), "strong")
    epicentres = isolated_epicentres(strong, radius_km, days, min_magnitude)
    return strong.join(epicentres, list(EPICENTRE)).select(*events.columns)
