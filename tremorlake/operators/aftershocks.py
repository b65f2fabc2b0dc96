"""Aftershock windows: one space-time join, then grouped conditional aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.functions.geo import Grid, haversine_km
from tremorlake.operators.isolation import EPICENTRE
from tremorlake.schema import (
    AFTERSHOCK_MAGNITUDE,
    LABEL_WINDOW_HOURS,
    RADIUS_KM,
    ROLLING_COUNT_HOURS,
    ROLLING_MAX_HOURS,
    SNAPSHOT_HOURS,
    TARGET,
)
from tremorlake.session import cut_lineage


def _hours(value: Column) -> Column:
    return F.make_dt_interval(F.lit(0), value.cast("int"))


def events_after(
    origins: DataFrame,
    events: DataFrame,
    horizon_hours: int,
    radius_km: float = RADIUS_KM,
) -> DataFrame:
    """Join each origin to the events near it in ``(origin, origin + horizon]``.

    Origins are copied to the cells and days in reach; events keep one home
    cell, so no pair is met twice and the large side is shuffled once at most.
    The copies are written first, because the optimizer's estimate does not see how
    far an explode multiplies rows. From their true size it chooses the join, and a
    hot cell is split at run time by adaptive skew handling.
    """
    grid = Grid.about_one_radius(radius_km)
    horizon = F.make_dt_interval(F.lit(0), F.lit(horizon_hours))
    reach = origins.withColumns(
        {
            "days": F.sequence(F.to_date("time_utc"), F.to_date(F.col("time_utc") + horizon)),
            "cell_rows": grid.rows_in_reach(F.col("latitude")),
            "cell_cols": grid.columns_in_reach(F.col("latitude"), F.col("longitude")),
        }
    )
    reached = cut_lineage(
        reach.withColumn("day", F.explode("days"))
        .withColumn("cell_row", F.explode("cell_rows"))
        .withColumn("cell_col", F.explode("cell_cols"))
        .drop("days", "cell_rows", "cell_cols"),
        "reached",
    ).alias("origin")
    placed = events.select(
        F.col("event_id"),
        *EPICENTRE,
        "magnitude",
        F.to_date("time_utc").alias("day"),
        grid.row(F.col("latitude")).alias("cell_row"),
        grid.column(F.col("longitude")).alias("cell_col"),
    ).alias("event")
    same_cell = [F.col(f"origin.{k}") == F.col(f"event.{k}") for k in ("day", "cell_row", "cell_col")]
    after = (F.col("event.time_utc") > F.col("origin.time_utc")) & (
        F.col("event.time_utc") <= F.col("origin.time_utc") + horizon
    )
    distance = haversine_km(
        F.col("origin.latitude"), F.col("origin.longitude"),
        F.col("event.latitude"), F.col("event.longitude"),
    )
    return placed.join(reached, [*same_cell, after, distance < radius_km]).select(
        *[F.col(f"origin.{c}") for c in origins.columns],
        F.col("event.event_id").alias("aftershock_id"),
        F.col("event.time_utc").alias("aftershock_time"),
        F.col("event.magnitude").alias("aftershock_magnitude"),
        distance.alias("distance_km"),
    )


def aftershock_pairs(
    mainshocks: DataFrame,
    events: DataFrame,
    snapshots: Sequence[int] = SNAPSHOT_HOURS,
) -> DataFrame:
    """Every (mainshock, event) pair any snapshot can see, before or after it."""
    origins = mainshocks.select(F.col("event_id").alias("mainshock_id"), *EPICENTRE)
    horizon = max(snapshots) + LABEL_WINDOW_HOURS
    pairs = events_after(origins, events, horizon)
    return pairs.filter(F.col("aftershock_id") != F.col("mainshock_id")).select(
        "mainshock_id",
        F.col("time_utc").alias("mainshock_time"),
        "aftershock_id",
        "aftershock_time",
        "aftershock_magnitude",
        "distance_km",
    )


def snapshot_expand(df: DataFrame, snapshots: Sequence[int] = SNAPSHOT_HOURS) -> DataFrame:
    """One row per snapshot hour, generated in place."""
    return df.withColumn("snapshot_hours", F.explode(F.array(*[F.lit(h) for h in snapshots])))


def snapshot_aggregates(
    epicentres: DataFrame, events: DataFrame, snapshots: Sequence[int] = SNAPSHOT_HOURS
) -> DataFrame:
    """Rolling counts, maxima and label per (epicentre, snapshot), quiet ones included.

    The join runs once over the whole horizon. Each pair then goes only to the
    snapshots that see it, and one empty row per (epicentre, snapshot) keeps the
    quiet ones, so no outer join is needed.
    """
    pairs = events_after(epicentres, events, max(snapshots) + LABEL_WINDOW_HOURS)
    hours = [F.lit(h) for h in snapshots]
    look_back = max(*ROLLING_COUNT_HOURS, *ROLLING_MAX_HOURS)

    def sees(snapshot: Column) -> Column:
        at = F.col("time_utc") + _hours(snapshot)
        oldest = at - _hours(F.lit(look_back))
        newest = at + _hours(F.lit(LABEL_WINDOW_HOURS))
        return F.col("aftershock_time").between(oldest, newest)

    seen = pairs.select(
        *EPICENTRE,
        "aftershock_time",
        "aftershock_magnitude",
        F.explode(F.filter(F.array(*hours), sees)).alias("snapshot_hours"),
    )
    quiet = snapshot_expand(
        epicentres.select(
            *EPICENTRE,
            F.lit(None).cast("timestamp").alias("aftershock_time"),
            F.lit(None).cast("double").alias("aftershock_magnitude"),
        ),
        snapshots,
    )
    snapshot = F.col("time_utc") + _hours(F.col("snapshot_hours"))
    time = F.col("aftershock_time")
    magnitude = F.col("aftershock_magnitude")

    def within(hours_back: int) -> Column:
        return (time <= snapshot) & (time >= snapshot - _hours(F.lit(hours_back)))

    strong_later = (time > snapshot) & (magnitude >= AFTERSHOCK_MAGNITUDE)
    return (
        seen.unionByName(quiet)
        .groupBy(*EPICENTRE, "snapshot_hours")
        .agg(
            *[F.count_if(within(h)).alias(f"count_susulan_{h}jam") for h in ROLLING_COUNT_HOURS],
            *[
                F.coalesce(F.max(F.when(within(h), magnitude)), F.lit(0.0)).alias(
                    f"max_mag_susulan_{h}jam"
                )
                for h in ROLLING_MAX_HOURS
            ],
            F.coalesce(F.max(F.when(strong_later, 1)), F.lit(0)).alias(TARGET),
        )
    )
