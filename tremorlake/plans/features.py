"""The training table: one row per (mainshock, snapshot)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.functions import catalogue, geo
from tremorlake.operators.aftershocks import snapshot_aggregates
from tremorlake.operators.isolation import EPICENTRE, find_mainshocks
from tremorlake.session import cut_lineage
from tremorlake.schema import DEFAULT_DEPTH_KM, LABEL_WINDOW_HOURS, SNAPSHOT_HOURS, TARGET


def feature_rows(
    mainshocks: DataFrame, events: DataFrame, snapshots: Sequence[int], carried: Sequence[str] = ()
) -> DataFrame:
    """Features and label of the given mainshocks, which are read twice; ``carried`` columns of theirs stay."""
    windows = snapshot_aggregates(mainshocks.select(*EPICENTRE).distinct(), events, snapshots)
    return mainshocks.join(windows, list(EPICENTRE)).select(
        F.col("event_id").cast("string").alias("mainshock_id"),
        F.col("time_utc").alias("mainshock_time"),
        "snapshot_hours",
        F.col("magnitude").alias("mainshock_magnitude"),
        F.coalesce("depth_km", F.lit(DEFAULT_DEPTH_KM)).alias("mainshock_depth"),
        geo.fault_zone_code(F.col("latitude"), F.col("longitude")).alias("zona_sesar"),
        F.col("snapshot_hours").cast("double").alias("jam_sejak_mainshock"),
        "count_susulan_1jam",
        "count_susulan_6jam",
        "count_susulan_24jam",
        "max_mag_susulan_6jam",
        "max_mag_susulan_24jam",
        catalogue.omori_rate(F.col("snapshot_hours")).alias("omori_rate_est"),
        TARGET,
        *carried,
    )


def build_feature_table(
    events: DataFrame, snapshots: Sequence[int] = SNAPSHOT_HOURS, label_complete: bool = False
) -> DataFrame:
    """Features and label of every mainshock at every snapshot.

    Mainshocks that share an epicentre share their aftershocks, so the windows
    are computed once per epicentre and joined back. The mainshocks are few and
    used twice, so they are written to the shared folder in between.
    ``label_complete`` adds a flag for labels whose window lies inside the catalogue.
    """
    rows = feature_rows(cut_lineage(find_mainshocks(events), "mainshocks"), events, snapshots)
    if label_complete:
        window_end = F.col("mainshock_time") + F.make_dt_interval(
            F.lit(0), F.col("snapshot_hours") + LABEL_WINDOW_HOURS
        )
        rows = rows.withColumn("label_complete", window_end <= events.agg(F.max("time_utc")).scalar())
    return rows
