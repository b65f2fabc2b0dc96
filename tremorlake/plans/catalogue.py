"""Ingest and cleaning jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.operators import clean
from tremorlake.operators.dedup import dedup_feed_order, dedup_source_priority, union_feeds
from tremorlake.schema import DEFAULT_DEPTH_KM
from tremorlake.session import cut_lineage


def ingest(*feeds: DataFrame) -> DataFrame:
    """Feeds to one raw snapshot: concatenate, one row per event. Sort where it is shown."""
    return dedup_feed_order(union_feeds(*feeds))


def typed_events(raw: DataFrame) -> DataFrame:
    return clean.normalize_types(clean.conform_schema(raw))


def _screened(typed: DataFrame) -> DataFrame:
    complete = clean.impute_defaults(clean.drop_critical_nulls(typed))
    return clean.filter_valid_ranges(clean.filter_bbox(complete))


def screened_events(raw: DataFrame) -> DataFrame:
    """The narrow part of cleaning: typing, required fields, defaults, ranges. No shuffle."""
    return _screened(typed_events(raw))


def _cleaned(typed: DataFrame) -> DataFrame:
    keys = [c for c in ("snapshot", "event_id") if c in typed.columns]
    return clean.add_derived(dedup_source_priority(_screened(typed), keys))


def clean_events(raw: DataFrame) -> DataFrame:
    """Raw snapshot to clean table: one stage up to the single shuffle on the event id.

    Frames with a ``snapshot`` column are cleaned per snapshot in the same job.
    """
    return _cleaned(typed_events(raw))


def _row_checks() -> dict[str, Column]:
    complete = clean.has_critical_fields()
    depth_missing = complete & F.col("depth_km").isNull()
    with_depth = F.coalesce("depth_km", F.lit(DEFAULT_DEPTH_KM))
    valid = clean.in_bbox() & F.col("magnitude").between(0.0, 10.0) & with_depth.between(0.0, 700.0)
    return {"complete": complete, "depth_missing": depth_missing, "kept": complete & valid}


def quality_report(raw: DataFrame) -> DataFrame:
    """Counts per cleaning step, then the summary of the clean table, as (metric, key, value).

    Text is read and typed once; the typed rows are stored. The first part is one pass of
    conditional counts over them; the second groups the clean rows to (zone, source) once
    and derives every figure from that.
    """
    typed = cut_lineage(typed_events(raw), "typed-events")
    steps = (
        typed.withColumns(_row_checks())
        .agg(
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(~F.col("complete")).alias("rows_without_critical_fields"),
            F.count_if("depth_missing").alias("depth_imputed"),
            F.count_if(F.col("complete") & ~F.col("kept")).alias("rows_out_of_range"),
            F.count_if("kept").alias("rows_before_dedup"),
        )
    )
    cells = (
        _cleaned(typed)
        .groupBy("zona_sesar", "source")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("magnitude").alias("magnitude_min"),
            F.max("magnitude").alias("magnitude_max"),
            F.min("depth_km").alias("depth_min"),
            F.max("depth_km").alias("depth_max"),
        )
    )
    overall = cells.agg(
        F.sum("n").alias("rows_clean"),
        F.min("magnitude_min").alias("magnitude_min"),
        F.max("magnitude_max").alias("magnitude_max"),
        F.min("depth_min").alias("depth_min"),
        F.max("depth_max").alias("depth_max"),
        F.count_distinct("source").alias("sources"),
    )
    zones = cells.groupBy("zona_sesar").agg(F.sum("n").cast("double").alias("value"))
    return (
        _long(steps)
        .unionByName(_long(overall))
        .unionByName(
            zones.select(F.lit("zone_rows").alias("metric"), F.col("zona_sesar").alias("key"), "value")
        )
    )


def _long(one_row: DataFrame) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.lit("all").alias("key"), F.col(c).cast("double").alias("value"))
            for c in one_row.columns
        ]
    )
    return one_row.select(F.inline(pairs))
