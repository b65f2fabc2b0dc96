"""Plain summaries of events, labels and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.operators.ranking import bucket_levels, exact_quantiles
from tremorlake.schema import MAGNITUDE_RANGE, TARGET
from tremorlake.session import cut_lineage

QUARTILES = (0.25, 0.5, 0.75)


def label_distribution(features: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows per class and each class's share of all rows."""
    counts = features.groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # One row per class: the window sees two rows.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select("label", "n", (F.col("n") / total).alias("share"))


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def magnitude_describe(events: DataFrame) -> DataFrame:
    """Count, mean, spread, exact quartiles and extremes of magnitude, and the time range.

    Events are scanned once, into counts and time ranges per distinct magnitude.
    """
    magnitude = F.col("magnitude")
    per_value = cut_lineage(
        events.groupBy(F.when(~F.isnan(magnitude), magnitude).alias("value"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("time_utc").alias("first_time"),
            F.max("time_utc").alias("last_time"),
        )
        .withColumns(bucket_levels(F.col("value"), *MAGNITUDE_RANGE)),
        "magnitudes",
    )
    counts = per_value.filter(F.col("value").isNotNull()).withColumn("feature", F.lit("magnitude"))
    quartiles = exact_quantiles(counts, "n", QUARTILES)

    def quartile(index: int, name: str) -> Column:
        return F.max(F.when(F.col("quantile_index") == index, F.col("quantile"))).alias(name)

    # Both are one row and ride along as scalars.
    q = quartiles.agg(F.struct(quartile(0, "q25"), quartile(1, "q50"), quartile(2, "q75"))).scalar()
    mean = counts.agg(F.sum(F.col("n") * F.col("value")) / F.sum("n")).scalar()
    known = F.col("value").isNotNull()
    size = F.sum(F.when(known, F.col("n")))
    centred = F.col("value") - F.col("mean")
    return (
        per_value.withColumn("mean", mean)
        .agg(
            F.coalesce(size, F.lit(0)).alias("n"),
            F.max("mean").alias("mean"),
            F.sqrt(F.try_divide(F.sum(F.col("n") * centred * centred), size - 1)).alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.min("first_time").alias("first_time"),
            F.max("last_time").alias("last_time"),
        )
        .withColumn("q", q)
        .select("n", "mean", "std", "min", "q.q25", "q.q50", "q.q75", "max", "first_time", "last_time")
    )
