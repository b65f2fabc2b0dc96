"""Distribution drift between a reference and a current window.

All statistics start from one table of counts per (column, value). Rows are
read once, copies of a value fold before the shuffle, and everything after that
works on running sums over value levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.operators.ranking import bucket_levels, exact_quantiles, running_before, value_counts
from tremorlake.schema import PSI_CRITICAL, PSI_MODERATE
from tremorlake.session import cut_lineage

# Windows and minimum sizes of the quick check.
RECENT_DAYS, REFERENCE_DAYS = 7, 30
MIN_REFERENCE, MIN_RECENT = 50, 10
# Columns the report watches.
WATCHED = ("magnitude", "depth_km", "latitude", "longitude")
# Bins of the stability index and its floor for empty shares.
PSI_BINS = 10
EMPTY_SHARE = 1e-6
# A column has drifted by the two-sample statistic if that is significant at
# 5 %, and by the distance if that reaches a tenth of a standard deviation.
KS_FACTOR_5_PERCENT = 1.3581
DISTANCE_LIMIT = 0.1
DRIFTED_SHARE_LIMIT = 0.5

SIDES = ("reference", "current")


def drift_counts(events: DataFrame, columns: list[str], reference: Column, current: Column) -> DataFrame:
    """Counts per value on both sides, with the levels that order the values.

    The statistics read the counts several times, so they are written once and
    the events are scanned once.
    """
    counts = value_counts(
        events.withColumns({"_reference": reference, "_current": current}),
        columns,
        {"reference": F.col("_reference"), "current": F.col("_current")},
    )
    return levelled(counts)


def levelled(counts: DataFrame) -> DataFrame:
    """Counts per (column, value) and side with the levels that order the values, stored."""
    counts = cut_lineage(counts.filter("reference > 0 or current > 0"), "value-counts")
    # One row per column.
    bounds = counts.groupBy("feature").agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    width = F.when(F.col("_high") > F.col("_low"), F.col("_high") - F.col("_low")).otherwise(1.0)
    levels = bucket_levels(F.col("value"), F.col("_low"), F.col("_low") + width)
    levelled = counts.join(F.broadcast(bounds), "feature").withColumns(levels)
    return cut_lineage(levelled.drop("_low", "_high"), "levelled-counts")


def psi_from_counts(counts: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """Population stability index per feature over quantile bins of the reference.

    A value's bin is the number of inner edges not above it, so repeated edges
    leave empty bins, which weigh nothing.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = (
        exact_quantiles(counts, "reference", inner)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list("quantile")).alias("edges"))
    )
    placed = counts.join(edges, "feature").select(
        "feature",
        F.size(F.filter("edges", lambda e: e <= F.col("value"))).alias("bin"),
        *SIDES,
    )
    binned = placed.groupBy("feature", "bin").agg(*[F.sum(s).alias(s) for s in SIDES])
    # Ten bins per feature: the window sees a handful of rows.
    whole = Window.partitionBy("feature")

    def share(side: str) -> Column:
        part = F.try_divide(F.col(side).cast("double"), F.sum(side).over(whole))
        return F.when(part > 0, part).otherwise(F.lit(EMPTY_SHARE))

    shares = binned.select("feature", share("reference").alias("r"), share("current").alias("c"))
    return shares.groupBy("feature").agg(
        F.sum((F.col("c") - F.col("r")) * F.ln(F.col("c") / F.col("r"))).alias("psi")
    )


def psi_band(psi: Column) -> Column:
    return (
        F.when(psi < PSI_MODERATE, "stable").when(psi < PSI_CRITICAL, "moderate").otherwise("critical")
    )


def _side_totals(counts: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, n_reference, n_current``: a row per column, whether or not it has any values."""
    names = counts.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    totals = counts.groupBy("feature").agg(*[F.sum(s).alias(f"n_{s}") for s in SIDES])
    return names.join(totals, "feature", "left").na.fill(0, [f"n_{s}" for s in SIDES])


def psi(events: DataFrame, column: str, reference: Column, current: Column, bins: int = PSI_BINS) -> DataFrame:
    """``feature, psi, band``: always one row; null where a side has no values, as nothing can be compared."""
    counts = drift_counts(events, [column], reference, current)
    scores = _side_totals(counts, [column]).join(psi_from_counts(counts, bins), "feature", "left")
    known = F.when((F.col("n_reference") > 0) & (F.col("n_current") > 0), F.col("psi"))
    return scores.select("feature", known.alias("psi")).withColumn("band", F.when(F.col("psi").isNotNull(), psi_band(F.col("psi"))))


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def _windowed(events: DataFrame, reference_days: int | None) -> tuple[DataFrame, Column, Column]:
    """Events of both windows and the two window tests, counted back from the newest event."""
    newest = events.agg(F.max("time_utc").alias("newest")).scalar()
    time = F.col("time_utc")
    current = time >= newest - _days(RECENT_DAYS)
    reference = time < newest - _days(RECENT_DAYS)
    if reference_days is None:
        return events, reference, current
    oldest = newest - _days(RECENT_DAYS + reference_days)
    return events.filter(time >= oldest), reference & (time >= oldest), current


def drift_quick_check(events: DataFrame) -> DataFrame:
    """PSI of magnitude, last week against the month before, and the retraining verdict."""
    windowed, reference, current = _windowed(events.select("time_utc", "magnitude"), REFERENCE_DAYS)
    return quick_verdict(drift_counts(windowed, ["magnitude"], reference, current))


def quick_verdict(counts: DataFrame) -> DataFrame:
    """The quick check from the counts of its two windows."""
    sizes = counts.agg(
        F.coalesce(F.sum("reference"), F.lit(0)).alias("n_reference"),
        F.coalesce(F.sum("current"), F.lit(0)).alias("n_recent"),
    )
    score = psi_from_counts(counts).agg(F.max("psi").alias("psi"))
    enough = (F.col("n_reference") >= MIN_REFERENCE) & (F.col("n_recent") >= MIN_RECENT)
    return (
        sizes.withColumn("psi_magnitude", F.when(enough, score.scalar()))
        .withColumn("status", F.when(enough, "ok").otherwise("insufficient_data"))
        .withColumn("should_retrain", F.coalesce(F.col("psi_magnitude") >= PSI_MODERATE, F.lit(False)))
        .select("status", "n_reference", "n_recent", "psi_magnitude", "should_retrain")
    )


def two_sample_distances(counts: DataFrame) -> DataFrame:
    """Per feature: sizes, largest gap of the distribution functions, normalised distance.

    The distance is the area between the two distribution functions over the
    reference's standard deviation. The next value of the last row in a bucket is
    the smallest value of the next bucket that has any.
    """
    levels = ["coarse", "fine"]
    ordered = running_before(counts, list(SIDES), ["value"], ["feature"], levels)

    def next_start(keys: list[str], order: str, table: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(order)
        return table.withColumn("next_start", F.lead("start").over(w))

    fine = counts.groupBy("feature", *levels).agg(F.min("value").alias("start"))
    coarse = fine.groupBy("feature", "coarse").agg(F.min("start").alias("start"))
    after_coarse = next_start(["feature"], "coarse", coarse).select(
        "feature", "coarse", F.col("next_start").alias("next_coarse")
    )
    after_fine = (
        next_start(["feature", "coarse"], "fine", fine)
        .join(after_coarse, ["feature", "coarse"])
        .select("feature", *levels, F.coalesce("next_start", "next_coarse").alias("next_bucket"))
    )
    totals = counts.groupBy("feature").agg(
        F.sum("reference").alias("n_reference"),
        F.sum("current").alias("n_current"),
        F.sum(F.col("reference") * F.col("value")).alias("_sum"),
    )
    inside = Window.partitionBy("feature", *levels).orderBy("value")
    steps = (
        ordered.withColumn("next_value", F.lead("value").over(inside))
        .join(after_fine, ["feature", *levels])
        .join(totals, "feature")
    )

    def cumulative(side: str, total: str) -> Column:
        return F.try_divide((F.col(f"{side}_before") + F.col(side)).cast("double"), F.col(total))

    gap = F.abs(cumulative("reference", "n_reference") - cumulative("current", "n_current"))
    width = F.coalesce("next_value", "next_bucket") - F.col("value")
    centred = F.col("value") - F.try_divide(F.col("_sum"), F.col("n_reference"))
    spread = F.sqrt(F.try_divide(F.sum(F.col("reference") * centred * centred), F.max("n_reference")))
    return (
        steps.groupBy("feature")
        .agg(
            F.max("n_reference").alias("n_reference"),
            F.max("n_current").alias("n_current"),
            F.max(gap).alias("ks"),
            F.sum(gap * F.coalesce(width, F.lit(0.0))).alias("area"),
            spread.alias("spread"),
        )
        .select(
            "feature",
            "n_reference",
            "n_current",
            "ks",
            (F.col("area") / F.greatest("spread", F.lit(0.001))).alias("wasserstein_normed"),
        )
    )


def drift_report(events: DataFrame, method: str = "distance") -> DataFrame:
    """Per watched column: KS, normalised distance, PSI and verdict, last week against all before.

    Rows with a null in any watched column are left out on both sides. Every row
    repeats the share of drifted columns and the verdict for the whole table. Both tests
    are shown; ``method``, "distance" or "ks", says which one decides. Every column has a row: if a side
    has no rows, ``status`` is ``insufficient_data`` and figures and verdicts are null.
    """
    columns = list(WATCHED)
    windowed, reference, current = _windowed(events.select("time_utc", *columns), None)
    return report_from_counts(drift_counts(windowed.na.drop(subset=columns), columns, reference, current), method)


def report_from_counts(counts: DataFrame, method: str = "distance") -> DataFrame:
    """The report from the counts of both windows over all watched columns."""
    if method not in ("distance", "ks"):
        raise ValueError(f"no such method: {method}")
    columns = list(WATCHED)
    totals = _side_totals(counts, columns)
    found = two_sample_distances(counts).drop("n_reference", "n_current").join(psi_from_counts(counts), "feature")
    enough = (F.col("n_reference") > 0) & (F.col("n_current") > 0)
    joined = totals.join(found, "feature", "left").withColumn("status", F.when(enough, "ok").otherwise("insufficient_data"))
    figures = ("ks", "wasserstein_normed", "psi")
    joined = joined.withColumns({c: F.when(enough, F.col(c)) for c in figures})
    n, m = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    significant = F.col("ks") > F.lit(KS_FACTOR_5_PERCENT) * F.sqrt(F.try_divide(n + m, n * m))
    # One row per watched column: the window sees as many rows as there are columns.
    table = Window.partitionBy(F.lit(0))
    share = F.avg(F.col("drifted").cast("double")).over(table)
    return (
        joined.withColumn("ks_drifted", significant)
        .withColumn("distance_drifted", F.col("wasserstein_normed") >= DISTANCE_LIMIT)
        .withColumn("drifted", F.col(f"{method}_drifted"))
        .withColumn("drift_share", share)
        .withColumn("dataset_drift", F.col("drift_share") >= DRIFTED_SHARE_LIMIT)
    )
