"""Exact order statistics without a one-partition window.

A window with no partition key sends every row to one task. Here the order is
cut into levels instead: each level has a bounded fan-out, totals are taken per
level (with partial aggregation before the shuffle), and the running sum is
carried down from one level to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _window(keys: Sequence[str], order: Sequence[str]) -> Window:
    spec = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return spec.orderBy(*[F.asc_nulls_last(c) for c in order])


def join_with_nulls(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a null key meets a null key, so no row is lost; keys come once."""
    named = other.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys]
    return df.join(named, same).drop(*[f"_other_{k}" for k in keys])


def running_before(
    df: DataFrame,
    measures: Sequence[str],
    order: Sequence[str],
    groups: Sequence[str] = (),
    levels: Sequence[str] = (),
) -> DataFrame:
    """Add ``<measure>_before``: the sum of each measure over all earlier rows.

    Rows are ordered by ``levels`` then ``order`` within ``groups``, nulls last. ``levels``
    are columns that coarsen the order, coarsest first; the number of values of
    each within the one before it must be bounded, as one task sees that many.
    """
    keys = [*groups, *levels]
    within = _window(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    inner = [F.coalesce(F.sum(m).over(within), F.lit(0)).alias(f"{m}_before") for m in measures]
    if not levels:
        return df.select("*", *inner)
    totals = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = running_before(totals, measures, [levels[-1]], groups, levels[:-1])
    offsets = offsets.select(*keys, *[F.col(f"{m}_before").alias(f"{m}_offset") for m in measures])
    joined = join_with_nulls(df.select("*", *inner), offsets, keys)
    carried = {f"{m}_before": F.col(f"{m}_before") + F.col(f"{m}_offset") for m in measures}
    return joined.withColumns(carried).drop(*[f"{m}_offset" for m in measures])


def rank_in_levels(
    df: DataFrame,
    levels: dict[str, Column],
    order: Sequence[Column],
    groups: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Add the 1-based position of each row within ``groups``.

    The order is that of the level expressions and then ``order``; only rows
    that share every level are numbered by one task.
    """
    levelled = df.withColumns(levels)
    keys = [*groups, *levels]
    counts = levelled.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    *coarse, last = levels
    offsets = running_before(counts, ["rows"], [last], groups, coarse).select(*keys, "rows_before")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = levelled.withColumn("_number", number)
    matched = join_with_nulls(numbered, offsets, keys)
    return matched.withColumn(name, F.col("rows_before") + F.col("_number")).drop(
        "_number", "rows_before", *levels
    )


def value_counts(
    df: DataFrame, columns: Sequence[str], sides: dict[str, Column] | None = None
) -> DataFrame:
    """One row per (column name, value) with a count per side.

    Nulls are left out. This is the pre-aggregation behind quantiles, PSI and
    the two-sample distances: all of them need counts per value, not rows.
    """
    sides = sides or {"n": F.lit(True)}
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    long = df.select(
        F.explode(pairs).alias("pair"), *[cond.alias(side) for side, cond in sides.items()]
    ).select("pair.feature", "pair.value", *sides)
    return (
        long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(*[F.count_if(F.col(side)).alias(side) for side in sides])
    )


# Values are cut into buckets by their physical range, two levels of this many.
BUCKETS = 1024


def bucket_levels(value: Column, low: Column | float, high: Column | float) -> dict[str, Column]:
    """Coarse and fine buckets of a value; values outside the range go to the ends."""
    low, high = (b if isinstance(b, Column) else F.lit(float(b)) for b in (low, high))
    place = (value - low) / (high - low) * F.lit(float(BUCKETS))
    inside = F.greatest(F.lit(-1.0), F.least(F.lit(float(BUCKETS)), place))
    coarse = F.floor(inside)
    fine = F.floor((inside - coarse) * F.lit(float(BUCKETS)))
    return {"coarse": coarse, "fine": fine}


def exact_quantiles(
    counts: DataFrame,
    side: str,
    probabilities: Sequence[float],
    groups: Sequence[str] = ("feature",),
    levels: Sequence[str] = ("coarse", "fine"),
) -> DataFrame:
    """Linear-interpolation quantiles of a value-count table, exact and distributed.

    Returns ``groups, quantile_index, probability, quantile``. The wanted ranks
    are a short fixed list, so each value row picks the ranks it covers by itself.
    """
    groups = list(groups)
    present = counts.filter(F.col(side) > 0)
    ordered = running_before(present, [side], ["value"], groups, levels)
    total = present.groupBy(*groups).agg(F.sum(side).alias("_total"))
    probes = []
    for index, p in enumerate(probabilities):
        place = (F.col("_total") - 1) * F.lit(float(p))
        for corner, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            probes.append(
                F.struct(
                    F.lit(index).alias("quantile_index"),
                    F.lit(float(p)).alias("probability"),
                    (place - F.floor(place)).alias("share"),
                    F.lit(corner).alias("corner"),
                    rank.cast("long").alias("rank"),
                )
            )
    before = F.col(f"{side}_before")
    covered = F.filter(
        F.array(*probes),
        lambda probe: (probe["rank"] >= before) & (probe["rank"] < before + F.col(side)),
    )
    hits = ordered.join(total, groups).select(*groups, "value", F.explode(covered).alias("probe"))
    corners = hits.groupBy(*groups, "probe.quantile_index", "probe.probability", "probe.share").agg(
        F.max(F.when(F.col("probe.corner") == "low", F.col("value"))).alias("_low"),
        F.max(F.when(F.col("probe.corner") == "high", F.col("value"))).alias("_high"),
    )
    return corners.select(
        *groups,
        "quantile_index",
        "probability",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("share")).alias("quantile"),
    )
