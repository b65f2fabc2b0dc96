"""Train and test splits by exact position, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.operators.ranking import join_with_nulls, rank_in_levels
from tremorlake.schema import SEED, TARGET, TEST_SIZE


def row_digest(*columns: str, salt: str = "") -> Column:
    """A text that orders rows in a fixed but arbitrary way."""
    parts = [F.col(c).cast("string") for c in columns]
    return F.md5(F.concat_ws("|", F.lit(salt), *parts).cast("binary"))


def time_split(features: DataFrame, test_size: float = TEST_SIZE) -> DataFrame:
    """Add ``part``: the oldest rows are train, the newest are test.

    Rows are ordered by mainshock time, those without one last; rows of one instant are ordered by a
    digest of their key, whose prefix also spreads a crowded instant over tasks.
    A day holds few instants, since isolated mainshocks are sparse in space.
    """
    digest = row_digest("mainshock_id", "snapshot_hours")
    levels = {
        "_day": F.to_date("mainshock_time"),
        "_time": F.col("mainshock_time"),
        "_prefix": F.substring(digest, 1, 2),
    }
    ranked = rank_in_levels(features, levels, [digest], name="_position")
    rows = features.agg(F.count(F.lit(1)).alias("rows")).scalar()
    train = F.col("_position") <= F.floor(rows * F.lit(1.0 - test_size))
    return ranked.withColumn("part", F.when(train, "train").otherwise("test")).drop("_position")


def stratified_split(
    features: DataFrame, keys: list[str], test_size: float = TEST_SIZE, label: str = TARGET, seed: int = SEED
) -> DataFrame:
    """Add ``part``: the same test share in every class, chosen by digest.

    Used when rows carry no time. Each class is ranked over digest prefixes, so
    even two classes spread over many tasks. Rows without a label are a class of their own.
    """
    digest = row_digest(*keys, salt=str(seed))
    levels = {"_coarse": F.substring(digest, 1, 2), "_fine": F.substring(digest, 3, 2)}
    ranked = rank_in_levels(features, levels, [digest], [label], name="_position")
    sizes = features.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    test = F.col("_position") <= F.round(F.col("_size") * F.lit(test_size))
    return (
        join_with_nulls(ranked, sizes, [label])
        .withColumn("part", F.when(test, "test").otherwise("train"))
        .drop("_position", "_size")
        .select(*features.columns, "part")
    )
