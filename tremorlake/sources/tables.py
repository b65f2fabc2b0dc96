"""Stored tables: the event table and the feature table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tremorlake.schema import CLEAN, FEATURE_TABLE
from tremorlake.session import ready


def scan_events_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The clean event table; name the columns a job needs and only those are read."""
    events = ready(spark).read.schema(CLEAN).parquet(path)
    return events.select(*(columns or CLEAN.names))


def scan_events_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "events",
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """The event table of a database, read in parallel slices of one column."""
    reader = ready(spark).read.format("jdbc").options(url=url, dbtable=table)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def scan_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table; a missing one says which jobs make it."""
    try:
        return ready(spark).read.schema(FEATURE_TABLE).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise FileNotFoundError(
            f"no feature table at {path}: ingest the feeds, clean the snapshots, build the features"
        ) from error
