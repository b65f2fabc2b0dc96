"""Streaming ingest of landed snapshot files.

The stream does only the stateless steps, exactly once, and drops nothing for
being late. One row per event is decided with the same source priority as in batch,
however far apart the copies landed: either when the appended table is read, or once
for all readers, by merging what was appended into a table by day.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tremorlake.functions import text
from tremorlake.operators.clean import add_derived
from tremorlake.operators.dedup import dedup_source_priority
from tremorlake.operators.merge import merge_days
from tremorlake.plans.catalogue import screened_events
from tremorlake.schema import RAW_TEXT, RAW_TYPED
from tremorlake.session import cut_lineage, ready
from tremorlake.sources import daily

# Fixed value: how late a copy may come for the stateful variant.
DEDUP_HORIZON = "7 days"


def read_landing(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Snapshot files as a stream of raw text rows."""
    reader = ready(spark).readStream.schema(RAW_TEXT).options(header=True, escape='"', enforceSchema=False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(folder)
    return rows.select(*[text.without_markers(F.col(c)).alias(c) for c in RAW_TEXT.names])


def append_screened(landing: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Type, complete and range-check what has landed, and append it to the table."""
    return (
        screened_events(landing)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(table)
    )


def read_screened(spark: SparkSession, table: str) -> DataFrame:
    """The streamed table as clean events, one row each."""
    return add_derived(dedup_source_priority(ready(spark).read.schema(RAW_TYPED).parquet(table)))


def _merged_files(spark: SparkSession, merged: str) -> DataFrame:
    try:
        return spark.read.schema("file string").parquet(f"{merged}/files")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "file string")


def merge_screened(spark: SparkSession, table: str, merged: str) -> int | None:
    """Merge the files of the streamed table that are not merged yet into a table by day.

    Returns the commit's number, or none if there was nothing new. The files are listed after the commit; a run that
    stops in between merges them again, which changes nothing. Older files are left unopened by their time.
    """
    rows = ready(spark).read.schema(RAW_TYPED).parquet(table)
    rows = rows.withColumns({"file": F.col("_metadata.file_path"), "written": F.col("_metadata.file_modification_time")})
    files = rows.select("file", "written").distinct()
    new = cut_lineage(files.join(_merged_files(spark, merged), "file", "left_anti"), "new-files")
    since = new.agg(F.min("written")).first()[0]
    if since is None:
        return None
    fresh = rows.filter(F.col("written") >= F.lit(since)).join(new.select("file"), "file", "left_semi")
    number = merge_days(merged, fresh, RAW_TYPED, dedup_source_priority)
    new.select("file").write.mode("append").parquet(f"{merged}/files")
    return number


def read_merged(spark: SparkSession, merged: str) -> DataFrame:
    """The merged table as clean events, one row each; no row is shuffled."""
    return add_derived(daily.read_days(spark, merged, RAW_TYPED).select(*RAW_TYPED.names))


def dedup_within_watermark(landing: DataFrame, horizon: str = DEDUP_HORIZON) -> DataFrame:
    """One row per event inside the stream, with state bounded by the horizon.

    The first copy to arrive wins, and copies older than the horizon are dropped,
    so use it for live consumers, not for the table of record.
    """
    return (
        screened_events(landing)
        .withWatermark("time_utc", horizon)
        .dropDuplicatesWithinWatermark(["event_id"])
    )
