"""Raw and processed CSV snapshots: one, the newest, or all of them.

Files may differ in their columns: those of one layout are read together, by name. A
column that a file lacks is null in its rows; further columns of raw files are kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.functions import text
from tremorlake.operators.dedup import first_per_key
from tremorlake.schema import CLEAN, RAW_TEXT, TIME_COLUMNS
from tremorlake.session import ready

# Name patterns. A snapshot is one file, or one folder of part
# files, under a name that carries the time of the run.
RAW_PATTERN = "gempa_*.csv"
PROCESSED_PATTERN = "gempa_*_processed.csv"
SNAPSHOT_NAME = r"(gempa_[^/]*\.csv)"

_CSV = {"header": True, "escape": '"'}


def _snapshot_name(path: Column) -> Column:
    return F.regexp_extract(path, SNAPSHOT_NAME, 1)


def _if_found(read: Callable[[], DataFrame], otherwise: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return otherwise()


def _layouts(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a path, grouped by their first line; files without any line are left out.

    Only the paths and first lines come to the driver, which lists the files anyway.
    """
    lines = ready(spark).read.text(path).filter(F.col("_metadata.file_block_start") == 0)
    numbered = lines.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("row"))
    heads = numbered.groupBy("path").agg(F.min_by("value", "row").alias("head"))
    files = defaultdict(list)
    for row in heads.orderBy("path").collect():
        files[row["head"]].append(unquote(row["path"]))
    return list(files.values())


def _cells(spark: SparkSession, path: str, names: list[str], extra: dict[str, Column]) -> DataFrame | None:
    """All cells as text: the named columns, null where a file lacks them, then all others."""
    parts = []
    for files in _layouts(spark, path):
        rows = spark.read.options(**_CSV).csv(files)
        parts.append(rows.select(*rows.columns, *[c.alias(n) for n, c in extra.items()]))
    if not parts:
        return None
    united = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    missing = {n: F.lit(None).cast("string") for n in names if n not in united.columns}
    others = [c for c in united.columns if c not in names and c not in extra]
    return united.withColumns(missing).select(*names, *others, *extra)


def _raw(spark: SparkSession, path: str, **extra: Column) -> DataFrame:
    """Raw cells as text with the usual no-value markers turned to null."""
    rows = _cells(spark, path, RAW_TEXT.names, extra)
    if rows is None:
        return spark.createDataFrame([], RAW_TEXT).withColumns({n: F.lit(None).cast("string") for n in extra})
    return rows.select(*[text.without_markers(F.col(f"`{c}`")).alias(c) for c in rows.columns if c not in extra], *extra)


def scan_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """One raw snapshot; a path that is missing or empty gives an empty frame."""
    return _if_found(lambda: _raw(spark, path), lambda: spark.createDataFrame([], RAW_TEXT))


def list_snapshots(spark: SparkSession, folder: str, pattern: str = RAW_PATTERN) -> DataFrame:
    """Paths and names of the snapshot files. Only the listing is read, no content."""
    listing = spark.read.format("binaryFile").load(f"{folder}/{pattern}").select("path")
    return listing.withColumn("snapshot", _snapshot_name(F.col("path")))


def scan_latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The raw snapshot whose name sorts last; only that one is read."""

    def newest() -> DataFrame:
        name = list_snapshots(spark, folder).agg(F.max("snapshot").alias("name")).first()["name"]
        return _raw(spark, f"{folder}/{name}")

    return _if_found(newest, lambda: spark.createDataFrame([], RAW_TEXT))


def scan_all_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """All raw snapshots in one scan, each row with the name of its ``snapshot``."""
    return _raw(spark, f"{folder}/{RAW_PATTERN}", snapshot=_snapshot_name(F.col("_metadata.file_path")))


def scan_processed_union(spark: SparkSession, folder: str) -> DataFrame:
    """All processed snapshots, the first row per event in file and row order.

    Rows without an event id count as one event, and rows without a readable
    time leave only after that choice. Order by ``time_utc`` where it is shown.
    """
    path = F.col("_metadata.file_path")
    places = {
        "_snapshot": _snapshot_name(path),
        "_path": path,
        "_block": F.col("_metadata.file_block_start"),
        "_row": F.monotonically_increasing_id(),
    }
    placed = _cells(spark, f"{folder}/{PROCESSED_PATTERN}", CLEAN.names, places)
    if placed is None:
        return spark.createDataFrame([], CLEAN)
    order = [F.col(c) for c in ("_snapshot", "_path", "_block", "_row")]
    first = first_per_key(placed, ["event_id"], order).select(*CLEAN.names)
    typed = first.select(
        *[
            (text.to_time(F.col(f.name)) if f.name in TIME_COLUMNS else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in CLEAN
        ]
    )
    return typed.filter(F.col("time_utc").isNotNull())
