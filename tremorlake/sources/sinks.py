"""Writers. Snapshots are never overwritten; tables are partitioned for pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.schema import RAW_COLUMNS

PREVIEW_ROWS = 5
_CSV = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def preview(df: DataFrame, order: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows in a stated order: a bounded top-k, never a full sort."""
    return df.orderBy(*order).limit(rows)


def _as_text(df: DataFrame) -> DataFrame:
    """Times as ISO text to the microsecond, the rest as is: the form CSV files carry."""
    iso = {
        c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        for c, kind in df.dtypes
        if kind == "timestamp"
    }
    return df.withColumns(iso)


def sink_raw_snapshot(df: DataFrame, folder: str, run: str, dry_run: bool = False) -> DataFrame | None:
    """Write one run under its own name; a run that exists is an error.

    A dry run writes nothing and returns the preview.
    """
    rows = df.select(*RAW_COLUMNS)
    if dry_run:
        return preview(rows, ["time_utc", "event_id"])
    writer = _as_text(rows).write.mode("errorifexists").options(**_CSV)
    writer.csv(f"{folder}/gempa_{run}.csv")
    return None


def manifest_rows(snapshots: DataFrame, run_timestamp: Column) -> DataFrame:
    """One audit row per snapshot file, counted in one pass."""
    counted = snapshots.groupBy(F.col("snapshot").alias("output_file")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counted.select(
        run_timestamp.alias("run_timestamp"),
        "output_file",
        "row_count",
        F.when(F.col("row_count") > 0, "success").otherwise("empty").alias("status"),
    )


def sink_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def sink_processed(clean: DataFrame, path: str, csv_folder: str | None = None, run: str = "") -> None:
    """Parquet by year and month, so time filters skip folders; CSV with text times on request.

    The rebalance brings each month to few write tasks, so files stay large, and
    splits a month that is too big for one task at run time.
    """
    clean.hint("rebalance", "year", "month").write.mode("errorifexists").partitionBy("year", "month").parquet(path)
    if csv_folder:
        writer = _as_text(clean).write.mode("errorifexists").options(**_CSV)
        writer.csv(f"{csv_folder}/gempa_{run}_processed.csv")


def sink_features(features: DataFrame, path: str, csv_path: str | None = None) -> None:
    features.write.mode("errorifexists").parquet(path)
    if csv_path:
        _as_text(features).write.mode("errorifexists").options(**_CSV).csv(csv_path)
