"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def ready(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC: event times are UTC and hours are read off them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from the session.

    Only a local session without one gets a temporary folder; on a cluster a
    machine-local folder would lose data with its executor, so that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tremorlake-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing there is ever overwritten."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result survives the loss of any executor and its size is known to the
    optimizer, so later joins choose their strategy from facts.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
