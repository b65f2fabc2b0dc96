"""Tables by day whose commits replace whole days.

The rows of a commit lie in a folder of their own, by day. A log names the days each commit replaces, and a
reader takes every day from the newest commit that names it. The log is written last and as one file, so a commit
is seen whole or not at all, and a job that failed on the way leaves files that nobody reads. A table takes one
writer at a time: a number that exists is an error, but two writers that look at the same moment aren't told apart.
Replaced rows stay on disk; ``replace_all`` starts a table over, and its owner may then remove what the log no
longer names.

The log holds a row per commit and replaced day; folded to the newest commit of each day it is bounded by the
calendar, so it may be broadcast, and it prunes the folders that are scanned.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tremorlake.session import ready

_LOG = "day date, commit string, mark string, whole boolean, number bigint"


def read_log(spark: SparkSession, table: str) -> DataFrame:
    """A row without a day per commit, with its mark, and one per day it replaced."""
    try:
        return ready(spark).read.schema(_LOG).parquet(f"{table}/log")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], _LOG)


def newest_commits(log: DataFrame) -> DataFrame:
    """The commit that holds each day. Commits before the last whole one don't count.

    That one's number is fetched, because a scan is pruned by a join only if the plan shows a comparison.
    """
    base = log.filter("whole").agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    since = log.filter((F.col("number") >= base) & F.col("day").isNotNull())
    return since.groupBy("day").agg(F.max_by("commit", "number").alias("commit"))


def read_days(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The rows as they stand, with their ``day``; a table that was never written is empty."""
    stored = StructType(schema.fields + [StructField("commit", StringType()), StructField("day", DateType())])
    log = read_log(spark, table)
    try:
        rows = spark.read.schema(stored).parquet(f"{table}/rows")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], stored)
    return rows.join(F.broadcast(newest_commits(log)), ["day", "commit"]).select(*schema.names, "day")


def last_mark(spark: SparkSession, table: str) -> str | None:
    """The mark of the newest commit."""
    return read_log(spark, table).filter("day is null").agg(F.max_by("mark", "number")).first()[0]


def replace_days(table: str, rows: DataFrame, days: DataFrame, mark: str | None = None, whole: bool = False) -> int:
    """Let ``rows``, which carry their ``day``, take the place of all rows of ``days``; returns the commit's number.

    A day without new rows becomes empty. Rows of other days must not be among them, and rows without a day
    have no place in such a table: both are left out of every later read.
    """
    spark = rows.sparkSession
    commit = uuid.uuid4().hex
    number = read_log(spark, table).agg(F.coalesce(F.max("number"), F.lit(0)) + 1).first()[0]
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(f"{table}/rows/commit={commit}")
    header = spark.range(1).select(F.lit(None).cast("date").alias("day"))
    named = header.unionByName(days.select("day").filter("day is not null").distinct())
    entry = named.select("day", F.lit(commit).alias("commit"), F.lit(mark).cast("string").alias("mark"), F.lit(whole).alias("whole"))
    entry.coalesce(1).write.parquet(f"{table}/log/number={number}")
    return number


def replace_all(table: str, rows: DataFrame, mark: str | None = None) -> int:
    """Start the table over with ``rows``, which are read twice and should be stored."""
    return replace_days(table, rows, rows.select("day"), mark, whole=True)
