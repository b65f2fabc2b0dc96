"""Model registry as tables: versions, stage transitions, aliases, promotion history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stages, aliases and the length of the history.
STAGES = ("Production", "Staging")
ALIASES = ("champion", "challenger")
UNSTAGED = "None"
ARCHIVED = "Archived"
HISTORY_LENGTH = 20
METRICS = ("pr_auc", "f1_score", "recall")


def current_stage(transitions: DataFrame) -> DataFrame:
    """Stage of every version after all transitions.

    ``transitions``: model_name, version, stage, at, archive_existing. A version
    holds the stage of its last transition unless a later transition of another
    version took that stage over. Both sides are aggregates with partial sums,
    so a model with most of the history is no hot spot.
    """
    latest = transitions.groupBy("model_name", "version").agg(
        F.max(F.struct("at", "stage")).alias("last")
    )
    takeovers = (
        transitions.filter("archive_existing")
        .groupBy("model_name", "stage")
        .agg(F.max("at").alias("taken_at"))
    )
    held = latest.select("model_name", "version", "last.stage", F.col("last.at").alias("since"))
    return held.join(takeovers, ["model_name", "stage"], "left").select(
        "model_name",
        "version",
        F.when(F.col("taken_at") > F.col("since"), ARCHIVED).otherwise(F.col("stage")).alias("stage"),
        "since",
    )


def promote_first_two(versions: DataFrame) -> DataFrame:
    """Lowest version to Production as champion, the next to Staging as challenger.

    Models with fewer than two versions stay as they are. Spark keeps two rows
    per model and input split before it shuffles.
    """
    by_version = Window.partitionBy("model_name").orderBy("version")
    lowest = versions.withColumn("place", F.row_number().over(by_version)).filter("place <= 2")
    both = Window.partitionBy("model_name")
    pairs = lowest.withColumn("n", F.count(F.lit(1)).over(both)).filter("n = 2")

    def by_place(values: tuple[str, str]):
        return F.when(F.col("place") == 1, values[0]).otherwise(values[1])

    return pairs.select(
        *versions.columns, by_place(STAGES).alias("stage"), by_place(ALIASES).alias("alias")
    )


def describe_production(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Per model, the version in Production or else the lowest, with its run's metrics."""
    in_production = F.when(F.col("stage") == STAGES[0], 0).otherwise(1)
    first = Window.partitionBy("model_name").orderBy(in_production, "version")
    chosen = (
        versions.withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place")
    )
    extra = ["params"] if "params" in runs.columns else []
    return chosen.join(runs.select("run_id", *METRICS, *extra), "run_id", "left").select(
        "model_name",
        "version",
        "run_id",
        "stage",
        *[F.round(m, 4).alias(m) for m in METRICS],
        *extra,
    )


def registry_summary(versions: DataFrame, runs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Versions with their stage, run metrics (0 if unlogged) and alias."""
    logged = runs.select("run_id", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in METRICS])
    return (
        versions.join(logged, "run_id", "left")
        .join(aliases, ["model_name", "version"], "left")
        .select("model_name", "version", "stage", "alias", "run_id", *METRICS)
    )


def history_keep_last(
    history: DataFrame, entries: DataFrame | None = None, keep: int = HISTORY_LENGTH
) -> DataFrame:
    """Append entries and keep the newest: a bounded top-k."""
    everything = history.unionByName(entries, allowMissingColumns=True) if entries else history
    return everything.orderBy(F.col("promoted_at").desc(), F.col("version").desc()).limit(keep)


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The ``history`` array of a registry document; a broken document counts as empty."""
    document = T.StructType(
        [
            T.StructField("history", T.ArrayType(schema)),
            T.StructField("_corrupt_record", T.StringType()),
        ]
    )
    documents = (
        spark.read.schema(document)
        .options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
        .json(path)
    )
    sound = documents.select("history", "_corrupt_record").filter("_corrupt_record is null")
    return sound.select(F.inline("history"))
