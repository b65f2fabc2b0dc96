"""Driver tables turned into catalogue inputs, with Spark expressions only.

Every view is a pure function of the ``events`` table, so the same rows can be
derived in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.session import ready

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored events; declaring the time type lets time filters reach the scan."""
    return ready(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def seismic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean catalogue: each user is one site, the value sets the magnitude."""
    user = F.col("user_id")
    return events_table(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("time_utc"),
        (F.lit(-11) + (user * 37 % 170) / 10.0).alias("latitude"),
        (F.lit(95) + (user * 53 % 460) / 10.0).alias("longitude"),
        (F.lit(2.5) + F.least(F.col("value"), F.lit(480.0)) / 100.0).alias("magnitude"),
        (F.col("event_id") % 701).cast("double").alias("depth_km"),
        F.when(F.col("event_id") % 3 == 0, "USGS")
        .when(F.col("event_id") % 2 == 0, "BMKG-terkini")
        .otherwise("BMKG-dirasakan")
        .alias("source"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same catalogue as a raw text snapshot, with gaps, bad cells and copies."""
    e = seismic_events(spark, sf_dir)
    n = F.col("event_id")
    first = e.select(
        F.when(n % 97 == 0, F.lit("  ")).otherwise(F.concat(F.lit("ev"), n)).alias("event_id"),
        "source",
        F.when(n % 19 == 0, F.lit("bad"))
        .otherwise(F.date_format("time_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("time_utc"),
        F.when(n % 23 == 0, F.col("latitude") + 40)
        .otherwise(F.col("latitude"))
        .cast("string")
        .alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        F.when(n % 13 == 0, F.lit(None))
        .when(n % 29 == 0, F.lit("701"))
        .otherwise(F.col("depth_km").cast("string"))
        .alias("depth_km"),
        F.when(n % 17 == 0, F.lit("")).otherwise(F.col("magnitude").cast("string")).alias("magnitude"),
        F.when(n % 7 == 0, F.lit("nan")).otherwise(F.lit(" mb ")).alias("magnitude_type"),
        F.when(n % 31 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("  Site "), (n % 100).cast("string"), F.lit(" ")))
        .alias("place"),
        F.when(n % 11 == 0, F.lit("III Palu")).when(n % 5 == 0, F.lit("3.5")).alias("felt_intensity"),
        F.when(n % 37 == 0, F.lit(None)).otherwise(F.lit("reviewed")).alias("status"),
        F.lit("2024-02-01T00:00:00").alias("ingested_at"),
        n.alias("feed_position"),
    )
    again = first.filter(F.col("feed_position") % 5 == 0).withColumns(
        {
            "source": F.when(F.col("source") == "USGS", F.lit("BMKG-terkini")).otherwise(F.lit("USGS")),
            "ingested_at": F.lit("2024-02-01T01:00:00"),
        }
    )
    return first.unionByName(again)


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label from the magnitude, score from the key: ties and both classes everywhere."""
    return seismic_events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        (F.col("magnitude") >= 4).cast("int").alias("y"),
        ((F.col("event_id") * 7919 % 1000) / 1000.0).alias("proba"),
        F.col("source"),
    )


def _share(digits: Column, below: int) -> Column:
    return F.count_if(digits < below) / F.count(F.lit(1))


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One training run per user; some failed, some never logged their main metric."""
    user, n = F.col("user_id"), F.col("event_id")
    return (
        events_table(spark, sf_dir)
        .groupBy("user_id")
        .agg(
            _share(n * 7919 % 100, 45).alias("pr_auc"),
            _share(n * 31 % 100, 33).alias("f1_score"),
            _share(n * 17 % 100, 42).alias("recall"),
        )
        .select(
            F.concat(F.lit("run"), user).alias("run_id"),
            F.concat(F.lit("name-"), user % 7).alias("run_name"),
            F.when(user % 4 == 3, "FAILED").otherwise("FINISHED").alias("status"),
            F.when(user % 13 != 12, F.col("pr_auc")).alias("pr_auc"),
            "f1_score",
            "recall",
        )
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five models; every run registered one version of one of them."""
    user = F.col("user_id")
    return (
        events_table(spark, sf_dir)
        .select("user_id")
        .distinct()
        .select(
            F.concat(F.lit("model"), user % 5).alias("model_name"),
            (F.floor(user / 5) + 1).alias("version"),
            F.concat(F.lit("run"), user).alias("run_id"),
        )
    )


def stage_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event moves its user's version to a stage."""
    user, n = F.col("user_id"), F.col("event_id")
    return events_table(spark, sf_dir).select(
        F.concat(F.lit("model"), user % 5).alias("model_name"),
        (F.floor(user / 5) + 1).alias("version"),
        F.when(n % 3 == 0, "Staging").when(n % 3 == 1, "Production").otherwise("None").alias("stage"),
        F.col("ts").alias("at"),
        (n % 2 == 0).alias("archive_existing"),
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is one promotion entry."""
    user, n = F.col("user_id"), F.col("event_id")
    return events_table(spark, sf_dir).select(
        F.concat(F.lit("model"), user % 5).alias("model_name"),
        n.alias("version"),
        F.when(n % 2 == 0, "Staging").otherwise("Production").alias("stage"),
        F.col("ts").alias("promoted_at"),
        F.concat(F.lit("run"), user).alias("mlflow_run_id"),
        ((n * 7919 % 1000) / 1000.0).alias("pr_auc"),
    )


def geojson_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed documents of at most a hundred features, one JSON text per row."""
    e = seismic_events(spark, sf_dir)
    n = F.col("event_id")
    point = [F.col("longitude"), F.col("latitude")]
    feature = F.struct(
        n.alias("seq"),
        F.concat(F.lit("us"), n).alias("id"),
        F.struct(
            F.unix_millis("time_utc").alias("time"),
            F.when(n % 43 != 0, F.col("magnitude")).alias("mag"),
            F.lit("mb").alias("magType"),
            F.concat(F.lit("Site "), n % 100).alias("place"),
            F.when(n % 5 == 0, F.lit(3.5)).alias("mmi"),
            F.lit("reviewed").alias("status"),
        ).alias("properties"),
        F.struct(
            F.when(n % 9 == 0, F.array(*point))
            .otherwise(F.array(*point, F.col("depth_km")))
            .alias("coordinates")
        ).alias("geometry"),
    )
    grouped = e.groupBy(F.floor(n / 100)).agg(F.array_sort(F.collect_list(feature)).alias("features"))
    return grouped.select(F.to_json(F.struct("features")).alias("value"))


def bulletin_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulletin documents: arrays of at most fifty items, and every tenth item alone."""
    e = seismic_events(spark, sf_dir)
    n = F.col("event_id")
    size = F.col("magnitude").cast("decimal(6,4)").cast("string")
    degrees = F.abs("latitude").cast("decimal(8,2)").cast("string")
    fields = {
        "DateTime": F.when(n % 41 != 0, F.date_format("time_utc", "yyyy-MM-dd HH:mm:ss'+00:00'")),
        "Magnitude": F.when(n % 43 == 0, F.lit("x")).otherwise(size),
        "Lintang": F.when(n % 47 == 0, F.lit("x LS"))
        .when(n % 61 == 0, F.lit(" "))
        .otherwise(F.concat(degrees, F.when(F.col("latitude") < 0, F.lit(" ls")).otherwise(F.lit(" LU")))),
        "Bujur": F.concat(F.col("longitude").cast("decimal(8,2)").cast("string"), F.lit(" BT")),
        "Kedalaman": F.when(n % 53 != 0, F.concat(F.col("depth_km").cast("int").cast("string"), F.lit(" km"))),
        "Wilayah": F.when(n % 5 != 0, F.concat(F.lit("Site "), n % 100)),
        "Keterangan": F.lit("Laut"),
        "Dirasakan": F.when(n % 11 == 0, F.lit("III Palu")),
    }
    item = F.to_json(F.struct(n.alias("seq"), *[c.alias(k) for k, c in fields.items()]))
    alone = F.when(n % 10 == 0, n)
    grouped = (
        e.select(n, item.alias("item"), F.floor(n / 50).alias("page"), alone.alias("alone"))
        .groupBy("page", "alone")
        .agg(F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("items"))
    )
    listed = F.concat(F.lit("["), F.array_join("items.item", ","), F.lit("]"))
    body = F.when(F.col("alone").isNull(), listed).otherwise(F.get("items.item", F.lit(0)))
    return grouped.select(
        F.concat(F.lit('{"Infogempa":{"gempa":'), body, F.lit("}}")).alias("value")
    )
