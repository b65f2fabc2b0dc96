"""Landed agency feeds: nested JSON documents flattened to raw event rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.functions import text
from tremorlake.schema import BULLETIN_FEED, GEOJSON_FEED, RAW_COLUMNS
from tremorlake.session import ready

# Source names and the constants feeds imply.
GEOJSON_SOURCE = "USGS"
BULLETIN_SOURCES = ("BMKG-terkini", "BMKG-dirasakan")
BULLETIN_MAGNITUDE_TYPE = "M"
BULLETIN_STATUS = "reviewed"

# The text of a document that could not be read.
_BROKEN = "_broken"


def _documents(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Documents of a schema, and the text of those that do not fit it."""
    with_broken = T.StructType([*schema, T.StructField(_BROKEN, T.StringType())])
    reader = ready(spark).read.schema(with_broken).option("columnNameOfCorruptRecord", _BROKEN)
    return reader.option("multiLine", multi_line).json(path)


def _geojson_items(spark: SparkSession, path: str, multi_line: bool) -> tuple[DataFrame, DataFrame]:
    """The documents, and their features one by one: place, text and what could be read of it."""
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StringType()))])
    documents = _documents(spark, path, schema, multi_line)
    items = documents.select(F.posexplode("features").alias("feed_position", "item"))
    return documents, items.withColumn("feature", F.from_json("item", GEOJSON_FEED["features"].dataType.elementType))


def _is_feature() -> Column:
    return F.col("feature.id").isNotNull() | F.col("feature.properties").isNotNull() | F.col("feature.geometry").isNotNull()


def geojson_rejects(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Documents and features that could not be read at all, each with the reason."""
    documents, items = _geojson_items(spark, path, multi_line)
    source = F.lit(GEOJSON_SOURCE).alias("source")
    broken = documents.filter("features IS NULL").select(source, F.col(_BROKEN).alias("item"), F.lit("document").alias("reason"))
    return broken.unionByName(items.filter(~F.coalesce(_is_feature(), F.lit(False))).select(source, "item", F.lit("item").alias("reason")))


def scan_geojson_feed(
    spark: SparkSession, path: str, ingested_at: Column | None = None, multi_line: bool = False
) -> DataFrame:
    """One row per feature; ``geojson_rejects`` has what could not be read. ``multi_line`` is for documents spread over lines;
    one document per line can be split between tasks."""
    features = _geojson_items(spark, path, multi_line)[1].filter(_is_feature())
    at = "feature.properties"
    coordinates = F.col("feature.geometry.coordinates")
    return features.select(
        F.col("feature.id").alias("event_id"),
        F.lit(GEOJSON_SOURCE).alias("source"),
        text.epoch_ms_to_utc(F.col(f"{at}.time")).alias("time_utc"),
        F.get(coordinates, F.lit(1)).alias("latitude"),
        F.get(coordinates, F.lit(0)).alias("longitude"),
        F.get(coordinates, F.lit(2)).alias("depth_km"),
        F.col(f"{at}.mag").alias("magnitude"),
        F.col(f"{at}.magType").alias("magnitude_type"),
        F.col(f"{at}.place").alias("place"),
        F.col(f"{at}.mmi").cast("string").alias("felt_intensity"),
        F.col(f"{at}.status").alias("status"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.col("feed_position").cast("long").alias("feed_position"),
    )


@dataclass(frozen=True)
class BulletinRows:
    """Rows that could be read, and the items that could not with the reason."""

    events: DataFrame
    rejects: DataFrame


def scan_bulletin_feed(
    spark: SparkSession,
    path: str,
    source: str,
    ingested_at: Column | None = None,
    multi_line: bool = False,
) -> BulletinRows:
    """Flatten ``Infogempa.gempa``, an array or a lone object, item by item.

    A missing field has a default, a field that is present but unreadable
    rejects its row, and one bad row never stops the others. Items that are no objects
    and documents that cannot be read are rejected with their text.
    """
    documents = _documents(spark, path, BULLETIN_FEED, multi_line)
    # A lone object is wrapped so that one schema reads both shapes.
    inner = F.trim("Infogempa.gempa")
    as_array = F.when(F.startswith(inner, F.lit("[")), inner).otherwise(
        F.concat(F.lit("["), inner, F.lit("]"))
    )
    listed = documents.select(F.from_json(F.when(inner != "", as_array), "array<string>").alias("items"), inner.alias("inner"), _BROKEN)
    broken = listed.filter("items IS NULL").select(
        F.lit(source).alias("source"), F.coalesce(_BROKEN, "inner").alias("item"), F.lit("document").alias("reason")
    )
    items = listed.select(F.posexplode("items").alias("feed_position", "raw"))
    items = items.withColumn("item", F.from_json("raw", "map<string,string>"))

    def field(name: str, default: str | None = None) -> Column:
        value = F.element_at("item", F.lit(name))
        if default is None:
            return value
        return F.when(F.map_contains_key("item", name), value).otherwise(F.lit(default))

    date_time, size = field("DateTime"), field("Magnitude")
    parsed = items.select(
        text.bulletin_event_id(date_time, size).alias("event_id"),
        F.lit(source).alias("source"),
        text.to_time(date_time).alias("time_utc"),
        text.hemisphere_coord(field("Lintang", "0 LS")).alias("latitude"),
        text.hemisphere_coord(field("Bujur", "0 BT")).alias("longitude"),
        text.depth_km(field("Kedalaman", "0 km")).alias("depth_km"),
        text.to_number(size).alias("magnitude"),
        F.lit(BULLETIN_MAGNITUDE_TYPE).alias("magnitude_type"),
        text.coalesce_place(field("Wilayah"), field("Keterangan")).alias("place"),
        field("Dirasakan").alias("felt_intensity"),
        F.lit(BULLETIN_STATUS).alias("status"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.col("feed_position").cast("long").alias("feed_position"),
        "item",
        "raw",
    )
    needed = ("event_id", "latitude", "longitude", "depth_km", "magnitude")
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    reason = F.when(F.col("item").isNull(), F.lit("item")).otherwise(missing)
    judged = parsed.withColumn("reason", reason)
    return BulletinRows(
        events=judged.filter("reason = ''").select(*RAW_COLUMNS, "feed_position"),
        rejects=judged.filter("reason != ''").select(
            "source", F.coalesce(F.to_json("item"), "raw").alias("item"), "reason"
        ).unionByName(broken),
    )
