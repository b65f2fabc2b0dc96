"""Table schemas and the constants shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# Study area, feed floor, validity ranges, defaults.
BBOX = {"min_lat": -11.0, "max_lat": 6.0, "min_lon": 95.0, "max_lon": 141.0}
FEED_MIN_MAGNITUDE = 2.5
MAGNITUDE_RANGE = (0.0, 10.0)
DEPTH_RANGE_KM = (0.0, 700.0)
DEFAULT_DEPTH_KM = 10.0
DEFAULT_MAGNITUDE_TYPE = "M"
DEFAULT_PLACE = "Unknown"
DEFAULT_FELT = 0.0

# Mainshock and aftershock definition.
MAINSHOCK_MAGNITUDE = 5.0
AFTERSHOCK_MAGNITUDE = 4.0
RADIUS_KM = 100.0
LABEL_WINDOW_HOURS = 24
ISOLATION_DAYS = 7
SNAPSHOT_HOURS = (1, 3, 6, 12, 24, 48, 72)
ROLLING_COUNT_HOURS = (1, 6, 24)
ROLLING_MAX_HOURS = (6, 24)

# Decay law and geometry.
OMORI_K, OMORI_C, OMORI_P = 10.0, 0.1, 1.0
EARTH_RADIUS_KM = 6371.0

# Model contract.
DECISION_THRESHOLD = 0.45
RECALL_THRESHOLD = 0.40
TEST_SIZE = 0.25
SEED = 42
TARGET = "label_susulan_besar_24jam"
FEATURES = (
    "mainshock_magnitude",
    "mainshock_depth",
    "jam_sejak_mainshock",
    "count_susulan_1jam",
    "count_susulan_6jam",
    "count_susulan_24jam",
    "max_mag_susulan_6jam",
    "max_mag_susulan_24jam",
    "omori_rate_est",
    "zona_sesar",
)

# Drift bands.
PSI_MODERATE, PSI_CRITICAL = 0.1, 0.25

RAW_COLUMNS = (
    "event_id", "source", "time_utc", "latitude", "longitude", "depth_km",
    "magnitude", "magnitude_type", "place", "felt_intensity", "status", "ingested_at",
)
TEXT_COLUMNS = ("event_id", "source", "place", "magnitude_type", "status")
TIME_COLUMNS = ("time_utc", "ingested_at")
NUMERIC_COLUMNS = ("latitude", "longitude", "depth_km", "magnitude", "felt_intensity")
REQUIRED_COLUMNS = RAW_COLUMNS[:9]

# A raw snapshot is all text until it is typed.
RAW_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def _typed(name: str) -> T.StructField:
    if name in TIME_COLUMNS:
        return T.StructField(name, T.TimestampType())
    if name in NUMERIC_COLUMNS:
        return T.StructField(name, T.DoubleType())
    return T.StructField(name, T.StringType())


RAW_TYPED = T.StructType([_typed(c) for c in RAW_COLUMNS])

CLEAN = T.StructType(
    RAW_TYPED.fields
    + [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("hour_utc", T.IntegerType()),
        T.StructField("depth_category", T.StringType()),
        T.StructField("magnitude_category", T.StringType()),
        T.StructField("zona_sesar", T.StringType()),
        T.StructField("is_felt", T.BooleanType()),
    ]
)

FEATURE_TABLE = T.StructType(
    [
        T.StructField("mainshock_id", T.StringType()),
        T.StructField("mainshock_time", T.TimestampType()),
        T.StructField("snapshot_hours", T.IntegerType()),
        T.StructField("mainshock_magnitude", T.DoubleType()),
        T.StructField("mainshock_depth", T.DoubleType()),
        T.StructField("zona_sesar", T.IntegerType()),
        T.StructField("jam_sejak_mainshock", T.DoubleType()),
        T.StructField("count_susulan_1jam", T.LongType()),
        T.StructField("count_susulan_6jam", T.LongType()),
        T.StructField("count_susulan_24jam", T.LongType()),
        T.StructField("max_mag_susulan_6jam", T.DoubleType()),
        T.StructField("max_mag_susulan_24jam", T.DoubleType()),
        T.StructField("omori_rate_est", T.DoubleType()),
        T.StructField(TARGET, T.IntegerType()),
    ]
)

# Main feed: one FeatureCollection per document.
GEOJSON_FEED = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "properties",
                            T.StructType(
                                [
                                    T.StructField("time", T.LongType()),
                                    T.StructField("mag", T.DoubleType()),
                                    T.StructField("magType", T.StringType()),
                                    T.StructField("place", T.StringType()),
                                    T.StructField("mmi", T.DoubleType()),
                                    T.StructField("status", T.StringType()),
                                ]
                            ),
                        ),
                        T.StructField(
                            "geometry",
                            T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))]),
                        ),
                    ]
                )
            ),
        )
    ]
)

# Bulletin feed: the inner field is an array or a lone object, so it stays text at first.
BULLETIN_FEED = T.StructType(
    [T.StructField("Infogempa", T.StructType([T.StructField("gempa", T.StringType())]))]
)
BULLETIN_ITEM = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "DateTime", "Magnitude", "Lintang", "Bujur", "Kedalaman",
            "Wilayah", "Keterangan", "Dirasakan",
        )
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("pr_auc", T.DoubleType()),
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    ]
)
