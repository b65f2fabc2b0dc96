"""Schema conformance, typing, required fields, defaults, range filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.functions import catalogue, geo, text
from tremorlake.schema import (
    BBOX,
    DEFAULT_DEPTH_KM,
    DEFAULT_FELT,
    DEFAULT_MAGNITUDE_TYPE,
    DEFAULT_PLACE,
    DEPTH_RANGE_KM,
    FEED_MIN_MAGNITUDE,
    MAGNITUDE_RANGE,
    NUMERIC_COLUMNS,
    REQUIRED_COLUMNS,
    TEXT_COLUMNS,
    TIME_COLUMNS,
)


def conform_schema(df: DataFrame) -> DataFrame:
    """Add the required columns that are absent, as nulls; keep everything else."""
    absent = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent})


def parse_once(df: DataFrame, parsed: dict[str, Column]) -> DataFrame:
    """Replace columns by parsed ones that are computed once per row.

    Filters on a plain projection are moved below it, and the parsing is repeated
    there for every comparison. Generated columns stay where they are.
    """
    if not parsed:
        return df
    row = F.struct(*[column.alias(name) for name, column in parsed.items()])
    kept = [c for c in df.columns if c not in parsed]
    return df.select(*kept, F.inline(F.array(row))).select(*df.columns)


def normalize_types(df: DataFrame) -> DataFrame:
    """Times, numbers and trimmed texts; what cannot be read becomes null."""
    types = {f.name: f.dataType for f in df.schema}
    parsed: dict[str, Column] = {}
    plain: dict[str, Column] = {}
    for c in TIME_COLUMNS:
        if isinstance(types.get(c), T.StringType):
            parsed[c] = text.to_time(F.col(c))
        elif c in types:
            plain[c] = F.col(c).cast("timestamp")
    for c in NUMERIC_COLUMNS:
        if isinstance(types.get(c), T.StringType):
            parsed[c] = text.to_number(F.col(c))
        elif c in types:
            number = F.col(c).cast("double")
            plain[c] = F.when(~F.isnan(number), number)
    for c in TEXT_COLUMNS:
        if c in types:
            parsed[c] = text.to_text(F.col(c).cast("string"))
    return parse_once(df.withColumns(plain), parsed)


def has_critical_fields() -> Column:
    present = F.coalesce(F.trim("event_id") != "", F.lit(False))
    for c in ("time_utc", "latitude", "longitude", "magnitude"):
        present = present & F.col(c).isNotNull()
    return present


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    """Keep rows that can be identified, dated, placed and sized."""
    return df.filter(has_critical_fields())


def impute_defaults(df: DataFrame) -> DataFrame:
    defaults = {
        "depth_km": DEFAULT_DEPTH_KM,
        "magnitude_type": DEFAULT_MAGNITUDE_TYPE,
        "place": DEFAULT_PLACE,
        "felt_intensity": DEFAULT_FELT,
    }
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns})


def in_bbox(box: dict[str, float] = BBOX) -> Column:
    return F.col("latitude").between(box["min_lat"], box["max_lat"]) & F.col("longitude").between(
        box["min_lon"], box["max_lon"]
    )


def in_valid_ranges() -> Column:
    return F.col("magnitude").between(*MAGNITUDE_RANGE) & F.col("depth_km").between(*DEPTH_RANGE_KM)


def filter_bbox(df: DataFrame, box: dict[str, float] = BBOX) -> DataFrame:
    return df.filter(in_bbox(box))


def filter_valid_ranges(df: DataFrame) -> DataFrame:
    return df.filter(in_valid_ranges())


def feed_window(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """The feed's request as predicates on the stored table: time, area, size. Sort where it is shown."""
    wanted = F.col("time_utc").between(start, end) & (F.col("magnitude") >= FEED_MIN_MAGNITUDE)
    return filter_bbox(df.filter(wanted))


def add_derived(df: DataFrame) -> DataFrame:
    """Calendar parts, size classes, fault zone and felt flag."""
    derived = {
        **catalogue.date_parts(F.col("time_utc")),
        "depth_category": catalogue.depth_category(F.col("depth_km")),
        "magnitude_category": catalogue.magnitude_category(F.col("magnitude")),
        "zona_sesar": geo.fault_zone_name(F.col("latitude"), F.col("longitude")),
    }
    if "felt_intensity" in df.columns:
        derived["is_felt"] = catalogue.is_felt(F.col("felt_intensity"))
    return df.withColumns(derived)


def select_features(df: DataFrame, features: tuple[str, ...], target: str) -> DataFrame:
    """Model inputs and an integer target; absent columns are an error at once."""
    absent = [c for c in (*features, target) if c not in df.columns]
    if absent:
        raise ValueError(f"feature table lacks columns: {absent}")
    return df.select(*features, F.col(target).cast("int").alias(target))
