"""Catalogue vocabulary: decay law, size classes, calendar parts, model labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorlake.schema import OMORI_C, OMORI_K, OMORI_P

# Class names and their right-closed upper bounds, above an open zero.
DEPTH_CLASSES = (("shallow", 70.0), ("intermediate", 300.0), ("deep", 700.0))
MAGNITUDE_CLASSES = (
    ("micro", 2.0), ("minor", 3.0), ("light", 4.0),
    ("moderate", 5.0), ("strong", 6.0), ("major", 10.0),
)
# Fixed value: text written for a number outside every class.
NO_CLASS = "nan"

# Label texts of the classifier.
CLASS_LABELS = {0: "Tidak Ada Susulan", 1: "Ada Susulan"}
RISK_LABELS = {0: "RENDAH", 1: "TINGGI"}


def _classify(value: Column, classes: tuple[tuple[str, float], ...]) -> Column:
    chain = F.when(value.isNull() | (value <= 0), F.lit(NO_CLASS))
    for name, upper in classes:
        chain = chain.when(value <= upper, F.lit(name))
    return chain.otherwise(F.lit(NO_CLASS))


def depth_category(depth_km: Column) -> Column:
    return _classify(depth_km, DEPTH_CLASSES)


def magnitude_category(magnitude: Column) -> Column:
    return _classify(magnitude, MAGNITUDE_CLASSES)


def is_felt(felt_intensity: Column) -> Column:
    return F.coalesce(felt_intensity, F.lit(0.0)) > 0


def date_parts(time_utc: Column) -> dict[str, Column]:
    return {"year": F.year(time_utc), "month": F.month(time_utc), "hour_utc": F.hour(time_utc)}


def omori_rate(
    hours: Column, k: float = OMORI_K, c: float = OMORI_C, p: float = OMORI_P
) -> Column:
    """Expected aftershocks per day; the floor on time keeps zero hours finite."""
    days = F.greatest(hours / 24.0, F.lit(0.001))
    return F.lit(k) / F.pow(days + F.lit(c), F.lit(p))


def threshold_predict(probability: Column, threshold: float | Column) -> Column:
    return (probability >= threshold).cast("int")


def _lookup(value: Column, names: dict[int, str]) -> Column:
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.element_at(F.create_map(*pairs), value.cast("int"))


def class_label(value: Column) -> Column:
    return _lookup(value, CLASS_LABELS)


def risk_label(value: Column) -> Column:
    return _lookup(value, RISK_LABELS)
