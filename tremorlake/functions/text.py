"""Turning feed text into typed values. Bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes that mean south or west.
NEGATIVE_HEMISPHERES = ("LS", "S", "W", "BB")
# Cells a raw CSV writes for "no value".
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
BLANKS = " \t\r\n"
# Last letters a cast would accept but that make a text no number
# (type suffixes, "inf" and "nan").
NO_NUMBER_ENDS = ("d", "D", "f", "F", "n", "N")


def _stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def to_number(text: Column) -> Column:
    """Decimal text to double; type suffixes and special literals do not count as numbers."""
    trimmed = _stripped(text)
    return F.when(~F.right(trimmed, F.lit(1)).isin(*NO_NUMBER_ENDS), trimmed.try_cast("double"))


def to_time(text: Column) -> Column:
    """Any ISO-8601 date and time to an instant."""
    return _stripped(text).try_cast("timestamp")


def to_text(text: Column) -> Column:
    trimmed = _stripped(text)
    return F.when(trimmed != "nan", trimmed)


def without_markers(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_MARKERS), text)


def hemisphere_coord(text: Column) -> Column:
    """``8.43 LS`` to -8.43. Blank text is 0; text that is no number is null."""
    words = F.split(_stripped(text), r"\s+")
    value = to_number(F.get(words, F.lit(0)))
    suffix = F.upper(F.coalesce(F.get(words, F.lit(1)), F.lit("")))
    signed = F.when(suffix.isin(*NEGATIVE_HEMISPHERES), -value).otherwise(value)
    return F.when(_stripped(text) == "", F.lit(0.0)).otherwise(signed)


def depth_km(text: Column) -> Column:
    """``10 km`` to 10.0."""
    return to_number(F.replace(text, F.lit(" km"), F.lit("")))


def bulletin_event_id(date_time: Column, magnitude: Column) -> Column:
    """Identifier made of the untouched feed texts, spaces turned to underscores."""
    joined = F.concat(F.lit("BMKG-"), date_time, F.lit("-"), magnitude)
    return F.replace(joined, F.lit(" "), F.lit("_"))


def coalesce_place(region: Column, remark: Column) -> Column:
    return F.coalesce(region, remark, F.lit(""))


def epoch_ms_to_utc(milliseconds: Column) -> Column:
    """Epoch milliseconds to an instant in whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(milliseconds))
