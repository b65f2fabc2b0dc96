import math

import pytest
from pyspark.sql import functions as F

from tremorlake.functions import catalogue, geo, text


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def texts(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def numbers(spark, fn, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_known_distance(spark):
    jakarta, bandung = (-6.2088, 106.8456), (-6.9175, 107.6191)
    d = one(spark, geo.haversine_km(*[F.lit(x) for x in jakarta + bandung]))[0]
    assert 100 < d < 140


def test_distance_of_antipodes_is_finite(spark):
    d = one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))[0]
    assert math.isclose(d, math.pi * 6371.0, rel_tol=1e-9)


@pytest.mark.parametrize(
    "lat, lon, code, name",
    [
        (-9.0, 110.0, 0, "Subduksi_Jawa"),
        (-0.95, 100.35, 2, "Sesar_Sumatra"),
        (-0.9, 119.9, 3, "Sesar_Palu_Koro"),
        (0.0, 130.0, 1, "Subduksi_Maluku"),
        (-6.0, 100.0, 4, "Lainnya_Papua"),
        (-5.44, 104.65, 4, "Lainnya_Papua"),
    ],
)
def test_fault_zones(spark, lat, lon, code, name):
    at = (F.lit(lat), F.lit(lon))
    assert tuple(one(spark, geo.fault_zone_code(*at), geo.fault_zone_name(*at))) == (code, name)


def test_decay_law(spark):
    zero, day, week = one(spark, *[catalogue.omori_rate(F.lit(float(h))) for h in (0, 24, 168)])
    assert 0 < zero < math.inf
    assert day > week
    assert math.isclose(day, 10.0 / 1.1)


def test_size_classes(spark):
    assert numbers(spark, catalogue.depth_category, [0, 70, 70.1, 300, 700, 701, None]) == [
        "nan", "shallow", "intermediate", "intermediate", "deep", "nan", "nan",
    ]
    assert numbers(spark, catalogue.magnitude_category, [0, 2, 4, 5, 5.1, 10, 10.1]) == [
        "nan", "micro", "light", "moderate", "strong", "major", "nan",
    ]


def test_coordinates(spark):
    values = ["8.43 LS", "2.14 LU", "115.23 BT", "", "x LS", "3.0 s", "7.5 bb", " 1.5  LS ", None]
    assert texts(spark, text.hemisphere_coord, values) == [
        -8.43, 2.14, 115.23, 0.0, None, -3.0, -7.5, -1.5, None,
    ]


def test_numbers(spark):
    values = ["5.0", " 5 ", "1e2", "1d", "2f", "III Palu", "", "nan", None, "-.5"]
    assert texts(spark, text.to_number, values) == [
        5.0, 5.0, 100.0, None, None, None, None, None, None, -0.5,
    ]
    assert texts(spark, text.depth_km, ["10 km", "10", "? km"]) == [10.0, 10.0, None]


def test_times_in_any_iso_form(spark):
    forms = ["2026-05-12 08:53:56+00:00", "2026-05-12T08:53:56Z", "2026-05-12T15:53:56+07:00", "bad", None]
    seconds = texts(spark, lambda c: F.unix_seconds(text.to_time(c)), forms)
    assert len(set(seconds[:3])) == 1 and seconds[3:] == [None, None]


def test_event_id_keeps_the_feed_text(spark):
    made = one(spark, text.bulletin_event_id(F.lit("2026-04-17 22:19:22"), F.lit("5.1")))[0]
    assert made == "BMKG-2026-04-17_22:19:22-5.1"


def test_epoch_drops_the_fraction(spark):
    assert one(spark, F.unix_millis(text.epoch_ms_to_utc(F.lit(1700000000999))))[0] == 1700000000000
