import datetime as dt

from pyspark.sql import functions as F

from tremorlake.operators import clean, dedup
from tremorlake.plans.catalogue import clean_events, ingest, quality_report, typed_events
from tremorlake.schema import CLEAN, RAW_COLUMNS, RAW_TEXT

GOOD = {
    "event_id": "a", "source": "USGS", "time_utc": "2026-05-12 08:53:56+00:00", "latitude": "4.8", "longitude": "127.5",
    "depth_km": "108.5", "magnitude": "5.0", "magnitude_type": "mb", "place": "sea", "felt_intensity": None,
    "status": "reviewed", "ingested_at": "2026-05-12 11:00:00+00:00",
}


def raw(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}[k] for k in RAW_COLUMNS) for c in changes], RAW_TEXT)


def ids(df):
    return sorted(r["event_id"] for r in df.collect())


def test_clean_row(spark):
    df = clean_events(raw(spark, {}))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEAN]
    row = df.first()
    assert (row.year, row.month, row.hour_utc) == (2026, 5, 8)
    assert (row.depth_category, row.magnitude_category, row.zona_sesar, row.is_felt) == (
        "intermediate", "moderate", "Lainnya_Papua", False,
    )
    assert row.time_utc == dt.datetime(2026, 5, 12, 8, 53, 56)


def test_missing_columns_are_added(spark):
    df = clean.conform_schema(raw(spark, {}).drop("depth_km", "place"))
    assert {"depth_km", "place"} <= set(df.columns)
    assert clean_events(raw(spark, {}).drop("depth_km", "place", "felt_intensity")).first()["depth_km"] == 10.0


def test_critical_fields(spark):
    bad = [
        {"event_id": ""}, {"event_id": "  "}, {"event_id": "nan"}, {"event_id": None}, {"time_utc": "bad"},
        {"latitude": ""}, {"longitude": "x"}, {"magnitude": None},
    ]
    assert ids(clean_events(raw(spark, {}, *bad))) == ["a"]


def test_defaults(spark):
    row = clean_events(raw(spark, {"depth_km": "", "magnitude_type": "nan", "place": None, "status": None})).first()
    assert (row.depth_km, row.magnitude_type, row.place, row.felt_intensity) == (10.0, "M", "Unknown", 0.0)
    assert row.status is None


def test_felt_text_is_lost_and_numbers_are_kept(spark):
    rows = clean_events(raw(spark, {"felt_intensity": "III Palu"}, {"event_id": "b", "felt_intensity": "2.5"})).collect()
    assert {r.event_id: (r.felt_intensity, r.is_felt) for r in rows} == {"a": (0.0, False), "b": (2.5, True)}


def test_range_ends_are_kept(spark):
    kept = [
        {"event_id": "s", "latitude": "-11"}, {"event_id": "n", "latitude": "6"}, {"event_id": "m", "magnitude": "10"},
        {"event_id": "d", "depth_km": "700"}, {"event_id": "w", "longitude": "95"}, {"event_id": "z", "depth_km": "0"},
    ]
    lost = [
        {"event_id": "x1", "latitude": "6.01"}, {"event_id": "x2", "magnitude": "-0.1"},
        {"event_id": "x3", "depth_km": "700.1"}, {"event_id": "x4", "longitude": "141.5"},
    ]
    df = clean_events(raw(spark, *kept, *lost))
    assert ids(df) == sorted(k["event_id"] for k in kept)
    assert df.filter("event_id = 'z'").first()["depth_category"] == "nan"


def test_preferred_source_wins(spark):
    rows = [{"source": "BMKG-terkini", "place": "x"}, {"source": "USGS", "time_utc": "2026-05-12 09:00:00"}]
    assert clean_events(raw(spark, *rows)).first()["source"] == "USGS"


def test_already_typed_rows_pass(spark):
    typed = typed_events(raw(spark, {}, {"event_id": "b", "magnitude": None}))
    nan = typed.withColumn("magnitude", F.coalesce("magnitude", F.lit(float("nan"))))
    assert ids(clean_events(nan)) == ["a"]


def test_one_event_with_most_rows_is_trimmed_before_the_shuffle(spark):
    df = clean_events(raw(spark, *[{"place": str(i)} for i in range(300)], {"event_id": "b"}))
    assert ids(df) == ["a", "b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_feed_order(spark):
    feeds = [
        raw(spark, {"source": s, "event_id": e}).withColumn("feed_position", F.lit(p).cast("long"))
        for s, e, p in (("BMKG-dirasakan", "a", 0), ("BMKG-terkini", "a", 5), ("BMKG-terkini", "a", 2), ("USGS", "b", 0))
    ]
    rows = {r.event_id: (r.source, r.feed_position) for r in ingest(*feeds).collect()}
    assert rows == {"a": ("BMKG-terkini", 2), "b": ("USGS", 0)}


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, only_a string")
    b = spark.createDataFrame([(2.0, 3)], "only_b double, id int")
    rows = dedup.union_feeds(a, b).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (3, None, 2.0)]


def test_quality_report(spark):
    df = raw(spark, {}, {}, {"event_id": "b", "depth_km": None}, {"event_id": "c", "magnitude": "11"}, {"event_id": ""})
    got = {(r.metric, r.key): r.value for r in quality_report(df).collect()}
    assert got[("rows_read", "all")] == 5
    assert got[("rows_without_critical_fields", "all")] == 1
    assert got[("depth_imputed", "all")] == 1
    assert got[("rows_out_of_range", "all")] == 1
    assert got[("rows_before_dedup", "all")] == 3
    assert got[("rows_clean", "all")] == 2
    assert got[("zone_rows", "Lainnya_Papua")] == 2
