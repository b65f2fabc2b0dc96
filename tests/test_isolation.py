import pytest
from brute import EVENT_SCHEMA, event, km, mainshocks, scatter
from pyspark.sql import functions as F

from tremorlake.functions.geo import Grid
from tremorlake.operators import isolation
from tremorlake.operators.isolation import find_mainshocks, isolated_epicentres
from tremorlake.session import cut_lineage

WEEK = 7 * 24


def found(spark, events):
    df = spark.createDataFrame(events, EVENT_SCHEMA)
    rows = [r[0] for r in find_mainshocks(df).select("event_id").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_window_ends(spark):
    assert found(spark, [event(1), event(2, WEEK)]) == {1}
    assert found(spark, [event(1), event(2, WEEK, seconds=1)]) == {1, 2}


def test_window_ends_between_cells(spark):
    lat = 0.85
    assert found(spark, [event(1), event(2, WEEK, lat=lat)]) == {1}
    assert found(spark, [event(1), event(2, WEEK, lat=lat, seconds=1)]) == {1, 2}


def test_equal_times_never_suppress(spark):
    assert found(spark, [event(1), event(2), event(3, lat=0.5)]) == {1, 2, 3}


def test_radius_is_strict(spark):
    near, far = 0.8993, 0.8994
    assert km(0, 100, near, 100) < 100 < km(0, 100, far, 100)
    assert found(spark, [event(1), event(2, 5, lat=near)]) == {1}
    assert found(spark, [event(1), event(2, 5, lat=far)]) == {1, 2}


def test_suppressed_events_still_suppress(spark):
    chain = [event(1), event(2, 6 * 24), event(3, 12 * 24), event(4, 12 * 24 + 1, lat=4.0)]
    assert found(spark, chain) == {1, 4}


def test_weak_events_do_not_count(spark):
    assert found(spark, [event(1, mag=4.9), event(2, 1), event(3, 2, mag=4.99)]) == {2}


def test_no_events(spark):
    assert found(spark, [event(1, mag=4.0)]) == set()


@pytest.mark.parametrize(
    "seed, area",
    [
        (1, {}),
        (2, {"spread": 0.9}),
        (3, {"lat": (-3, 3), "lon": (178, 182), "spread": 1.2}),
        (4, {"lat": (60, 89), "lon": (-180, 180), "spread": 2.0}),
        (5, {"days": 10, "spread": 0.1}),
    ],
)
def test_equals_brute_force(spark, seed, area):
    events = scatter(seed, 400, **area)
    assert found(spark, events) == mainshocks(events)


def test_a_cell_with_most_rows_shrinks_before_the_join(spark, monkeypatch):
    """Copies of one place and day leave the first aggregate as one row."""
    written = {}

    def record(df, name):
        written[name] = cut_lineage(df, name)
        return written[name]

    monkeypatch.setattr(isolation, "cut_lineage", record)
    hot = spark.range(20000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400).alias("time_utc"),
        F.lit(0.0).alias("latitude"),
        F.lit(100.0).alias("longitude"),
        F.lit(6.0).alias("magnitude"),
    )
    found_here = isolated_epicentres(hot)
    assert found_here.count() == 1 and written["sites"].count() == 1
    plan = found_here._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_hot_cell_is_split_when_both_sides_are_large(spark, conf):
    """Many places in one cell and day: the sort-merge path splits that day."""
    hot = spark.range(40000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200 + 3600) + F.col("id") % 80000).alias("time_utc"),
        (F.rand(3) * 0.5).alias("latitude"),
        (F.rand(4) * 0.5 + 100.0).alias("longitude"),
        F.lit(5.5).alias("magnitude"),
    )
    first = spark.createDataFrame([event(50000, lat=0.7, lon=100.2), event(50001, 24 * 3, lat=-0.2, lon=100.2)], EVENT_SCHEMA)
    events = cut_lineage(hot.unionByName(first.drop("depth_km")), "hot")
    expected = {r[0] for r in find_mainshocks(events).select("event_id").collect()}
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    )
    df = isolated_epicentres(events)
    assert df.count() == len(expected)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("lat", [-75.0, -11.0, 0.0, 6.0, 45.0, 84.0, 89.5])
def test_reach_covers_the_circle(spark, lat):
    """Every point nearer than the radius has its cell among the cells in reach."""
    import numpy as np

    rng = np.random.default_rng(7)
    lon = 179.9
    pts = [(float(a), float(b)) for a, b in zip(
        np.clip(lat + rng.uniform(-1, 1, 3000), -90, 90), lon + rng.uniform(-180, 180, 3000))]
    pts += [(float(np.clip(lat + rng.uniform(-1, 1), -90, 90)), float(lon + rng.uniform(-8, 8))) for _ in range(3000)]
    near = [p for p in pts if km(lat, lon, *p) < 100]
    assert near
    for grid in (Grid.with_close_cells(100.0), Grid.about_one_radius(100.0)):
        df = spark.createDataFrame(near, "a double, b double")
        outside = df.filter(
            ~F.array_contains(grid.rows_in_reach(F.lit(lat)), grid.row(F.col("a")))
            | ~F.array_contains(grid.columns_in_reach(F.lit(lat), F.lit(lon)), grid.column(F.col("b")))
        )
        assert outside.count() == 0
