import pytest
from brute import EVENT_SCHEMA, event, features, isclose, scatter
from pyspark.sql import functions as F

from tremorlake.operators.aftershocks import aftershock_pairs
from tremorlake.operators.isolation import find_mainshocks
from tremorlake.plans.features import build_feature_table
from tremorlake.schema import FEATURE_TABLE, FEATURES, TARGET
from tremorlake.session import cut_lineage

VALUES = [c for c in FEATURES if "susulan" in c] + [TARGET]


def table(spark, events):
    df = build_feature_table(spark.createDataFrame(events, EVENT_SCHEMA))
    return {(r["mainshock_id"], r["snapshot_hours"]): tuple(r[c] for c in VALUES) for r in df.collect()}


def test_schema(spark):
    df = build_feature_table(spark.createDataFrame([event(1)], EVENT_SCHEMA))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in FEATURE_TABLE]
    assert len(FEATURES) == 10 and set(FEATURES) <= set(df.columns)


def test_quiet_mainshock_has_all_snapshots(spark):
    rows = table(spark, [event(1)])
    assert sorted(h for _, h in rows) == [1, 3, 6, 12, 24, 48, 72]
    assert set(rows.values()) == {(0, 0, 0, 0.0, 0.0, 0)}


def test_snapshot_ends(spark):
    rows = table(spark, [event(1), event(2, 1, mag=4.0), event(3, 25, mag=4.0)])
    assert rows[("1", 1)] == (1, 1, 1, 4.0, 4.0, 1)
    assert rows[("1", 3)][5] == 1
    only_last = table(spark, [event(1), event(3, 25, mag=4.0, seconds=1)])
    assert only_last[("1", 1)][5] == 0 and only_last[("1", 3)][5] == 1
    weak = table(spark, [event(1), event(2, 2, mag=3.9)])
    assert weak[("1", 1)][5] == 0


def test_first_hour_counts_are_equal(spark):
    rows = table(spark, [event(0, -2, mag=4.5), event(1), event(2, 0.5, mag=3.0), event(3, 1, mag=3.0)])
    assert rows[("1", 1)][:3] == (2, 2, 2)


@pytest.mark.parametrize("seed, area", [(11, {}), (12, {"days": 12, "spread": 0.6}), (13, {"lon": (178, 182), "lat": (-2, 2)})])
def test_equals_brute_force(spark, seed, area):
    events = scatter(seed, 350, **area)
    expected, got = features(events), table(spark, events)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert all(isclose(a, b) for a, b in zip(got[key], values)), key


def test_missing_depth_gets_the_default(spark):
    df = build_feature_table(spark.createDataFrame([event(1, depth=None)], EVENT_SCHEMA))
    assert {r["mainshock_depth"] for r in df.collect()} == {10.0}


def test_label_complete_flag(spark):
    df = build_feature_table(spark.createDataFrame([event(1), event(2, 30, mag=3.0)], EVENT_SCHEMA), label_complete=True)
    flags = {r["snapshot_hours"]: r["label_complete"] for r in df.collect() if r["mainshock_id"] == "1"}
    assert flags[6] and not flags[12]


def test_merge_join_gives_the_same_pairs_and_splits_a_hot_cell(spark, conf):
    """A third of all events in one cell and day: the sort-merge path splits it."""
    hot = spark.range(60000).select(
        (F.col("id") + 10).alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 80000 + 1).alias("time_utc"),
        (F.rand(1) * 0.2).alias("latitude"),
        (F.rand(2) * 0.2 + 100).alias("longitude"),
        F.lit(3.0).alias("magnitude"),
        F.lit(10.0).alias("depth_km"),
    )
    others = spark.createDataFrame([event(1)] + scatter(5, 200), EVENT_SCHEMA)
    events = cut_lineage(hot.unionByName(others.filter("event_id = 1 or event_id > 70000")), "hot")
    mains = cut_lineage(find_mainshocks(events), "mains")
    small = aftershock_pairs(mains, events)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    )
    merged = aftershock_pairs(mains, events.repartition(8))
    counted = merged.groupBy("mainshock_id").count()
    expected = {r[0]: r[1] for r in small.groupBy("mainshock_id").count().collect()}
    assert {r[0]: r[1] for r in counted.collect()} == expected
    assert sum(expected.values()) >= 60000
    final = counted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in final
