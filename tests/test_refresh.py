import datetime as dt

import pytest
from brute import EVENT_SCHEMA, event, features, isclose, scatter
from test_features import VALUES

from tremorlake.plans.features import build_feature_table
from tremorlake.plans.refresh import read_kept_features, rebuild_features, refresh_features
from tremorlake.sources import daily


def rows(df):
    return {(r["mainshock_id"], r["snapshot_hours"]): tuple(r) for r in df.collect()}


def same(spark, table, events):
    kept = rows(read_kept_features(spark, table))
    assert kept == rows(build_feature_table(events))
    return kept


@pytest.mark.parametrize("seed, area", [(21, {}), (22, {"lon": (178, 182), "lat": (-2, 2)})])
def test_equals_a_rebuild_after_every_snapshot(spark, tmp_path, seed, area):
    """Three snapshots: later days, and late events among the days before."""
    table, everything = str(tmp_path / "t"), scatter(seed, 240, **area)
    cut = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d) for d in (15, 28, 400)]
    seen = []
    for n, until in enumerate(cut):
        late = [e for e in everything if e[1] < until and (e[0] % 9 or n == 2)]
        added = [e for e in late if e not in seen]
        seen += added
        events = spark.createDataFrame(seen, EVENT_SCHEMA)
        refresh_features(table, events, spark.createDataFrame(added, EVENT_SCHEMA), mark=str(n))
        kept = same(spark, table, events)
    assert daily.last_mark(spark, table) == "2"
    expected = features(everything)
    columns = read_kept_features(spark, table).columns
    at = [columns.index(c) for c in VALUES]
    assert kept.keys() == expected.keys()
    assert all(isclose(kept[k][i], v) for k, values in expected.items() for i, v in zip(at, values))


def test_a_suppressed_mainshock_leaves_its_day_empty(spark, tmp_path):
    table = str(tmp_path / "t")
    first = [event(1, 72), event(2, 2000, lat=3.0)]
    rebuild_features(table, spark.createDataFrame(first, EVENT_SCHEMA))
    assert {k[0] for k in rows(read_kept_features(spark, table))} == {"1", "2"}
    prior = [event(3, 0, lon=100.2)]
    events = spark.createDataFrame(first + prior, EVENT_SCHEMA)
    refresh_features(table, events, spark.createDataFrame(prior, EVENT_SCHEMA))
    assert {k[0] for k in same(spark, table, events)} == {"2", "3"}
    touched = daily.read_log(spark, table).filter("number = 2 and day is not null")
    # 96 hours before and seven days after the one event.
    assert touched.count() == 12


def test_corrections_name_both_versions(spark, tmp_path):
    table = str(tmp_path / "t")
    before, after = [event(1), event(2, 5, mag=4.5)], [event(1), event(2, 5, mag=4.5, lat=4.0)]
    rebuild_features(table, spark.createDataFrame(before, EVENT_SCHEMA))
    events = spark.createDataFrame(after, EVENT_SCHEMA)
    refresh_features(table, events, spark.createDataFrame([before[1], after[1]], EVENT_SCHEMA))
    same(spark, table, events)


def test_nothing_new_and_nothing_there(spark, tmp_path):
    table, none = str(tmp_path / "t"), spark.createDataFrame([], EVENT_SCHEMA)
    refresh_features(table, none, none)
    assert read_kept_features(spark, table).count() == 0
    events = spark.createDataFrame([event(1), (5, None, None, None, 6.0, None)], EVENT_SCHEMA)
    refresh_features(table, events, events)
    kept = same(spark, table, events)
    refresh_features(table, events, none)
    assert rows(read_kept_features(spark, table)) == kept
    rebuild_features(table, none)
    assert read_kept_features(spark, table).count() == 0


def test_an_unlogged_commit_is_not_seen_and_a_number_is_taken_once(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.sql("SELECT 1 AS x, DATE'2024-01-01' AS day")
    daily.replace_all(table, df)
    df.write.partitionBy("day").parquet(f"{table}/rows/commit=lost")
    schema = df.drop("day").schema
    assert daily.read_days(spark, table, schema).count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        df.write.parquet(f"{table}/log/number=1")


def test_the_log_prunes_folders(spark, tmp_path):
    table = str(tmp_path / "t")
    daily.replace_all(table, spark.sql("SELECT 1 AS x, DATE'2024-01-01' AS day"))
    one = spark.sql("SELECT 2 AS x, DATE'2024-01-02' AS day")
    daily.replace_days(table, one, one)
    read = daily.read_days(spark, table, one.drop("day").schema)
    assert "dynamicpruning" in read._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted(r.x for r in read.collect()) == [1, 2]
