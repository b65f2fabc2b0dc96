import datetime as dt

import duckdb
import numpy as np
import pytest
from compare import compare
from pyspark.sql import functions as F

from tremorlake.checks.inputs import EVENTS
from tremorlake.checks.oracles import ORACLES
from tremorlake.checks.queries import QUERIES
from tremorlake.operators import neighbors, resample, split
from tremorlake.operators.neighbors import nearest_neighbors
from tremorlake.schema import FEATURES, TARGET

NAMES = ("a", "b", "c")


def feature_rows(spark, n, hot=0):
    """n rows of distinct hours, and hot more rows that share one instant."""
    base = spark.range(n + hot).select(
        F.col("id").cast("string").alias("mainshock_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.least("id", F.lit(n // 2)) * 3600).alias("mainshock_time"),
        F.lit(1).alias("snapshot_hours"),
        (F.col("id") % 5 == 0).cast("int").alias(TARGET),
    )
    return base


@pytest.mark.parametrize("n, size", [(100, 0.25), (37, 0.25), (10, 0.3), (3, 0.25)])
def test_time_split_sizes_and_order(spark, n, size):
    df = split.time_split(feature_rows(spark, n, hot=20), size)
    rows = df.collect()
    train = [r.mainshock_time for r in rows if r.part == "train"]
    test = [r.mainshock_time for r in rows if r.part == "test"]
    assert len(train) == int((n + 20) * (1 - size)) and len(rows) == n + 20
    assert max(train) <= min(test)


def test_stratified_split_keeps_the_shares(spark):
    df = split.stratified_split(feature_rows(spark, 400), ["mainshock_id"])
    counts = {(r[0], r[1]): r[2] for r in df.groupBy(TARGET, "part").count().collect()}
    assert counts == {(0, "train"): 240, (0, "test"): 80, (1, "train"): 60, (1, "test"): 20}


def cloud(seed, n, dims=3, digits=1):
    return np.unique(np.round(np.random.default_rng(seed).normal(size=(n, dims)), digits), axis=0)


def brute_neighbors(points, k):
    squared = np.zeros((len(points), len(points)))
    for axis in range(points.shape[1]):
        squared += (points[:, None, axis] - points[None, :, axis]) ** 2
    np.fill_diagonal(squared, np.inf)
    return np.argsort(squared, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("box_points, requests", [(4096, 4096), (60, 50)])
def test_neighbors_equal_brute_force(spark, monkeypatch, box_points, requests):
    monkeypatch.setattr(neighbors, "BOX_REQUESTS", requests)
    points = cloud(1, 700)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")
    got = {(r.id, r.rank): r.neighbor for r in nearest_neighbors(df, 5, box_points).collect()}
    expected = brute_neighbors(points, 5)
    assert got == {(i, j + 1): expected[i, j] for i in range(len(points)) for j in range(5)}


def mostly_zero(seed, n, dims=30):
    """Distinct vectors of which most have one or two places that aren't zero."""
    rng, points = np.random.default_rng(seed), set()
    while len(points) < n:
        v = np.zeros(dims)
        v[rng.integers(0, dims, rng.integers(1, 3))] = np.round(rng.random() * 5, 2)
        points.add(tuple(v))
    return np.array(sorted(points))


@pytest.mark.parametrize("points", [cloud(5, 900), mostly_zero(6, 700), np.vstack([cloud(7, 300) * 1e-3, cloud(8, 30) * 1e4])])
def test_boxes_hold_no_more_than_their_limit(spark, points):
    """Clouds, equal values almost everywhere, and a dense spot among far points; the limit changes no neighbour."""
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")
    placed, bounds, rounds = neighbors.boxed(df.repartition(3), points.shape[1], 25)
    sizes = placed.groupBy("box").count().collect()
    assert rounds >= 1 and max(r["count"] for r in sizes) <= 25 and sum(r["count"] for r in sizes) == len(points)
    assert bounds.count() == len(sizes)
    whole, parts = (sorted(tuple(r) for r in nearest_neighbors(df, 3, limit).collect()) for limit in (10**6, 25))
    assert whole == parts
    expected = brute_neighbors(points, 3)
    assert [(i, expected[i, j]) for i in range(len(points)) for j in range(3)] == [(r[0], r[1]) for r in sorted(whole, key=lambda r: (r[0], r[3]))]


def test_no_points(spark):
    assert nearest_neighbors(spark.createDataFrame([], "id long, v array<double>"), 2).count() == 0


def test_fewer_points_than_neighbors(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<double>")
    assert sorted((r.id, r.neighbor) for r in nearest_neighbors(df, 5).collect()) == [(1, 2), (2, 1)]


def labelled(spark, points, labels):
    rows = [(f"r{i:04d}", *[float(x) for x in p], int(y)) for i, (p, y) in enumerate(zip(points, labels))]
    return spark.createDataFrame(rows, "id string, a double, b double, c double, y int")


def test_links_with_copies(spark):
    """Two copies of opposite class are a link; a third copy and the neighbours are not."""
    points = [(0, 0, 0)] * 3 + [(1, 0, 0), (50, 0, 0), (51, 0, 0), (90, 0, 0), (90.5, 0, 0)]
    links = resample.tomek_links(labelled(spark, points, [0, 1, 0, 1, 0, 1, 1, 1]), NAMES, "y")
    assert sorted(r.id for r in links.collect()) == ["r0000", "r0001", "r0004", "r0005"]


def test_links_equal_brute_force(spark):
    points = cloud(2, 300, digits=2)
    labels = np.random.default_rng(2).integers(0, 2, len(points))
    nearest = brute_neighbors(points, 1)[:, 0]
    expected = [
        f"r{i:04d}" for i, j in enumerate(nearest) if nearest[j] == i and labels[i] != labels[j]
    ]
    links = resample.tomek_links(labelled(spark, points, labels), NAMES, "y", box_points=40)
    assert sorted(r.id for r in links.collect()) == expected


def test_oversampling(spark):
    points = np.vstack([cloud(3, 200), np.zeros((12, 3)), cloud(4, 20) + 5])
    labels = [0] * len(cloud(3, 200)) + [1] * 12 + [1] * len(cloud(4, 20))
    rows = labelled(spark, points, labels)
    made = resample.smote_oversample(rows, NAMES, "y").collect()
    counts = {y: sum(r.y == y for r in made) for y in (0, 1)}
    assert counts[0] == counts[1]
    minority = points[np.asarray(labels) == 1]
    for r in made:
        if r.synthetic:
            base = points[int(r.id.split("#")[0][1:])]
            assert base in minority
            line = np.asarray(r.v) - base
            span = minority - base
            on = [np.allclose(line, s * (line @ s) / (s @ s), atol=1e-9) and -1e-9 <= line @ s / (s @ s) <= 1 for s in span if s @ s > 0]
            assert np.allclose(line, 0) or any(on)
    again = resample.smote_oversample(rows, NAMES, "y").collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, made), key=str)


def test_resampling_balances_and_keeps_types(spark):
    n = 240
    df = spark.range(n).select(
        F.concat(F.lit("k"), "id").alias("id"),
        *[(F.rand(i) * 10).cast("long" if f.startswith("count") else "double").alias(f) for i, f in enumerate(FEATURES)],
        (F.col("id") % 6 == 0).cast("int").alias(TARGET),
    )
    out = resample.resample(df)
    assert dict(out.dtypes)["count_susulan_1jam"] == "bigint"
    counts = {r[0]: r[1] for r in out.groupBy(TARGET).count().collect()}
    assert counts[0] == counts[1] <= n * 5 // 6
    assert 0.10 < counts[1] / sum(counts.values()) < 0.90


def test_one_class_is_an_error(spark):
    with pytest.raises(ValueError):
        resample.smote_oversample(labelled(spark, [(0, 0, 0)], [1]), NAMES, "y")


def test_one_class_may_stay_as_it_is(spark, tmp_path):
    """Strong events everywhere: all isolated mainshocks have a strong aftershock, and the query's SQL adds nothing."""
    rows = labelled(spark, [(0, 0, 0), (1, 0, 0)], [1, 1])
    kept = resample.smote_oversample(rows, NAMES, "y", one_class=True).collect()
    assert sorted((r.id, r.v, r.y, r.synthetic) for r in kept) == [("r0000", [0.0] * 3, 1, False), ("r0001", [1.0, 0.0, 0.0], 1, False)]
    assert resample.smote_oversample(rows.limit(0), NAMES, "y", one_class=True).isEmpty()
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    events = [(n, start + dt.timedelta(minutes=n), 1, "x", 300.0) for n in range(40)]
    spark.createDataFrame(events, EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    made = QUERIES["smote_oversample"](spark, str(tmp_path))
    assert made.count() > 0 and compare(made, con, ORACLES["smote_oversample"]) is None


def test_splits_keep_rows_without_time_or_label(spark):
    rows = [(f"m{n}", None if n % 4 == 0 else dt.datetime(2024, 1, 1 + n), 1, None if n % 4 == 1 else n % 2) for n in range(20)]
    df = spark.createDataFrame(rows, "mainshock_id string, mainshock_time timestamp, snapshot_hours int, y int")
    timed = split.time_split(df).collect()
    assert len(timed) == 20 and {r.part for r in timed if r.mainshock_time is None} == {"test"}
    assert split.stratified_split(df, ["mainshock_id"], label="y").count() == 20
