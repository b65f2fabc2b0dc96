import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.operators import drift
from tremorlake.operators.dedup import dedup_source_priority
from tremorlake.operators.merge import merge_days
from tremorlake.plans import drift_counts
from tremorlake.schema import RAW_TYPED
from tremorlake.sources import daily

END = dt.datetime(2024, 6, 1)
SCHEMA = "time_utc timestamp, magnitude double, depth_km double, latitude double, longitude double"


def events(spark, reference, recent):
    rows = [(END - dt.timedelta(days=20), float(m), 10.0, 0.0, 100.0) for m in reference]
    rows += [(END - dt.timedelta(days=1), float(m), 10.0, 0.0, 100.0) for m in recent]
    rows[-1] = (END, *rows[-1][1:])
    return spark.createDataFrame(rows, SCHEMA)


def numpy_psi(reference, current):
    edges = np.quantile(reference, np.linspace(0, 1, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    shares = []
    for side in (reference, current):
        counts = np.histogram(side, bins=edges)[0]
        share = counts / max(counts.sum(), 1)
        shares.append(np.where(share == 0, 1e-6, share))
    r, c = shares
    return float(np.sum((c - r) * np.log(c / r)))


@pytest.mark.parametrize("digits", [1, 4])
def test_index_equals_numpy(spark, digits):
    rng = np.random.default_rng(digits)
    reference = np.round(rng.normal(4.5, 0.4, 400), digits)
    recent = np.round(rng.normal(4.7, 0.5, 120), digits)
    row = drift.drift_quick_check(events(spark, reference, recent)).first()
    assert (row.status, row.n_reference, row.n_recent) == ("ok", 400, 120)
    assert math.isclose(row.psi_magnitude, numpy_psi(reference, recent), abs_tol=1e-9)
    assert row.should_retrain == (row.psi_magnitude >= 0.1)


@pytest.mark.parametrize("n_reference, n_recent", [(49, 20), (60, 9), (0, 20)])
def test_too_few_rows(spark, n_reference, n_recent):
    row = drift.drift_quick_check(events(spark, [4.0] * n_reference, [4.0] * n_recent)).first()
    assert (row.status, row.psi_magnitude, row.should_retrain) == ("insufficient_data", None, False)


def test_enough_rows_exactly(spark):
    row = drift.drift_quick_check(events(spark, [4.0, 5.0] * 25, [4.0, 5.0] * 5)).first()
    assert row.status == "ok" and math.isclose(row.psi_magnitude, 0.0, abs_tol=1e-12)


def test_bands(spark):
    values = spark.createDataFrame([(0.0,), (0.1,), (0.2499,), (0.25,)], "p double")
    bands = [r[0] for r in values.select(drift.psi_band(F.col("p"))).collect()]
    assert bands == ["stable", "moderate", "moderate", "critical"]


def test_old_rows_are_outside_the_quick_check(spark):
    old = spark.createDataFrame([(END - dt.timedelta(days=38), 9.0, 1.0, 0.0, 100.0)], SCHEMA)
    df = events(spark, [4.0] * 60, [4.0] * 20).unionByName(old)
    assert drift.drift_quick_check(df).first().n_reference == 60


def test_report(spark):
    rng = np.random.default_rng(3)
    reference, recent = np.round(rng.normal(4, 0.5, 300), 2), np.round(rng.normal(5, 0.5, 80), 2)
    df = events(spark, reference, recent)
    hole = df.limit(1).withColumn("depth_km", F.lit(None).cast("double"))
    rows = {r.feature: r for r in drift.drift_report(df.unionByName(hole)).collect()}
    assert set(rows) == {"magnitude", "depth_km", "latitude", "longitude"}
    m = rows["magnitude"]
    grid = np.unique(np.concatenate([reference, recent]))
    f1 = np.searchsorted(np.sort(reference), grid, "right") / len(reference)
    f2 = np.searchsorted(np.sort(recent), grid, "right") / len(recent)
    assert math.isclose(m.ks, np.max(np.abs(f1 - f2)), abs_tol=1e-12)
    area = np.sum(np.abs(f1 - f2)[:-1] * np.diff(grid))
    assert math.isclose(m.wasserstein_normed, area / reference.std(), rel_tol=1e-9)
    assert m.drifted and not rows["depth_km"].drifted
    assert m.n_reference == 300 and m.drift_share == 0.25 and not m.dataset_drift


def test_index_of_any_column_and_both_verdicts(spark):
    df = events(spark, [4.0, 5.0, 6.0] * 40, [5.0, 6.0, 7.0] * 20).withColumn("other", F.col("magnitude") * 1000 - 7)
    late = F.col("time_utc") >= F.lit(END) - F.expr("interval 7 days")
    one, other = (drift.psi(df, c, ~late, late).first().psi for c in ("magnitude", "other"))
    assert math.isclose(one, other, rel_tol=1e-9) and one > 0
    rows = {r.feature: r for r in drift.drift_report(df, "ks").collect()}
    assert rows["magnitude"].ks_drifted == rows["magnitude"].drifted and rows["magnitude"].distance_drifted
    with pytest.raises(ValueError):
        drift.drift_report(df, "guess")


def test_a_side_without_rows_has_a_status(spark):
    df = events(spark, [], [4.0, 5.0] * 20)
    rows = drift.drift_report(df).collect()
    assert {r.feature for r in rows} == {"magnitude", "depth_km", "latitude", "longitude"}
    assert {(r.status, r.n_reference, r.ks, r.psi, r.drifted, r.dataset_drift) for r in rows} == {("insufficient_data", 0, None, None, None, None)}
    assert {r.n_current for r in rows} == {40}
    early = F.col("time_utc") < F.lit("1999-01-01").cast("timestamp")
    for one, other in ((early, ~early), (~early, early)):
        assert [tuple(r) for r in drift.psi(df, "magnitude", one, other).collect()] == [("magnitude", None, None)]


def _event_rows(spark, seed, first_day, n):
    """Events over twenty days with gaps, repeated values and missing cells, one of them the newest."""
    rng = np.random.default_rng(seed)
    hole = lambda x: None if rng.random() < 0.1 else (float("nan") if rng.random() < 0.05 else x)
    rows = []
    for i in range(n):
        time = dt.datetime(2024, 3, 1) + dt.timedelta(days=first_day, microseconds=int(rng.integers(0, 20 * 86400 * 10**6)))
        rows.append((f"{seed}-{i % (n - 9)}", "BMKG", time, *[hole(round(float(x), 1)) for x in rng.normal([0, 100, 30, 4.5], 1)]))
    rows.append((f"{seed}-last", "USGS", dt.datetime(2024, 3, 21, 15, 30) + dt.timedelta(days=first_day), 0.0, 100.0, 5.0, None))
    df = spark.createDataFrame(rows, "event_id string, source string, time_utc timestamp, latitude double, longitude double, depth_km double, magnitude double")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_TYPED])


def _close(kept, scanned):
    rows = [sorted(df.collect(), key=str) for df in (kept, scanned)]
    assert len(rows[0]) == len(rows[1])
    for one, other in zip(*rows):
        for a, b in zip(one, other):
            assert math.isclose(a, b, abs_tol=1e-9) if isinstance(a, float) else a == b


def test_kept_counts_equal_the_full_scan(spark, tmp_path):
    """After each merge, late and repeated events among them, both checks are as from all events; one day at least is empty."""
    at, counts = str(tmp_path / "events"), str(tmp_path / "counts")
    none = daily.read_days(spark, at, RAW_TYPED)
    drift_counts.refresh_counts(spark, at, RAW_TYPED, counts)
    assert drift_counts.drift_quick_check(spark, counts, none).first().status == "insufficient_data"
    for turn, (first_day, n) in enumerate([(0, 250), (25, 250), (10, 90)]):
        merge_days(at, _event_rows(spark, turn, first_day, n), RAW_TYPED, dedup_source_priority)
        drift_counts.refresh_counts(spark, at, RAW_TYPED, counts)
        events = daily.read_days(spark, at, RAW_TYPED)
        _close(drift_counts.drift_quick_check(spark, counts, events), drift.drift_quick_check(events))
        _close(drift_counts.drift_report(spark, counts, events), drift.drift_report(events))
    before = daily.read_log(spark, counts).count()
    drift_counts.refresh_counts(spark, at, RAW_TYPED, counts)
    assert daily.read_log(spark, counts).count() == before
