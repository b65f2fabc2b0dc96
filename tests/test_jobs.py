"""The whole path on driver data: landed feeds to drift check, through the command line."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tremorlake.__main__ import main
from tremorlake.checks import inputs
from tremorlake.operators import boosting, neighbors
from tremorlake.operators.model import GbtParams, Variation
from tremorlake.plans import jobs
from tremorlake.plans.features import build_feature_table
from tremorlake.plans.refresh import read_kept_features
from tremorlake.schema import CLEAN, FEATURE_TABLE
from tremorlake.sources import daily, sinks

SF_DIR = "/root/testdata/sf0.01"
SMALL = GbtParams(n_estimators=3, max_depth=2, subsample=1.0, colsample=1.0, min_child_weight=1, gamma=0.0)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    if not Path(SF_DIR).exists():
        pytest.skip("driver data is absent")
    base = tmp_path_factory.mktemp("jobs")
    inputs.geojson_documents(spark, SF_DIR).write.text(str(base / "geojson"))
    inputs.bulletin_documents(spark, SF_DIR).write.text(str(base / "bulletin"))
    return base


def test_whole_path(spark, folder, capsys):
    at = {n: str(folder / n) for n in ("raw", "none", "processed", "features", "runs", "models", "history")}
    feeds = ["--geojson", str(folder / "geojson"), "--latest-bulletin", str(folder / "bulletin")]
    assert main(["ingest", "--raw", at["raw"], *feeds, "--dry-run"]) == 0
    assert not Path(at["raw"]).exists()
    main(["ingest", "--raw", at["none"], "--geojson", str(folder / "geojson"), "--hours", "1"])
    assert not Path(at["none"]).exists()  # all landed events are older
    main(["ingest", "--raw", at["raw"], *feeds, "--run", "20240201_000000"])
    main(["ingest", "--raw", at["raw"], "--geojson", str(folder / "geojson"), "--run", "20240202_000000"])
    assert spark.read.parquet(at["raw"] + "/manifest").count() == 2

    main(["preprocess", "--raw", at["raw"], "--processed", at["processed"], "--all"])
    every = spark.read.parquet(at["processed"]).groupBy("snapshot").count().collect()
    assert len(every) == 2
    main(["preprocess", "--raw", at["raw"], "--processed", at["processed"]])
    again = spark.read.parquet(at["processed"]).groupBy("snapshot").count().collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, every))
    main(["preprocess", "--raw", at["raw"], "--processed", at["processed"], "--input", "gempa_20240201_000000.csv"])
    assert spark.read.parquet(at["processed"]).groupBy("snapshot").count().count() == 2
    events = jobs.read_processed(spark, at["processed"])
    assert events.count() == events.select("event_id").distinct().count()
    assert events.filter("event_id like 'us%'").count() == 10000 - len(range(0, 10000, 43))

    main(["features", "--processed", at["processed"], "--output", at["features"]])
    table = spark.read.parquet(at["features"])
    assert [f.name for f in table.schema] == FEATURE_TABLE.names and table.count() % 7 == 0

    one = (Variation("small", SMALL, 0.45),)
    assert jobs.train_job(spark, at["features"], at["runs"], at["models"], one).count() == 1
    assert main(["evaluate", "--runs", at["runs"]]) in (0, 1)
    assert main(["evaluate", "--runs", at["runs"], "--rule", "two-of-three"]) in (0, 1)
    nothing = ["--min-pr-auc", "0", "--min-f1-score", "0", "--min-recall", "0"]
    assert main(["evaluate", "--runs", at["runs"], *nothing]) == 0
    assert main(["evaluate", "--runs", at["runs"], *nothing[:-1], "1.1"]) == 1
    by_hand = ["--run-name", "mine", "--trees", "3", "--depth", "2", "--rate", "0.3", "--threshold", "0.3"]
    for _ in range(2):
        main(["train", "--features", at["features"], "--runs", at["runs"], "--models", at["models"], *by_hand, "--no-resampling", "--test-size", "0.5"])
    runs = jobs.read_runs(spark, at["runs"]).collect()
    assert len(runs) == len({r.run_id for r in runs}) == 3
    assert {r.run_id for r in runs} == {p.name for p in Path(at["models"]).iterdir()}
    assert {(r.params["n_estimators"], r.params["resampling"]) for r in runs if r.run_name == "mine"} == {("3", "none")}
    for version in (1, 2):
        main(["promote", "--history", at["history"], "--run-id", "0001", "--model-name", "m", "--version", str(version)])
    assert spark.read.parquet(at["history"]).count() == 2

    capsys.readouterr()
    main(["drift", "--processed", at["processed"]])
    assert "ok" in capsys.readouterr().out
    assert jobs.drift_job(spark, at["processed"], full=True).count() == 4


def test_refresh_follows_the_snapshots(spark, folder, capsys):
    """Snapshot after snapshot gives what the whole jobs give; a run that stopped after the events is finished."""
    at = {n: str(folder / f"refresh-{n}") for n in ("raw", "processed", "events", "features", "halted")}
    events = inputs.raw_events(spark, SF_DIR)
    n = F.col("feed_position")
    for k, part in enumerate((n % 3 == 0, n % 3 == 1, n % 5 < 2), start=1):
        sinks.sink_raw_snapshot(events.filter(part), at["raw"], f"2024020{k}_000000")
        main(["preprocess", "--raw", at["raw"], "--processed", at["processed"]])
        if k == 2:
            jobs.refresh_job(spark, at["processed"], at["events"], at["halted"])
        main(["refresh", "--processed", at["processed"], "--events", at["events"], "--kept-features", at["features"]])
        if k != 2:
            main(["drift", "--events", at["events"], "--counts", at["events"] + "-counts"])
            assert "ok" in capsys.readouterr().out
    jobs.refresh_job(spark, at["processed"], at["events"], at["halted"])
    expected = jobs.read_processed(spark, at["processed"])
    kept = daily.read_days(spark, at["events"], CLEAN).select(*CLEAN.names)
    assert kept.exceptAll(expected).isEmpty() and expected.exceptAll(kept).isEmpty()
    kept_check = jobs.kept_drift_job(spark, at["events"], at["events"] + "-counts").drop("psi_magnitude").collect()
    assert kept_check == jobs.drift_job(spark, at["processed"]).drop("psi_magnitude").collect()
    whole = build_feature_table(expected)
    for table in (at["features"], at["halted"]):
        features = read_kept_features(spark, table)
        assert features.exceptAll(whole).isEmpty() and whole.exceptAll(features).isEmpty()
        assert daily.last_mark(spark, table) == "gempa_20240203_000000.csv"


def test_evaluate_reads_the_best_run(spark, tmp_path):
    rows = [("1", "a", "FINISHED", 0.36, 0.31, 0.41, None), ("2", "b", "FAILED", 0.9, 0.9, 0.9, None)]
    runs = spark.createDataFrame(rows, "run_id string, run_name string, status string, pr_auc double, f1_score double, recall double, params map<string,string>")
    runs.write.parquet(str(tmp_path / "runs"))
    assert main(["evaluate", "--runs", str(tmp_path / "runs")]) == 0
    runs.filter(F.lit(False)).write.parquet(str(tmp_path / "none"))
    assert main(["evaluate", "--runs", str(tmp_path / "none")]) == 1


def test_no_feed_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.ingest_job(spark, str(tmp_path), "x")


def test_task_code_needs_no_package(tmp_path):
    """Executors without this package can load what the neighbour join sends them."""
    code = cloudpickle.dumps((neighbors._nearest, neighbors._long, boosting.Growth))
    load = "import pickle, sys; print(len(pickle.loads(sys.stdin.buffer.read())))"
    done = subprocess.run(
        [sys.executable, "-c", load], input=code, cwd=tmp_path, capture_output=True, env={"PATH": "/usr/bin:/bin"}, check=False
    )
    assert done.stdout.strip() == b"3", done.stderr
