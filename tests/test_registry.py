import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from tremorlake.operators import gates, registry

RUNS = "run_id string, run_name string, status string, pr_auc double, f1_score double, recall double"
DAY = dt.datetime(2026, 5, 1)


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [
            ("1", "a", "FINISHED", 0.4809, 0.3981, 0.5125),
            ("2", "b", "FINISHED", 0.4809, 0.2, 0.6),
            ("3", "c", "FAILED", 0.9, 0.9, 0.9),
            ("4", "d", "FINISHED", None, None, None),
            ("5", "e", "FINISHED", 0.35, 0.30, 0.40),
        ],
        RUNS,
    )


def by_run(df, *columns):
    return {r["run_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_best_runs(runs):
    assert [r.run_id for r in gates.top_runs(runs).collect()] == ["1", "2", "5", "4"]
    assert [r.run_id for r in gates.top_runs(runs, finished_only=False).collect()][0] == "3"
    assert gates.best_run(runs.filter("status = 'FINISHED'")).first().run_id == "1"
    assert gates.top_runs(runs, limit=2).count() == 2


def test_gates(runs):
    assert by_run(gates.gate_all(runs), "passed") == {"1": (True,), "2": (False,), "3": (True,), "4": (False,), "5": (True,)}
    two = by_run(gates.gate_two_of_three(runs), "n_passed", "passed")
    assert two == {"1": (3, True), "2": (2, True), "3": (3, True), "4": (0, False), "5": (1, False)}
    details = gates.gate_details(runs.filter("run_id = '4'")).collect()
    assert [(d.metric, d.actual, d.passed) for d in details] == [(m, 0.0, False) for m in ("pr_auc", "f1_score", "recall")]


def test_stages(spark):
    moves = [
        ("m", 1, "Staging", 0, False), ("m", 1, "Production", 1, False), ("m", 2, "Staging", 2, True),
        ("m", 3, "Staging", 3, True), ("m", 4, "Production", 4, False), ("n", 1, "Staging", 0, True),
    ]
    df = spark.createDataFrame(
        [(m, v, s, DAY + dt.timedelta(hours=h), a) for m, v, s, h, a in moves],
        "model_name string, version long, stage string, at timestamp, archive_existing boolean",
    )
    got = {(r.model_name, r.version): r.stage for r in registry.current_stage(df).collect()}
    assert got == {
        ("m", 1): "Production", ("m", 2): "Archived", ("m", 3): "Staging", ("m", 4): "Production", ("n", 1): "Staging",
    }


def test_promotion_and_summary(spark, runs):
    versions = spark.createDataFrame(
        [("m", 3, "5"), ("m", 1, "1"), ("m", 2, "2"), ("solo", 1, "4")], "model_name string, version long, run_id string"
    )
    promoted = registry.promote_first_two(versions)
    assert {(r.model_name, r.version): (r.stage, r.alias) for r in promoted.collect()} == {
        ("m", 1): ("Production", "champion"), ("m", 2): ("Staging", "challenger"),
    }
    chosen = registry.describe_production(promoted, runs).first()
    assert (chosen.version, chosen.run_id, chosen.pr_auc) == (1, "1", 0.4809)
    staged = versions.join(promoted.select("run_id", "stage"), "run_id", "left").na.fill("None", ["stage"])
    lowest = {r.model_name: r.version for r in registry.describe_production(staged.filter("stage != 'Production'"), runs).collect()}
    assert lowest == {"m": 2, "solo": 1}
    shown = registry.registry_summary(staged, runs, promoted.select("model_name", "version", "alias"))
    rows = {(r.model_name, r.version): (r.stage, r.alias, r.pr_auc) for r in shown.collect()}
    assert rows[("m", 1)] == ("Production", "champion", 0.4809)
    assert rows[("solo", 1)] == ("None", None, 0.0)


HISTORY = "model_name string, version long, stage string, promoted_at timestamp"


def test_history_keeps_the_newest(spark):
    old = spark.createDataFrame([("m", i, "Staging", DAY + dt.timedelta(hours=i)) for i in range(30)], HISTORY)
    new = spark.createDataFrame([("m", 99, "Staging", DAY + dt.timedelta(hours=99))], HISTORY)
    versions = [r.version for r in registry.history_keep_last(old, new).collect()]
    assert versions == [99, *range(29, 10, -1)]


def test_broken_history_counts_as_empty(spark, tmp_path):
    schema = T.StructType([T.StructField("model_name", T.StringType()), T.StructField("version", T.LongType())])
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps({"history": [{"model_name": "m", "version": 1}]}, indent=2))
    bad.write_text('{"history": [{"model_name": "m" "version": 1}]}')
    assert registry.read_history(spark, str(good), schema).count() == 1
    assert registry.read_history(spark, str(bad), schema).count() == 0
