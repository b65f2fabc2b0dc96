import math

import numpy as np
import pytest
from brute import average_precision as brute_ap
from pyspark.sql import functions as F

from tremorlake.operators import metrics

SCORED = "y int, proba double"


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], SCORED)


@pytest.fixture(scope="module")
def golden(spark):
    """A published run: 346 / 85 / 39 / 41."""
    pairs = [(0, 0.1)] * 346 + [(0, 0.9)] * 85 + [(1, 0.1)] * 39 + [(1, 0.9)] * 41
    return scored(spark, pairs)


def test_published_run(golden):
    assert tuple(metrics.confusion_matrix(golden).first()) == (346, 85, 39, 41)
    f1, recall = metrics.classification_metrics(golden).first()
    assert (round(f1, 4), recall) == (0.3981, 0.5125)


def test_published_report(golden):
    rows = {r.row: tuple(round(v, 2) for v in r[1:4]) + (r.support,) for r in metrics.classification_report(golden).collect()}
    assert rows["Tidak Ada Susulan (0)"] == (0.90, 0.80, 0.85, 431)
    assert rows["Ada Susulan (1)"] == (0.33, 0.51, 0.40, 80)
    assert rows["accuracy"] == (0.76, 0.76, 0.76, 511)
    assert rows["macro avg"] == (0.61, 0.66, 0.62, 511)
    assert rows["weighted avg"] == (0.81, 0.76, 0.78, 511)


def test_nothing_predicted(spark):
    assert tuple(metrics.classification_metrics(scored(spark, [(0, 0.1), (0, 0.2)])).first()) == (0.0, 0.0)
    assert metrics.average_precision(scored(spark, [(0, 0.1)])).first()[0] == 0.0
    assert metrics.roc_auc(scored(spark, [(0, 0.1)])).first()[0] is None


def test_threshold_is_inclusive(spark):
    assert tuple(metrics.confusion_matrix(scored(spark, [(1, 0.45)])).first()) == (0, 0, 0, 1)


@pytest.mark.parametrize("digits", [1, 6])
def test_ranking_metrics_equal_brute_force(spark, digits):
    rng = np.random.default_rng(digits)
    p = np.round(rng.uniform(0, 1, 300), digits)
    y = (rng.uniform(0, 1, 300) < 0.2 + 0.4 * p).astype(int)
    df = scored(spark, zip(y, p))
    assert math.isclose(metrics.average_precision(df).first()[0], brute_ap(y, p), abs_tol=1e-12)
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert math.isclose(metrics.roc_auc(df).first()[0], auc, abs_tol=1e-12)


def test_grouped_metrics(spark):
    df = scored(spark, [(1, 0.9), (0, 0.1), (1, 0.2), (0, 0.8)]).withColumn("g", F.col("proba") > 0.85)
    rows = {r.g: r.average_precision for r in metrics.average_precision(df, ["g"]).collect()}
    assert rows == {True: 1.0, False: 0.5}
    assert metrics.three_metrics(df, 0.5, ["g"]).count() == 2


def test_tradeoff_and_weight(golden):
    rows = metrics.threshold_tradeoff(golden, [0.95, 0.05]).collect()
    assert [(r.threshold, r.recall) for r in rows] == [(0.05, 1.0), (0.95, 0.0)]
    assert round(metrics.class_weight(golden).first()["scale_pos_weight"], 4) == round(431 / 80, 4)


def test_rows_without_a_score_are_an_error(spark):
    for bad in ((1, None), (None, 0.5)):
        scored = spark.createDataFrame([(1, 0.9), (0, 0.2), bad], "y int, proba double")
        with pytest.raises(Exception, match="1 rows have no label or no score"):
            metrics.confusion_matrix(scored).collect()
