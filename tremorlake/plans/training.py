"""Split, resample, train the configurations, score and compare them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.operators.metrics import three_metrics
from tremorlake.operators.model import VARIATIONS, BoostedTrees, GbtParams, Variation, batch_score, train_models
from tremorlake.operators.resample import keyed, resample
from tremorlake.operators.split import stratified_split, time_split
from tremorlake.schema import FEATURES, TARGET, TEST_SIZE
from tremorlake.session import cut_lineage

KEYS = ("mainshock_id", "snapshot_hours")


def prepare_train_test(features: DataFrame, test_size: float = TEST_SIZE) -> tuple[DataFrame, DataFrame]:
    """Time split, or a stratified one if rows carry no time. Written once, read as two parts."""
    absent = [c for c in (*FEATURES, TARGET) if c not in features.columns]
    if absent:
        raise ValueError(f"feature table lacks columns: {absent}")
    if "mainshock_time" in features.columns:
        parts = time_split(features, test_size)
    else:
        parts = stratified_split(features, [c for c in features.columns if c != TARGET], test_size)
    stored = cut_lineage(parts, "split")
    return (
        stored.filter("part = 'train'").drop("part"),
        stored.filter("part = 'test'").drop("part"),
    )


def resampled_train(train: DataFrame) -> DataFrame:
    """Balanced training rows; a lone class has nothing to be balanced with and is trained on as it is."""
    return cut_lineage(resample(keyed(train, KEYS), one_class=True), "train")


def run_variations(
    train: DataFrame,
    test: DataFrame,
    variations: Sequence[Variation] = VARIATIONS,
    balance: bool = True,
    batch: str | None = None,
) -> tuple[DataFrame, dict[GbtParams, BoostedTrees]]:
    """The run table, and the models by configuration.

    The training rows are resampled once (not at all unless ``balance``), all configurations are grown together,
    and those that differ only in their threshold share one model and one scored table. Run ids are ``batch``, a
    new one by default, and the variation's number.
    """
    balanced = resampled_train(train) if balance else train
    distinct = list(dict.fromkeys(v.params for v in variations))
    models = dict(zip(distinct, train_models(balanced, distinct)))
    scored = {p: cut_lineage(batch_score(m, test).select("y", "proba"), "scored") for p, m in models.items()}
    batch, runs = batch or uuid4().hex[:12], []
    for order, variation in enumerate(variations):
        resampling = "SMOTETomek" if balance else "none"
        logged = {**asdict(variation.params), "threshold": variation.threshold, "resampling": resampling}
        pairs = [F.lit(str(part)) for item in logged.items() for part in item]
        runs.append(
            three_metrics(scored[variation.params], variation.threshold).select(
                F.lit(f"{batch}-{order + 1:04d}").alias("run_id"),
                F.lit(variation.run_name).alias("run_name"),
                F.lit("FINISHED").alias("status"),
                "pr_auc",
                "f1_score",
                "recall",
                F.create_map(*pairs).alias("params"),
            )
        )
    return reduce(DataFrame.unionByName, runs), models
