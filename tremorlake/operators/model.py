"""Boosted-tree models: configurations, the model as a table of nodes, scoring, importance."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.functions.catalogue import threshold_predict
from tremorlake.operators.boosting import grow_forests
from tremorlake.schema import DECISION_THRESHOLD, FEATURES, RECALL_THRESHOLD, SEED, TARGET

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class GbtParams:
    n_estimators: int = 200
    max_depth: int = 4
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.8
    min_child_weight: float = 5
    gamma: float = 0.5


@dataclass(frozen=True)
class Variation:
    run_name: str
    params: GbtParams
    threshold: float


# The three configurations that are compared.
LIGHT = GbtParams(
    n_estimators=100, max_depth=3, learning_rate=0.1, subsample=1.0, colsample=1.0,
    min_child_weight=1, gamma=0.0,
)
VARIATIONS = (
    Variation("run1_smote_light_n100_d3", LIGHT, DECISION_THRESHOLD),
    Variation("run2_smote_tuned_n200_d4", GbtParams(), DECISION_THRESHOLD),
    Variation("run3_smotetomek_thresh040", GbtParams(), RECALL_THRESHOLD),
)

# A model as a table: children of a node are 2 * node + 1, for values below the threshold, and 2 * node + 2.
MODEL = "tree int, node int, feature string, threshold double, missing_left boolean, value double, gain double, cover double"


@dataclass(frozen=True)
class BoostedTrees:
    """The nodes of all trees (columns of MODEL), the features in order, and the margin that trees add to."""

    nodes: pa.Table
    features: tuple[str, ...]
    base: float

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes).select(*[F.col(n.split()[0]).cast(n.split()[1]) for n in MODEL.split(", ")])

    def _arrays(self):
        """Per tree and heap place: number of the feature (-1 for a leaf), threshold, side of missing values, value."""
        column = {n: self.nodes.column(n).to_pylist() for n in ("tree", "node", "feature", "threshold", "missing_left", "value")}
        trees, size = max(column["tree"]) + 1, max(column["node"]) + 1
        number = {f: n for n, f in enumerate(self.features)}
        feature = np.full((trees, size), -1)
        threshold, left, value = np.zeros((trees, size)), np.zeros((trees, size), bool), np.zeros((trees, size))
        at = column["tree"], column["node"]
        feature[at] = [number.get(f, -1) for f in column["feature"]]
        threshold[at] = [t or 0.0 for t in column["threshold"]]
        left[at], value[at] = column["missing_left"], column["value"]
        return feature, threshold, left, value

    def margin(self, *values: Column) -> Column:
        """The sum of all trees for features in order; missing values go the way each node learnt."""
        feature, threshold, left, value = self._arrays()
        base = self.base

        @F.arrow_udf("double")
        def score(*columns: pa.Array) -> pa.Array:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns], 1)
            out, rows = np.full(len(x), base), np.arange(len(x))
            for f, t, m, v in zip(feature, threshold, left, value):
                node = np.zeros(len(x), np.int64)
                while (inner := f[node] >= 0).any():
                    at = x[rows, f[node]]
                    goes_left = np.where(np.isnan(at), m[node], at < t[node])
                    node = np.where(inner, 2 * node + 2 - goes_left, node)
                out += v[node]
            return pa.array(out)

        return score(*values)

    def sql(self) -> str:
        """The margin as an SQL expression over the features, for any engine; missing values are null."""
        feature, threshold, left, value = self._arrays()

        def number(x: float) -> str:
            """With an exponent, else engines would take it for a decimal."""
            text = repr(float(x))
            return "CAST('Infinity' AS DOUBLE)" if math.isinf(x) else text if "e" in text else f"{text}e0"

        def node(tree: int, at: int) -> str:
            if feature[tree, at] < 0:
                return number(value[tree, at])
            name, cut = self.features[feature[tree, at]], number(threshold[tree, at])
            test = f"coalesce({name} < {cut}, {'true' if left[tree, at] else 'false'})"
            return f"CASE WHEN {test} THEN {node(tree, 2 * at + 1)} ELSE {node(tree, 2 * at + 2)} END"

        return " + ".join([number(self.base), *(f"({node(n, 0)})" for n in range(len(feature)))])


def train_models(
    train: DataFrame,
    params: Sequence[GbtParams],
    features: Sequence[str] = FEATURES,
    label: str = TARGET,
    seed: int = SEED,
    **limits: int,
) -> list[BoostedTrees]:
    """Fit several configurations on one table, all grown together."""
    grown, base, edges = grow_forests(train, params, features, label, seed, **limits)
    names = [n.split()[0] for n in MODEL.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.bool_(), *[pa.float64()] * 3])))

    def named(row: dict) -> dict:
        """A node with the feature's name and the least value that goes right; beyond all edges only missing values do."""
        if row["feature"] < 0:
            return row | {"feature": None, "threshold": None}
        inner = edges[row["feature"]]
        cut = float(inner[row["cut"] - 1]) if row["cut"] <= len(inner) else math.inf
        return row | {"feature": features[row["feature"]], "threshold": cut}

    def model(number: int) -> BoostedTrees:
        mine = [{n: r[n] for n in names} for r in map(named, grown.to_pylist()) if r["model"] == number]
        return BoostedTrees(pa.Table.from_pylist(mine, schema), tuple(features), base)

    return [model(n) for n in range(len(params))]


def train_gbt(
    train: DataFrame,
    params: GbtParams = GbtParams(),
    features: Sequence[str] = FEATURES,
    label: str = TARGET,
    seed: int = SEED,
) -> BoostedTrees:
    """Fit boosted trees with logistic loss."""
    return train_models(train, [params], features, label, seed)[0]


def save_model(model: BoostedTrees, path: str, threshold: float, spark: SparkSession) -> None:
    """The nodes, and the threshold the model is to be used with."""
    model.table(spark).coalesce(1).write.parquet(f"{path}/nodes")
    facts = [(float(threshold), model.base, list(model.features))]
    spark.createDataFrame(facts, "threshold double, base double, features array<string>").coalesce(1).write.parquet(f"{path}/facts")


def load_model(path: str, spark: SparkSession) -> tuple[BoostedTrees, float]:
    facts = spark.read.parquet(f"{path}/facts").first()
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toArrow()
    return BoostedTrees(nodes, tuple(facts["features"]), facts["base"]), facts["threshold"]


def batch_score(
    model: BoostedTrees, rows: DataFrame, threshold: float = DECISION_THRESHOLD, label: str = TARGET
) -> DataFrame:
    """Probability of the positive class and the prediction at the threshold."""
    margin = model.margin(*[F.col(f).cast("double") for f in model.features])
    scored = rows.withColumn("_margin", margin).withColumn("proba", 1 / (1 + F.exp(-F.col("_margin")))).drop("_margin")
    named = scored.withColumn("y", F.col(label).cast("int")) if label in rows.columns else scored
    return named.withColumn("prediction", threshold_predict(F.col("proba"), threshold))


def feature_importance(model: BoostedTrees, spark: SparkSession) -> DataFrame:
    """Each feature's mean gain per split as a share of all features', largest first; 0 if it is never used."""
    gains = model.table(spark).filter(F.col("feature").isNotNull()).groupBy("feature").agg(F.avg("gain").alias("mean"))
    whole = gains.agg(F.sum("mean").alias("whole")).first()["whole"] or 1.0
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    share = F.coalesce(F.col("mean") / F.lit(whole), F.lit(0.0)).alias("importance")
    return names.join(gains, "feature", "left").select("feature", share).orderBy(F.col("importance").desc(), "feature")
