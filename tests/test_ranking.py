import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.operators.ranking import (
    bucket_levels,
    exact_quantiles,
    rank_in_levels,
    running_before,
    value_counts,
)


def test_running_sums_over_levels(spark):
    rng = np.random.default_rng(1)
    values = sorted({float(v) for v in rng.uniform(-5, 15, 500)})
    df = spark.createDataFrame([("g", v, i % 7) for i, v in enumerate(values)], "g string, value double, n long")
    levelled = df.withColumns(bucket_levels(F.col("value"), 0.0, 10.0))
    rows = running_before(levelled, ["n"], ["value"], ["g"], ["coarse", "fine"]).orderBy("value").collect()
    before = 0
    for r in rows:
        assert r["n_before"] == before
        before += r["n"]


@pytest.mark.parametrize("n", [1, 2, 10, 997])
def test_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(5, 3, n), 2)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "magnitude double")
    counts = value_counts(df, ["magnitude"]).withColumns(bucket_levels(F.col("value"), 0.0, 10.0))
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["quantile_index"]: r["quantile"] for r in exact_quantiles(counts, "n", probabilities).collect()}
    assert np.allclose([got[i] for i in range(6)], np.quantile(values, probabilities), atol=1e-9)


def test_rank_is_a_permutation(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    levels = {"_a": F.floor(F.col("k") / 3), "_b": F.col("k")}
    rows = rank_in_levels(df, levels, [F.col("id")]).orderBy("k", "id").collect()
    assert [r["position"] for r in rows] == list(range(1, 1001))
    assert rows[0].__fields__ == ["id", "k", "position"]
