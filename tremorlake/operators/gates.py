"""Run selection and promotion gates over the run table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Minimum metrics of the two gates.
CI_MINIMUM = {"pr_auc": 0.35, "f1_score": 0.30, "recall": 0.40}
PROMOTION_MINIMUM = {"pr_auc": 0.45, "f1_score": 0.35, "recall": 0.40}
# How many runs are looked at, and the state a finished run has.
TOP_RUNS = 10
FINISHED = "FINISHED"


def top_runs(runs: DataFrame, finished_only: bool = True, limit: int = TOP_RUNS) -> DataFrame:
    """The best runs by PR-AUC: a bounded top-k, runs without the metric last."""
    candidates = runs.filter(F.col("status") == FINISHED) if finished_only else runs
    return candidates.orderBy(F.col("pr_auc").desc_nulls_last(), "run_id").limit(limit)


def best_run(runs: DataFrame, order: str = "run_id") -> DataFrame:
    """The run with the highest PR-AUC, the first in ``order`` on ties."""
    return runs.orderBy(F.col("pr_auc").desc_nulls_last(), order).limit(1)


def _passes(minimum: dict[str, float]) -> dict[str, Column]:
    """One flag per metric; an unlogged metric counts as 0."""
    return {m: F.coalesce(F.col(m), F.lit(0.0)) >= bound for m, bound in minimum.items()}


def gate_all(runs: DataFrame, minimum: dict[str, float] = CI_MINIMUM) -> DataFrame:
    """Every metric must reach its minimum."""
    checks = _passes(minimum)
    verdict = F.lit(True)
    for passed in checks.values():
        verdict = verdict & passed
    return runs.withColumns({**{f"pass_{m}": c for m, c in checks.items()}, "passed": verdict})


def gate_details(runs: DataFrame, minimum: dict[str, float] = CI_MINIMUM) -> DataFrame:
    """One row per run and metric: what was reached, what was asked."""
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.coalesce(F.col(m), F.lit(0.0)).alias("actual"),
            F.lit(bound).alias("threshold"),
            (F.coalesce(F.col(m), F.lit(0.0)) >= bound).alias("passed"),
        )
        for m, bound in minimum.items()
    ]
    return runs.select("run_id", F.inline(F.array(*rows)))


def gate_two_of_three(runs: DataFrame, minimum: dict[str, float] = PROMOTION_MINIMUM) -> DataFrame:
    """PR-AUC must pass, and at least two of the three metrics."""
    checks = _passes(minimum)
    count = sum((c.cast("int") for c in checks.values()), F.lit(0))
    return runs.withColumns(
        {
            **{f"pass_{m}": c for m, c in checks.items()},
            "n_passed": count,
            "passed": checks["pr_auc"] & (count >= 2),
        }
    )
