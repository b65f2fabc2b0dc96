"""Exact classifier metrics from a scored table with a 0/1 label and a probability.

Counts at a threshold are conditional aggregates. Ranking metrics group by
score first and take their running sums over score levels, so neither equal
scores nor many scores gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.functions.catalogue import threshold_predict
from tremorlake.operators.ranking import bucket_levels, running_before
from tremorlake.schema import DECISION_THRESHOLD
from tremorlake.session import cut_lineage

# Class names in the report.
REPORT_NAMES = {0: "Tidak Ada Susulan (0)", 1: "Ada Susulan (1)"}


def _ratio(part: Column, whole: Column) -> Column:
    """A ratio that is 0 where it has no denominator."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2.0 * precision * recall, precision + recall)


def confusion_matrix(
    scored: DataFrame,
    threshold: float | Column = DECISION_THRESHOLD,
    groups: Sequence[str] = (),
    label: str = "y",
    probability: str = "proba",
) -> DataFrame:
    """True and false negatives and positives, per group if asked.

    A row without a label or a score belongs to none of the four, so it is an error, not left out.
    """
    positive = threshold_predict(F.col(probability), threshold) == 1
    actual = F.col(label) == 1
    unknown = F.count_if(F.col(label).isNull() | F.col(probability).isNull())
    failed = F.raise_error(F.concat(unknown.cast("string"), F.lit(" rows have no label or no score"))).cast("long")
    return scored.groupBy(*groups).agg(
        F.when(unknown > 0, failed).otherwise(F.count_if(~actual & ~positive)).alias("tn"),
        F.count_if(~actual & positive).alias("fp"),
        F.count_if(actual & ~positive).alias("fn"),
        F.count_if(actual & positive).alias("tp"),
    )


def rates(confusion: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion.withColumns(
        {
            "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
        }
    ).withColumn("f1_score", _ratio(2 * tp, 2 * tp + fp + fn))


def classification_metrics(scored: DataFrame, threshold: float = DECISION_THRESHOLD, **names) -> DataFrame:
    return rates(confusion_matrix(scored, threshold, **names)).select("f1_score", "recall")


def classification_report(scored: DataFrame, threshold: float = DECISION_THRESHOLD, **names) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""
    counts = confusion_matrix(scored, threshold, **names)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def class_row(name: str, hit: Column, claimed: Column, support: Column) -> dict[str, Column]:
        precision, recall = _ratio(hit, claimed), _ratio(hit, support)
        return {
            "row": F.lit(name),
            "precision": precision,
            "recall": recall,
            "f1_score": _f1(precision, recall),
            "support": support,
        }

    negative = class_row(REPORT_NAMES[0], tn, tn + fn, tn + fp)
    positive = class_row(REPORT_NAMES[1], tp, tp + fp, tp + fn)
    total = tn + fp + fn + tp
    scores = ("precision", "recall", "f1_score")
    accuracy = _ratio(tn + tp, total)
    macro = {c: (negative[c] + positive[c]) / 2.0 for c in scores}
    weighted = {
        c: _ratio(
            negative[c] * negative["support"] + positive[c] * positive["support"], total
        )
        for c in scores
    }
    rows = [
        negative,
        positive,
        {"row": F.lit("accuracy"), **{c: accuracy for c in scores}, "support": total},
        {"row": F.lit("macro avg"), **macro, "support": total},
        {"row": F.lit("weighted avg"), **weighted, "support": total},
    ]
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return counts.select(F.inline(F.array(*structs)))


def score_counts(
    scored: DataFrame, groups: Sequence[str] = (), label: str = "y", probability: str = "proba"
) -> DataFrame:
    """Positives and negatives per distinct score, with the levels that order them downward.

    The ranking metrics read the counts several times, so they are written once
    and the scored rows are scanned once.
    """
    by_score = scored.groupBy(*groups, F.col(probability).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) != 1).alias("negatives"),
    )
    descending = by_score.withColumn("descending", -F.col("score"))
    return cut_lineage(
        descending.withColumns(bucket_levels(F.col("descending"), -1.0, 0.0)), "score-counts"
    )


def average_precision(scored: DataFrame, groups: Sequence[str] = (), **names) -> DataFrame:
    """Step-wise area under precision and recall; tied scores move together."""
    return _average_precision(score_counts(scored, groups, **names), groups)


def _average_precision(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    ordered = running_before(
        counts, ["positives", "negatives"], ["descending"], groups, ["coarse", "fine"]
    )
    hits = F.col("positives_before") + F.col("positives")
    claimed = hits + F.col("negatives_before") + F.col("negatives")
    total = F.sum("positives")
    return ordered.groupBy(*groups).agg(
        _ratio(F.sum(F.col("positives") * (hits / claimed)), total).alias("average_precision")
    )


def roc_auc(scored: DataFrame, groups: Sequence[str] = (), **names) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    ordered = running_before(
        score_counts(scored, groups, **names), ["positives"], ["descending"], groups, ["coarse", "fine"]
    )
    # A negative is beaten by the positives scored above it.
    wins = F.sum(F.col("negatives") * (F.col("positives_before") + F.col("positives") / 2.0))
    pairs = F.sum("positives").cast("double") * F.sum("negatives")
    return ordered.groupBy(*groups).agg(F.try_divide(wins, pairs).alias("roc_auc"))


def three_metrics(
    scored: DataFrame, threshold: float = DECISION_THRESHOLD, groups: Sequence[str] = (), **names
) -> DataFrame:
    """The metrics a run is judged by: PR-AUC, F1 and recall."""
    counts = score_counts(scored, groups, **names)
    ranking = _average_precision(counts, groups).withColumnRenamed("average_precision", "pr_auc")
    claimed = threshold_predict(F.col("score"), threshold) == 1

    def rows(kind: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(kind))), F.lit(0))

    confusion = counts.groupBy(*groups).agg(
        rows("negatives", ~claimed).alias("tn"),
        rows("negatives", claimed).alias("fp"),
        rows("positives", ~claimed).alias("fn"),
        rows("positives", claimed).alias("tp"),
    )
    at_threshold = rates(confusion).select(*groups, "f1_score", "recall")
    if groups:
        return ranking.join(at_threshold, list(groups))
    both = at_threshold.select(F.struct("f1_score", "recall").alias("at"))
    return ranking.withColumn("at", both.scalar()).select("pr_auc", "at.f1_score", "at.recall")


def threshold_tradeoff(scored: DataFrame, thresholds: Sequence[float], **names) -> DataFrame:
    """The same scores judged at several thresholds in one pass."""
    at_each = scored.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    return rates(confusion_matrix(at_each, F.col("threshold"), ["threshold"], **names)).orderBy("threshold")


def class_weight(labelled: DataFrame, label: str = "y") -> DataFrame:
    """Negatives per positive: the weight that evens the classes out."""
    positive = F.count_if(F.col(label) == 1)
    negative = F.count_if(F.col(label) != 1)
    return labelled.agg(
        positive.alias("positives"),
        negative.alias("negatives"),
        F.try_divide(negative.cast("double"), positive).alias("scale_pos_weight"),
    )
