"""Quality measures of a binary classifier, computed where the predictions are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import safe_ratio
from ..operators.lookups import with_summary
from ..operators.ordered import running_totals
from ..operators.slicing import DEFAULT_POLICY, SlicePolicy


def confusion_counts(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: true/false negatives and positives."""

    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))

    return predictions.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def confusion_matrix(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count) with all four cells."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    entries = [
        F.struct(
            F.lit(a).cast("long").alias("label"), F.lit(p).cast("long").alias("prediction"), F.col(n).alias("count")
        )
        for a, p, n in cells
    ]
    return confusion_counts(predictions, label, prediction).select(F.inline(F.array(*entries)))


def roc_auc(
    predictions: DataFrame, label: str = "label", score: str = "probability", policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """One row: exact area under the ROC curve, ties sharing their rank.

    Equal scores are counted first; the running count of negatives below a score is sliced, so the global
    ranking is not done in one task.
    """
    positive = F.col(label) == 1
    per_score = (
        predictions.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("_score"))
        .agg(F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg"))
    )
    ranked = running_totals(
        per_score, [], ["_score"], {"_neg_upto": "_neg"}, {"_all_pos": "_pos", "_all_neg": "_neg"}, policy
    )
    wins = F.sum(F.col("_pos").cast("double") * (F.col("_neg_upto") - F.col("_neg") / 2))
    pairs = F.max("_all_pos").cast("double") * F.max("_all_neg")
    return ranked.agg(safe_ratio(wins, pairs).alias("roc_auc"))


def _precision_recall(tp: Column, predicted: Column, actual: Column) -> tuple[Column, Column, Column]:
    zero = F.lit(0.0)
    precision = F.coalesce(safe_ratio(tp, predicted), zero)
    recall = F.coalesce(safe_ratio(tp, actual), zero)
    f1 = F.coalesce(safe_ratio(2 * precision * recall, precision + recall), zero)
    return precision, recall, f1


def classification_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "probability"
) -> DataFrame:
    """One row: counts, positive rate, accuracy, precision, recall, F1 and AUC."""
    tn, fp, fn, tp = (F.col(n) for n in ("tn", "fp", "fn", "tp"))
    precision, recall, f1 = _precision_recall(tp, tp + fp, tp + fn)
    total = tn + fp + fn + tp
    counts = confusion_counts(predictions, label, prediction)
    return with_summary(
        counts.withColumns(
            {
                "samples": total,
                "positive_rate": safe_ratio(tp + fn, total),
                "accuracy": safe_ratio(tp + tn, total),
                "precision": precision,
                "recall": recall,
                "f1": f1,
            }
        ),
        roc_auc(predictions, label, score),
    )


def classification_report(
    predictions: DataFrame,
    names: tuple[str, str] = ("negative", "positive"),
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Per class, macro and weighted average: precision, recall, F1 and support."""
    tn, fp, fn, tp = (F.col(n) for n in ("tn", "fp", "fn", "tp"))
    negative = (*_precision_recall(tn, tn + fn, tn + fp), tn + fp)
    positive = (*_precision_recall(tp, tp + fp, tp + fn), tp + fn)
    support = negative[3] + positive[3]
    macro = [(a + b) / 2 for a, b in zip(negative[:3], positive[:3])]
    weighted = [
        F.coalesce(safe_ratio(a * negative[3] + b * positive[3], support), F.lit(0.0))
        for a, b in zip(negative[:3], positive[:3])
    ]
    rows = [
        (names[0], *negative),
        (names[1], *positive),
        ("macro avg", *macro, support),
        ("weighted avg", *weighted, support),
    ]
    entries = [
        F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            count.cast("long").alias("support"),
        )
        for name, precision, recall, f1, count in rows
    ]
    return confusion_counts(predictions, label, prediction).select(F.inline(F.array(*entries)))
