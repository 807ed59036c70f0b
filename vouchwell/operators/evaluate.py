"""Any detector's predictions against the fraud labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.functions.scalar import round_half_up
from vouchwell.storage import broadcast_if_small

NORMAL = "normal"


def with_labels(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Unlabelled invoices are normal. Where labels are few, the predictions stay where they are."""
    truth = broadcast_if_small(labels.select("invoice_id", "fraud_label", "fraud_type"))
    return predictions.join(truth, "invoice_id", "left").withColumns(
        {
            "fraud_label": F.coalesce("fraud_label", F.lit(0)),
            "fraud_type": F.coalesce("fraud_type", F.lit(NORMAL)),
        }
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def outcome_counts(evaluation: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row: true/false positives and negatives."""
    fraud, raised = F.col("fraud_label") == 1, F.col(prediction) == 1
    return evaluation.agg(
        F.count_if(fraud & raised).alias("tp"),
        F.count_if(~fraud & raised).alias("fp"),
        F.count_if(fraud & ~raised).alias("fn"),
        F.count_if(~fraud & ~raised).alias("tn"),
    )


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def metrics(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return counts.select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1_score"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """The counts with precision, recall and F1 beside them."""
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return counts.withColumns({"precision": precision, "recall": recall, "f1_score": _f1(precision, recall)})


def confusion_matrix(counts: DataFrame) -> DataFrame:
    def row(name, normal, fraud):
        return F.struct(F.lit(name).alias("actual"), F.col(normal).alias("pred_normal"), F.col(fraud).alias("pred_fraud"))

    return counts.select(F.inline(F.array(row("Actual Normal", "tn", "fp"), row("Actual Fraud", "fn", "tp"))))


def class_report(counts: DataFrame) -> DataFrame:
    """Per-class precision, recall, F1 and support, then accuracy and both averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p0, r0, p1, r1 = _ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    f0, f1 = _f1(p0, r0), _f1(p1, r1)
    s0, s1 = tn + fp, tp + fn
    total = s0 + s1

    def macro(a, b):
        return (a + b) / 2

    def weighted(a, b):
        return _ratio(a * s0 + b * s1, total)

    def row(name, precision, recall, f, support):
        return F.struct(
            F.lit(name).alias("label"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f.alias("f1_score"),
            support.alias("support"),
        )

    nothing = F.lit(None)
    return counts.select(
        F.inline(
            F.array(
                row("0", p0, r0, f0, s0),
                row("1", p1, r1, f1, s1),
                row("accuracy", nothing, nothing, _ratio(tp + tn, total), total),
                row("macro avg", macro(p0, p1), macro(r0, r1), macro(f0, f1), total),
                row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
            )
        )
    )


def recall_by_type(evaluation: DataFrame, prediction: str = "prediction") -> DataFrame:
    return (
        evaluation.filter(F.col("fraud_label") == 1)
        .groupBy("fraud_type")
        .agg(F.count("invoice_id").alias("total_fraud"), F.sum(prediction).alias("detected"))
        .withColumn("recall", round_half_up(F.col("detected") / F.col("total_fraud"), 3))
    )
