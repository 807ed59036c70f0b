"""Four-rule vote at invoice level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.storage import broadcast_if_small, materialize

FLAGS = ["threshold_flag", "duplicate_flag", "shell_vendor_flag", "benford_flag"]


def merge_flag(predictions: DataFrame, rule: DataFrame, key: str, flag: str) -> DataFrame:
    """Left join of a rule's raised flags; everything else is 0."""
    raised = rule.filter(F.col(flag) == 1).select(key, flag).distinct()
    return predictions.join(raised, key, "left").withColumn(flag, F.coalesce(flag, F.lit(0)))


def merge_vendor_flag(predictions: DataFrame, rule: DataFrame, flag: str) -> DataFrame:
    """Vendor-level flags: written first, so their size decides how they join."""
    raised = materialize(rule.filter(F.col(flag) == 1).select("vendor_id", flag).distinct(), flag)
    joined = predictions.join(broadcast_if_small(raised), "vendor_id", "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(0)))


def vote(
    invoices: DataFrame, benford: DataFrame, threshold: DataFrame, duplicates: DataFrame, shell_vendors: DataFrame
) -> DataFrame:
    """Flags of all four rules per invoice, and their OR."""
    predictions = invoices.select("invoice_id", "vendor_id")
    predictions = merge_vendor_flag(predictions, benford, "benford_flag")
    predictions = merge_vendor_flag(predictions, shell_vendors, "shell_vendor_flag")
    predictions = merge_flag(predictions, threshold, "invoice_id", "threshold_flag")
    predictions = merge_flag(predictions, duplicates, "invoice_id", "duplicate_flag")
    return predictions.select("invoice_id", "vendor_id", *FLAGS, F.greatest(*FLAGS).alias("final_prediction"))


def vote_summary(predictions: DataFrame) -> DataFrame:
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c.replace("flag", "flags")) for c in FLAGS]
    return predictions.agg(
        F.count(F.lit(1)).alias("total_invoices"),
        *totals,
        F.coalesce(F.sum("final_prediction"), F.lit(0)).alias("flagged_invoices"),
    )
