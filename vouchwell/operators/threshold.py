"""Approval-threshold rule: repeated invoices just below the limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.functions.scalar import flag, quarter_label

APPROVAL_THRESHOLD = 50000.0
MARGIN = 0.02
MIN_INVOICES = 3


def near_threshold(invoices: DataFrame, threshold: float = APPROVAL_THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """Invoices in the band below the limit, with their distance and quarter."""
    amount = F.col("amount")
    return invoices.filter((amount >= threshold * (1 - margin)) & (amount < threshold)).withColumns(
        {"distance_from_threshold": threshold - amount, "quarter": quarter_label(F.col("invoice_date"))}
    )


def quarter_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("vendor_id", "quarter").agg(F.count(F.lit(1)).alias("vendor_threshold_count"))


def with_counts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts back on the candidates; undated rows form a quarter of their own.

    A join on pre-aggregated counts rather than a window, so a vendor-quarter holding
    most candidates can be split over tasks.
    """
    right = counts.select(
        F.col("vendor_id").alias("_vendor"), F.col("quarter").alias("_quarter"), "vendor_threshold_count"
    )
    same = F.col("vendor_id").eqNullSafe(F.col("_vendor")) & F.col("quarter").eqNullSafe(F.col("_quarter"))
    return candidates.join(right, same, "left").drop("_vendor", "_quarter")


def threshold_rule(
    invoices: DataFrame,
    threshold: float = APPROVAL_THRESHOLD,
    margin: float = MARGIN,
    min_invoices: int = MIN_INVOICES,
) -> DataFrame:
    candidates = near_threshold(invoices, threshold, margin)
    counted = with_counts(candidates, quarter_counts(candidates))
    return counted.withColumn("threshold_flag", flag(F.col("vendor_threshold_count") >= min_invoices))


def top_candidates(flagged: DataFrame, n: int = 10) -> DataFrame:
    return flagged.orderBy(F.desc("vendor_threshold_count"), "invoice_id").limit(n)
