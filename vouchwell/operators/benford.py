"""Leading-digit rule: vendors whose digit shares sit far from the expected ones."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.functions.scalar import flag, leading_digit, round_half_up

# Expected share of each leading digit.
EXPECTED_SHARE = {1: 0.301, 2: 0.176, 3: 0.125, 4: 0.097, 5: 0.079, 6: 0.067, 7: 0.058, 8: 0.051, 9: 0.046}
MIN_INVOICES = 30
FIXED_THRESHOLD = 2.0


def with_leading_digit(invoices: DataFrame) -> DataFrame:
    return invoices.withColumn("leading_digit", leading_digit(F.col("amount")))


def vendor_distribution(invoices: DataFrame, min_invoices: int = MIN_INVOICES) -> DataFrame:
    """Share of digits 1 to 9 per vendor with enough invoices.

    Digit 0 (amounts below 1) has no share of its own but counts in the denominator.
    """
    digit = F.col("leading_digit")
    shares = [F.avg((digit == k).cast("double")).alias(f"share_{k}") for k in EXPECTED_SHARE]
    return (
        with_leading_digit(invoices)
        .groupBy("vendor_id")
        .agg(F.count(F.lit(1)).alias("invoice_count"), *shares)
        .filter(F.col("vendor_id").isNotNull() & (F.col("invoice_count") >= min_invoices))
    )


def vendor_scores(distribution: DataFrame) -> DataFrame:
    """Squared distance of shares from expectation, each over its expected share."""
    terms = [(F.col(f"share_{k}") - e) * (F.col(f"share_{k}") - e) / e for k, e in EXPECTED_SHARE.items()]
    score = round_half_up(reduce(add, terms), 4)
    return distribution.select("vendor_id", "invoice_count", score.alias("chi_square_score"))


def score_threshold(scores: DataFrame) -> DataFrame:
    """One row: mean plus two sample standard deviations of the vendor scores."""
    score = F.col("chi_square_score")
    return scores.agg((F.avg(score) + 2 * F.stddev_samp(score)).alias("threshold"))


def with_flag(scores: DataFrame, mode: str = "mean_2std", fixed_threshold: float = FIXED_THRESHOLD) -> DataFrame:
    """Flag scores above the spread-based threshold, or above a fixed one."""
    if mode == "fixed":
        limit = F.lit(fixed_threshold)
    elif mode == "mean_2std":
        limit = score_threshold(scores).scalar()
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return scores.withColumn("benford_flag", flag(F.col("chi_square_score") > limit))


def benford_rule(invoices: DataFrame, min_invoices: int = MIN_INVOICES, mode: str = "mean_2std") -> DataFrame:
    return with_flag(vendor_scores(vendor_distribution(invoices, min_invoices)), mode)


def top_scores(scores: DataFrame, n: int = 5) -> DataFrame:
    return scores.orderBy(F.desc("chi_square_score"), "vendor_id").limit(n)
