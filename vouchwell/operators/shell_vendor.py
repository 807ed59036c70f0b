"""Shared-account rule: vendors that pay into one bank account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.functions.scalar import flag

MIN_SHARED_VENDORS = 2


def account_counts(vendors: DataFrame) -> DataFrame:
    """Distinct vendors per account; vendors without an account are not counted."""
    return (
        vendors.filter(F.col("bank_account_id").isNotNull())
        .groupBy("bank_account_id")
        .agg(F.count_distinct("vendor_id").alias("vendor_count"))
    )


def shell_vendor_rule(vendors: DataFrame, min_shared_vendors: int = MIN_SHARED_VENDORS) -> DataFrame:
    return (
        vendors.join(account_counts(vendors), "bank_account_id", "left")
        .select(*vendors.columns, "vendor_count")
        .withColumn("shell_vendor_flag", flag(F.col("vendor_count") >= min_shared_vendors))
    )


def flagged_vendors(rule: DataFrame, n: int = 20) -> DataFrame:
    return rule.filter(F.col("shell_vendor_flag") == 1).orderBy("vendor_id").limit(n)
