"""The invoice feature mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.functions.scalar import flag, sunday_based_weekday
from vouchwell.operators.history import MAX_GROUP_ROWS, with_history
from vouchwell.operators.staging import STAGED_COLUMNS

APPROVAL_THRESHOLD = 50000.0

HISTORY_COLUMNS = [
    "vendor_invoice_count",
    "vendor_avg_amount",
    "vendor_std_amount",
    "vendor_min_amount",
    "vendor_max_amount",
    "vendor_invoice_number",
    "previous_invoice_amount",
    "previous_invoice_date",
    "previous_payment_delay",
    "rolling_avg_amount",
    "rolling_std_amount",
    "rolling_total_amount",
    "rolling_avg_days_to_payment",
    "cumulative_vendor_spend",
    "bank_account_vendor_count",
]
FEATURE_COLUMNS = [
    *STAGED_COLUMNS,
    "days_to_payment",
    "days_past_due",
    "invoice_year",
    "invoice_month",
    "invoice_day",
    "invoice_weekday",
    "has_discount",
    "has_tax",
    *HISTORY_COLUMNS,
    "is_round_100",
    "is_round_1000",
    "days_since_previous_invoice",
    "vendor_amount_zscore",
    "amount_to_threshold_distance",
    "submission_hour",
    "submission_day_of_week",
]


def with_round_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"is_round_100": flag(F.col("amount") % 100 == 0), "is_round_1000": flag(F.col("amount") % 1000 == 0)}
    )


def with_derived(df: DataFrame) -> DataFrame:
    """Columns computed from history columns and the submission time."""
    spread = F.col("vendor_std_amount")
    return df.withColumns(
        {
            "days_since_previous_invoice": F.datediff("invoice_date", "previous_invoice_date").cast("bigint"),
            "vendor_amount_zscore": F.when(F.coalesce(spread, F.lit(0.0)) == 0, 0.0).otherwise(
                (F.col("amount") - F.col("vendor_avg_amount")) / spread
            ),
            "amount_to_threshold_distance": F.when(
                F.col("amount") <= APPROVAL_THRESHOLD, APPROVAL_THRESHOLD - F.col("amount")
            ),
            "submission_hour": F.hour("submission_timestamp").cast("bigint"),
            "submission_day_of_week": sunday_based_weekday(F.col("submission_timestamp")).cast("bigint"),
        }
    )


def invoice_features(
    staged: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, counts: DataFrame | None = None
) -> DataFrame:
    """``counts`` per vendor and account are made when they are not given."""
    history = with_history(staged, max_group_rows, counts)
    return with_derived(with_round_flags(history)).select(*FEATURE_COLUMNS)
