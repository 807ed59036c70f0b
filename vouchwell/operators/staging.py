"""Typed raw tables and the staging join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell import schemas
from vouchwell.functions.scalar import flag, sunday_based_weekday
from vouchwell.storage import broadcast_if_small

STAGED_COLUMNS = [
    "invoice_id",
    "vendor_id",
    "vendor_name",
    "vendor_category",
    "bank_account_id",
    "invoice_date",
    "submission_timestamp",
    "payment_date",
    "due_date",
    "amount",
    "quantity",
    "unit_price",
    "discount",
    "tax_amount",
    "currency",
    "payment_terms",
    "payment_method",
    "invoice_status",
    "department",
    "requester",
    "approver",
    "purchase_order_id",
    "contract_id",
    "description",
]


def _typed(df: DataFrame, schema) -> DataFrame:
    """Cast to the fixed schema; text that does not parse becomes NULL."""
    return df.select(
        *[
            F.col(f.name) if df.schema[f.name].dataType == f.dataType else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def raw_invoices(invoices: DataFrame) -> DataFrame:
    return _typed(invoices, schemas.INVOICES)


def raw_vendors(vendors: DataFrame) -> DataFrame:
    return _typed(vendors, schemas.VENDORS)


def stg_vendors(vendors: DataFrame) -> DataFrame:
    return raw_vendors(vendors).withColumns(
        {"vendor_name": F.trim("vendor_name"), "vendor_address": F.trim("vendor_address")}
    )


def stg_invoices(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Invoices with vendor attributes, day counts, calendar parts and flags."""
    attributes = stg_vendors(vendors).select("vendor_id", "vendor_name", "vendor_category", "bank_account_id")
    return (
        raw_invoices(invoices)
        .join(broadcast_if_small(attributes), "vendor_id", "left")
        .select(
            *STAGED_COLUMNS,
            F.datediff("payment_date", "invoice_date").cast("bigint").alias("days_to_payment"),
            F.datediff("payment_date", "due_date").cast("bigint").alias("days_past_due"),
            F.year("invoice_date").cast("bigint").alias("invoice_year"),
            F.month("invoice_date").cast("bigint").alias("invoice_month"),
            F.dayofmonth("invoice_date").cast("bigint").alias("invoice_day"),
            sunday_based_weekday(F.col("invoice_date")).cast("bigint").alias("invoice_weekday"),
            flag(F.col("discount") > 0).alias("has_discount"),
            flag(F.col("tax_amount") > 0).alias("has_tax"),
        )
    )


def register_views(invoices: DataFrame, vendors: DataFrame) -> None:
    """Raw and staging layers as temp views."""
    raw_invoices(invoices).createOrReplaceTempView("raw_invoices")
    raw_vendors(vendors).createOrReplaceTempView("raw_vendors")
    stg_vendors(vendors).createOrReplaceTempView("stg_vendors")
    stg_invoices(invoices, vendors).createOrReplaceTempView("stg_invoices")
