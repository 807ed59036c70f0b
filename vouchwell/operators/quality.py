"""Whole-table checks, profiles and the line-item table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.operators.quantiles import exact_quantiles
from vouchwell.storage import materialize

CURRENCY = "INR"


def _long(row: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    entries = [F.struct(F.lit(n).alias(key), F.col(n).alias(value)) for n in names]
    return row.select(F.inline(F.array(*entries)))


def _fails(condition: Column) -> Column:
    """A missing value fails as well."""
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def dq_report(invoices: DataFrame) -> DataFrame:
    """(check, violations, passed) for the eight table checks, from one pass."""
    nulls = F.lit(0)
    for name in invoices.columns:
        nulls = nulls + F.col(name).isNull().cast("int")
    checks = {
        "unique_invoice_id": F.count("invoice_id") - F.count_distinct("invoice_id"),
        "no_missing_values": F.coalesce(F.sum(nulls), F.lit(0)),
        "positive_amount": _fails(F.col("amount") > 0),
        "positive_quantity": _fails(F.col("quantity") > 0),
        "positive_unit_price": _fails(F.col("unit_price") > 0),
        "payment_not_before_invoice": _fails(F.col("payment_date") >= F.col("invoice_date")),
        "due_not_before_invoice": _fails(F.col("due_date") >= F.col("invoice_date")),
        "single_currency": _fails(F.col("currency") == CURRENCY),
    }
    row = invoices.agg(*[c.cast("bigint").alias(name) for name, c in checks.items()])
    return _long(row, list(checks), "check", "violations").withColumn("passed", F.col("violations") == 0)


def numeric_profile(df: DataFrame, column: str = "amount") -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles.

    The column is written first: quantiles read it several times, the source is read once.
    """
    df = materialize(df.select(column), "profiled_column")
    quartile = exact_quantiles(df, [column], [0.25, 0.5, 0.75])
    c = F.col(column)
    return df.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    ).withColumns(
        {f"p{int(p * 100)}": F.lit(quartile[column, p]).cast("double") for p in (0.25, 0.5, 0.75)}
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(column).alias("column_name"), "value", "n")
    )


def dataset_summary(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Row counts and the invoice date range, in one row."""
    vendor_rows = vendors.agg(F.count(F.lit(1)).alias("n")).scalar()
    item_rows = line_items(invoices).agg(F.count(F.lit(1)).alias("n")).scalar()
    return invoices.agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
    ).select(
        vendor_rows.alias("total_vendors"),
        "total_invoices",
        item_rows.alias("total_line_items"),
        "first_date",
        "last_date",
    )


def null_profile(df: DataFrame, n: int = 10) -> DataFrame:
    """Columns with the most NULLs."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(row, df.columns, "column_name", "missing").orderBy(F.desc("missing"), "column_name").limit(n)


def line_items(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "invoice_id",
        F.lit(1).alias("line_number"),
        "description",
        "quantity",
        "unit_price",
        F.col("amount").alias("line_total"),
    )
