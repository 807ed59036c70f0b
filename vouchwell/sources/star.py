"""Invoices and vendors derived from star-schema sales tables.

One invoice per line item, one vendor per supplier. No join side is hinted: orders,
parts and suppliers all grow with the data, so sizes decide at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchwell.functions.scalar import money
from vouchwell.sources.narrow import NarrowInvoices
from vouchwell.storage import materialize

# The domains the adapter assigns by key.
TERMS = [15, 30, 45, 60]
CATEGORIES = [
    "Office Supplies",
    "IT Equipment",
    "Software",
    "Manufacturing",
    "Logistics",
    "Maintenance",
    "Consulting",
    "Furniture",
]
PAYMENT_METHODS = ["Bank Transfer", "NEFT", "RTGS", "IMPS"]
DEPARTMENTS = ["Finance", "IT", "Operations", "Manufacturing", "HR", "Procurement", "Marketing", "Administration"]


def _pick(values: list, key: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


def _padded(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded id that never truncates a longer number."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Shuffle a file with fewer splits than cores; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def vendors(spark: SparkSession, folder: str) -> DataFrame:
    supplier = load(spark, folder, "supplier")
    nation = load(spark, folder, "nation")
    region = load(spark, folder, "region")
    key = F.col("s_suppkey")
    account = key - F.when(key % 10 == 1, 1).otherwise(0)
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            _padded("V", key, 6).alias("vendor_id"),
            F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("vendor_name"),
            _pick(CATEGORIES, F.col("s_nationkey")).alias("vendor_category"),
            _padded("BANK", account, 6).alias("bank_account_id"),
            F.concat(F.lit(" "), "n_name", F.lit(", "), "r_name", F.lit(" ")).alias("vendor_address"),
            F.date_add(F.lit("1993-01-01").cast("date"), ((key * 37) % 700).cast("int")).alias("onboarding_date"),
            _pick(TERMS, key).alias("payment_terms"),
        )
    )


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    return _view(_with_vendor(_joined(spark, folder)))


def narrow_invoices(spark: SparkSession, folder: str) -> NarrowInvoices:
    """The same invoices, joined once and written before their columns are spelled out."""
    return NarrowInvoices(_with_vendor(materialize(_joined(spark, folder), "invoice_rows", large=True)), _view)


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    lines = _spread(load(spark, folder, "lineitem"), "l_orderkey")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = load(spark, folder, "part").select("p_partkey", "p_name")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount",
            F.col("l_shipdate").cast("date").alias("l_shipdate"), "o_custkey", "o_orderdate", "p_name",
        )
    )


def _with_vendor(joined: DataFrame) -> DataFrame:
    return joined.withColumn("vendor_id", _padded("V", F.col("l_suppkey"), 6))


def _view(rows: DataFrame) -> DataFrame:
    price, lineno = F.col("l_extendedprice"), F.col("l_linenumber")
    invoice_date = F.col("o_orderdate").cast("date")
    terms = _pick(TERMS, F.col("l_suppkey"))
    due = F.date_add(invoice_date, terms)
    delay = ((F.col("l_orderkey") + lineno) % 14 - 3).cast("int")
    seconds = (F.col("l_partkey") * 997 + lineno * 61) % 86400
    return rows.select(
        F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            lineno.cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.floor(price * 100 + 0.5).cast("bigint").cast("string"),
            F.col("l_shipdate").cast("string"),
        ).alias("invoice_id"),
        "vendor_id",
        invoice_date.alias("invoice_date"),
        F.timestamp_add("SECOND", seconds.cast("int"), F.col("o_orderdate")).alias("submission_timestamp"),
        F.date_add(due, delay).alias("payment_date"),
        due.alias("due_date"),
        price.alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money(price / F.col("l_quantity")).alias("unit_price"),
        F.lit("INR").alias("currency"),
        _padded("EMP", F.col("o_custkey") % 300 + 1, 4).alias("requester"),
        _padded("MGR", F.col("o_custkey") % 40 + 1, 3).alias("approver"),
        F.concat(F.lit("PO"), (100000 + F.col("l_orderkey") % 900000).cast("string")).alias("purchase_order_id"),
        F.concat(F.lit("CTR"), (10000 + F.col("l_partkey") % 90000).cast("string")).alias("contract_id"),
        terms.alias("payment_terms"),
        _pick(PAYMENT_METHODS, F.col("l_orderkey")).alias("payment_method"),
        F.lit("Paid").alias("invoice_status"),
        _pick(DEPARTMENTS, F.col("o_custkey")).alias("department"),
        F.col("p_name").alias("description"),
        money(price * F.col("l_tax")).alias("tax_amount"),
        money(price * F.col("l_discount")).alias("discount"),
    )
