"""Near-duplicate invoices with labels, for testing detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vouchwell import schemas
from vouchwell.functions.scalar import money
from vouchwell.storage import materialize

FRAUD_TYPE = "Duplicate Invoice"


def sampled(invoices: DataFrame, n: int, seed: int) -> DataFrame:
    """A reproducible sample without replacement: the n smallest salted digests."""
    digest = F.md5(F.concat(F.col("invoice_id"), F.lit(f"|{seed}")))
    return invoices.withColumn("_digest", digest).orderBy("_digest", "invoice_id").limit(n)


def max_invoice_number(invoices: DataFrame) -> DataFrame:
    number = F.regexp_extract("invoice_id", r"(\d+)", 1).cast("bigint")
    return invoices.agg(F.max(number).alias("max_number"))


def _new_id(invoices: DataFrame, id_scheme: str) -> Column:
    if id_scheme == "prefix":
        return F.concat(F.lit("DUP-"), "invoice_id")
    if id_scheme == "sequence":
        # Numbers only the n sampled rows, in sample order.
        position = F.row_number().over(W.orderBy("_digest", "invoice_id"))
        number = max_invoice_number(invoices).scalar() + position
        return F.format_string("INV%06d", number)
    raise ValueError(f"unknown id_scheme {id_scheme!r}")


def inject_duplicates(
    invoices: DataFrame,
    n_duplicates: int = 100,
    amount_delta: float = 0.01,
    max_date_shift: int = 5,
    seed: int = 42,
    id_scheme: str = "sequence",
) -> tuple[DataFrame, DataFrame]:
    """Invoices plus shifted copies of a sample, and the labels of the copies.

    Invoices may come with some of their columns only; id, date and amount must be among them.
    """
    number = F.conv(F.substring(F.md5("invoice_id"), 1, 8), 16, 10).cast("bigint")
    shift = (F.lit(1) + number % max_date_shift).cast("int")
    amount = money(F.col("amount") + amount_delta)
    tax_rate = F.try_divide("tax_amount", "amount")
    changed = {
        "invoice_id": F.col("_new_id"),
        "invoice_date": F.date_add("invoice_date", F.col("_shift")),
        "due_date": F.date_add("due_date", F.col("_shift")),
        "payment_date": F.date_add("payment_date", F.col("_shift")),
        "submission_timestamp": F.col("submission_timestamp") + F.make_dt_interval(F.col("_shift")),
        "amount": amount,
        "tax_amount": money(amount * tax_rate),
        "unit_price": money(F.try_divide(amount, F.col("quantity"))),
    }
    # Written at once: behind further columns Spark would sort all invoices rather than keep the n smallest of each task.
    copies = (
        materialize(sampled(invoices, n_duplicates, seed), "sampled_invoices")
        .withColumns({"_source": F.col("invoice_id"), "_shift": shift, "_new_id": _new_id(invoices, id_scheme)})
        .withColumns({c: value for c, value in changed.items() if c in invoices.columns})
    )
    copies = materialize(copies.drop("_digest", "_new_id"), "injected_copies")
    parameters = F.to_json(
        F.struct(
            F.lit(amount_delta).alias("amount_delta"),
            F.col("_shift").alias("date_shift_days"),
            F.lit(True).alias("same_vendor"),
            F.lit(True).alias("same_description"),
        )
    )
    labels = copies.select(
        "invoice_id",
        F.lit(1).alias("fraud_label"),
        F.lit(FRAUD_TYPE).alias("fraud_type"),
        F.col("_source").alias("source_invoice"),
        parameters.alias("parameters"),
    )
    return invoices.unionByName(copies.drop("_source", "_shift")), labels


def label_parameters(labels: DataFrame) -> DataFrame:
    decoded = F.from_json("parameters", schemas.LABEL_PARAMETERS)
    return labels.withColumn("p", decoded).select("invoice_id", "source_invoice", "p.*")
