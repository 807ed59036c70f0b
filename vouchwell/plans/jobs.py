"""End-to-end jobs over invoice and vendor tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchwell.functions.scalar import round_half_up
from vouchwell.operators import (
    autoencoder,
    benford,
    duplicates,
    encode,
    evaluate,
    features,
    history,
    iforest,
    inject,
    lof,
    shell_vendor,
    staging,
    sweep,
    threshold,
    vote,
    wide_autoencoder,
)
from vouchwell.sources import files
from vouchwell.sources.narrow import NarrowInvoices
from vouchwell.storage import materialize


def feature_mart(
    invoices: DataFrame | NarrowInvoices, vendors: DataFrame, max_group_rows: int = history.MAX_GROUP_ROWS
) -> DataFrame:
    """Narrow rows travel to their vendor as they are; their columns are made there."""
    if not isinstance(invoices, NarrowInvoices):
        return features.invoice_features(staging.stg_invoices(invoices, vendors), max_group_rows)
    counts = history.vendor_counts(staging.stg_invoices(invoices.whole(), vendors))
    dealt = history.dealt(invoices, counts, max_group_rows)
    return features.invoice_features(staging.stg_invoices(dealt, vendors), max_group_rows, counts)


def save_mart(invoices: DataFrame, vendors: DataFrame, table: str = "invoice_features") -> None:
    """Raw and staging layers as views, the mart as a table."""
    staging.register_views(invoices, vendors)
    feature_mart(invoices, vendors).write.mode("overwrite").saveAsTable(table)


def rule_vote(invoices: DataFrame, vendors: DataFrame, flag_side: str = "first") -> DataFrame:
    """All four rules and their vote.

    The columns that the rules read are written first, so the source is read once; the
    vendor-level flags and the similar descriptions are written before this returns, too.
    """
    return _written_vote(materialize(invoices.select(*RULE_COLUMNS), "rule_columns", large=True), vendors, flag_side)


def _written_vote(invoices: DataFrame, vendors: DataFrame, flag_side: str) -> DataFrame:
    return vote.vote(
        invoices,
        benford.benford_rule(invoices),
        threshold.threshold_rule(invoices),
        duplicates.duplicate_flags(invoices, flag_side=flag_side, written=True),
        shell_vendor.shell_vendor_rule(vendors),
    )


def evaluated_vote(
    invoices: DataFrame, vendors: DataFrame, flag_side: str = "first", **injection
) -> DataFrame:
    """Inject labelled near-duplicates, vote on everything, attach the labels.

    The columns that the rules read are written before the injection, so the source is read once.
    """
    invoices = materialize(invoices.select(*RULE_COLUMNS), "rule_columns", large=True)
    augmented, labels = inject.inject_duplicates(invoices, **injection)
    return evaluate.with_labels(_written_vote(augmented, vendors, flag_side), labels)


def save_injection(invoices: DataFrame, folder: str, **injection) -> None:
    """The augmented invoices and the labels of the copies, as CSV."""
    augmented, labels = inject.inject_duplicates(invoices, **injection)
    files.write_csv(augmented, f"{folder}/invoices")
    files.write_csv(labels, f"{folder}/fraud_labels")


RULE_COLUMNS = ["invoice_id", "vendor_id", "invoice_date", "amount", "description"]
RULE_TABLES = ["benford_results", "threshold_results", "duplicate_results", "shell_vendor_results"]


def save_rule_results(invoices: DataFrame, vendors: DataFrame, folder: str) -> DataFrame:
    """One table per rule; the duplicate table is the pair report.

    Returns the columns that the rules read, which are written first. Only the threshold table,
    which has all columns of its few candidates, goes back to the source.
    """
    columns = materialize(invoices.select(*RULE_COLUMNS), "rule_columns", large=True)
    results = [
        benford.benford_rule(columns),
        threshold.threshold_rule(invoices),
        duplicates.duplicate_pairs(columns, written=True).drop("amount_gap"),
        shell_vendor.shell_vendor_rule(vendors),
    ]
    for name, result in zip(RULE_TABLES, results):
        files.write_table(result, f"{folder}/{name}")
    return columns


def vote_from_results(spark: SparkSession, invoices: DataFrame, folder: str) -> DataFrame:
    """The vote over saved rule tables."""
    return vote.vote(invoices, *[files.read_table(spark, f"{folder}/{name}") for name in RULE_TABLES])


@dataclass
class Prepared:
    """The encoded view of a written mart, and the encoder fitted on it."""

    encoded: DataFrame
    encoder: encode.Encoder


def prepared(
    invoices: DataFrame | NarrowInvoices,
    vendors: DataFrame,
    feature_set: str = "reference",
    digits: int | None = None,
    metadata: bool = True,
    numbers: bool = True,
    categories: bool = True,
) -> Prepared:
    """``digits`` rounds the scaled numbers, so that summation order cannot move a row over a cut.

    Without the descriptive columns, the numbers or the categories the mart is as much narrower.
    """
    mart = feature_mart(invoices, vendors)
    if not (metadata and numbers and categories):
        numeric, categorical = encode.feature_types(mart, feature_set)
        about = encode.METADATA_COLUMNS if metadata else ["invoice_id"]
        mart = mart.select(*about, *(numeric if numbers else []), *(categorical if categories else []))
    mart = materialize(mart, "invoice_features", large=True)
    encoder = encode.fit_encoder(mart, feature_set)
    encoded = encoder.transform(mart)
    if digits is not None:
        encoded = encoded.withColumns({c: round_half_up(F.col(c), digits) for c in encoder.numeric})
    return Prepared(encoded, encoder)


def isolation_forest(data: Prepared) -> DataFrame:
    """With the descriptive columns that the prepared view has."""
    return iforest.predictions(data.encoded, iforest.fit_forest(data.encoded, data.encoder))


def forest_sweep(invoices: DataFrame, vendors: DataFrame, injection: dict | None = None, digits: int | None = None, **grid) -> DataFrame:
    """Forest settings ranked by how well they find injected near-duplicates; ``grid`` as in ``sweep.sweep``."""
    augmented, labels = inject.inject_duplicates(invoices, **(injection or {}))
    data = prepared(augmented, vendors, digits=digits, metadata=False)
    return sweep.sweep(data.encoded, data.encoder, labels, **grid)


def local_outlier_factor(data: Prepared) -> DataFrame:
    return lof.predictions(data.encoded, data.encoder)


def trained_autoencoder(data: Prepared) -> tuple[DataFrame, autoencoder.Autoencoder]:
    vectorizer = encode.fit_vectorizer(data.encoded, data.encoder)
    rows, width = autoencoder.inputs(data.encoded, data.encoder, vectorizer)
    rows = materialize(rows, "autoencoder_inputs", large=True)
    return rows, autoencoder.train(autoencoder.sharded(rows), width)


def autoencoder_predictions(data: Prepared) -> tuple[DataFrame, float]:
    rows, model = trained_autoencoder(data)
    return autoencoder.predictions(rows, model)


def wide_autoencoder_predictions(data: Prepared, epochs: int = autoencoder.EPOCHS) -> tuple[DataFrame, float]:
    """As ``autoencoder_predictions``, for any number of categories."""
    shards = wide_autoencoder.packed(wide_autoencoder.keyed(data.encoded, data.encoder))
    model = wide_autoencoder.train(shards, len(data.encoder.numeric), epochs)
    about = data.encoded.select(*encode.METADATA_COLUMNS, F.col("invoice_amount").alias("amount"))
    scored = about.join(wide_autoencoder.errors(shards, model), "invoice_id")
    return autoencoder.labelled_errors(materialize(scored, "reconstruction_errors", large=True))


def save_autoencoder_results(data: Prepared, folder: str) -> None:
    """Predictions with their errors, the threshold, and the training history."""
    rows, model = trained_autoencoder(data)
    predicted, limit = autoencoder.predictions(rows, model)
    spark = rows.sparkSession
    save_threshold(predicted, limit, folder)
    files.write_table(model.history(spark), f"{folder}/training_history")


def save_threshold(predicted: DataFrame, limit: float, folder: str) -> None:
    """Predictions with their errors, and the threshold that labelled them."""
    files.write_table(predicted, f"{folder}/autoencoder_predictions")
    files.write_table(predicted.sparkSession.createDataFrame([(limit,)], "threshold double"), f"{folder}/threshold")
