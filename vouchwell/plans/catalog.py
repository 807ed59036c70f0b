"""Named queries over a star-schema folder."""

from __future__ import annotations

from collections.abc import Callable

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
    mart_store,
    quality,
    shell_vendor,
    staging,
    threshold,
    vote,
)
from vouchwell.plans import jobs
from vouchwell.sources import files, star
from vouchwell.sources.narrow import NarrowInvoices
from vouchwell.storage import materialize, run_folder

Query = Callable[[SparkSession, str], DataFrame]

# Digits kept of computed doubles, so that summation order cannot show.
DIGITS = {
    "vendor_avg_amount": 6,
    "vendor_std_amount": 4,
    "rolling_avg_amount": 4,
    "rolling_std_amount": 4,
    "rolling_total_amount": 2,
    "rolling_avg_days_to_payment": 4,
    "cumulative_vendor_spend": 2,
    "vendor_amount_zscore": 4,
    "amount_to_threshold_distance": 4,
}
SLICED_GROUP_ROWS = 100


def rounded(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    digits = DIGITS if digits is None else digits
    return df.withColumns({c: round_half_up(F.col(c), d) for c, d in digits.items() if c in df.columns})


def _invoices(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: query(star.invoices(spark, folder))


def _vendors(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: query(star.vendors(spark, folder))


def _both(query: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: query(star.invoices(spark, folder), star.vendors(spark, folder))


def _narrow(query: Callable[[NarrowInvoices, DataFrame], DataFrame]) -> Query:
    """For queries over many columns of the mart, or that read the invoices often."""
    return lambda spark, folder: query(star.narrow_invoices(spark, folder), star.vendors(spark, folder))


def _written(query: Callable[..., DataFrame]) -> Query:
    return _narrow(lambda invoices, vendors: query(invoices.whole(), vendors))


def _mart(*columns: str) -> Query:
    return _both(lambda i, v: rounded(jobs.feature_mart(i, v).select("invoice_id", *columns)))


def _sliced_history(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    mart = jobs.feature_mart(invoices, vendors, max_group_rows=SLICED_GROUP_ROWS)
    return rounded(mart.select("invoice_id", *features.HISTORY_COLUMNS))


def _round_flags(invoices: DataFrame) -> DataFrame:
    return features.with_round_flags(invoices).select("invoice_id", "is_round_100", "is_round_1000")


def _threshold_candidates(invoices: DataFrame) -> DataFrame:
    return rounded(
        threshold.near_threshold(invoices).select(
            "invoice_id", "vendor_id", "amount", "distance_from_threshold", "quarter"
        ),
        {"distance_from_threshold": 2},
    )


def _threshold_flags(invoices: DataFrame) -> DataFrame:
    return rounded(threshold.threshold_rule(invoices), {"distance_from_threshold": 2})


def _description_similarity(invoices: DataFrame) -> DataFrame:
    scored = duplicates.similar_texts(duplicates.distinct_descriptions(invoices), 70)
    return rounded(scored, {"similarity": 4})


def _pairs(invoices: DataFrame, **options) -> DataFrame:
    return rounded(duplicates.duplicate_pairs(invoices, **options), {"amount_gap": 2})


def _injected(part: int) -> Callable[[DataFrame], DataFrame]:
    return lambda invoices: inject.inject_duplicates(invoices, id_scheme="prefix")[part]


def _evaluated(invoices: DataFrame, vendors: DataFrame, side: str = "first") -> DataFrame:
    return jobs.evaluated_vote(invoices, vendors, side, id_scheme="prefix")


def _eval_counts(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    return evaluate.outcome_counts(_evaluated(invoices, vendors, "both"), "final_prediction")


# The source has no gaps, so some are cut into it by a digest of the id.
GAPS = {"amount": "0", "quantity": "1", "unit_price": "2", "payment_date": "3", "due_date": "4", "currency": "5"}


def _with_gaps(invoices: DataFrame) -> DataFrame:
    first = F.substring(F.md5("invoice_id"), 1, 1)
    return invoices.withColumns({c: F.when(first != digit, F.col(c)) for c, digit in GAPS.items()})


def _csv_invoices(invoices: DataFrame) -> DataFrame:
    """Written with its columns in another order and blanks around their names, read by name."""
    spark, path = invoices.sparkSession, run_folder(invoices.sparkSession, "csv_invoices")
    names = sorted(invoices.columns, reverse=True)
    files.write_csv(invoices.select(*[F.col(n).alias(f" {n} ") for n in names]), path)
    return files.read_invoices(spark, path)


def _csv_vendors(vendors: DataFrame) -> DataFrame:
    path = run_folder(vendors.sparkSession, "csv_vendors")
    one_line = files.with_one_line_addresses(vendors)
    files.write_csv(one_line.select(*reversed(vendors.columns)), path)
    return files.read_vendors(vendors.sparkSession, path)


def _csv_rule_table(invoices: DataFrame) -> DataFrame:
    path = run_folder(invoices.sparkSession, "csv_benford")
    flags = benford.benford_rule(invoices)
    files.write_csv(flags, path)
    return files.read_results(invoices.sparkSession, path, flags.schema)


def _saved_vote(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    folder = run_folder(invoices.sparkSession, "rule_results")
    columns = jobs.save_rule_results(invoices, vendors, folder)
    path = run_folder(invoices.sparkSession, "votes")
    files.write_table(jobs.vote_from_results(invoices.sparkSession, columns, folder), path)
    return files.read_table(invoices.sparkSession, path)


def _saved_injection(invoices: DataFrame) -> DataFrame:
    folder = run_folder(invoices.sparkSession, "injection")
    jobs.save_injection(invoices, folder, id_scheme="prefix")
    return files.read_labels(invoices.sparkSession, f"{folder}/fraud_labels")


def _mart_after_append(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """A sixteenth of the invoices of every fourth vendor are appended to a mart of the others."""
    staged = staging.stg_invoices(invoices, vendors)
    late = (F.substring(F.md5("invoice_id"), 1, 1) == "0") & (F.substring("vendor_id", -2, 2).cast("int") % 4 == 0)
    folder = run_folder(invoices.sparkSession, "mart_store")
    mart_store.create(staged.filter(~F.coalesce(late, F.lit(False))), folder)
    mart_store.append(staged.filter(late), folder)
    return rounded(mart_store.read(invoices.sparkSession, folder))


def _saved_matrix(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """The matrix, written and read: scaled numbers, and the names of the ones."""
    spark, folder = invoices.sparkSession, run_folder(invoices.sparkSession, "matrix")
    data = jobs.prepared(invoices, vendors)
    encode.save_matrix(folder, data.encoded, data.encoder)
    saved = encode.load_matrix(spark, folder)
    numeric, categorical = saved.encoder.numeric, saved.encoder.categorical
    names = F.concat_ws(",", *[F.concat(F.lit(f"categorical__{c}_"), F.col(c)) for c in categorical])
    return rounded(saved.encoded().select("invoice_id", *numeric, names.alias("ones")), dict.fromkeys(numeric, 4))


def _saved_predictions(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Predictions with their metadata, as CSV and back."""
    spark, path = invoices.sparkSession, run_folder(invoices.sparkSession, "predictions")
    predicted = _lowest_scores(invoices, vendors)
    files.write_csv(predicted, path)
    return files.read_results(spark, path, predicted.schema)


def _saved_evaluation(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    path = run_folder(invoices.sparkSession, "evaluation")
    judged = _evaluated(invoices, vendors)
    files.write_csv(judged, path)
    return files.read_results(invoices.sparkSession, path, judged.schema)


def _saved_threshold(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Errors and labels beside the threshold that gave them, from two saved tables."""
    spark, folder = invoices.sparkSession, run_folder(invoices.sparkSession, "threshold")
    labelled, limit = _zscore_labels(invoices, vendors)
    jobs.save_threshold(labelled, limit, folder)
    errors, limits = (files.read_table(spark, f"{folder}/{name}") for name in ("autoencoder_predictions", "threshold"))
    limit = limits.first()["threshold"]
    found = errors.select("invoice_id", "reconstruction_error", "prediction", F.lit(limit).alias("threshold"))
    return rounded(found, {"threshold": 6})


def _fixed_reconstruction(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Errors under a network of stated weights that was saved and loaded."""
    spark, path = invoices.sparkSession, run_folder(invoices.sparkSession, "autoencoder")
    data = _small(invoices, vendors)
    rows, width = autoencoder.inputs(data.encoded, data.encoder, encode.fit_vectorizer(data.encoded, data.encoder))
    network = autoencoder.Network(width)
    autoencoder.save_model(spark, autoencoder.Autoencoder(network, network.stated(), [(1, 0.0, 0.0)]), path)
    errors = autoencoder.with_errors(rows, autoencoder.load_model(spark, path))
    return rounded(errors.select("invoice_id", "reconstruction_error"), {"reconstruction_error": 6})


def _zscored(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Every invoice with the size of its z-score as the error that a detector would give."""
    mart = jobs.feature_mart(invoices, vendors)
    error = round_half_up(F.abs("vendor_amount_zscore"), 4)
    return materialize(mart.select(*encode.METADATA_COLUMNS, "amount", error.alias("reconstruction_error")), "zscores", large=True)


def _zscore_labels(invoices: DataFrame, vendors: DataFrame) -> tuple[DataFrame, float]:
    return autoencoder.labelled_errors(_zscored(invoices, vendors))


def _score_threshold(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    limit = autoencoder.error_threshold(_zscored(invoices, vendors))
    return rounded(invoices.sparkSession.createDataFrame([(limit,)], "threshold double"), {"threshold": 6})


def _lowest_scores(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """The forest's and the outlier factor's way to label: the lowest scores are anomalies."""
    scored = _zscored(invoices, vendors).withColumn("anomaly_score", -F.col("reconstruction_error"))
    return iforest.labelled(scored, iforest.lowest_share(scored, "anomaly_score")).drop("reconstruction_error", "amount")


def _vendor_points(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """One point per vendor, from all its invoices."""
    profile = invoices.groupBy("vendor_id").agg(
        (F.count(F.lit(1)) / 100).alias("n"), (F.avg("amount") / 10_000).alias("mean"), (F.max("amount") / 100_000).alias("top")
    )
    return profile.join(vendors, "vendor_id").select(
        F.col("vendor_id").alias("invoice_id"),
        F.array("n", "mean", "top").alias("x"),
        F.array(F.xxhash64("vendor_category")).alias("c"),
    )


VENDOR_NEIGHBORS, VENDOR_CELL_ROWS = 5, 16


def _vendor_neighbors(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Small cells, so that the join crosses several."""
    return lof.nearest_neighbors(_vendor_points(invoices, vendors), VENDOR_NEIGHBORS, VENDOR_CELL_ROWS)


def _encoded_again(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Encoded by an encoder that was saved and loaded."""
    mart, _ = encode.separate_metadata(jobs.feature_mart(invoices, vendors))
    mart = materialize(mart, "invoice_features", large=True)
    path = run_folder(invoices.sparkSession, "encoder")
    encode.save_encoder(invoices.sparkSession, encode.fit_encoder(mart), path)
    encoder = encode.load_encoder(invoices.sparkSession, path)
    return rounded(encoder.transform(mart).select("invoice_id", *encoder.numeric), dict.fromkeys(encoder.numeric, 4))


REPORT_DIGITS = dict.fromkeys(["accuracy", "precision", "recall", "f1_score"], 6)


def rule_queries() -> dict[str, Query]:
    return {
        "raw_invoices": _invoices(staging.raw_invoices),
        "raw_vendors": _vendors(staging.raw_vendors),
        "stg_vendors": _vendors(staging.stg_vendors),
        "stg_invoices": _both(staging.stg_invoices),
        "fe_vendor_stats": _mart(*history.STATISTICS),
        "fe_history": _mart(
            "vendor_invoice_number", "previous_invoice_amount", "previous_invoice_date", "previous_payment_delay"
        ),
        "fe_rolling": _mart(
            "rolling_avg_amount", "rolling_std_amount", "rolling_total_amount", "rolling_avg_days_to_payment"
        ),
        "fe_cumulative": _mart("cumulative_vendor_spend"),
        "fe_bank_count": _mart("bank_account_id", "bank_account_vendor_count"),
        "fe_round_flags": _invoices(_round_flags),
        "fe_derived": _mart(
            "days_since_previous_invoice",
            "vendor_amount_zscore",
            "amount_to_threshold_distance",
            "submission_hour",
            "submission_day_of_week",
        ),
        "fe_sliced_history": _narrow(_sliced_history),
        "invoice_features": _narrow(lambda i, v: rounded(jobs.feature_mart(i, v))),
        "benford_digits": _invoices(benford.vendor_distribution),
        "benford_scores": _invoices(lambda i: benford.vendor_scores(benford.vendor_distribution(i))),
        "benford_flags": _invoices(benford.benford_rule),
        "benford_top": _invoices(lambda i: benford.top_scores(benford.benford_rule(i))),
        "threshold_candidates": _invoices(_threshold_candidates),
        "threshold_counts": _invoices(lambda i: threshold.quarter_counts(threshold.near_threshold(i))),
        "threshold_flags": _invoices(_threshold_flags),
        "threshold_top": _invoices(
            lambda i: threshold.top_candidates(threshold.threshold_rule(i)).select(
                "invoice_id", "vendor_id", "quarter", "vendor_threshold_count", "threshold_flag"
            )
        ),
        "shell_bank_counts": _vendors(shell_vendor.account_counts),
        "shell_vendor_flags": _vendors(shell_vendor.shell_vendor_rule),
        "shell_flagged_top": _vendors(lambda v: shell_vendor.flagged_vendors(shell_vendor.shell_vendor_rule(v))),
        "duplicate_candidate_counts": _invoices(duplicates.candidate_counts),
        "description_similarity": _invoices(_description_similarity),
        "duplicate_pairs": _invoices(_pairs),
        "duplicate_pairs_close_amounts": _invoices(lambda i: _pairs(i, amount_tolerance=0.01)),
        "duplicate_pairs_loose_text": _invoices(lambda i: _pairs(i, min_similarity=75, hot_rows=2)),
        "duplicate_pairs_top": _invoices(lambda i: duplicates.first_pairs(_pairs(i))),
        "duplicate_flags": _invoices(duplicates.duplicate_flags),
        "duplicate_flags_both": _invoices(lambda i: duplicates.duplicate_flags(i, flag_side="both")),
        "rule_vote": _both(jobs.rule_vote),
        "rule_vote_summary": _both(lambda i, v: vote.vote_summary(jobs.rule_vote(i, v))),
        "injected_invoices": _invoices(_injected(0)),
        "injected_labels": _invoices(_injected(1)),
        "label_parameters": _invoices(lambda i: inject.label_parameters(_injected(1)(i))),
        "eval_joined": _both(_evaluated),
        "eval_metrics": _both(lambda i, v: rounded(evaluate.metrics(_eval_counts(i, v)), REPORT_DIGITS)),
        "eval_confusion": _both(lambda i, v: evaluate.confusion_matrix(_eval_counts(i, v))),
        "eval_class_report": _both(lambda i, v: rounded(evaluate.class_report(_eval_counts(i, v)), REPORT_DIGITS)),
        "eval_by_type": _both(lambda i, v: evaluate.recall_by_type(_evaluated(i, v, "both"), "final_prediction")),
        "dq_report": _invoices(quality.dq_report),
        "amount_profile": _invoices(
            lambda i: rounded(quality.numeric_profile(i), {"mean": 4, "std": 4, "p25": 4, "p50": 4, "p75": 4})
        ),
        "value_counts": _both(
            lambda i, v: quality.value_counts(i, "department")
            .union(quality.value_counts(i, "payment_terms"))
            .union(quality.value_counts(v, "vendor_category"))
        ),
        "dataset_summary": _both(quality.dataset_summary),
        "dq_report_gaps": _invoices(lambda i: quality.dq_report(_with_gaps(i))),
        "injected_labels_wide": _invoices(
            lambda i: inject.inject_duplicates(i, max_date_shift=30, id_scheme="prefix")[1]
        ),
        "max_invoice_number": _invoices(inject.max_invoice_number),
        "injected_sequence_ids": _invoices(
            lambda i: inject.inject_duplicates(i)[1].select("invoice_id", "source_invoice")
        ),
        "mart_metadata": _both(lambda i, v: encode.separate_metadata(jobs.feature_mart(i, v))[1]),
        "mart_features": _both(lambda i, v: rounded(encode.separate_metadata(jobs.feature_mart(i, v))[0])),
        "autoencoder_split": _invoices(lambda i: i.select("invoice_id", autoencoder.held_out().alias("validation"))),
        "csv_invoices": _invoices(_csv_invoices),
        "csv_vendors": _vendors(_csv_vendors),
        "csv_rule_table": _invoices(_csv_rule_table),
        "saved_vote": _written(_saved_vote),
        "saved_injection": _written(lambda i, _: _saved_injection(i)),
        "score_threshold": _both(_score_threshold),
        "score_labels": _both(
            lambda i, v: _zscore_labels(i, v)[0].select("invoice_id", "reconstruction_error", "prediction")
        ),
        "score_histogram": _both(
            lambda i, v: rounded(
                autoencoder.error_histogram(*_zscore_labels(i, v)), dict.fromkeys(["lower", "upper", "threshold"], 6)
            )
        ),
        "score_top": _both(lambda i, v: autoencoder.most_suspicious(_zscore_labels(i, v)[0])),
        "score_summary": _both(lambda i, v: iforest.prediction_summary(_zscore_labels(i, v)[0])),
        "lowest_score_labels": _both(
            lambda i, v: _lowest_scores(i, v).select("invoice_id", "anomaly_score", "prediction")
        ),
        "lowest_score_top": _both(
            lambda i, v: iforest.most_suspicious(_lowest_scores(i, v)).select("invoice_id", "anomaly_score", "prediction")
        ),
        "vendor_neighbors": _both(lambda i, v: rounded(_vendor_neighbors(i, v), {"distance": 6})),
        "vendor_outlier_factors": _both(
            lambda i, v: rounded(lof.outlier_factors(_vendor_neighbors(i, v)), {"anomaly_score": 6})
        ),
        "saved_predictions": _narrow(_saved_predictions),
        "saved_evaluation": _both(_saved_evaluation),
        "saved_threshold": _both(_saved_threshold),
        "mart_after_append": _written(_mart_after_append),
        "null_profile": _both(lambda i, v: quality.null_profile(jobs.feature_mart(i, v))),
        "line_items": _invoices(quality.line_items),
    }


def _impute_stats(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    mart = materialize(encode.separate_metadata(jobs.feature_mart(invoices, vendors))[0], "invoice_features", large=True)
    return rounded(encode.fill_rows(mart, encode.fit_encoder(mart)), {"median": 4})


def _encoded_numeric(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    data = jobs.prepared(invoices, vendors, metadata=False, categories=False)
    numeric = data.encoder.numeric
    return rounded(data.encoded.select("invoice_id", *numeric), dict.fromkeys(numeric, 4))


def _encoded_onehot(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    data = jobs.prepared(invoices, vendors, metadata=False, numbers=False)
    return encode.onehot_rows(data.encoded, data.encoder)


def _forest_report(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Class report of the isolation forest on invoices with injected duplicates."""
    augmented, labels = inject.inject_duplicates(invoices, id_scheme="prefix")
    predicted = jobs.isolation_forest(jobs.prepared(augmented, vendors, metadata=False))
    return evaluate.class_report(evaluate.outcome_counts(evaluate.with_labels(predicted, labels)))


# A forest that SQL can follow; scaled numbers are rounded, so both see equal ones.
SMALL_TREES, SMALL_SAMPLE, ENCODED_DIGITS = 8, 64, 4
SWEEP = {"tree_counts": [4, 8], "sample_sizes": [32, 64], "contaminations": [0.01, 0.02, 0.05, 0.1]}
SWEEP_DIGITS = dict.fromkeys(["threshold", "precision", "recall", "f1_score"], 6)


def _small(invoices: DataFrame, vendors: DataFrame, metadata: bool = True) -> jobs.Prepared:
    return jobs.prepared(invoices, vendors, digits=ENCODED_DIGITS, metadata=metadata)


def _small_forest(data: jobs.Prepared) -> iforest.Forest:
    return iforest.fit_forest(data.encoded, data.encoder, SMALL_TREES, SMALL_SAMPLE)


def _forest_samples(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    data = _small(invoices, vendors, metadata=False)
    return iforest.sampled(data.encoded, data.encoder, SMALL_TREES, SMALL_SAMPLE)[0].select("tree", "invoice_id")


def _forest_nodes(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """The small forest's nodes, saved and read, with the names of their features."""
    spark, path = invoices.sparkSession, run_folder(invoices.sparkSession, "forest")
    iforest.save_forest(spark, _small_forest(_small(invoices, vendors)), path)
    return rounded(iforest.named_nodes(spark, iforest.load_forest(spark, path)), {"threshold": 6, "length": 6})


def _small_scores(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    data = _small(invoices, vendors)
    scored = iforest.with_scores(data.encoded, _small_forest(data))
    return rounded(scored.select("invoice_id", "raw_score"), {"raw_score": 6})


def _forest_sweep(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    found = jobs.forest_sweep(invoices, vendors, {"id_scheme": "prefix"}, ENCODED_DIGITS, **SWEEP)
    return rounded(found, SWEEP_DIGITS)


def _autoencoder_history(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    rows, model = jobs.trained_autoencoder(jobs.prepared(invoices, vendors))
    return model.history(rows.sparkSession)


def _detector(job: Callable, then: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    return _narrow(lambda i, v: then(job(jobs.prepared(i, v))))


def model_queries() -> dict[str, Query]:
    return {
        "impute_stats": _both(_impute_stats),
        "encoded_numeric": _both(_encoded_numeric),
        "scored_with_saved_encoder": _narrow(_encoded_again),
        "encoded_onehot": _both(_encoded_onehot),
        "saved_matrix": _narrow(_saved_matrix),
        "reconstruction_fixed": _narrow(_fixed_reconstruction),
        "iforest_predictions": _detector(jobs.isolation_forest),
        "iforest_top": _detector(jobs.isolation_forest, iforest.most_suspicious),
        "iforest_summary": _detector(jobs.isolation_forest, iforest.prediction_summary),
        "iforest_class_report": _written(_forest_report),
        "iforest_samples": _both(_forest_samples),
        "iforest_nodes": _narrow(_forest_nodes),
        "iforest_small": _narrow(_small_scores),
        "iforest_sweep": _written(_forest_sweep),
        "lof_predictions": _detector(jobs.local_outlier_factor),
        "lof_top": _detector(jobs.local_outlier_factor, iforest.most_suspicious),
        "autoencoder_history": _narrow(_autoencoder_history),
        "autoencoder_predictions": _detector(jobs.autoencoder_predictions, lambda result: result[0]),
        "autoencoder_top": _detector(
            jobs.autoencoder_predictions, lambda result: autoencoder.most_suspicious(result[0])
        ),
        "wide_autoencoder_predictions": _detector(jobs.wide_autoencoder_predictions, lambda result: result[0]),
        "error_histogram": _detector(
            jobs.autoencoder_predictions, lambda result: autoencoder.error_histogram(*result)
        ),
    }


def queries() -> dict[str, Query]:
    return rule_queries() | model_queries()
