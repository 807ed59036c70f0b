"""Parameter sweep of the isolation forest: every setting judged by the labels, and ranked.

One forest is grown per sample size, with the largest number of trees. One walk over it scores
a row by every smaller number of trees, too, and one pass over the rows walks all forests. Each
contamination is a quantile of a score column, and one conditional aggregation counts the
outcomes of all settings, so the sweep costs a fit per sample size, a scoring pass and an
aggregation, however many settings it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vouchwell.functions.scalar import round_half_up
from vouchwell.operators import evaluate, iforest
from vouchwell.operators.encode import Encoder
from vouchwell.operators.quantiles import exact_quantiles
from vouchwell.storage import materialize

TREE_COUNTS = [50, 100, 200]
SAMPLE_SIZES = [128, 256]
CONTAMINATIONS = [0.005, 0.01, 0.02, 0.05]
SCORE_DIGITS = 6
OUTCOMES = ["tp", "fp", "fn", "tn"]
SETTING = "sample_rows int, n_trees int, contamination double, threshold double, tp bigint, fp bigint, fn bigint, tn bigint"


def threshold_curve(scored: DataFrame, columns: list[str], shares: list[float]) -> list[tuple[str, float, float, list[int]]]:
    """(column, share, threshold, [tp, fp, fn, tn]) for rows whose score is below the share's quantile.

    ``scored`` has a score per column and fraud_label.
    """
    limits = exact_quantiles(scored, columns, shares)
    settings = [(c, p, limits[c, p]) for c in columns for p in shares if limits[c, p] is not None]
    fraud = F.col("fraud_label") == 1
    counts = []
    for k, (column, _, limit) in enumerate(settings):
        raised = F.col(column) < limit
        counts.append(F.struct(F.count_if(fraud & raised), F.count_if(~fraud & raised),
                               F.count_if(fraud & ~raised), F.count_if(~fraud & ~raised)).alias(str(k)))
    row = scored.agg(*counts).first() if counts else []
    return [(*setting, list(row[k])) for k, setting in enumerate(settings)]


def sweep(
    encoded: DataFrame,
    encoder: Encoder,
    labels: DataFrame,
    tree_counts: list[int] | None = None,
    sample_sizes: list[int] | None = None,
    contaminations: list[float] | None = None,
    seed: int = iforest.SEED,
) -> DataFrame:
    """One row per setting, ranked by F1, then recall; equal ones by their parameters.

    Scores are rounded, so that rows with equal paths tie whatever order they were summed in.
    """
    tree_counts, sample_sizes = tree_counts or TREE_COUNTS, sample_sizes or SAMPLE_SIZES
    spark = encoded.sparkSession
    forests = [iforest.fit_forest(encoded, encoder, max(tree_counts), n, seed) for n in sample_sizes]
    settings = {f"score_{k}": setting for k, setting in enumerate((n, trees) for n in sample_sizes for trees in tree_counts)}
    scores = [round_half_up(F.col("raw_scores")[k], SCORE_DIGITS).alias(name) for k, name in enumerate(settings)]
    scored = iforest.with_scores_of_all(encoded, forests, tree_counts).select("invoice_id", *scores)
    judged = materialize(evaluate.with_labels(scored, labels).drop("fraud_type"), "sweep_scores", large=True)
    curve = threshold_curve(judged, list(settings), contaminations or CONTAMINATIONS)
    rows = [(*settings[column], share, limit, *counts) for column, share, limit, counts in curve]
    return ranked(spark.createDataFrame(rows, SETTING))


def ranked(settings: DataFrame) -> DataFrame:
    """Settings, a few dozen rows, with precision, recall, F1 and their rank."""
    judged = evaluate.with_rates(settings)
    best = W.orderBy(F.desc("f1_score"), F.desc("recall"), "sample_rows", "n_trees", "contamination")
    return judged.select(F.row_number().over(best).alias("rank"), *judged.columns)
