"""Quality by the perplexity of a model of trusted text.

An interpolated modified Kneser-Ney model over character n-grams is counted from the texts
labelled as good (``ngram_lm``: sharded joins of counts). The perplexity of a document is
that of its symbols; a document is kept if it does not exceed its language's threshold, a
quantile of the perplexities of trusted texts in that language that were not counted (one in
four by crc32 of the id).

Defined results: empty and null texts have perplexity 1 and are kept; a language without
such trusted texts, null included, has the threshold of all languages together; without any
trusted text every document is kept with the perplexity of a uniform model; a document with
several labels is trusted only if all are good; equal texts get equal perplexities; an empty
table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.llm import ngram_lm
from vouchwell.storage import broadcast_if_small, materialize

QUANTILE = 0.99
ACCURACY = 10_000
_LOSS, _TRUSTED, _COUNTED = "__loss", "__trusted", "__counted"


def judge(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "quality",
) -> DataFrame:
    """id, lang, perplexity, threshold, kept: one row per document."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("good")).where("good = 1")
    counted = F.pmod(ngram_lm.fold(id_col), F.lit(4)) != 0
    good = materialize(good.select(id_col, F.lit(True).alias(_TRUSTED), counted.alias(_COUNTED)), "trusted")
    rows = docs.select(id_col, lang_col, text_col).join(broadcast_if_small(good), id_col, "left")
    kind = F.when(F.col(_COUNTED), 0).otherwise(-1)
    chances = ngram_lm.probabilities(ngram_lm.class_counts(rows, kind, 1, text_col), ["c0"])
    losses = materialize(chances.select("gram", (-F.log("p_c0")).alias("value")), "log_loss")
    scored = ngram_lm.with_means(rows, losses, _LOSS, text_col)
    scored = materialize(scored.select(id_col, lang_col, F.exp(f"{_LOSS}.mean").alias("perplexity"), _TRUSTED, _COUNTED), "perplexities")
    fresh = scored.where(F.col(_TRUSTED) & ~F.col(_COUNTED))
    cut = F.percentile_approx("perplexity", quantile, ACCURACY)
    overall = fresh.agg(cut).first()[0]
    per_lang = fresh.where(F.col(lang_col).isNotNull()).groupBy(lang_col).agg(cut.alias("threshold"))
    overall = F.lit(float("inf") if overall is None else overall)
    judged = scored.join(broadcast_if_small(materialize(per_lang, "thresholds")), lang_col, "left")
    judged = judged.withColumn("threshold", F.coalesce("threshold", overall))
    return judged.select(id_col, lang_col, "perplexity", "threshold", (F.col("perplexity") <= F.col("threshold")).alias("kept"))
