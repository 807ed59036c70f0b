"""Toxicity by class-conditional Kneser-Ney models of words.

Two models are counted from the labelled texts, one of toxic and one of ordinary texts. Each
takes a word's own count in its class less a modified Kneser-Ney discount and gives what the
discounts free to counts that both share: the number of documents a word occurs in, over both
classes together (its continuation count, with the document as context), itself discounted
against a uniform share. A word speaks for a class only where its two log-likelihoods differ
by ``LEAST`` and a likelihood-ratio test on its documents exceeds ``CERTAIN``; any other, rare
or unseen words above all, has the shared probability in both models and adds nothing. A
text's evidence is the difference of the log-likelihoods, divided by its number of words and
in sum. A logistic curve over the logarithms of both turns it into a score.

Every labelled training text is counted. The curve is fitted on one in four of them by crc32
of the id, about ``CURVE_ROWS`` by hash where that is more, with evidence from counts that leave
these texts out.

A word is what stands between white space, lower-cased and without marks at its ends.

Defined results: texts without words, null included, have evidence 0 and the curve's score
there; a null id is scored like any other and never trains; where a document has several
labels the largest counts; equal texts get equal scores; without labels of both classes every
score is 1 if all labels are toxic and else 0; an empty table gives an empty result; other
columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.llm import ngram_lm
from vouchwell.llm.common import PIECE_CHARS, slices, text_of
from vouchwell.llm.wordcache import coded
from vouchwell.storage import broadcast_if_small, materialize

CURVE_ROWS = 50_000
LEAST, CERTAIN = 2.5, 15.0
THRESHOLD = 0.7
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’¡¿…–—·•。、！？"
PER = 200.0
COUNTS = ["ordinary", "toxic", "toxic_documents", "documents"]
_EVIDENCE, _LABEL, _MEAN, _SCORE, _SUM = "__evidence", "__label", "__mean", "__score", "__sum"


def words(texts: list[str | None], most: int = PIECE_CHARS) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(rows, words per row, 64-bit hashes of the words end to end) of groups of whole texts."""
    start, held = 0, 0
    for row in range(len(texts) + 1):
        size = len(texts[row] or "") if row < len(texts) else 0
        if row == len(texts) or (held and held + size > most):
            if row > start:
                yield _words(texts[start:row], start)
            start, held = row, 0
        held += size


def _words(texts: list[str | None], first: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    split = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.string()))
    codes, chunks = coded(split.flatten())
    bare = np.array([w.lower().strip(MARKS) for w in chunks], dtype=object)
    hashes = pd.util.hash_array(bare, categorize=False).view(np.int64) if len(bare) else np.zeros(0, np.int64)
    real = np.array([bool(w) for w in bare], dtype=bool)[codes]
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    sizes = np.bincount(owner[real], minlength=len(texts))
    return list(range(first, first + len(texts))), sizes, hashes[codes][real]


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(ngram_lm.fold(id_col), F.lit(3)) == 1, F.lit(False))


def _training(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias(_LABEL))
    curve = F.pmod(F.floor(ngram_lm.fold(id_col) / 3), F.lit(4)) == 0
    return materialize(known.select(id_col, _LABEL, curve.alias("__curve")), "training_labels")


def _counts(texts: DataFrame) -> DataFrame:
    """gram, ordinary, toxic, toxic_documents, documents: counts of every word of the labelled texts.

    The same with ``_rest``: of the texts that are not kept for the curve.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            label = batch.column("label").to_numpy(zero_copy_only=False)
            rest = ~batch.column("curve").to_numpy(zero_copy_only=False)
            for rows, sizes, found in words(batch.column("text").to_pylist()):
                codes, distinct = pd.factorize(found)
                owner = np.repeat(rows, sizes)
                width = max(len(distinct), 1)
                pairs = np.unique(owner * width + codes)
                columns = [pa.array(distinct)]
                for part in (np.ones(len(label), bool), rest):
                    for places, weight in ((codes, (part & (label == 0))[owner]), (codes, (part & (label == 1))[owner]),
                                           (pairs % width, (part & (label == 1))[pairs // width]), (pairs % width, part[pairs // width])):
                        columns.append(pa.array(np.bincount(places, weight, len(distinct)).astype(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["gram", *names])

    names = [f"{c}{part}" for part in ("", "_rest") for c in COUNTS]
    counted = texts.mapInArrow(count, "gram long, " + ", ".join(f"{c} long" for c in names))
    return materialize(counted.groupBy("gram").agg(*(F.sum(c).alias(c) for c in names)), "words")


def _surprise(a: Column, b: Column, all_a: int, all_b: int) -> Column:
    """Likelihood-ratio statistic of a of all_a against b of all_b documents."""
    share = (a + b) / (all_a + all_b)
    cells = [(a, share * all_a), (b, share * all_b), (all_a - a, (1 - share) * all_a), (all_b - b, (1 - share) * all_b)]
    return 2 * sum(F.when(x > 0, x * F.log(x / e)).otherwise(0.0) for x, e in cells)


def log_ratios(counted: DataFrame, all_toxic: int, all_ordinary: int) -> DataFrame:
    """(gram, value): log-likelihood as toxic less that as ordinary, of the words that speak."""
    names = ["ordinary", "toxic", "documents"]
    held = ngram_lm.discounts(counted, names)
    sums = [e for c in names for e in (F.sum(c).alias(c), F.count_if(F.col(c) == 1).alias(f"{c}1"),
            F.count_if(F.col(c) == 2).alias(f"{c}2"), F.count_if(F.col(c) > 2).alias(f"{c}3"))]
    seen = counted.agg(*sums, F.count("*").alias("types")).first()
    share = {c: sum(d * seen[f"{c}{k}"] for k, d in enumerate(held[c], 1)) / seen[c] for c in names}

    def own(c: str) -> Column:
        n, (d1, d2, d3) = F.col(c), held[c]
        return (n - F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)) / seen[c]

    shared = own("documents") + share["documents"] / (seen["types"] + 1)
    chance = {c: own(c) + share[c] * shared for c in ("ordinary", "toxic")}
    value = F.log(chance["toxic"]) - F.log(chance["ordinary"])
    ordinary = F.col("documents") - F.col("toxic_documents")
    certain = _surprise(F.col("toxic_documents"), ordinary, all_toxic, all_ordinary) >= CERTAIN
    return counted.select("gram", value.alias("value")).where(certain & (F.abs("value") >= LEAST))


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", into: str = "score"
) -> DataFrame:
    """``docs`` with a column ``into``."""
    known = _training(labels, id_col, label_col)
    n, toxic = known.agg(F.count("*"), F.sum(_LABEL)).first()
    if not n or toxic in (0, n):
        return docs.withColumn(into, F.lit(1.0 if n and toxic else 0.0))
    kept = known.where("__curve").count()
    if kept > CURVE_ROWS:  # the others are counted
        enters = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(CURVE_ROWS / kept * (1 << 30))
        known = known.withColumn("__curve", F.col("__curve") & enters)
    texts = docs.join(broadcast_if_small(known), id_col)
    found = _counts(texts.select(text_of(text_col).alias("text"), F.col(_LABEL).alias("label"), F.col("__curve").alias("curve")))
    present = found.agg(*(F.sum(c) for c in ("toxic", "ordinary", "toxic_rest", "ordinary_rest"))).first()
    if not present[0] or not present[1]:
        return docs.withColumn(into, F.lit(toxic / n))

    def ratios(labels: DataFrame, part: str) -> DataFrame:
        every = {row[_LABEL]: row["count"] for row in labels.groupBy(_LABEL).count().collect()}
        own = found.select("gram", *(F.col(f"{c}{part}").alias(c) for c in COUNTS)).where("documents > 0")
        return materialize(log_ratios(own, every[1], every[0]), f"log_ratios{part}")

    def evidence(rows: DataFrame, ratio: DataFrame) -> DataFrame:
        """Add the two logarithms: per ``PER`` words, and of the sum."""
        rows = ngram_lm.with_means(rows, ratio, _EVIDENCE, text_col, words)
        mean = F.greatest(F.col(f"{_EVIDENCE}.mean"), F.lit(0.0))
        return rows.withColumns({_MEAN: F.log1p(PER * mean), _SUM: F.log1p(mean * F.col(f"{_EVIDENCE}.size"))}).drop(_EVIDENCE)

    by_mean, by_sum, offset = 1.0, 0.0, -1.0
    if present[2] and present[3]:
        curve = known.where("__curve").select(id_col, _LABEL)
        sample = evidence(docs.join(broadcast_if_small(curve), id_col), ratios(known.where("NOT __curve"), "_rest"))
        sample = sample.select(_MEAN, _SUM, _LABEL).toArrow()
        x = np.column_stack([sample.column(c).to_numpy() for c in (_MEAN, _SUM)])
        y = sample.column(_LABEL).to_numpy().astype(float)
        if 0 < y.sum() < len(y):
            by_mean, by_sum, offset = ngram_lm.logistic(x, y)
    height = F.col(_MEAN) * by_mean + F.col(_SUM) * by_sum + offset
    return evidence(docs, ratios(known, "")).withColumn(into, 1 / (1 + F.exp(-height))).drop(_MEAN, _SUM)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted: one row per document."""
    scored = score(docs.select(id_col, text_col), labels, id_col, text_col)
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", predicted.alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return score(docs, labels, into=_SCORE).where(F.col(_SCORE) < threshold).select(*docs.columns)
