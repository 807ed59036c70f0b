"""The corpus pipeline: stages that each take the documents their predecessor kept.

A stage writes little and its caller runs the rest, so each sets how many rows the session moves
to Python at a time: workers serve all stages, and long texts in large batches would stay with them.

Defined results: every stage treats a null text as an empty one and keeps null ids; rows that
repeat id and text are one document after exact dedup; an empty table stays empty through all
stages; other columns pass through all but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vouchwell.llm import exact_dedup, near_dedup, packing, suffix_dedup, toxicity
from vouchwell.llm.common import small_batches, table
from vouchwell.storage import materialize

#: Passages of over 50 words, found by anchors of 13.
REPEATED_WORDS, ANCHOR_WORDS = 51, 13
TOKENIZER = "word_bpe_49k.json"


def ordinary(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Toxicity: rejected documents go."""
    small_batches(spark)
    return toxicity.keep_ordinary(docs, table(spark, folder, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Exact dedup: of equal texts one row stays, that with the largest doc_id."""
    small_batches(spark)
    return exact_dedup.deduplicate(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Near dedup on shingles of five words, similarity 0.8: one document of each group stays."""
    small_batches(spark)
    return near_dedup.deduplicate(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages of ``REPEATED_WORDS`` that occur again anywhere leave the texts; n_chars follows."""
    small_batches(spark)
    return suffix_dedup.remove(docs, length=REPEATED_WORDS, gram=ANCHOR_WORDS, chars_col="n_chars", words=True)


def sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row per piece of a document in a packed sequence."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", ordinary),
    ("exact dedup", distinct),
    ("near dedup", dissimilar),
    ("suffix dedup", unrepeated),
    ("packing", sequences),
]
#: Tokenised pieces, model scores and sampled sketches are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, folder)
