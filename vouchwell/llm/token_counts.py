"""Token counts of texts from a cache by digest of the text and of the tokenizer.

The cache is a Parquet folder of (digest, n_tokens), one part per tokenizer version. Texts are
looked up by digest; only distinct texts that the cache lacks are encoded, and their counts
are appended to it before the counts are joined to the rows. Texts travel only where they
must: rows meet counts by digest, and a text is shuffled once, after equal texts of a
partition have become one. Counts of texts that make up more than a thousandth of all rows,
a thousand of them at most, are broadcast, so that no task gets all copies of one text.

The normal form of a text is the text: tokenizers tell case, white space and Unicode forms
apart, so any stronger one could give a text the count of another. A version is the digest of
the tokenizer's file, of the library's name and of its version.

Defined results: a null text counts as an empty one; texts are never cut; every row gives one
row, repeated rows and null ids too; an empty table gives none. Other columns, whatever their
names, are not read. A write that fails leaves the cache as it was; two runs that append the
same text add rows that say the same.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchwell.llm.common import BATCH_ROWS, batches_of, per_worker, slices, text_of
from vouchwell.storage import BROADCAST_ROWS, broadcast_if_small, materialize

LIMIT = 4096
#: A text with more than one in so many rows is a hot one; there are fewer of those than this.
HOT_SHARE = 1000
CACHE_SCHEMA = "digest binary, n_tokens bigint"

Count = Callable[[list[str]], list[int]]


def count(
    docs: DataFrame, tokenizer: str, cache: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row; ``tokenizer`` is a .model or .json file.

    The library's defaults hold, without begin, end or other added tokens, without
    truncation or padding. ``cache`` is a folder in shared storage, made when missing.
    """
    spark = docs.sparkSession
    version, counter = tokenizer_of(tokenizer)
    part = f"{cache.rstrip('/')}/version={version}"
    texts = docs.select(F.col(id_col).alias("row_id"), text_of(text_col).alias("text"))
    texts = texts.select("row_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = materialize(texts.select("row_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "token_rows")
    wanted = materialize(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")), "token_digests")
    with batches_of(spark, BATCH_ROWS):
        misses(texts.select("digest", "text"), wanted, cached(spark, part), counter, version).write.mode("append").parquet(part)
    counts = cached(spark, part).join(broadcast_if_small(wanted.select("digest")), "digest", "left_semi")
    counted = _joined(rows, wanted, materialize(counts, "token_counts"))
    return counted.select(
        F.col("row_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def tokenizer_of(path: str) -> tuple[str, Callable[[], Count]]:
    """(version, what makes a counter in a worker); the file is read here and travels by value."""
    content = Path(path).read_bytes()
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    about = f"{library} {importlib.metadata.version(library)}\n".encode()
    version = hashlib.sha256(about + content).hexdigest()

    def sentencepiece_counter() -> Count:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]

    def tokenizers_counter() -> Count:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        loaded = tokenizers.Tokenizer.from_str(content.decode())
        loaded.no_truncation()
        loaded.no_padding()
        return lambda texts: [len(e.ids) for e in loaded.encode_batch(texts, add_special_tokens=False)]

    return version, sentencepiece_counter if library == "sentencepiece" else tokenizers_counter


def cached(spark: SparkSession, part: str) -> DataFrame:
    """What the cache holds of one version, a row per text."""
    try:
        found = spark.read.schema(CACHE_SCHEMA).parquet(part)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], CACHE_SCHEMA)
    return found.dropDuplicates(["digest"])


def misses(texts: DataFrame, wanted: DataFrame, known: DataFrame, counter: Callable[[], Count], version: str) -> DataFrame:
    """(digest, n_tokens) of the distinct texts that the cache lacks, each encoded once."""
    lacking = materialize(wanted.join(known, "digest", "left_anti").select("digest"), "token_misses")
    few = lacking.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if few:
        texts = texts.join(F.broadcast(lacking), "digest", "left_semi")
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
    if not few:
        distinct = distinct.join(lacking, "digest", "left_semi")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = per_worker(f"token counter {version}", counter)
        for batch in slices(batches, "text"):
            sizes = pa.array(counts(batch.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), sizes], names=["digest", "n_tokens"])

    return distinct.mapInArrow(encode, CACHE_SCHEMA)


def _joined(rows: DataFrame, wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows with their counts; a hot text's rows stay where they are."""
    total = rows.count()
    often = wanted.where(F.col("copies") * HOT_SHARE > total).select("digest")
    hot = F.broadcast(materialize(counts.join(F.broadcast(often), "digest"), "hot_token_counts"))
    rest = rows.join(hot.select("digest"), "digest", "left_anti").join(counts, "digest")
    return rows.join(hot, "digest").unionByName(rest)
