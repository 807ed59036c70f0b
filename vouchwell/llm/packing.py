"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A document is cut into pieces. Whole sequences come first; of what is left a piece is cut
off at the largest reciprocal of the capacity that fits (capacity // k), until the rest fills
its class nearly: pieces of at most capacity // k tokens, k of which waste at most
``SLACK`` of the capacity, are cut no further. Class k then fills its sequences with exactly
k pieces each. Workers number the pieces of each class on their own; counts per worker and
class turn those into places, so no worker waits for another and no group is collected.
The pieces that are left over when a class's last sequence stays short are fewer than k a
class, a few thousand at most whatever the input; they are packed first-fit decreasing.

Tokens: the word tokenizer's ids of the whole text without special tokens, then ``END``.
Ids of distinct words come from the tokenizer itself and are held in a bounded cache; its
pre-tokenizer drops white space, so words between ASCII white space are encoded apart. A text
that holds the string of a special token goes to the tokenizer whole.

Defined results: null and empty texts are documents of one token, ``END``; rows that repeat
an id are documents of their own; a null id is kept; an empty table gives an empty result;
other columns play no part.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vouchwell.llm.common import per_worker, slices, text_of
from vouchwell.llm.wordcache import WordTable, cut_marks
from vouchwell.storage import materialize

CAPACITY = 2048
END = 1
SLACK = 1 / 128
JOINED = 2_000
#: Words a worker keeps; workers of earlier stages run the later ones, so what they hold adds up.
KEPT_WORDS = 300_000

def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return per_worker(f"tokenizer {path}", lambda: Tokenizer.from_file(path))


def _special_tokens(path: str) -> list[str]:
    """Strings that the tokenizer finds before it splits words, in lower case as it may see them."""
    found = json.loads(_tokenizer(path).to_str()).get("added_tokens") or []
    return sorted({token["content"].lower() for token in found})


def _word_cache(path: str) -> WordTable:
    tokenizer = _tokenizer(path)
    mark = tokenizer.encode("\0", add_special_tokens=False).ids

    def alone(word: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids, np.int32)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many words in one call, with a NUL between them; words beside one with a NUL of its own go alone."""
        found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for start in range(0, len(words), JOINED):
            part = words[start : start + JOINED]
            ids = alone(" \0 ".join(part))
            cuts = np.flatnonzero(ids == mark[0])
            if len(mark) != 1 or len(cuts) != len(part) - 1 or any("\0" in w for w in part):
                pieces = [alone(w) for w in part]
                found += pieces
                sizes.append(np.array([len(p) for p in pieces], np.int64))
            else:
                found.append(np.delete(ids, cuts))
                sizes.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
        return np.concatenate(found), np.concatenate(sizes)

    return WordTable(encode, KEPT_WORDS)


def word_cache(path: str) -> WordTable:
    """One cache a worker process and tokenizer file."""
    return per_worker(f"words of {path}", lambda: _word_cache(path))


def token_ids(texts: pa.Array, path: str) -> list[np.ndarray]:
    """The ids of each text."""
    cache = word_cache(path)
    lower = pc.ascii_lower(texts)
    special = np.zeros(len(texts), bool)
    for token in per_worker(f"special tokens of {path}", lambda: _special_tokens(path)):
        special |= pc.match_substring(lower, token).to_numpy(zero_copy_only=False)
    split = pc.ascii_split_whitespace(lower)
    chunks = pc.dictionary_encode(split.flatten())
    words = pc.dictionary_encode(pa.concat_arrays(cut_marks(chunks.dictionary)))
    places = cache.lookup(words.dictionary)[words.indices.to_numpy()].reshape(2, -1)
    ids, sizes = cache.gather(places[:, chunks.indices.to_numpy()].T.ravel())
    per_chunk = np.concatenate([[0], np.cumsum(sizes.reshape(-1, 2).sum(axis=1))])
    ends = per_chunk[split.offsets.to_numpy() - split.offsets[0].as_py()]
    found = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    for row in np.flatnonzero(special):  # a special token is found across words, so its text goes whole
        found[row] = np.array(_tokenizer(path).encode(texts[int(row)].as_py(), add_special_tokens=False).ids, np.int32)
    return found


def cuts(tokens: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(length, class) of a document's pieces, in order."""
    found = [(capacity, 1)] * (tokens // capacity)
    left = tokens % capacity
    while left:
        k = capacity // left
        if capacity - k * left <= slack * capacity:
            found.append((left, k))
            break
        size = capacity // (k + 1)
        found.append((size, capacity // size))
        left -= size
    return found


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written table of pieces with their class and their number within worker and class."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "class", "worker", "number"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, numbers = TaskContext.get().partitionId(), {}
        for batch in slices(batches, "text", 4 << 20):
            out: list[tuple] = []
            owners: list[int] = []
            for row, ids in enumerate(token_ids(batch.column("text"), path)):
                ids = np.append(ids, end).astype("<u4")
                data, start = ids.tobytes(), 0
                for length, k in cuts(len(ids), capacity):
                    number = numbers.get(k, 0)
                    numbers[k] = number + 1
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    owners.append(row)
                    out.append((start, length, crc, len(ids), k, worker, number))
                    start += length
            if out:
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(owners)), *columns], names)

    schema = f"id {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    return materialize(rows.mapInArrow(cut, schema), "pieces")


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, class."""
    spark = docs.sparkSession
    cut = pieces(docs, path, capacity, end, id_col, text_col)
    held = cut.groupBy("class", "worker").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    held = materialize(held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "class_counts")
    # A class is capacity // length: about twice the capacity's root of them at most.
    totals = sorted((r["class"], r["n"]) for r in held.groupBy("class").agg(F.sum("n").alias("n")).collect())
    bases, base = [], 0
    for k, n in totals:
        bases.append((k, base, n // k * k))
        base += n // k
    if not totals:
        bases = [(1, 0, 0)]
    classes = F.broadcast(spark.createDataFrame(bases, "class long, base long, whole long"))
    placed = cut.join(held.drop("n"), ["class", "worker"]).join(classes, "class")
    placed = placed.withColumn("place", F.col("before") + F.col("number"))
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", "class"]
    in_bin = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    full = (
        placed.where("place < whole")
        .withColumn("sequence_id", F.col("base") + F.expr("place div class"))
        .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
        .select(*columns, "sequence_id", "offset")
    )

    def first_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        rest = pa.Table.from_batches(found).sort_by([("length", "descending"), ("class", "ascending"), ("place", "ascending")])
        free: list[int] = []
        bins, offsets = [], []
        for length in rest.column("length").to_pylist():
            place = next((i for i, room in enumerate(free) if room >= length), len(free))
            if place == len(free):
                free.append(capacity)
            bins.append(base + place)
            offsets.append(capacity - free[place])
            free[place] -= length
        rest = rest.select(columns)
        yield from rest.append_column("sequence_id", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    rest = materialize(placed.where("place >= whole").select(*columns, "place"), "left_over").coalesce(1)
    packed = full.unionByName(rest.mapInArrow(first_fit, full.schema))
    return packed.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"
    )
