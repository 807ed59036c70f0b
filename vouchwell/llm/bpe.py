"""Byte-level BPE encoding and decoding by DuckDB queries within each partition.

Encoding: every distinct word of a batch becomes rows (word, position, token), one a byte. A
recursive query joins neighbouring tokens with the merge table, takes each word's leftmost
pair of the smallest rank, contracts it, and goes on with the words that still have a pair.
Ids of words are held in a bounded cache of the worker. Decoding joins the rows (document,
position, id) with the vocabulary, orders them and aggregates the bytes in that order, which
a database with one thread keeps; ``measure`` holds what it decodes against the text.

Texts are cut into words by the pattern itself. Where only single blanks separate the parts
of a text, equal parts are cut once; texts with other white space runs are cut whole.

Defined results: null and empty texts have no ids and decode to no bytes; rows that repeat
an id are rows of their own; an empty table gives an empty result; other columns play no
part in ``measure`` and are kept by ``encode`` and ``decode``.
"""

from __future__ import annotations

import base64
import hashlib
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.llm.common import per_worker, slices, text_of
from vouchwell.llm.wordcache import WordCache, coded, cut_mark

WORDS_AT_ONCE = 20_000
DECODED_AT_ONCE = 1_000_000
SLICE_BYTES = 8 << 20
#: Unicode white space, which the tokenizer library's \s stands for.
_SPACE_POINTS = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE = "".join(map(chr, _SPACE_POINTS))

CONTRACT = """
    WITH RECURSIVE state(word, pos, token, done) AS (
        SELECT word, pos, token, false FROM bytes_of
        UNION ALL
        (WITH pairs AS (
            SELECT word, pos, token, lead(token) OVER (ORDER BY word, pos) AS next_token,
                   lead(word) OVER (ORDER BY word, pos) AS next_word
            FROM state WHERE NOT done),
        ranked AS (
            SELECT word, pos, token, merged, merged::BIGINT * 1099511627776 + pos AS rank
            FROM pairs LEFT JOIN merges ON pair = token::BIGINT * 4294967296 + next_token AND next_word = word),
        best AS (SELECT word AS best_word, min(rank) AS best FROM ranked GROUP BY word),
        placed AS (
            SELECT word, pos, token, merged, rank, best, lag(rank) OVER (ORDER BY word, pos) AS before
            FROM ranked JOIN best ON word = best_word)
        SELECT word, pos, CASE WHEN rank = best THEN merged ELSE token END, best IS NULL
        FROM placed WHERE best IS NULL OR before IS DISTINCT FROM best)
    )
    SELECT word, token FROM state WHERE done ORDER BY word, pos
"""
CONCATENATE = """
    SELECT document, unhex(string_agg(digits, '' ORDER BY pos)) AS bytes
    FROM tokens JOIN vocabulary USING (id) GROUP BY document
"""


def space_aware(pattern: str) -> regex.Pattern:
    """The pattern with \\s as Unicode white space."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


class Bpe:
    """A vocabulary file (base64 token and rank a line) with its tables in an own DuckDB database."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = space_aware(pattern)
        self._con = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": tempfile.mkdtemp(prefix="bpe-")})
        merges = [
            (first, second, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (first := self.ranks.get(token[:cut])) is not None and (second := self.ranks.get(token[cut:])) is not None
        ]
        first, second, rank = (np.array(c, np.int64) for c in zip(*merges, strict=True))
        self._table("merges", pair=first * (1 << 32) + second, merged=rank.astype(np.int32))
        self._table("vocabulary", id=np.array(list(self.ranks.values()), np.int32), digits=pa.array([t.hex() for t in self.ranks]))
        self._single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.cache = WordCache(self._encode_words)

    def _table(self, name: str, **columns: np.ndarray | pa.Array) -> None:
        self._con.register("given", pa.table(columns))
        self._con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self._con.unregister("given")

    def _ask(self, query: str, name: str, **columns: np.ndarray) -> dict[str, np.ndarray]:
        self._con.register(name, pa.table(columns))
        try:
            return self._con.execute(query).fetchnumpy()
        finally:
            self._con.unregister(name)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for start in range(0, len(words), WORDS_AT_ONCE):
            data = [w.encode() for w in words[start : start + WORDS_AT_ONCE]]
            n = np.array([len(x) for x in data])
            token = self._single[np.frombuffer(b"".join(data), np.uint8)]
            word = np.repeat(np.arange(len(data), dtype=np.int32), n)
            pos = np.arange(len(token), dtype=np.int64) - np.repeat(np.cumsum(n) - n, n)
            found = self._ask(CONTRACT, "bytes_of", word=word, pos=pos, token=token)
            ids.append(found["token"].astype(np.int32))
            sizes.append(np.bincount(found["word"], minlength=len(data)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _words(self, chunk: str, lead: str) -> list[str]:
        bare, mark = cut_mark(chunk)
        words = [lead + bare] if bare.isalpha() else self.pattern.findall(lead + bare)
        return [*words, mark] if mark else words

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        split = pc.split_pattern(texts, " ")
        codes, chunks = coded(split.flatten())
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        odd_chunk = np.array([not c or c.strip(SPACE) != c for c in chunks], dtype=bool)
        odd = np.add.reduceat(odd_chunk[codes], offsets[:-1]) > 0 if len(codes) else np.zeros(0, bool)
        parts = [self._words(c, " ") if not o else [] for c, o in zip(chunks, odd_chunk, strict=True)]
        variants, firsts = codes.copy(), offsets[:-1]
        for row, first in enumerate(firsts):
            variants[first] = len(parts)
            text = texts[row].as_py()
            parts.append(self.pattern.findall(text) if odd[row] else self._words(chunks[codes[first]], ""))
        inside = np.ones(len(variants), dtype=bool)
        for row in np.flatnonzero(odd):  # such a text is one part, in the place of its first
            inside[offsets[row] + 1 : offsets[row + 1]] = False
        places = self.cache.lookup([w for part in parts for w in part])
        counts = np.array([len(p) for p in parts], np.int64)
        starts = np.cumsum(counts) - counts
        used = variants[inside]
        n = counts[used]
        ends = np.cumsum(n)
        sequence = places[np.repeat(starts[used] - (ends - n), n) + np.arange(n.sum())]
        ids, sizes = self.cache.gather(sequence)
        per_part = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])]
        per_text = per_part[np.concatenate([[0], np.cumsum(inside)])[offsets]]
        return [ids[a:b] for a, b in zip(per_text[:-1], per_text[1:], strict=True)]

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        out = [b""] * len(texts)
        sizes = np.array([len(x) for x in texts], np.int64)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        ids = np.concatenate(texts).astype(np.int32) if len(texts) else np.zeros(0, np.int32)
        for start in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[start : start + DECODED_AT_ONCE]
            pos = np.arange(len(part), dtype=np.int32)
            found = self._ask(CONCATENATE, "tokens", document=owner[start : start + DECODED_AT_ONCE], pos=pos, id=part)
            for row, data in zip(found["document"], found["bytes"], strict=True):
                out[row] += bytes(data)
        return out


def loaded(path: str, pattern: str) -> Bpe:
    """One a worker process."""
    return per_worker(f"bpe {path} {pattern}", lambda: Bpe(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(loaded(path, pattern).encode(pa.array(texts, pa.string())))

    return docs.withColumn(ids_col, ids(text_of(text_col)))


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """``rows`` with the bytes of a column of token ids; null ids give no bytes."""

    @F.pandas_udf("binary")
    def data(ids: pd.Series) -> pd.Series:
        return pd.Series(loaded(path, pattern).decode([np.asarray(x, np.int32) for x in ids]))

    return rows.withColumn(bytes_col, data(F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>"))))


def measure(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and the digests of the ids and of the bytes they decode to: one row per document."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids = bpe.encode(batch.column("text"))
            decoded = bpe.decode(ids)
            if any(a != b.as_py().encode() for a, b in zip(decoded, batch.column("text"), strict=True)):
                raise ValueError("decoded bytes differ from the text")
            columns = [
                batch.column("id"),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
