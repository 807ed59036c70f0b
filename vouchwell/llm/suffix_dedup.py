"""Removal of long repeated byte strings by suffix sorting around sampled anchors.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Every
window of that length has one anchor, the leftmost smallest hash of its ``GRAM``-byte strings,
so equal windows have equal anchors at equal distances, and about one position in 150 is one.

1. Anchors are counted by the hash of their own string. One that is alone in the corpus
   proves all its windows unique.
2. The windows of an anchor are consecutive; their joint string is the anchor's run. A run
   that occurs more than once is settled: all its windows repeat.
3. What is left are the ends of repeated passages: runs that differ though their anchors are
   equal. One text of each distinct run is read. For each anchor the texts after it and the
   reversed texts before it are deep-shallow sorted (``suffix_sort``): common prefixes in the
   two orders say how far any two runs agree on both sides, and so which windows repeat.
4. An anchor with more than ``MOST_RUNS`` distinct runs is not collected: each of its windows
   becomes a row, and rows are counted by hash, for any number of them.

Hashes have 64 bits and are joined with the anchor's own.

With ``words`` all of this counts words in place of bytes: a word is what stands between ASCII
white space, and a Chinese or Japanese character (U+3000 to U+9FFF) is one of its own. Words
are compared by 64-bit hash, whatever white space stands between them; what goes reaches from
the first byte of the first word to the last byte of the last.

Defined results: null text counts as empty; texts shorter than ``length`` keep all bytes;
matches within a document count; rows that repeat a text lose it where it has ``length``
bytes; an empty table gives an empty result; other columns are kept by ``remove``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.llm.common import BATCH_ROWS, PIECE_CHARS, batches_of, slices, text_of
from vouchwell.llm.suffix_sort import deep_shallow
from vouchwell.storage import broadcast_if_small, materialize

LENGTH = 400
GRAM = 100
MOST_RUNS = 4_096
PAIRWISE = 64

_U = np.uint64
_SPACES = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
WORD_BYTES = 8
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE_BITS = 20
_PIECE = 1 << _PLACE_BITS
_TABLE = np.random.default_rng(408).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _both_powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.append(np.ones(1, _U), np.full(size - 1, x, _U)), dtype=_U) for x in (_BASE, _INVERSE)]
    return _powers


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, np.iinfo(_U).max, _U)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _places(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, starts, ends) of the words of a text, by pieces that end at white space."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            cut = max(text.rfind(x, at, end) for x in _SPACES)
            cuts = [cut] if cut > at else [x for x in (text.find(x, end) for x in _SPACES) if x >= 0]
            end = min(cuts, default=len(text))
        yield _piece_words(text[at:end], at)
        at = end


def _piece_words(text: bytes, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    real = (data != 32) & ((data < 9) | (data > 13))
    lead = (data >= 0xE3) & (data <= 0xE9)
    alone = lead.copy()
    alone[1:] |= lead[:-1]
    alone[2:] |= lead[:-2]
    fresh = real & (lead | np.append(True, ~real[:-1] | (alone[:-1] & ~alone[1:])))
    starts = np.flatnonzero(fresh)
    if not len(starts):
        return np.zeros(0, _U), starts, starts
    ends = np.flatnonzero(real & np.append(~real[1:] | fresh[1:], True)) + 1
    far = np.arange(len(data)) - starts[np.maximum(np.cumsum(fresh) - 1, 0)]
    far[~real] = 0
    values = np.where(real, _TABLE[data], _U(0)) * _both_powers(int(far.max()) + 1)[0][far]
    hashes = _mix(np.add.reduceat(values, starts) + (ends - starts).astype(_U)) | _U(1)
    return hashes, starts + offset, ends + offset


def _units(text: bytes, words: bool) -> bytes | np.ndarray:
    """What is counted: the bytes themselves, or the hashes of the words."""
    if not words:
        return text
    return np.concatenate([np.zeros(0, _U), *(x[0] for x in _places(text))])


def _numbers(units: bytes | np.ndarray) -> np.ndarray:
    return _TABLE[np.frombuffer(units, np.uint8)] if isinstance(units, bytes) else units


def anchors(text: bytes | np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """[position, first and last window start, hash of the anchor, hash of the run] of a text's anchors."""
    found = [_piece_anchors(text[a : a + _PIECE], a, length, gram) for a in range(0, max(len(text) - length + 1, 0), _PIECE - length + 1)]
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5


def _piece_anchors(text: bytes | np.ndarray, offset: int, length: int, gram: int) -> list[np.ndarray]:
    n = len(text)
    up, down = _both_powers(n + 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_numbers(text) * up[:n], dtype=_U)])
    hashes = _mix((sums[gram:] - sums[: n + 1 - gram]) * down[: n + 1 - gram])
    place = np.arange(len(hashes), dtype=_U)
    low = _U(_PIECE - 1)
    best = (_sliding_min((hashes & ~low) | place, length - gram + 1) & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    last = np.append(first[1:], len(best)) - 1
    at = best[first]
    run = _mix((sums[last + length] - sums[first]) * down[first])
    run = _mix(run + _mix(((at - first) * length + (at - last)).astype(_U)))
    return [at + offset, first + offset, last + offset, hashes[at].view(np.int64), run.view(np.int64)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with two hashes of id and text, which name a row wherever it is read again."""
    rows = docs.withColumn("__text", F.encode(text_of(text_col), "UTF-8"))
    return rows.withColumns({"__key": F.xxhash64(id_col, "__text"), "__print": F.xxhash64("__text", id_col)})


def _all_anchors(rows: DataFrame, length: int, gram: int, words: bool) -> DataFrame:
    names = ["key", "print", "at", "first", "last", "anchor", "run"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_CHARS):
            found = [anchors(_units(x.as_buffer().to_pybytes(), words), length, gram) for x in batch.column("text")]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found]))
            columns = [batch.column(c).take(owner) for c in ("key", "print")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.concatenate(c)) for c in zip(*found, strict=True))], names)

    text = rows.select(F.col("__key").alias("key"), F.col("__print").alias("print"), F.col("__text").alias("text"))
    with batches_of(rows.sparkSession, BATCH_ROWS):
        return materialize(text.mapInArrow(find, ", ".join(f"{c} long" for c in names)), "anchors")


def repeated_windows(runs: list[bytes], heads: list[int], length: int, unit: int = 1) -> list[list[tuple[int, int]]]:
    """For runs with one anchor: ranges of distances (window start to anchor) whose windows another run has.

    ``heads`` is how many units, of ``unit`` bytes each, of a run lie before its anchor.
    """
    after = [run[head * unit :] for run, head in zip(runs, heads, strict=True)]
    before = [run[: head * unit][::-1] for run, head in zip(runs, heads, strict=True)]
    sorted_after, shared_after = deep_shallow(after)
    sorted_before, shared_before = deep_shallow(before)
    shared_after, shared_before = ([n // unit for n in x] for x in (shared_after, shared_before))
    g = len(runs)
    if g <= PAIRWISE:
        ahead, back = _pairwise(sorted_after, shared_after), _pairwise(sorted_before, shared_before)
        found = []
        for i in range(g):
            pairs = sorted((length - ahead[i][j], back[i][j]) for j in range(g) if j != i and length - ahead[i][j] <= back[i][j])
            found.append(_merged(pairs))
        return found
    found = [[] for _ in range(g)]
    drop_after, drop_before = np.array(shared_after), np.array(shared_before)
    for k in range(max(heads) + 1):
        one, two = np.empty(g, np.int64), np.empty(g, np.int64)
        one[sorted_after] = np.cumsum(drop_after < length - k)
        two[sorted_before] = np.cumsum(drop_before < k)
        fits = np.array([len(a) >= (length - k) * unit and len(b) >= k * unit for a, b in zip(after, before, strict=True)])
        _, kind, count = np.unique(one * (g + 1) + two, return_inverse=True, return_counts=True)
        # Rows too short for this distance share no class of that depth with another.
        for i in np.flatnonzero((count[kind] > 1) & fits):
            if found[i] and found[i][-1][1] == k - 1:
                found[i][-1] = (found[i][-1][0], k)
            else:
                found[i].append((k, k))
    return found


def _pairwise(order: list[int], shared: list[int]) -> list[list[int]]:
    g = len(order)
    out = [[0] * g for _ in range(g)]
    for a in range(g):
        least = 1 << 60
        for b in range(a + 1, g):
            least = min(least, shared[b])
            out[order[a]][order[b]] = out[order[b]][order[a]] = least
    return out


def _merged(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in pairs:
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _among(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows that a written table names, or with "left_anti" the others; only its keys are ever broadcast."""
    return rows.join(broadcast_if_small(table.select(*keys)), keys, how)


def _run_texts(rows: DataFrame, wanted: DataFrame, length: int, words: bool) -> DataFrame:
    """``wanted`` (key, print, at, first, last, anchor, run, times) with the bytes or word hashes of each run, written."""
    held = ["at", "first", "last", "anchor", "run", "times"]
    per_doc = materialize(wanted.groupBy("key", "print").agg(F.collect_list(F.struct(*held)).alias("runs")), "runs_by_document")
    text = rows.select(F.col("__key").alias("key"), F.col("__print").alias("print"), F.col("__text").alias("text"))
    joined = _among(text, per_doc, ["key", "print"]).join(per_doc, ["key", "print"]).dropDuplicates(["key", "print"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_CHARS):
            out = []
            for key, mark, text, runs in zip(*(batch.column(c).to_pylist() for c in ("key", "print", "text", "runs")), strict=True):
                units = _units(text, words)
                out += [{"key": key, "print": mark, **run, "text": bytes(units[run["first"] : run["last"] + length])} for run in runs]
            yield pa.RecordBatch.from_pylist(out, schema=types)

    types = pa.schema([(c, pa.int64()) for c in ("key", "print", *held)] + [("text", pa.binary())])
    with batches_of(rows.sparkSession, BATCH_ROWS):
        return materialize(joined.mapInArrow(cut, ", ".join(f"{c} long" for c in ("key", "print", *held)) + ", text binary"), "run_texts")


def _sorted_groups(texts: DataFrame, length: int, words: bool) -> DataFrame:
    """(key, print, start, end) of what repeats of runs that occur once, by sorting each anchor's runs."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def ranges(group: list[dict]) -> list[tuple[int, int, int, int]]:
            if len(group) < 2:
                return []
            found = repeated_windows([x["text"] for x in group], [x["at"] - x["first"] for x in group], length, WORD_BYTES if words else 1)
            out = []
            for run, parts in zip(group, found, strict=True):
                if run["times"] == 1:
                    out += [(run["key"], run["print"], run["at"] - far, run["at"] - near + length) for near, far in parts]
            return out

        def batch_of(out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["key", "print", "start", "end"])

        out: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["anchor"] != now:
                    out += ranges(held)
                    held, now = [], row["anchor"]
                held.append(row)
                if len(out) > 50_000:
                    yield batch_of(out)
                    out = []
        out += ranges(held)
        if out:
            yield batch_of(out)

    rows = texts.repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(settle, "key long, print long, start long, end long")


def _counted_windows(texts: DataFrame, length: int, words: bool) -> DataFrame:
    """The same for anchors of any number of runs: a row a window, counted by hash."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                values = _numbers(np.frombuffer(run["text"], _U) if words else run["text"])
                n = len(values)
                up, down = _both_powers(n + 1)
                sums = np.concatenate([np.zeros(1, _U), np.cumsum(values * up[:n], dtype=_U)])
                own = _mix((sums[length:] - sums[: n + 1 - length]) * down[: n + 1 - length]).view(np.int64)
                count = len(own)
                start = run["first"] + np.arange(count)
                fixed = [np.full(count, run[c]) for c in ("key", "print", "anchor", "times")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*fixed, start, run["at"] - start, own)], names)

    names = ["key", "print", "anchor", "times", "start", "distance", "window"]
    rows = materialize(texts.mapInArrow(windows, ", ".join(f"{c} long" for c in names)), "windows")
    same = ["anchor", "distance", "window"]
    several = rows.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1")
    found = rows.where("times = 1").join(several, same, "left_semi")
    return found.select("key", "print", "start", (F.col("start") + length).alias("end"))


def repeats(rows: DataFrame, length: int, gram: int, most_runs: int, words: bool = False) -> DataFrame:
    """(key, print, start, end): ranges of bytes or words that go; they may overlap."""
    found = _all_anchors(rows, length, gram, words)
    example = F.min(F.struct("key", "print", "at", "first", "last")).alias("example")
    runs = materialize(found.groupBy("anchor", "run").agg(F.count("*").alias("times"), example), "runs")
    several = runs.where("times > 1").select("anchor", "run")
    settled = found.join(several, ["anchor", "run"]).select("key", "print", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    kinds = runs.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("times").alias("least")).where("kinds > 1 AND least = 1")
    wanted = runs.join(kinds.drop("least"), "anchor").select("anchor", "run", "times", "kinds", "example.*")
    wanted = materialize(wanted, "open_runs")
    texts = _run_texts(rows, wanted.drop("kinds"), length, words)
    hot = materialize(wanted.where(F.col("kinds") > most_runs).select("anchor").distinct(), "hot_anchors")
    out = settled.unionByName(_sorted_groups(texts.join(broadcast_if_small(hot), "anchor", "left_anti"), length, words))
    if hot.head(1):
        out = out.unionByName(_counted_windows(texts.join(broadcast_if_small(hot), "anchor", "left_semi"), length, words))
    return out


def _ranges(rows: DataFrame, length: int, gram: int, most_runs: int, words: bool) -> DataFrame:
    """(__key, __print, __ranges) of the texts that repeat something, written."""
    ranges = repeats(rows, length, gram, most_runs, words).groupBy("key", "print").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__ranges")
    )
    return materialize(ranges.withColumnsRenamed({"key": "__key", "print": "__print"}), "ranges")


def _covered(ranges: str) -> Column:
    """How many places sorted ranges cover."""
    start = F.struct(F.lit(-1).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(seen: Column, r: Column) -> Column:
        new = F.greatest(r["end"] - F.greatest(r["start"], seen["end"]), F.lit(0))
        return F.struct(F.greatest(r["end"], seen["end"]).alias("end"), (seen["total"] + new).alias("total"))

    return F.aggregate(ranges, start, add, lambda seen: seen["total"])


def _with_ranges(
    docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, most_runs: int, words: bool = False
) -> DataFrame:
    rows = _keyed(docs, id_col, text_col)
    ranges = _ranges(rows, length, gram, most_runs, words)
    keys = ["__key", "__print"]
    untouched = _among(rows, ranges, keys, "left_anti").withColumn("__ranges", F.lit(None).cast(ranges.schema["__ranges"].dataType))
    return _among(rows, ranges, keys).join(ranges, keys).unionByName(untouched)


def _kept(text: bytes, ranges: list[dict] | None, words: bool = False) -> tuple[bytes, int, int]:
    """(what stays, bytes removed, maximal removed runs)."""
    spans: list[list[int]] = []
    for span in ranges if ranges is not None else ():
        if spans and span["start"] <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], span["end"])
        else:
            spans.append([span["start"], span["end"]])
    if not spans:
        return text, 0, 0
    if words:
        starts, ends = (np.concatenate(c) for c in list(zip(*_places(text), strict=True))[1:])
        spans = [[int(starts[a]), int(ends[b - 1])] for a, b in spans]
    cuts = [0, *(x for span in spans for x in span), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
    return kept, len(text) - len(kept), len(spans)


def measure(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    gram: int = GRAM,
    most_runs: int = MOST_RUNS,
    passage: int | None = None,
    passage_gram: int = 13,
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256: one row per document.

    With ``passage`` also repeated_words, how many words lie in stretches of so many that occur
    again in any spacing, and has_passage, whether there are any; they change no other column.
    """
    rows = _with_ranges(docs.select(id_col, text_col), id_col, text_col, length, gram, most_runs)
    rows = rows.select(F.col(id_col).alias("id"), F.col("__text").alias("text"), F.col("__ranges").alias("ranges"), "__key", "__print")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_CHARS):
            out = [(text, *_kept(text, ranges)) for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True)]
            columns = [
                *(batch.column(c) for c in ("id", "__key", "__print")),
                pa.array([len(x[0]) for x in out], pa.int64()),
                pa.array([x[2] for x in out], pa.int64()),
                pa.array([x[3] for x in out], pa.int64()),
                pa.array([hashlib.sha256(x[1]).hexdigest() for x in out], pa.string()),
            ]
            names = ["id", "__key", "__print", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)

    out = rows.mapInArrow(run, f"id {kind}, __key long, __print long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    found = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if passage is not None:
        texts = _keyed(docs.select(id_col, text_col), id_col, text_col)
        repeated = _ranges(texts, passage, passage_gram, most_runs, words=True)
        repeated = repeated.select("__key", "__print", _covered("__ranges").alias("repeated_words"))
        out = out.join(repeated, ["__key", "__print"], "left")
        out = out.withColumn("repeated_words", F.coalesce("repeated_words", F.lit(0)))
        out = out.withColumn("has_passage", F.col("repeated_words") > 0)
        found += ["repeated_words", "has_passage"]
    return out.select(F.col("id").alias(id_col), *found)


def remove(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str | None = None,
    gram: int = GRAM,
    most_runs: int = MOST_RUNS,
    words: bool = False,
) -> DataFrame:
    """``docs`` with repeated bytes removed from the texts; what a cut leaves of a character goes too.

    With ``words``, ``length`` and ``gram`` are numbers of words. With ``chars_col`` that column follows the number of characters of a changed text.
    """
    rows = _with_ranges(docs, id_col, text_col, length, gram, most_runs, words)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([_kept(t, r, words)[0].decode("utf-8", "ignore") for t, r in zip(texts, ranges, strict=True)])

    changed = F.col("__ranges").isNotNull()
    new = {text_col: F.when(changed, kept("__text", "__ranges")).otherwise(F.col(text_col))}
    if chars_col is not None:
        new[chars_col] = F.when(changed, F.length(new[text_col])).otherwise(F.col(chars_col)).cast(docs.schema[chars_col].dataType)
    return rows.withColumns(new).select(*docs.columns)
