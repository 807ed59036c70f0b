"""Periodic runs of words, by an online sparse dynamic program over diagonals.

A run is a stretch of words in which words ``q`` apart are identical, ``q`` is the smallest
such period, the stretch holds ``MIN_LENGTH`` words and ``MIN_EXPONENT`` periods at least and
no neighbouring word extends it.

Diagonal ``q`` pairs every word with the one ``q`` before it. Each word's earlier
occurrences lengthen the matches of the diagonals they lie on; a match that ends with three
periods or more is a run. Visiting every earlier occurrence would be quadratic in a text that
repeats itself, so a diagonal of ``2**k <= q < 2**(k+1)`` is visited at every ``2**k``-th word
only: a match of three periods holds three such places in a row. What has three is looked at a few other places, then walked at
half the step again and again, down to every word, which leaves exact matches. A match inside
a run already emitted, whose period divides the diagonal, is that run again and is passed
over. So a text of n words costs O(n log n) steps, whatever it repeats, and all texts of a
batch go through each step together.

Defined results: a null text is an empty one, with no run and an empty collapsed text; texts
are never cut; every row gives one row, repeated rows and null ids too; an empty table gives
none. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.llm.common import slices, text_of

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Parts of a step at which a likely match is looked at before its step is halved.
OFFSETS = (0.24, 0.38, 0.62, 0.85)
SPACES = r"[\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) per row.

    ``runs`` are sorted by start, then period, in words from 0. ``collapsed`` is the text, its
    words joined by one space, without the words that a run holds after its first period.
    """
    texts = docs.select(F.col(id_col).alias("row_id"), text_of(text_col).alias("text"))
    kind = texts.schema["row_id"].dataType.simpleString()
    found = texts.mapInArrow(_detect, f"row_id {kind}, n_words bigint, runs {RUNS}, collapsed string")
    return found.select(F.col("row_id").alias(id_col), "n_words", "runs", "collapsed")


def longest(runs: str = "runs") -> Column:
    """The run of greatest length; of equals the one that starts first, then the least period."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(ranked)
    return F.when(
        best.isNotNull(),
        F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period")),
    )


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        lists = pc.split_pattern_regex(batch.column("text"), SPACES)
        words = lists.flatten()
        real = pc.not_equal(words, "")
        doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
        words = words.filter(real)
        codes = pc.dictionary_encode(words)
        sizes = np.bincount(doc, minlength=batch.num_rows)
        key = doc * (len(codes.dictionary) + 1) + codes.indices.to_numpy()
        start, stop, period = runs_of(key, int(sizes.max(initial=0)))
        first = np.cumsum(sizes) - sizes
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_id"),
                pa.array(sizes, pa.int64()),
                _listed(doc[start], start - first[doc[start]], stop - start, period, batch.num_rows),
                _collapsed(words, doc, start + period, stop, batch.num_rows),
            ],
            names=["row_id", "n_words", "runs", "collapsed"],
        )


def _offsets(doc: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=rows))]), pa.int32())


def _listed(doc: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray, rows: int) -> pa.Array:
    order = np.lexsort((period, start, doc))
    parts = [pa.array(part[order], pa.int64()) for part in (start, length, period)]
    return pa.ListArray.from_arrays(_offsets(doc, rows), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))


def _collapsed(words: pa.Array, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, rows: int) -> pa.Array:
    """The words outside all [start, stop), joined again text by text."""
    depth = np.zeros(len(doc) + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, stop, -1)
    stays = np.cumsum(depth[:-1]) == 0
    kept = pa.ListArray.from_arrays(_offsets(doc[stays], rows), words.filter(pa.array(stays)))
    return pc.binary_join(kept, " ")


def runs_of(key: np.ndarray, longest_text: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of all runs of a line of words, equal words of a text having equal keys.

    Texts stand one after the other and share no key, so no match crosses them.
    """
    order = np.argsort(key, kind="stable")
    base = len(key) + 1
    place = key[order] * base + order
    starts, stops, periods = (np.zeros(0, np.int64) for _ in range(3))
    step = 1
    while MIN_EXPONENT * step <= longest_text:
        lag, low, high = _probed(order, key, place, base, step)
        lag, low, high = _fresh(lag, low, high, starts, stops, periods, step)
        lag, low, high = _exact(key, lag, low, high, step)
        whole = high - low + 1 + lag >= np.maximum(MIN_LENGTH, MIN_EXPONENT * lag)
        starts = np.concatenate([starts, (low - lag)[whole]])
        stops = np.concatenate([stops, high[whole] + 1])
        periods = np.concatenate([periods, lag[whole]])
        step *= 2
    by = np.lexsort((periods, stops, starts))
    starts, stops, periods = starts[by], stops[by], periods[by]
    # The same stretch under a multiple of its period comes after it.
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1]) | (stops[1:] != stops[:-1])
    return starts[new], stops[new], periods[new]


def _joined(lag: np.ndarray, at: np.ndarray, step: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lag, first, last) of stretches of ``least`` places or more, ``step`` apart, on one diagonal."""
    by = np.lexsort((at, lag))
    lag, at = lag[by], at[by]
    apart = np.ones(len(lag) + 1, bool)
    apart[1:-1] = (lag[1:] != lag[:-1]) | (at[1:] - at[:-1] != step)
    edges = np.flatnonzero(apart)
    first, last = edges[:-1], edges[1:] - 1
    enough = last - first + 1 >= least
    return lag[first[enough]], at[first[enough]], at[last[enough]]


def _probed(order: np.ndarray, key: np.ndarray, place: np.ndarray, base: int, step: int):
    """Three places in a row on a diagonal of ``step <= lag < 2 * step``, among every ``step``-th word."""
    probe = order[(order & (step - 1)) == 0]
    row = key[probe] * base
    low = np.searchsorted(place, row + np.maximum(probe - 2 * step + 1, 0))
    high = np.searchsorted(place, row + probe - step, side="right")
    count = np.where(probe >= step, np.maximum(high - low, 0), 0)
    at = np.repeat(probe, count)
    earlier = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(at))]
    return _joined(at - earlier, at, step, 3)


def _fresh(lag, low, high, starts, stops, periods, step: int):
    """What no run holds whose period divides the lag.

    A run that could hold such a match has four steps' length at least. Two runs of that
    length and of periods below a step share less than two steps, so at a place there are two
    of them at most, neighbours by their starts.
    """
    large = np.flatnonzero(stops - starts >= MIN_EXPONENT * step)
    if not len(large) or not len(lag):
        return lag, low, high
    large = large[np.lexsort((periods[large], starts[large]))]
    # Of one stretch only the smallest period is kept.
    same = np.zeros(len(large), bool)
    same[1:] = (starts[large][1:] == starts[large][:-1]) & (stops[large][1:] == stops[large][:-1])
    large = large[~same]
    near = np.searchsorted(starts[large], low - lag, side="right") - 1
    held = np.zeros(len(lag), bool)
    for back in (0, 1):
        run = large[np.maximum(near - back, 0)]
        held |= (near - back >= 0) & (stops[run] > high) & (lag % periods[run] == 0)
    return lag[~held], low[~held], high[~held]


def _exact(key: np.ndarray, lag, low, high, step: int):
    """Keep what still matches for three steps at other places, then at half the step, down to 1."""
    whole = 3 * step
    # Words that are alike by chance at every visited place seldom are at the next few offsets, too.
    for offset in sorted({int(step * part) | 1 for part in OFFSETS}) if step > 1 else ():
        lag, low, high = _walked(key, lag, low - step + offset, high + offset, step, whole)
    while step > 1:
        step //= 2
        lag, low, high = _walked(key, lag, low - step, high + step, step, whole)
    return lag, low, high


def _walked(key: np.ndarray, lag, low, high, step: int, whole: int):
    """The stretches of ``whole`` words or more that match at every ``step``-th place from low to high."""
    low = np.where(low >= lag, low, low + step)
    high = np.where(high < len(key), high, high - step)
    count = (high - low) // step + 1
    index = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at, q = np.repeat(low, count) + step * index, np.repeat(lag, count)
    hit = key[at] == key[at - q]
    return _joined(q[hit], at[hit], step, whole // step)
