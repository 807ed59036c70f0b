"""Word-order-free text similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def sorted_words(text: Column) -> Column:
    """Words in sorted order joined by one blank; a missing text reads 'nan'."""
    spaced = F.trim(F.regexp_replace(F.coalesce(text, F.lit("nan")), r"(?U)\s+", " "))
    return F.array_join(F.array_sort(F.split(spaced, " ")), " ")


WORD_BITS = 64
#: Bytes that the letter masks of one batch may take.
MASK_BYTES = 32 << 20


def _codes(texts: list[str], sizes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of letters in ``known``, one row per text; behind a text's end, and for others, its length."""
    letters = np.array(texts, dtype=f"U{max(int(sizes.max()), 1)}").view(np.uint32).reshape(len(texts), -1)
    place = np.searchsorted(known, letters)
    inside = np.arange(letters.shape[1]) < sizes[:, None]
    found = inside & (known[np.minimum(place, len(known) - 1)] == letters)
    return np.where(found, place, len(known))


def _batch_common_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Longest common subsequences, one bit per letter of ``a`` (Hyyro 2004), a step per letter of ``b``.

    Texts longer than a machine word take several, and sums carry from one to the next.
    """
    sizes, others = (np.array([len(t) for t in side], np.int64) for side in (a, b))
    known = np.unique(np.array(sorted(set().union(*a)) or ["\0"], dtype="U1").view(np.uint32))
    words = -(-int(sizes.max(initial=1)) // WORD_BITS) or 1
    rows = np.arange(len(a))
    masks = np.zeros((len(a), len(known) + 1, words), np.uint64)
    left = _codes(a, sizes, known)
    for i in range(left.shape[1]):
        held = rows[i < sizes]
        masks[held, left[held, i], i // WORD_BITS] |= np.uint64(1 << (i % WORD_BITS))
    full = np.bitwise_or.reduce(masks, axis=1)
    masks[:, -1] = 0
    open_ = full.copy()
    for code in _codes(b, others, known).T:
        places = masks[rows, code]
        total = open_ + (open_ & places)
        carry = (total < open_)[:, :-1]
        while carry.any():
            above = total[:, 1:] + carry
            carry = np.concatenate([np.zeros((len(a), 1), bool), above < total[:, 1:]], axis=1)[:, :-1]
            total[:, 1:] = above
        open_ = (total | (open_ & ~places)) & full
    return (sizes - np.bitwise_count(open_).sum(axis=1)).astype(np.int32)


def _common_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    """The subsequence is as long either way round, so the shorter text gives the bits."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    found = np.zeros(len(pairs), np.int32)
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
    start = 0
    while start < len(order):
        stop, letters = start, set()
        while stop < len(order):
            letters |= set(pairs[order[stop]][0])
            words = len(pairs[order[stop]][0]) // WORD_BITS + 1
            if stop > start and (stop - start) * (len(letters) + 1) * words * 8 > MASK_BYTES:
                break
            stop += 1
        part = order[start:stop]
        found[part] = _batch_common_lengths(*map(list, zip(*[pairs[i] for i in part])))
        start = stop
    return pd.Series(found)


# Marked non-deterministic so that a filter on the score does not compute it twice.
common_subsequence_length = F.pandas_udf(_common_lengths, IntegerType()).asNondeterministic()


def similarity(a: Column, b: Column) -> Column:
    """0 to 100: twice the common subsequence over both lengths. Equal texts give 100."""
    return F.when(a == b, F.lit(100.0)).otherwise(
        200.0 * common_subsequence_length(a, b) / (F.length(a) + F.length(b))
    )
