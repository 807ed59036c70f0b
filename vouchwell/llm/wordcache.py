"""Token ids of many texts from a bounded cache of the ids of their words.

``WordCache`` keeps words as Python strings. ``WordTable`` holds them end to end in one Arrow array and looks a
whole batch up in one call. Most distinct words of a corpus occur once, so it keeps a word from its second lookup
on only: less memory, for a second encoding of the words it keeps. Which words were seen before is told by a table
of marks at their hashes, where a collision keeps a word early.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 1_000_000
#: Places for marks, a byte each; with half as many marks set they are wiped.
MARKED = 1 << 22
#: A trailing mark after a letter is a word of its own for every tokenizer used here.
MARKS = frozenset(".,;:!?")

Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]  # words -> (ids end to end, ids per word)


class WordCache:
    """Ids of words; a full cache starts anew, which costs time and changes no result."""

    def __init__(self, encode: Encode, most: int = CACHE_WORDS) -> None:
        self._encode, self._most = encode, most
        self._clear()

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._ids = np.zeros(1 << 16, np.int32)
        self._starts, self._sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._used = 0

    @staticmethod
    def _room(values: np.ndarray, needed: int) -> np.ndarray:
        if needed <= len(values):
            return values
        grown = np.zeros(max(needed, 2 * len(values)), values.dtype)
        grown[: len(values)] = values
        return grown

    def lookup(self, words: list[str]) -> np.ndarray:
        """Places of the words, valid until the next lookup."""
        if len(self._index) > self._most:
            self._clear()
        index = self._index
        new = list(dict.fromkeys(w for w in words if w not in index))
        if new:
            ids, sizes = self._encode(new)
            n, used = len(index), self._used
            self._ids = self._room(self._ids, used + len(ids))
            self._ids[used : used + len(ids)] = ids
            self._starts, self._sizes = self._room(self._starts, n + len(new)), self._room(self._sizes, n + len(new))
            self._starts[n : n + len(new)] = used + np.cumsum(sizes) - sizes
            self._sizes[n : n + len(new)] = sizes
            self._used = used + len(ids)
            index.update(zip(new, range(n, n + len(new)), strict=True))
        return np.fromiter((index[w] for w in words), np.int64, len(words))

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, ids per place)."""
        return _gathered(self._ids, self._starts, self._sizes, places)


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = sizes[places]
    ends = np.cumsum(sizes)
    steps = np.repeat(starts[places] - (ends - sizes), sizes)
    return ids[steps + np.arange(len(steps))], sizes


class WordTable:
    """Ids of words, kept from their second lookup on; a full table starts anew, which costs time and changes no result."""

    def __init__(self, encode: Encode, most: int = CACHE_WORDS) -> None:
        self._encode, self._most = encode, most
        self._words = pa.array([], pa.string())
        self._ids, self._starts, self._sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._kept = 0  # the words behind these go with the next lookup
        self._seen, self._marks = np.zeros(MARKED, bool), 0

    @property
    def _index(self) -> dict[str, int]:
        """The words kept, with their places."""
        return {word: n for n, word in enumerate(self._words.slice(0, self._kept).to_pylist())}

    def _again(self, words: list[str]) -> np.ndarray:
        """Which of the distinct words a lookup had before. Marks them all."""
        if self._marks > MARKED // 2:
            self._seen[:] = False
            self._marks = 0
        at = np.fromiter(map(hash, words), np.int64, len(words)) & (MARKED - 1)
        again = self._seen[at]
        self._seen[at] = True
        self._marks += len(words) - int(again.sum())
        return again

    def lookup(self, words: pa.Array | list[str]) -> np.ndarray:
        """Places of distinct words, valid until the next lookup."""
        words = pa.array(words, pa.string()) if isinstance(words, list) else words.cast(pa.string())
        kept = self._kept if self._kept <= self._most else 0
        used = int(self._starts[kept]) if kept < len(self._starts) else len(self._ids)
        held = pc.index_in(words, value_set=self._words.slice(0, kept))
        found = held.fill_null(0).to_numpy().astype(np.int64)
        missing = np.flatnonzero(held.is_null().to_numpy(zero_copy_only=False))
        again = self._again(words.take(pa.array(missing)).to_pylist())
        missing = missing[np.argsort(~again, kind="stable")]  # words to keep first
        new = words.take(pa.array(missing))
        ids, sizes = self._encode(new.to_pylist())
        found[missing] = kept + np.arange(len(missing))
        self._words = pa.concat_arrays([self._words.slice(0, kept), new])
        self._starts = np.concatenate([self._starts[:kept], used + np.cumsum(sizes) - sizes])
        self._ids, self._sizes = np.concatenate([self._ids[:used], ids]), np.concatenate([self._sizes[:kept], sizes])
        self._kept = kept + int(again.sum())
        return found

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, ids per place)."""
        return _gathered(self._ids, self._starts, self._sizes, places)


def cut_marks(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """What ``cut_mark`` gives for each word."""
    cut = pc.match_substring_regex(words, r"[A-Za-z][.,;:!?]$").to_numpy(zero_copy_only=False).copy()
    other = np.flatnonzero(pc.match_substring_regex(words, r"[^\x00-\x7F][.,;:!?]$").to_numpy(zero_copy_only=False))
    cut[other] = [bool(cut_mark(w)[1]) for w in words.take(pa.array(other)).to_pylist()]
    mask, whole = pa.array(cut), words.filter(pa.array(cut))
    bare = pc.replace_with_mask(words, mask, pc.utf8_slice_codeunits(whole, 0, -1))
    return bare, pc.replace_with_mask(pa.array([""] * len(words), words.type), mask, pc.utf8_slice_codeunits(whole, -1))


def cut_mark(word: str) -> tuple[str, str]:
    """The word without a trailing mark that follows a letter, and that mark or nothing."""
    if len(word) > 1 and word[-1] in MARKS and word[-2].isalpha():
        return word[:-1], word[-1]
    return word, ""


def coded(chunks: pa.Array) -> tuple[np.ndarray, list[str]]:
    """(code per chunk, distinct chunks)."""
    held = pc.dictionary_encode(chunks)
    return held.indices.to_numpy(zero_copy_only=False), held.dictionary.to_pylist()
