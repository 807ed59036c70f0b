import hashlib
import random
import zlib

import numpy as np
import pytest

from vouchwell.llm import periodic_runs, queries


def runs_by_hand(words):
    """Every maximal stretch with its smallest period, from all diagonals."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            start = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i > start and i - start + q >= max(6, 4 * q):
                found.setdefault((start - q, i), q)
            i = max(i, start + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def repetitive(draw, parts):
    words = []
    for _ in range(draw.randint(0, parts)):
        unit = [f"w{draw.randint(0, draw.choice([1, 2, 6]))}" for _ in range(draw.randint(1, draw.choice([2, 5, 20])))]
        words += unit * draw.randint(1, 9) + unit[: draw.randint(0, len(unit))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_diagonals(seed):
    draw = random.Random(seed)
    for _ in range(400):
        texts = [repetitive(draw, 6) for _ in range(draw.randint(1, 4))]
        key = np.array([hash((d, w)) for d, text in enumerate(texts) for w in text], np.int64)
        _, key = np.unique(key, return_inverse=True) if len(key) else (None, key)
        found = zip(*periodic_runs.runs_of(key, max(map(len, texts))), strict=True)
        first = np.cumsum([0, *map(len, texts)])
        expected = [(a + s, a + s + n, q) for a, text in zip(first, texts) for s, n, q in runs_by_hand(text)]
        assert sorted((int(s), int(e), int(p)) for s, e, p in found) == sorted(expected)


@pytest.mark.parametrize(
    "words",
    [np.zeros(300_000), np.arange(300_000) % 7, np.where(np.arange(300_000) % 8 == 0, -1, np.arange(300_000))],
    ids=["one word", "one period", "a word at every eighth place"],
)
def test_long_texts_that_repeat_are_not_quadratic(words):
    starts, stops, periods = periodic_runs.runs_of(words.astype(np.int64), len(words))
    expected = {1: [(0, 300_000, 1)], 7: [(0, 300_000, 7)]}.get(len(np.unique(words)), [])
    assert list(zip(starts, stops, periods)) == expected


def test_detect_keeps_rows_and_collapses(documents, prose):
    long = prose(3, 30_000)
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b a b a b\u000ba b c"), (4, "a b a b a b\u000ba b c"), (None, "x " * 6),
            (5, "a a a a a"), (6, long + " " + "red green " * 4_000), (7, "    x")]
    found = periodic_runs.detect(documents(rows)).collect()
    by_id = {}
    for row in found:
        by_id.setdefault(row["doc_id"], []).append((row["n_words"], [tuple(r) for r in row["runs"]], row["collapsed"]))
    assert len(found) == len(rows)
    assert by_id[1] == by_id[2] == by_id[3] == [(0, [], "")]
    assert by_id[4] == [(9, [(0, 8, 2)], "a b c")] * 2
    assert by_id[None] == [(6, [(0, 6, 1)], "x")]
    assert by_id[5] == [(5, [], "a a a a a")]
    assert by_id[7] == [(3, [], "    x")]
    words, runs, collapsed = by_id[6][0]
    assert words == 38_000 and runs[-1] == (30_000, 8_000, 2) and collapsed.endswith(" red green")
    assert periodic_runs.detect(documents([])).count() == 0


def expected_row(doc_id, text):
    words = (text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_hand(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{m},{q}\n" for s, m, q in runs),
              " ".join(w for i, w in enumerate(words) if i not in dropped))]
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, *digest)


def test_query_equals_brute_force(spark, documents, prose, tmp_path):
    draw = random.Random(5)
    rows = [(i, prose(i, draw.randint(0, 60)) + "\t" + " ".join(repetitive(draw, 4))) for i in range(150)]
    rows += [(i, draw.choice(["", None, "one", "a b", "x x x x x x x"])) for i in range(150, 250)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.periodic_words(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected_row(i, t) for i, t in rows)
