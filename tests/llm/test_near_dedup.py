import random

import numpy as np
import pytest

from vouchwell.llm import near_dedup
from vouchwell.llm.components import components


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, similarity):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= similarity * (len(sets[a]) + len(sets[b]) - shared):
                    up[root(a)] = root(b)
    groups = {}
    for n in range(len(rows)):
        groups.setdefault(root(n), []).append(rows[n][0])
    return [(rows[n][0], len(sets[n]), min((i for i in groups[root(n)] if i is not None), default=None)) for n in range(len(rows))]


def edited(text, draw, share):
    return " ".join(f"x{draw.random()}" if draw.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def rows(prose):
    draw = random.Random(4)
    texts = [prose(n, draw.randint(1, 150)) for n in range(60)]
    rows = [(n, t) for n, t in enumerate(texts)]
    rows += [(100 + n, edited(texts[n % 60], draw, 0.02)) for n in range(90)]
    base = prose(1000, 200)
    rows += [(300 + n, edited(base, draw, draw.choice([0.01, 0.02, 0.03, 0.04]))) for n in range(60)]  # a large group, not all linked
    passage = prose(2000, 60)
    rows += [(400 + n, f"{passage} {prose(3000 + n, 30)}") for n in range(40)]  # a shared passage, no copies
    rows += [(500, None), (501, ""), (502, " \t\r\n\x0b\x0c"), (503, "One"), (504, "one\n"), (505, "one two"), (506, "ÄÖ ü"), (507, "äö ü")]
    rows += [(600, texts[5].upper()), (5, texts[5]), (None, texts[5]), (None, None), (700, prose(5000, 30_000)), (701, prose(5000, 30_000) + " end")]
    return rows


@pytest.mark.parametrize(("width", "small", "tile"), [(4, 8, 256), (5, 2, 7)])
def test_groups_match_brute_force(documents, rows, monkeypatch, width, small, tile):
    """The second case settles nearly all buckets by stars and tiles."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "TILE", tile)
    found = near_dedup.group(documents(rows).repartition(3), width=width).collect()
    expected = brute(rows, width, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == sorted(expected, key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    gone = {i for i, _, c in expected if i != c}
    assert near_dedup.deduplicate(documents(rows), width=width).count() == sum(i not in gone for i, _ in rows)


def test_empty_table(documents):
    assert near_dedup.group(documents([])).count() == 0
    assert near_dedup.deduplicate(documents([])).columns == documents([]).columns


def test_sketches_merge_and_estimate_similarity():
    draw = np.random.default_rng(2)
    x = draw.integers(0, 1 << 63, 6_000, dtype=np.uint64)
    for size in (3, 40, 3_000):
        a, b = x[:size], x[size // 3 : size // 3 + size]
        one, two = near_dedup.sketch(a), near_dedup.sketch(b)
        assert (np.maximum(one, two) == near_dedup.sketch(np.union1d(a, b))).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        n = np.array([size])
        assert abs(near_dedup.estimate(one[None], two[None], n, n)[0] - true) < 0.15


def test_components_of_paths_and_stars(spark):
    edges = [(n, n + 1) for n in range(60)] + [(500 + n, 499) for n in range(40)] + [(900, 900), (800, 799), (799, 800)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {found[n] for n in range(61)} == {0} and {found[499 + n] for n in range(41)} == {499}
    assert found[800] == found[799] == 799 and 900 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_that_share_an_id_go_by_their_own_text(documents, prose):
    text, clean = prose(1, 200), prose(2, 200)
    docs = documents([(3, text), (5, text + " tail"), (5, clean), (None, text)])
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, text), (5, clean), (None, text)], key=str)
