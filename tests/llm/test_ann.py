import numpy as np
import pytest
from pyspark.sql import functions as F

from vouchwell.llm import ann


def brute(rows, step, k):
    out = []
    for qi, q in rows:
        if qi % step == 0:
            scores = [(-float(np.dot(np.float64(v), np.float64(q))), i) for i, v in rows if i != qi and len(v) == len(q)]
            out += [(qi, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((8, 64))
    rows = [(n, (centres[n % 8] + 0.3 * draw.standard_normal(64)).astype(np.float32).tolist()) for n in range(900)]
    same = draw.standard_normal(64).astype(np.float32).tolist()
    rows += [(2000 + n, same) for n in range(300)]  # a third of all rows: ties go to smaller ids
    return rows + [(4000 + n, draw.standard_normal(70).tolist()) for n in range(30)]


def frame(spark, rows):
    bad = [(None, [1.0] * 64), (10, None), (20, [0.0] * 64), (30, [float("nan")] * 64), (40, [None] + [1.0] * 63), (50, [float("inf")] * 64), (60, [])]
    bad = [(i if i is None else 10_000 + i, v) for i, v in bad]
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in [*rows, *bad]], "vec_id long, embedding array<float>, label int, code string")


@pytest.mark.parametrize(("cells", "queries"), [(8_192, 4_096), (100, 30)])
def test_recall_ranks_and_scores(spark, rows, monkeypatch, cells, queries):
    monkeypatch.setattr(ann, "CELL_ROWS", cells)
    monkeypatch.setattr(ann, "CELL_QUERIES", queries)
    found = ann.search(ann.build(frame(spark, rows)), F.col("id") % 20 == 0, 10).collect()
    rounded = [(i, np.float32(v).tolist()) for i, v in rows]
    expected = brute(rounded, 20, 10)
    right = {(q, i) for q, _, i, _ in expected}
    assert len(found) == len(expected)
    assert len({(r.query_id, r.vec_id) for r in found} & right) >= 0.99 * len(right)
    vectors = dict(rounded)
    for r in found:
        assert abs(r.score - float(np.dot(vectors[r.query_id], vectors[r.vec_id]))) < 1e-9
    ranks = {}
    for r in found:
        ranks.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) and sorted(v) == sorted(v, key=lambda x: x[1:]) for v in ranks.values())


def test_few_candidates_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [0.5, 0.5])]
    found = ann.search(ann.build(frame(spark, rows)), F.col("id") == 0, 5).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 1, 5.0), (0, 2, 2, 1.5)]
    empty = frame(spark, rows).where("false")
    assert ann.search(ann.build(empty), F.col("id") == 0, 5).count() == 0
