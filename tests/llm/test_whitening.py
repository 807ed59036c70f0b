import numpy as np
import pytest

from vouchwell.llm import queries, rank_one, whitening

SCHEMA = "vec_id long, embedding array<double>, n long, component int, row_id string, part int, vector string"


@pytest.fixture(scope="module")
def table(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 1, 2, "x", 3, "y") for i, v in rows], SCHEMA)

    return build


def by_hand(vectors, most):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    centred = x - x.mean(axis=0)
    levels, axes = np.linalg.eigh(centred.T @ centred / len(x))
    levels, axes = levels[::-1], axes[:, ::-1]
    return x.astype(int), centred @ axes[:, :most] / np.sqrt(levels[:most]), levels[:most] / levels.sum()


@pytest.mark.parametrize("n, lanes", [(1, 3), (2, 4), (7, 5), (40, 2)])
def test_rank_one_updates_equal_a_direct_decomposition(n, lanes):
    draw = np.random.default_rng(n)
    sums = np.zeros((lanes, n, n))
    values, vectors = np.zeros((lanes, n)), np.tile(np.eye(n), (lanes, 1, 1))
    for step in range(120):
        change = draw.normal(size=(lanes, n))
        change = np.round(change) if step % 7 == 3 else change  # equal and zero entries are deflated
        change[:, n // 2 :] *= step % 5 != 1
        change[0] *= step % 11 != 2
        change *= 1000 if step == 60 else 1
        sums += change[:, :, None] * change[:, None, :]
        values, vectors = rank_one.update(values, vectors, change)
    size = np.abs(sums).max()
    assert np.abs((vectors * values[:, None, :]) @ vectors.transpose(0, 2, 1) - sums).max() < 1e-12 * size
    assert np.abs(vectors.transpose(0, 2, 1) @ vectors - np.eye(n)).max() < 1e-12
    assert (np.diff(values, axis=1) >= 0).all()


@pytest.mark.parametrize("partitions", [1, 20])
def test_query_equals_brute_force(spark, table, tmp_path, partitions):
    draw = np.random.default_rng(3)
    good = (draw.normal(size=(700, 40)) * np.linspace(0.05, 3, 40) + 5).tolist()
    bad = [None, [], [1.0] * 39, [None] + [1.0] * 39, [float("nan")] * 40, [float("inf")] + [0.0] * 39, [1e300] * 40]
    rows = list(enumerate(good)) + [(1000 + i, v) for i, v in enumerate(bad)] + [(5, good[5]), (None, good[6])]
    kept = [(i, v) for i, v in rows if i is None or i < 1000]
    table(rows).repartition(partitions).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.whitened_vectors(spark, str(tmp_path)).toPandas().sort_values(["vec_id", "component"])
    x, whitened, explained = by_hand([v for _, v in kept], 32)
    n = len(x)
    assert len(found) == 32 * n and set(found["n"]) == {n}
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    for place, (row, _) in enumerate(kept[:700]):
        mine = found[found["vec_id"] == row]
        assert set(mine["deviation"]) == {deviation[place]}
        if len(mine) == 32:
            assert np.abs(np.abs(mine["whitened"]) - np.abs(whitened[place])).max() < 1e-9
            assert np.abs(mine["explained"] / explained - 1).max() < 1e-10
    assert found["identity_error"].max() < 1e-10 and found["vec_id"].isna().sum() == 32
    # One sign holds for all rows.
    first = found[(found["component"] == 1) & (found["vec_id"] < 5)]["whitened"].to_numpy()
    assert len(set(np.sign(first * whitened[:5, 0]))) == 1


def test_components_without_variance_are_left_out(table):
    draw = np.random.default_rng(1)
    flat = draw.integers(-40, 40, size=(60, 3)) @ draw.integers(-3, 3, size=(3, 6))
    model = whitening.fit(table(list(enumerate(flat.astype(float).tolist()))))
    assert len(model.levels) == 3 and model.identity_error < 1e-10
    assert whitening.transform(table([(1, [1.0] * 6)]), model).count() == 3


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [float("nan")])]])
def test_nothing_to_whiten(table, rows):
    assert whitening.transform(table(rows), whitening.fit(table(rows))).count() == 0
