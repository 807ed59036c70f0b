import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vouchwell.operators import autoencoder, encode, iforest, lof, sweep
from vouchwell.operators.quantiles import exact_quantiles
from vouchwell.plans import jobs

COLUMNS = "amount double, quantity_sold double, constant double, payment_method string, currency string"


@pytest.mark.parametrize("max_values", [500_000, 60])
def test_exact_quantiles(spark, max_values):
    rng = np.random.default_rng(1)
    a, b = rng.lognormal(size=20_001), rng.integers(0, 5, 20_001).astype(float)
    rows = [(float(x), float(y), None if i % 3 else float(x)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("none", F.lit(None).cast("double"))
    got = exact_quantiles(df, ["a", "b", "c", "none"], [0.0, 0.02, 0.5, 0.98, 1.0], max_values)
    for p in (0.0, 0.02, 0.5, 0.98, 1.0):
        assert got["a", p] == pytest.approx(np.quantile(a, p), rel=1e-12)
        assert got["b", p] == np.quantile(b, p)
        assert got["c", p] == pytest.approx(np.quantile(a[::3], p), rel=1e-12)
        assert got["none", p] is None


def mart(spark, rows):
    values = [(f"I{n:05d}", *r) for n, r in enumerate(rows)]
    df = spark.createDataFrame(values, "invoice_id string, " + COLUMNS)
    for c in encode.METADATA_COLUMNS[1:]:
        df = df.withColumn(c, F.lit("m"))
    return df


def blob(spark, n=400):
    rng = np.random.default_rng(2)
    rows = [(float(x), float(y), 7.0, "NEFT" if i % 2 else "IMPS", "INR") for i, (x, y) in enumerate(rng.normal(size=(n, 2)))]
    rows += [(9.0, 9.0, 7.0, "NEFT", "INR"), (-9.0, 9.0, 7.0, "CASH", "INR")]
    data = mart(spark, rows)
    encoder = encode.fit_encoder(data)
    return encoder.transform(data).cache(), encoder, {f"I{n:05d}", f"I{n + 1:05d}"}


def test_encoding_fills_scales_and_ignores_unseen_categories(spark):
    rows = [(1.0, 2.0, 7.0, "b", "INR"), (None, 4.0, 7.0, "a", "INR"), (5.0, 6.0, 7.0, None, "INR"), (6.0, 8.0, 7.0, "a", "INR")]
    rows += [(6.0, 8.0, 7.0, "b", "INR")]
    data = mart(spark, rows)
    encoder = encode.fit_encoder(data)
    assert encoder.numeric == ["amount", "quantity_sold", "constant"]
    assert encoder.categorical == ["payment_method", "currency"]
    assert encoder.fills["amount"] == 5.5 and encoder.fills["payment_method"] == "a"
    encoded = encoder.transform(data)
    filled = np.array([1.0, 5.5, 5.0, 6.0, 6.0])
    got = [r["amount"] for r in encoded.orderBy("invoice_id").collect()]
    assert got == pytest.approx(list((filled - filled.mean()) / filled.std()))
    assert {r["constant"] for r in encoded.collect()} == {0.0}
    vectorizer = encode.fit_vectorizer(encoded, encoder)
    assert encode.feature_names(vectorizer, encoder)[3:] == [
        "categorical__payment_method_a", "categorical__payment_method_b", "categorical__currency_INR",
    ]
    unseen = encoder.transform(mart(spark, [(1.0, 1.0, 7.0, "zzz", "INR")]))
    vector = encode.feature_matrix(unseen, vectorizer).first()["features"].toArray()
    assert list(vector[3:]) == [0.0, 0.0, 1.0]


def test_artifacts_are_written(spark, tmp_path):
    encoded, encoder, _ = blob(spark, 40)
    vectorizer = encode.fit_vectorizer(encoded, encoder)
    encode.save_artifacts(str(tmp_path), encoded, encoder, vectorizer)
    assert spark.read.parquet(f"{tmp_path}/feature_matrix").count() == 42
    assert spark.read.parquet(f"{tmp_path}/feature_names").count() == 3 + 3 + 1


def test_average_path_length():
    assert iforest.average_path_length(1) == 0.0
    assert iforest.average_path_length(2) == 1.0
    assert iforest.average_path_length(256) == pytest.approx(10.2448, abs=1e-4)


def test_isolation_forest_ranks_outliers_first(spark):
    encoded, encoder, outliers = blob(spark)
    forest = iforest.fit_forest(encoded, encoder, n_trees=60)
    assert forest.n_trees == 60
    predicted = iforest.predictions(encoded, forest)
    top = iforest.most_suspicious(predicted, 2).collect()
    assert {r["invoice_id"] for r in top} == outliers
    assert all(r["prediction"] == 1 and r["anomaly_score"] < 0 for r in top)
    summary = iforest.prediction_summary(predicted).first()
    assert summary["predicted_anomalies"] == 9  # ranks below 0.02 * 401
    again = iforest.predictions(encoded.repartition(7), iforest.fit_forest(encoded.repartition(3), encoder, n_trees=60))
    assert sorted(again.collect()) == sorted(predicted.collect())


def brute_lof(x, c, ids, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2) + 2.0 * (c[:, None] != c[None]).sum(2))
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    near = np.take_along_axis(d, order, 1)
    reach = np.maximum(near, near[:, -1][order])
    density = 1.0 / (reach.mean(1) + 1e-10)
    return {i: ids[o].tolist() for i, o in zip(ids, order)}, -density[order].mean(1) / density


@pytest.mark.parametrize(("group_rows", "max_leaves"), [(40, 2), (25, 4096)])
def test_neighbours_and_factors_equal_brute_force(spark, group_rows, max_leaves):
    encoded, encoder, outliers = blob(spark)
    rows = lof.points(encoded, encoder)
    rows = rows.union(rows.limit(30).select(F.concat(F.lit("J"), "invoice_id"), "x", "c"))  # exact copies
    pdf = rows.toPandas().sort_values("invoice_id", ignore_index=True)
    x, c, ids = np.stack(pdf["x"]), np.stack(pdf["c"]), pdf["invoice_id"].to_numpy()
    expected, factors = brute_lof(x, c, ids, 20)
    found = lof.nearest_neighbors(rows, 20, group_rows, max_leaves)
    got = found.toPandas().sort_values(["invoice_id", "rank"]).groupby("invoice_id")["neighbor"].agg(list).to_dict()
    assert got == expected
    scores = lof.outlier_factors(found).toPandas().set_index("invoice_id")["anomaly_score"]
    assert scores[ids].to_numpy() == pytest.approx(factors)


def test_boxes_keep_rows_from_far_pieces(spark):
    """Clusters far apart are not compared, and an outlier's wide search does not widen its neighbours'."""
    rng = np.random.default_rng(5)
    rows = [(f"I{n:04d}", [float(100 * (n % 8)), *rng.normal(size=2).tolist()], [n % 8]) for n in range(800)]
    rows.append(("OUT", [350.0, 900.0, 0.0], [9]))
    df = spark.createDataFrame(rows, "invoice_id string, x array<double>, c array<bigint>")
    counts = lof.routed_copies(df, 10, 50, 64).first()
    assert counts["total"] == 801 and counts["pieces"] >= 16
    assert counts["copies"] < 5 * 801
    x, c = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    expected, _ = brute_lof(x, c, np.array([r[0] for r in rows]), 10)
    found = lof.nearest_neighbors(df, 10, 50, 64).toPandas().sort_values(["invoice_id", "rank"])
    assert found.groupby("invoice_id")["neighbor"].agg(list).to_dict() == expected


def test_a_small_piece_holds_few_pairs():
    """Pairs found and not yet ranked grow with a piece's rows, not with the block that it is matched with."""
    rng = np.random.default_rng(8)
    x, c, ids = rng.normal(size=(4000, 2)), np.zeros((4000, 1), np.int64), np.array([f"I{n:04d}" for n in range(4000)], object)
    piece = lof._Queries(5)
    piece.add(ids[:16], x[:16], c[:16], np.full(16, 100.0))
    piece.close()
    piece.offer(ids, x, c)
    assert sum(len(found) for found, _, _ in piece.found) <= lof.PENDING * 5 * 16
    got = piece.result().to_pandas().sort_values(["invoice_id", "rank"])
    away = np.linalg.norm(x[:16, None] - x[None], axis=2)
    assert got["neighbor"].tolist() == [n for row in away for n in ids[row.argsort()[1:6]]]


def test_lof_flags_outliers(spark):
    encoded, encoder, outliers = blob(spark)
    predicted = lof.predictions(encoded, encoder)
    assert outliers <= {r["invoice_id"] for r in predicted.filter("prediction = 1").collect()}
    few = encoded.limit(3)
    assert lof.nearest_neighbors(lof.points(few, encoder)).count() == 6


def test_network_gradients_match_differences(monkeypatch):
    monkeypatch.setattr(autoencoder, "DROPOUT", 0.0)
    net = autoencoder.Network(5)
    rng = np.random.default_rng(0)
    state, x, n = net.initial(1), rng.normal(size=(16, 5)), net.n_weights()
    stepped = state.copy()
    net.step(stepped, x, rng)
    gradient = stepped[n + 128 : 2 * n + 128] / (1 - autoencoder.ADAM_BETA1)

    def loss(weights):
        probe = state.copy()
        probe[:n] = weights
        first = np.maximum(x @ net.views(weights)[0] + net.views(weights)[1], 0)
        probe[n : n + 128] = np.concatenate([first.mean(0), first.var(0)])
        return ((net.reconstruct(probe, x) - x) ** 2).mean()

    for i in rng.choice(n, 80, replace=False):
        up, down = state[:n].copy(), state[:n].copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert (loss(up) - loss(down)) / 2e-6 == pytest.approx(gradient[i], abs=1e-7)


def test_autoencoder_learns_and_ranks_outliers(spark):
    encoded, encoder, outliers = blob(spark, 1500)
    vectorizer = encode.fit_vectorizer(encoded.withColumn("invoice_amount", F.col("amount")), encoder)
    rows, width = autoencoder.inputs(encoded, encoder, vectorizer)
    assert width == 3 + 3 + 1
    training = autoencoder.sharded(rows, shard_rows=400)
    model = autoencoder.train(training, width, epochs=12)
    losses = [loss for _, loss, _ in model.epochs]
    assert losses[-1] < losses[0] * 0.8
    predicted, limit = autoencoder.predictions(rows, model)
    flagged = predicted.filter("prediction = 1")
    assert flagged.count() == 31  # ranks above 0.98 * 1501
    assert outliers <= {r["invoice_id"] for r in flagged.collect()}
    bins = autoencoder.error_histogram(predicted, limit, 10).collect()
    assert sum(b["n"] for b in bins) == 1502
    assert autoencoder.most_suspicious(predicted, 3).count() == 3
    assert [r["epoch"] for r in model.history(spark).collect()] == list(range(1, len(losses) + 1))


def test_wide_categories_and_saved_encoder(spark, tmp_path):
    encoded, encoder, _ = blob(spark, 40)
    wide = encoded.withColumn("c", F.col("invoice_id")) if "c" in encoder.categorical else encoded
    vectorizer = encode.fit_vectorizer(wide, encoder)
    rows, width = autoencoder.inputs(wide, encoder, vectorizer)
    model = autoencoder.train(autoencoder.sharded(rows, shard_rows=20), width, epochs=2)
    assert autoencoder.with_errors(rows, model).filter("reconstruction_error >= 0").count() == encoded.count()
    known = encode.categories(encoded, encoder)
    assert encode.onehot_rows(encoded, encoder, known).count() == encode.onehot_rows(encoded, encoder).count()
    assert encode.onehot_rows(encoded, encoder, known.limit(0)).count() == 0
    encode.save_encoder(spark, encoder, str(tmp_path / "encoder"))
    assert encode.load_encoder(spark, str(tmp_path / "encoder")) == encoder
    forest = iforest.fit_forest(encoded, encoder, n_trees=5)
    iforest.save_forest(spark, forest, str(tmp_path / "forest"))
    again = iforest.load_forest(spark, str(tmp_path / "forest"))
    score = lambda f: sorted(map(tuple, iforest.with_scores(encoded, f).select("invoice_id", "raw_score").collect()))
    assert score(again) == score(forest)
    autoencoder.save_model(spark, model, str(tmp_path / "autoencoder"))
    loaded = autoencoder.load_model(spark, str(tmp_path / "autoencoder"))
    assert loaded.epochs == model.epochs and loaded.network == model.network and (loaded.state == model.state).all()


def test_neighbours_read_blocks_without_copies_of_rows(spark, monkeypatch):
    """Rows are written once for the join, whatever number of pieces looks at them, and ties stay in bounded memory."""
    rng = np.random.default_rng(7)
    rows = [(f"I{n:04d}", rng.normal(size=6).tolist(), [n % 3]) for n in range(500)]
    rows += [(f"T{n:04d}", [0.5] * 6, [1]) for n in range(300)]  # all at distance 0 from each other
    df = spark.createDataFrame(rows, "invoice_id string, x array<double>, c array<bigint>")
    monkeypatch.setattr(lof, "_sent", None)  # the routed copies
    monkeypatch.setattr(lof, "BLOCK_ROWS", 100)
    found = lof.nearest_neighbors(df, 5, 50, 64).toPandas().sort_values(["invoice_id", "rank"])
    x, c = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    expected, _ = brute_lof(x, c, np.array([r[0] for r in rows]), 5)
    assert found.groupby("invoice_id")["neighbor"].agg(list).to_dict() == expected
    queries = lof._Queries(5)
    ids = np.array([r[0] for r in rows[500:]], object)
    queries.add(ids, x[500:], c[500:], np.full(300, 1.0))
    queries.close()
    queries.offer(ids, x[500:], c[500:])
    queries.compact()
    assert queries.pending == 5 * 300


def test_errors_and_steps_make_no_dense_outputs():
    """Errors over 200,000 one-hot columns equal the dense ones; a batch of them stays narrow."""
    rng = np.random.default_rng(3)
    numbers, hot = rng.normal(size=(300, 2)), [np.array([2 + n % 5, 7 + n % 190_000]) for n in range(300)]
    hot[4] = np.zeros(0, int)  # a row without known categories
    small = autoencoder.Network(400)
    state = small.initial(1)
    state[-small.n_weights() * 2 - 1 - 128 - 400 : -small.n_weights() * 2 - 1 - 128] += 0.01
    rows = autoencoder._Rows(numbers, [h % 398 + 2 for h in hot], 400)
    found = np.concatenate([small.errors(state, part, small.output_gram(state)) for part in rows.batches()])
    x = np.zeros((300, 400))
    x[:, :2] = numbers
    for n, h in enumerate(rows.hot):
        x[n, h.astype(int)] = 1.0
    assert found == pytest.approx(((small.reconstruct(state, x) - x) ** 2).mean(1), rel=1e-9)
    dense, sparse = state.copy(), state.copy()
    losses = [small.step(s, b, np.random.default_rng(9)) for s, b in [(dense, x[:128]), (sparse, next(rows.batches()))]]
    # A dense batch is one whose columns are all numbers.
    assert losses[0] == pytest.approx(losses[1], rel=1e-9) and sparse == pytest.approx(dense, abs=1e-9)
    wide = autoencoder.Network(200_000)
    part = next(autoencoder._Rows(numbers, hot, 200_000).batches())
    assert part.numbers.shape == (128, 2) and len(part.column) == 2 * 127
    assert len(wide.errors(wide.initial(1), part, np.zeros((65, 65)))) == 128


def test_steps_hold_no_whole_gradient_and_single_precision_follows_double():
    work = autoencoder._Work(autoencoder.Network(200_000))
    held = sum(a.size for a in [*work.gradient, work.outer, *work.spare] if a is not None)
    assert held < 1_000_000  # 25,800,000 weights
    rng = np.random.default_rng(5)
    net = autoencoder.Network(5_000)
    parts = list(autoencoder._Rows(rng.normal(size=(512, 3)), [np.array([3 + n % 7, 10 + n]) for n in range(512)], 5_000).batches())
    double = net.initial(2)
    single = double.astype(np.float32)
    losses = [[net.step(s, b, np.random.default_rng(k)) for k, b in enumerate(parts)] for s in (double, single)]
    assert single.dtype == np.float32 and losses[1] == pytest.approx(losses[0], rel=1e-4)
    n = net.n_weights()
    assert np.abs(single[:n] - double[:n]).mean() < 1e-5


def test_training_files_hold_equal_shares_of_shards(spark):
    rows = spark.range(6_400).select(
        (F.col("id") * 100).alias("draw"), F.lit(False).alias("validation"), F.array(F.lit(0.0)).alias("numbers"), F.array(F.lit(1)).alias("hot")
    )
    files = autoencoder.sharded(rows, shard_rows=100).groupBy(F.input_file_name()).agg(F.count_distinct("shard").alias("n"))
    sizes = sorted(r["n"] for r in files.collect())
    assert sum(sizes) == 64 and len(sizes) == 4 and sizes[-1] <= 20


def random_forest(rng, n_numeric, n_categorical, trees, levels):
    """Node arrays as ``Forest.arrays`` lays them out: tree after tree, by node number."""
    rows = []
    for _ in range(trees):
        start, numbers = len(rows), [1]
        for node in numbers:  # grows while it is read
            if node < 2**levels and rng.random() < 0.8:
                numbers += [2 * node, 2 * node + 1]
        place = {node: start + i for i, node in enumerate(sorted(numbers))}
        for node in sorted(numbers):
            inner = 2 * node in place
            f = int(rng.integers(n_numeric + n_categorical)) if inner else -1
            cut = 0.0 if f < 0 else float(rng.normal()) if f < n_numeric else float(rng.integers(3))
            own = place[node]
            rows.append((f, cut, place.get(2 * node, own), place.get(2 * node + 1, own), 0.0 if inner else float(rng.random() * 9), node))
    columns = [np.array(c) for c in zip(*rows)]
    return (*columns[:5], np.flatnonzero(columns[5] == 1))


def test_forest_walk_equals_a_walk_row_by_row(monkeypatch):
    monkeypatch.setattr(iforest, "WALK_ROWS", 64)
    rng = np.random.default_rng(11)
    arrays = random_forest(rng, 3, 2, 12, 5)
    x = np.column_stack([rng.normal(size=(150, 3)), rng.integers(-1, 3, (150, 2))])
    x[0, :3] = np.nan
    feature, threshold, left, right, length, roots = arrays
    expected = []
    for row in x:
        total, sums = 0.0, []
        for node in roots:
            while feature[node] >= 0:
                f, cut = feature[node], threshold[node]
                node = left[node] if (row[f] <= cut if f < 3 else row[f] != cut) else right[node]
            total += length[node]
            sums.append(total)
        expected.append([sums[4], sums[-1]])
    assert iforest.path_totals(x, 3, arrays, [5, 12]).tolist() == expected


def test_forest_points_are_looked_up_inside_arrow():
    texts = pa.array(["b", None, "a", "new", "b"])
    batch = (pa.array([1.5, None, -2.0, 0.0, 3.0]), pa.array([1, 2, 3, 4, None], pa.int64()), texts, texts)
    x = iforest.points(batch, 2, [{"a": 0, "b": 1}, {}])
    assert np.array_equal(x[:, 0], [1.5, np.nan, -2.0, 0.0, 3.0], equal_nan=True)
    assert np.array_equal(x[:, 1], [1, 2, 3, 4, np.nan], equal_nan=True)
    assert x[:, 2].tolist() == [1, -1, 0, -1, 1] and x[:, 3].tolist() == [-1] * 5
    assert iforest.points(tuple(c[:0] for c in batch), 2, [{}, {}]).shape == (0, 4)


def test_encoder_statistics_and_narrow_marts(spark, make_invoices, make_vendors):
    values = [1e9 + n % 7 for n in range(40)] + [None] * 3
    df = spark.createDataFrame([(f"I{n}", v, 5.0, None) for n, v in enumerate(values)], "invoice_id string, a double, b double, s string")
    encoder = encode.fit_encoder(df)
    filled = np.array([encoder.fills["a"] if v is None else v for v in values])
    assert encoder.means["a"] == pytest.approx(filled.mean(), rel=1e-15) and encoder.scales["a"] == pytest.approx(filled.std(), rel=1e-12)
    assert encoder.means["b"] == 5.0 and encoder.scales["b"] is None
    invoices, vendors = make_invoices(*[{"amount": 10.0 * n, "department": "IT" if n % 3 else "HR"} for n in range(30)]), make_vendors({"vendor_id": "V1"})
    whole = jobs.prepared(invoices, vendors)
    hot = jobs.prepared(invoices, vendors, metadata=False, numbers=False)
    assert hot.encoded.columns == ["invoice_id", *whole.encoder.categorical]
    pairs = [sorted(map(tuple, encode.onehot_rows(d.encoded, d.encoder).collect())) for d in (whole, hot)]
    assert pairs[0] == pairs[1]
    numbers = jobs.prepared(invoices, vendors, metadata=False, categories=False)
    assert numbers.encoder.numeric == whole.encoder.numeric and numbers.encoder.scales == pytest.approx(whole.encoder.scales)


def test_sweep_scores_all_forests_in_one_pass(spark, monkeypatch):
    rows = [(f"I{n:03d}", float(n % 17), "even" if n % 2 else "odd") for n in range(120)]
    encoded = spark.createDataFrame(rows, "invoice_id string, a double, s string")
    encoder = encode.Encoder(["a"], ["s"], {}, {"a": 0.0}, {"a": 1.0})
    labels = encoded.limit(3).select("invoice_id", F.lit(1).alias("fraud_label"), F.lit("x").alias("fraud_type"))
    written, plain = [], sweep.materialize
    monkeypatch.setattr(sweep, "materialize", lambda df, name, **given: written.append(df) or plain(df, name, **given))
    found = sweep.sweep(encoded, encoder, labels, [2, 4], [16, 32], [0.1]).collect()
    assert len(found) == 4 and {(r.sample_rows, r.n_trees) for r in found} == {(16, 2), (16, 4), (32, 2), (32, 4)}
    (judged,) = written
    alone = [iforest.with_prefix_scores(encoded, iforest.fit_forest(encoded, encoder, 4, n), [2, 4]) for n in (16, 32)]
    expected = {r.invoice_id: [round(v, 5) for v in r.raw_scores] for r in alone[0].collect()}
    for r in alone[1].collect():
        expected[r.invoice_id] += [round(v, 5) for v in r.raw_scores]
    for r in judged.collect():
        assert [r[f"score_{k}"] for k in range(4)] == pytest.approx(expected[r.invoice_id], abs=2e-5)
