import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vouchwell.operators import encode, features, iforest, mart_store, staging, sweep


@pytest.fixture
def staged(make_invoices, make_vendors):
    rng = np.random.default_rng(8)
    rows = [
        {"vendor_id": f"V{n % 7}" if n % 11 else None, "invoice_date": dt.date(2025, 1, 1) + dt.timedelta(days=int(rng.integers(0, 30))),
         "amount": float(rng.integers(1, 5000))}
        for n in range(120)
    ]
    vendors = make_vendors(*[{"vendor_id": f"V{n}", "bank_account_id": f"B{n % 3}"} for n in range(6)])
    return staging.stg_invoices(make_invoices(*rows), vendors)


def comparable(mart):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in mart.collect())


def test_appends_equal_a_mart_over_all_rows(spark, staged, tmp_path):
    """Late invoices of old and new vendors, and of none, in two appends."""
    number = F.substring("invoice_id", 4, 6).cast("int")
    part = F.when(number <= 80, 0).when((number <= 100) & F.coalesce(F.col("vendor_id").isin("V1", "V6"), F.lit(True)), 1).otherwise(2)
    rows = staged.withColumn("part", part)
    folder = str(tmp_path / "store")
    mart_store.create(rows.filter("part = 0").drop("part"), folder, buckets=8)
    first = mart_store.append(rows.filter("part = 1").drop("part"), folder).first()
    assert first["vendors"] == 3 and first["buckets"] <= 3
    mart_store.append(rows.filter("part = 2").drop("part"), folder)
    assert comparable(mart_store.read(spark, folder)) == comparable(features.invoice_features(staged))
    # Only what an append touched was written again.
    written = spark.read.parquet(f"{folder}/history").groupBy("generation").agg(F.count_distinct("bucket").alias("n"))
    held = {r["generation"]: r["n"] for r in written.collect()}
    assert held[1] == first["buckets"] < held[0]


def test_a_store_may_start_empty_and_an_append_may_be_empty(spark, staged, tmp_path):
    folder = str(tmp_path / "store")
    mart_store.create(staged.limit(0), folder, buckets=4)
    assert mart_store.read(spark, folder).count() == 0
    mart_store.append(staged, folder)
    mart_store.append(staged.limit(0), folder)
    assert comparable(mart_store.read(spark, folder)) == comparable(features.invoice_features(staged))


def test_numbered_rows_follow_the_order_without_gaps(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 101).alias("a"), F.col("id").alias("b")).repartition(7)
    found = encode.numbered(rows, "a", "b").orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(1000))
    assert [(r["a"], r["b"]) for r in found] == sorted((i * 37 % 101, i) for i in range(1000))


def encoded_rows(spark, n=60):
    kinds = ["b", "a", "é", "c,d"]
    rows = [(f"I{i:03d}", float(i % 9), float(i), kinds[i % 4], "only") for i in range(n)]
    df = spark.createDataFrame(rows, "invoice_id string, amount double, size double, kind string, constant string")
    for c in encode.METADATA_COLUMNS[1:]:
        df = df.withColumn(c, F.lit("m"))
    encoder = encode.fit_encoder(df)
    return encoder.transform(df), encoder


def test_a_saved_matrix_gives_the_encoded_rows_back(spark, tmp_path):
    encoded, encoder = encoded_rows(spark)
    encode.save_matrix(str(tmp_path), encoded, encoder)
    saved = encode.load_matrix(spark, str(tmp_path))
    assert saved.encoder == encoder
    names = [r["name"] for r in saved.names.orderBy("position").collect()]
    vectorizer = encode.fit_vectorizer(encoded, encoder)
    assert names == encode.feature_names(vectorizer, encoder)
    columns = ["invoice_id", *encoder.numeric, *encoder.categorical]
    assert sorted(saved.encoded().select(columns).collect()) == sorted(encoded.select(columns).collect())


def test_sweep_ranks_all_settings(spark):
    encoded, encoder = encoded_rows(spark, 300)
    encoded = encoded.withColumn("amount", F.when(F.col("invoice_id") < "I006", 40.0).otherwise(F.col("amount")))
    labels = spark.createDataFrame([(f"I{i:03d}", 1, "x") for i in range(6)], "invoice_id string, fraud_label int, fraud_type string")
    found = sweep.sweep(encoded, encoder, labels, [5, 20], [32, 64], [0.02, 0.1]).collect()
    assert [r["rank"] for r in found] == list(range(1, 9))
    assert [r["f1_score"] for r in found] == sorted((r["f1_score"] for r in found), reverse=True)
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == 300 and r["tp"] + r["fn"] == 6 for r in found)
    # A setting's outcome is that of its forest scored alone.
    best = found[0]
    forest = iforest.fit_forest(encoded, encoder, 20, best["sample_rows"])
    forest = iforest.Forest(forest.numeric, forest.categorical, forest.nodes[forest.nodes["tree"] < best["n_trees"]], forest.sample_rows, best["n_trees"])
    alone = {r["invoice_id"]: round(r["raw_score"], 6) for r in iforest.with_scores(encoded, forest).select("invoice_id", "raw_score").collect()}
    raised = {i for i, s in alone.items() if s < best["threshold"]}
    assert len(raised) == best["tp"] + best["fp"] and sum(i < "I006" for i in raised) == best["tp"]


def test_a_partition_holds_one_bucket(spark, tmp_path):
    vendors = spark.range(300).select(F.format_string("V%06d", "id").alias("vendor_id"))
    placed = mart_store._bucketed(mart_store._by_bucket(vendors, 8, 9 * mart_store.TASK_ROWS), 8)
    assert placed.rdd.getNumPartitions() == 16
    kinds = placed.groupBy(F.spark_partition_id()).agg(F.count_distinct("bucket").alias("n")).collect()
    assert {r["n"] for r in kinds} == {1}


def test_a_store_of_heavy_vendors_has_few_files(spark, staged, tmp_path):
    folder = str(tmp_path / "store")
    mart_store.create(staged, folder, buckets=4, max_group_rows=2)
    assert comparable(mart_store.read(spark, folder)) == comparable(features.invoice_features(staged))
    assert len(spark.read.parquet(f"{folder}/history").inputFiles()) <= 16
