import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vouchwell import schemas
from vouchwell.operators import evaluate, inject, quality
from vouchwell.plans import jobs
from vouchwell.sources import files
from vouchwell.storage import materialize


def counts(spark, tn, fp, fn, tp):
    return spark.createDataFrame([(tp, fp, fn, tn)], "tp bigint, fp bigint, fn bigint, tn bigint")


def test_published_isolation_forest_figures(spark):
    table = counts(spark, 49000, 1000, 98, 2)
    m = evaluate.metrics(table).first()
    assert [round(m[c], 4) for c in ("accuracy", "precision", "recall", "f1_score")] == [0.9781, 0.0020, 0.0200, 0.0036]
    report = {r["label"]: [None if x is None else round(x, 4) for x in r[1:]] for r in evaluate.class_report(table).collect()}
    assert report == {
        "0": [0.9980, 0.9800, 0.9889, 50000],
        "1": [0.0020, 0.0200, 0.0036, 100],
        "accuracy": [None, None, 0.9781, 50100],
        "macro avg": [0.5000, 0.5000, 0.4963, 50100],
        "weighted avg": [0.9960, 0.9781, 0.9870, 50100],
    }
    assert [tuple(r) for r in evaluate.confusion_matrix(table).collect()] == [
        ("Actual Normal", 49000, 1000),
        ("Actual Fraud", 98, 2),
    ]


def test_nothing_predicted_gives_zero(spark):
    m = evaluate.metrics(counts(spark, 5, 0, 0, 0)).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1_score"]) == (1.0, 0.0, 0.0, 0.0)


def test_labels_join_and_recall_by_type(spark):
    predictions = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "invoice_id string, prediction int")
    labels = spark.createDataFrame(
        [("a", 1, "Duplicate Invoice", "x", "{}"), ("b", 1, "Duplicate Invoice", "y", "{}")], schemas.FRAUD_LABELS
    )
    joined = evaluate.with_labels(predictions, labels)
    assert {r["invoice_id"]: r["fraud_type"] for r in joined.collect()}["c"] == "normal"
    assert tuple(evaluate.recall_by_type(joined).first()) == ("Duplicate Invoice", 2, 1, 0.5)
    c = evaluate.outcome_counts(joined).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (1, 0, 1, 1)


def test_injection_numbers_copies_and_keeps_the_rest(spark, make_invoices, tmp_path):
    invoices = make_invoices(*[{"amount": 10.0 + n, "tax_amount": 1.8} for n in range(40)])
    augmented, labels = inject.inject_duplicates(invoices, n_duplicates=7)
    assert augmented.count() == 47 and labels.count() == 7
    assert augmented.exceptAll(augmented.filter("invoice_id > 'INV000040'")).exceptAll(invoices).isEmpty()
    rows = {r["invoice_id"]: r for r in augmented.collect()}
    for label in labels.collect():
        copy, source = rows[label["invoice_id"]], rows[label["source_invoice"]]
        shift = json.loads(label["parameters"])["date_shift_days"]
        assert 1 <= shift <= 5
        for c in ("invoice_date", "due_date", "payment_date", "submission_timestamp"):
            assert copy[c] - source[c] == dt.timedelta(days=shift)
        assert copy["amount"] == pytest.approx(source["amount"] + 0.01)
        assert copy["vendor_id"] == source["vendor_id"] and copy["description"] == source["description"]
    assert sorted(r["invoice_id"] for r in labels.collect()) == [f"INV0000{n}" for n in range(41, 48)]
    files.write_csv(labels, str(tmp_path / "labels"))
    again = files.read_labels(spark, str(tmp_path / "labels"))
    assert sorted(again.collect()) == sorted(labels.collect())
    assert inject.label_parameters(again).filter(F.col("same_vendor") & (F.col("amount_delta") == 0.01)).count() == 7


@pytest.mark.parametrize("id_scheme", ["prefix", "sequence"])
def test_injection_does_not_sort_all_invoices(make_invoices, monkeypatch, id_scheme):
    plans = []

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, name)

    monkeypatch.setattr(inject, "materialize", written)
    inject.inject_duplicates(make_invoices(*[{}] * 9), n_duplicates=3, id_scheme=id_scheme)
    assert not any("rangepartitioning" in plan for plan in plans)


def test_both_sided_vote_finds_every_injected_copy(make_invoices, make_vendors):
    invoices = make_invoices(
        *[{"vendor_id": f"V{n % 5}", "invoice_date": dt.date(2025, 1, 1) + dt.timedelta(days=n), "description": f"item {n}"}
          for n in range(60)]
    )
    vendors = make_vendors(*[{"vendor_id": f"V{n}", "bank_account_id": f"B{n}"} for n in range(5)])
    judged = jobs.evaluated_vote(invoices, vendors, "both", n_duplicates=10)
    assert tuple(evaluate.recall_by_type(judged, "final_prediction").first())[1:] == (10, 10, 1.0)


def test_saved_rule_tables_give_the_same_vote(spark, make_invoices, make_vendors, tmp_path):
    invoices = make_invoices(*[{"vendor_id": f"V{n % 3}", "amount": 49500.0 + n} for n in range(12)])
    vendors = make_vendors(*[{"vendor_id": f"V{n}", "bank_account_id": f"B{n // 2}"} for n in range(3)])
    jobs.save_rule_results(invoices, vendors, str(tmp_path))
    saved = jobs.vote_from_results(spark, invoices, str(tmp_path))
    assert sorted(saved.collect()) == sorted(jobs.rule_vote(invoices, vendors).collect())


def test_saved_rule_tables_read_their_source_three_times_at_most(spark, make_invoices, make_vendors, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    made = make_invoices(*[{"vendor_id": f"V{n % 3}", "amount": 100.0 + n} for n in range(12)])
    invoices = made.mapInArrow(counted, made.schema)
    columns = jobs.save_rule_results(invoices, make_vendors({"vendor_id": "V0"}), str(tmp_path))
    assert jobs.vote_from_results(spark, columns, str(tmp_path)).count() == 12
    assert 0 < reads.value <= 36  # the rules' columns; the candidates and their counts for the threshold table


def test_quality_report_counts_violations(make_invoices):
    bad = {
        "invoice_id": "INV000001",
        "amount": 0.0,
        "quantity": -1,
        "unit_price": None,
        "payment_date": dt.date(2024, 1, 1),
        "currency": "USD",
    }
    report = {r["check"]: r["violations"] for r in quality.dq_report(make_invoices({}, bad)).collect()}
    assert report == {
        "unique_invoice_id": 1,
        "no_missing_values": 1,
        "positive_amount": 1,
        "positive_quantity": 1,
        "positive_unit_price": 1,
        "payment_not_before_invoice": 1,
        "due_not_before_invoice": 0,
        "single_currency": 1,
    }


def test_line_items_and_null_profile(make_invoices):
    invoices = make_invoices({"amount": 5.0, "discount": None}, {"discount": None, "description": None})
    assert quality.line_items(invoices).schema.names == schemas.LINE_ITEMS.names
    top = quality.null_profile(invoices, 2).collect()
    assert [(r["column_name"], r["missing"]) for r in top] == [("discount", 2), ("description", 1)]


def test_profile_reads_its_source_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS amount").mapInArrow(counted, "amount double")
    row = quality.numeric_profile(df).first()
    assert (row["count"], row["p25"], row["p50"], row["max"]) == (1000, 249.75, 499.5, 999.0)
    assert reads.value == 1000
