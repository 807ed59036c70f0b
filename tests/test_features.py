import datetime as dt

import numpy as np
import pytest

from vouchwell.operators import features, history, staging
from vouchwell.sources import files


def mart(invoices, vendors, **options):
    return features.invoice_features(staging.stg_invoices(invoices, vendors), **options)


def by_id(df):
    return {r["invoice_id"]: r for r in df.collect()}


def test_ties_share_the_cumulative_sum_and_break_by_id(make_invoices, make_vendors):
    rows = by_id(mart(make_invoices({"amount": 1.0}, {"amount": 2.0}, {"amount": 4.0}), make_vendors({"vendor_id": "V1"})))
    assert [rows[f"INV00000{n}"]["cumulative_vendor_spend"] for n in (1, 2, 3)] == [7.0] * 3
    assert [rows[f"INV00000{n}"]["vendor_invoice_number"] for n in (1, 2, 3)] == [1, 2, 3]
    assert rows["INV000003"]["previous_invoice_amount"] == 2.0
    assert rows["INV000002"]["rolling_total_amount"] == 3.0


def test_single_invoice_has_no_spread_and_no_history(make_invoices, make_vendors):
    (row,) = mart(make_invoices({}), make_vendors({"vendor_id": "V1"})).collect()
    assert row["vendor_std_amount"] is None and row["rolling_std_amount"] is None
    assert row["vendor_amount_zscore"] == 0.0
    assert row["previous_invoice_amount"] is None and row["days_since_previous_invoice"] is None


def test_round_amounts_and_threshold_distance(make_invoices, make_vendors):
    rows = by_id(
        mart(
            make_invoices({"amount": 1000.0}, {"amount": 1100.0}, {"amount": 1234.5}, {"amount": 50000.5}),
            make_vendors({"vendor_id": "V1"}),
        )
    )
    assert [(r["is_round_100"], r["is_round_1000"]) for r in rows.values()] == [(1, 1), (1, 0), (0, 0), (0, 0)]
    assert rows["INV000001"]["amount_to_threshold_distance"] == 49000.0
    assert rows["INV000004"]["amount_to_threshold_distance"] is None


def test_weekday_starts_on_sunday_and_flags_treat_null_as_zero(make_invoices, make_vendors):
    sunday = dt.date(2025, 1, 5)
    (row,) = mart(
        make_invoices({"invoice_date": sunday, "discount": None, "tax_amount": 1.0}), make_vendors({"vendor_id": "V1"})
    ).collect()
    assert (row["invoice_weekday"], row["has_discount"], row["has_tax"]) == (0, 0, 1)
    assert row["submission_hour"] == 9 and row["submission_day_of_week"] == 3
    assert row["vendor_name"] == "Acme"


def test_accounts_count_invoices_and_null_is_one_account(make_invoices, make_vendors):
    vendors = make_vendors(
        {"vendor_id": "V1"}, {"vendor_id": "V2"}, {"vendor_id": "V3", "bank_account_id": None}
    )
    invoices = make_invoices(
        {"vendor_id": "V1"}, {"vendor_id": "V2"}, {"vendor_id": "V2"}, {"vendor_id": "V3"}, {"vendor_id": "V9"}
    )
    rows = by_id(mart(invoices, vendors))
    assert [r["bank_account_vendor_count"] for r in rows.values()] == [3, 3, 3, 2, 2]
    assert rows["INV000005"]["vendor_name"] is None


@pytest.mark.parametrize("limit", [1, 3, 7, 40])
def test_sliced_history_equals_whole_vendor_windows(make_invoices, make_vendors, limit):
    """One heavy vendor, one heavy day in it, gaps, a NULL date and a NULL vendor."""
    rng = np.random.default_rng(5)
    rows = []
    for n in range(150):
        day = dt.date(2025, 1, 1) + dt.timedelta(days=int(rng.integers(0, 40)))
        rows.append({"invoice_date": day, "amount": float(rng.integers(1, 10_000)) / 100})
    rows += [{"invoice_date": dt.date(2025, 1, 20), "amount": float(n)} for n in range(90)]
    rows += [{"invoice_date": None, "amount": 3.0}, {"amount": None}]
    rows += [{"vendor_id": "V2", "amount": float(n)} for n in range(5)]
    rows += [{"vendor_id": None, "amount": float(n)} for n in range(9)]
    invoices = make_invoices(*rows)
    vendors = make_vendors({"vendor_id": "V1"}, {"vendor_id": "V2"})
    plain = by_id(mart(invoices, vendors))
    sliced = by_id(mart(invoices, vendors, max_group_rows=limit))
    assert plain.keys() == sliced.keys()
    for key, expected in plain.items():
        for c in features.HISTORY_COLUMNS:
            a, b = expected[c], sliced[key][c]
            assert a == b or a == pytest.approx(b, rel=1e-9, abs=1e-9), (key, c)


def test_heavy_days_are_cut(make_invoices):
    heavy = make_invoices(*[{} for _ in range(100)]).withColumnRenamed("invoice_date", "_day")
    starts, big = history._slice_starts(heavy, 10)
    cuts = history._day_cuts(heavy, big, 10).collect()
    assert len(cuts) == 1 and len(cuts[0]["_cuts"]) >= 5


def test_mixed_date_text(spark, tmp_path):
    header = (
        "invoice_id,vendor_id,invoice_date,submission_timestamp,payment_date,due_date,amount,quantity,unit_price,"
        "currency,requester,approver,purchase_order_id,contract_id,payment_terms,payment_method,invoice_status,"
        "department,description,tax_amount,discount"
    )
    tail = "2025-01-01 10:00:00,2025-02-01,2025-01-31,10.5,1,10.5,INR,E,M,P,C,30,NEFT,Paid,IT,\"a, \"\"b\"\"\",1.0,0.0"
    lines = [f"I{n},V1,{d},{tail}" for n, d in enumerate(["2025-01-01", "2025-01-05 00:00:00", "bad"])]
    (tmp_path / "invoices.csv").write_text("\n".join([header, *lines]))
    rows = files.read_invoices(spark, str(tmp_path / "invoices.csv")).orderBy("invoice_id").collect()
    assert [r["invoice_date"] for r in rows] == [dt.date(2025, 1, 1), dt.date(2025, 1, 5), None]
    assert rows[0]["description"] == 'a, "b"' and rows[0]["submission_timestamp"] == dt.datetime(2025, 1, 1, 10)


def test_tables_round_trip(spark, make_invoices, make_vendors, tmp_path):
    invoices = make_invoices({}, {"amount": None})
    vendors = files.with_one_line_addresses(make_vendors({"vendor_id": "V1", "vendor_address": " 1 Road\nTown"}))
    assert vendors.first()["vendor_address"] == " 1 Road, Town"
    files.write_csv(invoices, str(tmp_path / "i"))
    files.write_csv(vendors, str(tmp_path / "v"))
    assert files.read_invoices(spark, str(tmp_path / "i")).collect() == invoices.collect()
    assert files.read_vendors(spark, str(tmp_path / "v")).collect() == vendors.collect()
    staging.register_views(invoices, vendors)
    assert spark.sql("SELECT count(*) FROM stg_invoices").first()[0] == 2
