import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vouchwell import schemas  # noqa: E402
from vouchwell.session import local_session  # noqa: E402

DEFAULTS = {
    "vendor_id": "V1",
    "invoice_date": dt.date(2025, 1, 1),
    "submission_timestamp": dt.datetime(2025, 1, 1, 9, 30),
    "payment_date": dt.date(2025, 2, 1),
    "due_date": dt.date(2025, 1, 31),
    "amount": 100.0,
    "quantity": 2,
    "unit_price": 50.0,
    "currency": "INR",
    "requester": "EMP0001",
    "approver": "MGR001",
    "purchase_order_id": "PO1",
    "contract_id": "CTR1",
    "payment_terms": 30,
    "payment_method": "NEFT",
    "invoice_status": "Paid",
    "department": "IT",
    "description": "printer paper",
    "tax_amount": 18.0,
    "discount": 0.0,
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_invoices(spark):
    def build(*rows):
        names = schemas.INVOICES.names
        full = [DEFAULTS | {"invoice_id": f"INV{n:06d}"} | row for n, row in enumerate(rows, 1)]
        return spark.createDataFrame([tuple(r[c] for c in names) for r in full], schemas.INVOICES)

    return build


@pytest.fixture(scope="session")
def make_vendors(spark):
    def build(*rows):
        full = [
            {
                "vendor_name": " Acme ",
                "vendor_category": "Software",
                "bank_account_id": "B1",
                "vendor_address": " 1 Road ",
                "onboarding_date": dt.date(2024, 1, 1),
                "payment_terms": 30,
            }
            | row
            for row in rows
        ]
        names = schemas.VENDORS.names
        return spark.createDataFrame([tuple(r[c] for c in names) for r in full], schemas.VENDORS)

    return build
