"""Fixed table schemas."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


VENDORS = _struct(
    vendor_id=StringType,
    vendor_name=StringType,
    vendor_category=StringType,
    bank_account_id=StringType,
    vendor_address=StringType,
    onboarding_date=DateType,
    payment_terms=IntegerType,
)

INVOICES = _struct(
    invoice_id=StringType,
    vendor_id=StringType,
    invoice_date=DateType,
    submission_timestamp=TimestampNTZType,
    payment_date=DateType,
    due_date=DateType,
    amount=DoubleType,
    quantity=IntegerType,
    unit_price=DoubleType,
    currency=StringType,
    requester=StringType,
    approver=StringType,
    purchase_order_id=StringType,
    contract_id=StringType,
    payment_terms=IntegerType,
    payment_method=StringType,
    invoice_status=StringType,
    department=StringType,
    description=StringType,
    tax_amount=DoubleType,
    discount=DoubleType,
)

LINE_ITEMS = _struct(
    invoice_id=StringType,
    line_number=IntegerType,
    description=StringType,
    quantity=IntegerType,
    unit_price=DoubleType,
    line_total=DoubleType,
)

FRAUD_LABELS = _struct(
    invoice_id=StringType,
    fraud_label=IntegerType,
    fraud_type=StringType,
    source_invoice=StringType,
    parameters=StringType,
)

LABEL_PARAMETERS = _struct(
    amount_delta=DoubleType,
    date_shift_days=IntegerType,
    same_vendor=BooleanType,
    same_description=BooleanType,
)
