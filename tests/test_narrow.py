import datetime as dt
import os
import time

from pyspark.sql import functions as F

from vouchwell.operators import features, staging
from vouchwell.plans import jobs
from vouchwell.sources.narrow import NarrowInvoices
from vouchwell.storage import SHUFFLE_CLEANUP, materialize


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_columns_are_made_behind_the_exchange_by_vendor(make_invoices, make_vendors):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=n) for n in (0, 0, 3, 4, 9, 9, 30)]
    given = [{"vendor_id": v, "invoice_date": day, "amount": 10.0 * n} for v in ("V1", "V2", None) for n, day in enumerate(days)]
    vendors = make_vendors({"vendor_id": "V1"}, {"vendor_id": "V2", "bank_account_id": "B2"})
    written = materialize(make_invoices(*given).drop("description"), "rows")
    narrow = NarrowInvoices(written, lambda rows: rows.withColumn("description", F.concat(F.lit("a text of "), "invoice_id")))
    expected = rows_of(features.invoice_features(staging.stg_invoices(narrow.whole(), vendors)))
    found = jobs.feature_mart(narrow, vendors)
    assert rows_of(found) == expected and len(expected) == len(given)
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("== Initial Plan ==") :]
    assert plan.count("Exchange hashpartitioning(vendor_id") == 1 and "REPARTITION_BY_COL" in plan
    below = plan[plan.index("Exchange hashpartitioning(vendor_id") :]
    assert "a text of" in plan and "a text of" not in below
    # Vendors too heavy for a task stay, and travel in slices.
    sliced = jobs.feature_mart(narrow, vendors, max_group_rows=2)
    assert rows_of(sliced) == expected
    assert "REPARTITION_BY_COL" not in sliced._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in folders for _, _, files in os.walk(str(top)) for f in files if f.startswith("shuffle_")}


def test_a_large_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(20_000).repartition(3, F.xxhash64("id"))
    written = materialize(rows, "moved", large=True)
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting and written.count() == 20_000
    assert all(".zstd." in file for file in written.inputFiles())
