"""Per-vendor statistics and ordered history.

With every vendor within ``max_group_rows`` the features are plain windows over one
exchange on the vendor. A heavier vendor would put all its rows into one task, so its
history is cut into consecutive slices of whole days (a day that is itself too heavy is
cut again by invoice id). Each slice is windowed on its own, preceded by the last rows
of the slices before it, and running counts and totals are carried over from a small
per-slice table. Both forms return the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vouchwell.sources.narrow import NarrowInvoices
from vouchwell.storage import broadcast_if_small, materialize

MAX_GROUP_ROWS = 1_000_000
ROLLING_ROWS = 5
CARRIED = ROLLING_ROWS - 1
SAMPLES_PER_CUT = 8
ARRAY_ROWS = 20_000

STATISTICS = {
    "vendor_invoice_count": F.count,
    "vendor_avg_amount": F.avg,
    "vendor_std_amount": F.stddev_samp,
    "vendor_min_amount": F.min,
    "vendor_max_amount": F.max,
}


def _statistic(name: str) -> Column:
    return F.count(F.lit(1)) if name == "vendor_invoice_count" else STATISTICS[name]("amount")


def _previous_and_rolling(ordered: W) -> dict[str, Column]:
    recent = ordered.rowsBetween(-CARRIED, W.currentRow)
    return {
        "previous_invoice_amount": F.lag("amount").over(ordered),
        "previous_invoice_date": F.lag("invoice_date").over(ordered),
        "previous_payment_delay": F.lag("days_to_payment").over(ordered),
        "rolling_avg_amount": F.avg("amount").over(recent),
        "rolling_std_amount": F.stddev_samp("amount").over(recent),
        "rolling_total_amount": F.sum("amount").over(recent),
        "rolling_avg_days_to_payment": F.avg("days_to_payment").over(recent),
    }


def with_history(staged: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Vendor statistics, previous invoice, rolling and cumulative amounts, account counts."""
    counts = vendor_counts(staged) if counts is None else counts
    accounts = counts.groupBy("bank_account_id").agg(F.sum("n").alias("n"))
    return with_account_counts(vendor_history(staged, max_group_rows, counts), accounts)


def vendor_counts(staged: DataFrame) -> DataFrame:
    """Invoices per vendor and bank account, written."""
    return materialize(account_counts(staged, "vendor_id"), "vendor_counts")


def dealt(invoices: NarrowInvoices, counts: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Invoice columns, made where the windows find them: the narrow rows have moved to their vendor.

    With a vendor above ``max_group_rows`` rows stay, as slices of vendors travel instead.
    """
    _, heaviest = _vendor_rows(counts)
    return invoices.whole() if heaviest > max_group_rows else invoices.view(invoices.rows.repartition("vendor_id"))


def _vendor_rows(counts: DataFrame) -> tuple[DataFrame, int]:
    """(vendor_id, n), and the largest n."""
    rows = counts.groupBy("vendor_id").agg(F.sum("n").alias("n"))
    return rows, rows.agg(F.max("n")).first()[0] or 0


def account_counts(staged: DataFrame, *keys: str) -> DataFrame:
    """Invoices per bank account (and ``keys``)."""
    return staged.groupBy(*keys, "bank_account_id").agg(F.count(F.lit(1)).alias("n"))


def vendor_history(staged: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """What depends on the invoices of the same vendor only."""
    vendor_rows, heaviest = _vendor_rows(account_counts(staged, "vendor_id") if counts is None else counts)
    # Undated rows come last.
    rows = staged.withColumn("_day", F.coalesce("invoice_date", F.lit("9999-12-31").cast("date")))
    if heaviest <= max_group_rows:
        rows = _whole_vendors(rows)
    else:
        rows = _sliced_vendors(rows, vendor_rows, max_group_rows)
    return rows.drop("_day")


def _whole_vendors(rows: DataFrame) -> DataFrame:
    vendor = W.partitionBy("vendor_id")
    ordered = vendor.orderBy("_day", "invoice_id")
    to_date = vendor.orderBy("_day").rangeBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumns(
        {"vendor_invoice_number": F.row_number().over(ordered).cast("bigint")} | _previous_and_rolling(ordered)
    ).withColumns(
        {"cumulative_vendor_spend": F.sum("amount").over(to_date)}
        | {name: _statistic(name).over(vendor) for name in STATISTICS}
    )


def with_account_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Invoices per bank account from (bank_account_id, n); NULL is one account."""
    accounts = broadcast_if_small(
        counts.select(F.col("bank_account_id").alias("_account"), F.col("n").alias("bank_account_vendor_count"))
    )
    return rows.join(accounts, rows["bank_account_id"].eqNullSafe(F.col("_account")), "left").drop("_account")


def _position(sorted_values: Column, value: Column) -> Column:
    """How many entries of a sorted array are <= value, by halving steps; as many as any array's size has bits."""
    steps = F.array(*[F.lit(2**k) for k in range(30, -1, -1)])

    def step(pos, width):
        reach = pos + F.least(width, F.size(sorted_values))
        fits = (pos + width.cast("long") <= F.size(sorted_values)) & (F.get(sorted_values, reach - 1) <= value)
        return F.when(fits, reach).otherwise(pos)

    return F.when(sorted_values.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))


def _slice_starts(heavy: DataFrame, max_group_rows: int) -> tuple[DataFrame, DataFrame]:
    """Per heavy vendor its slice-opening days, and the days that need cutting by id."""
    days = heavy.groupBy("vendor_id", "_day").agg(F.count(F.lit(1)).alias("n"))
    by_day = W.partitionBy("vendor_id").orderBy("_day")
    before = F.coalesce(F.sum("n").over(by_day.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    days = days.withColumn("fill", F.floor(before / max_group_rows)).withColumn("big", F.col("n") > max_group_rows)
    opens = (
        F.lag("fill").over(by_day).isNull()
        | (F.lag("fill").over(by_day) != F.col("fill"))
        | F.col("big")
        | F.lag("big").over(by_day)
    )
    days = days.withColumn("opens", opens)
    starts = (
        days.filter("opens")
        .groupBy(F.col("vendor_id").alias("_vendor"))
        .agg(F.sort_array(F.collect_list("_day")).alias("_starts"))
    )
    return starts, days.filter("big").select("vendor_id", "_day", "n")


def _day_cuts(heavy: DataFrame, big_days: DataFrame, max_group_rows: int) -> DataFrame:
    """Id boundaries inside heavy days, from a hash sample of bounded size per day."""
    pieces = F.ceil(F.col("n") / max_group_rows)
    rated = big_days.select(
        F.col("vendor_id").alias("_vendor"),
        F.col("_day").alias("_cut_day"),
        F.greatest(F.lit(1), F.floor(F.col("n") / (pieces * SAMPLES_PER_CUT))).alias("every"),
    )
    sample = heavy.join(
        broadcast_if_small(rated), F.col("vendor_id").eqNullSafe(F.col("_vendor")) & (F.col("_day") == F.col("_cut_day"))
    ).filter(F.pmod(F.xxhash64("invoice_id"), F.col("every")) == 0)
    ids = F.sort_array(F.collect_list("invoice_id"))
    return (
        sample.groupBy("_vendor", "_cut_day")
        .agg(ids.alias("ids"))
        .select(
            "_vendor",
            "_cut_day",
            F.filter("ids", lambda _, i: i % SAMPLES_PER_CUT == SAMPLES_PER_CUT - 1).alias("_cuts"),
        )
    )


def _sliced_vendors(rows: DataFrame, vendor_rows: DataFrame, max_group_rows: int) -> DataFrame:
    # At most total_rows / max_group_rows vendors, and about twice as many slices.
    heavy_vendors = vendor_rows.filter(F.col("n") > max_group_rows).select(F.col("vendor_id").alias("_vendor"))
    heavy_vendors = broadcast_if_small(materialize(heavy_vendors, "heavy_vendors"))
    same_vendor = F.col("vendor_id").eqNullSafe(F.col("_vendor"))
    narrow = rows.select("vendor_id", "_day", "invoice_id", "amount", "invoice_date", "days_to_payment")
    heavy = materialize(narrow.join(heavy_vendors, same_vendor, "left_semi"), "heavy_rows", large=True)

    starts, big_days = _slice_starts(heavy, max_group_rows)
    starts = materialize(starts, "slice_starts", large=True)
    big_days = materialize(big_days, "big_days", large=True)
    cuts = materialize(_day_cuts(heavy, big_days, max_group_rows), "day_cuts", large=True)

    def placed(df: DataFrame) -> DataFrame:
        in_day = same_vendor & (F.col("_day") == F.col("_cut_day"))
        return (
            df.join(broadcast_if_small(starts, ARRAY_ROWS), same_vendor, "left")
            .withColumn("_slice", _position(F.col("_starts"), F.col("_day")))
            .drop("_vendor", "_starts")
            .join(broadcast_if_small(cuts, ARRAY_ROWS), in_day, "left")
            .withColumn("_piece", _position(F.col("_cuts"), F.col("invoice_id")))
            .drop("_vendor", "_cut_day", "_cuts")
        )

    keys = ["vendor_id", "_slice", "_piece"]
    slices = materialize(_slice_summary(placed(heavy), keys), "vendor_slices", large=True)
    totals = heavy.groupBy(F.col("vendor_id").alias("_vendor")).agg(
        *[_statistic(name).alias(f"_{name}") for name in STATISTICS]
    )
    totals = materialize(totals.withColumn("_heavy", F.lit(True)), "heavy_vendor_totals", large=True)

    carried = slices.select(*keys, F.explode("carried").alias("c")).select(*keys, "c.*", F.lit(True).alias("_carried"))
    summary = slices.select(
        F.col("vendor_id").alias("_vendor"),
        F.col("_slice").alias("_s"),
        F.col("_piece").alias("_p"),
        "rows_before",
        "spend_before",
        "slice_spend",
        "pieces",
    )
    same_piece = same_vendor & (F.col("_slice") == F.col("_s")) & (F.col("_piece") == F.col("_p"))

    piece = W.partitionBy(*keys)
    ordered = piece.orderBy("_day", "invoice_id")
    to_date = piece.orderBy("_day").rangeBetween(W.unboundedPreceding, W.currentRow)
    own_amount = F.when(F.col("_carried").isNull(), F.col("amount"))
    windowed = (
        placed(rows)
        .unionByName(carried, allowMissingColumns=True)
        .withColumns({"_number": F.row_number().over(ordered).cast("bigint")} | _previous_and_rolling(ordered))
        .withColumns(
            {"_spend": F.sum(own_amount).over(to_date)} | {name: _statistic(name).over(piece) for name in STATISTICS}
        )
        .filter(F.col("_carried").isNull())
        .join(broadcast_if_small(summary), same_piece, "left")
        .drop("_vendor")
        .join(broadcast_if_small(totals), same_vendor, "left")
    )
    rows_before = F.coalesce("rows_before", F.lit(0))
    # A day cut into pieces is a slice of its own, and all its rows share one running total.
    in_slice = F.when(F.col("pieces") > 1, F.col("slice_spend")).otherwise(F.col("_spend"))
    before = F.col("spend_before")
    windowed = windowed.withColumns(
        {
            "vendor_invoice_number": F.col("_number") + rows_before - F.least(rows_before, F.lit(CARRIED)),
            "cumulative_vendor_spend": F.coalesce(before + in_slice, before, in_slice),
        }
        | {name: F.when(F.col("_heavy"), F.col(f"_{name}")).otherwise(F.col(name)) for name in STATISTICS}
    )
    added = ["vendor_invoice_number", *_previous_and_rolling(ordered), "cumulative_vendor_spend", *STATISTICS]
    return windowed.select(*rows.columns, *added)


def _slice_summary(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Per slice: rows and spend before it, and the last rows that precede it."""
    newest = W.partitionBy(*keys).orderBy(F.desc("_day"), F.desc("invoice_id"))
    entry = F.struct("_day", "invoice_id", "amount", "invoice_date", "days_to_payment")
    tails = (
        placed.withColumn("r", F.row_number().over(newest))
        .filter(F.col("r") <= CARRIED)
        .groupBy(*keys)
        .agg(F.collect_list(entry).alias("tail"))
    )
    totals = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("spend"))
    match = [totals[k].eqNullSafe(tails[k]) for k in keys]
    slices = totals.join(tails, match[0] & match[1] & match[2]).select(
        *[totals[k] for k in keys], "n", "spend", "tail"
    )
    in_order = W.partitionBy("vendor_id").orderBy("_slice", "_piece")
    earlier_slices = W.partitionBy("vendor_id").orderBy("_slice").rangeBetween(W.unboundedPreceding, -1)
    slice_ = W.partitionBy("vendor_id", "_slice")
    preceding = F.sort_array(F.flatten(F.collect_list("tail").over(in_order.rowsBetween(-CARRIED, -1))))
    return slices.select(
        *keys,
        F.coalesce(F.sum("n").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("rows_before"),
        F.sum("spend").over(earlier_slices).alias("spend_before"),
        F.sum("spend").over(slice_).alias("slice_spend"),
        F.count(F.lit(1)).over(slice_).alias("pieces"),
        F.slice(preceding, F.greatest(F.size(preceding) - CARRIED + 1, F.lit(1)), CARRIED).alias("carried"),
    )
