"""Invoices as the few short columns that all others follow from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class NarrowInvoices:
    """A written table with vendor_id, and the invoice columns as ``view`` makes them, row by row.

    What moves these rows moves them before ``view``; texts and ids that can be spelled out
    behind an exchange do not travel.
    """

    rows: DataFrame
    view: Callable[[DataFrame], DataFrame]

    @property
    def sparkSession(self) -> SparkSession:
        return self.rows.sparkSession

    def whole(self) -> DataFrame:
        return self.view(self.rows)
