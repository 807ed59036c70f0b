"""Written intermediate tables and size-checked broadcasts.

Intermediate tables go to the shared folder the session names in
``spark.checkpoint.dir``; they survive executor loss and, being parquet, give Spark
real sizes to plan with. A session without executors of its own, where the setting is
missing, gets a folder that is removed when the process ends.

What a finished write has shuffled is of no use any more; for tables as long as the input those
files go with the write, so the disk holds them for one job at a time.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
#: Spark then removes an execution's shuffle files at its end; older versions pass over it.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="vouchwell-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared place."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}/{name}"


def worker_uri(path: str) -> str:
    """A folder of the shared place as a URI that pyarrow opens inside tasks."""
    if "://" in path:
        return path.replace("file:////", "file:///")
    return "file://" + path.removeprefix("file:")


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go as soon as it is done."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, large: bool = False) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Tables as long as the input (``large``) are packed tighter, and leave no shuffle files.
    """
    path = run_folder(df.sparkSession, name)
    if large:
        with dropping_shuffles(df.sparkSession):
            df.write.parquet(path, compression="zstd")
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a row count; beyond the bound Spark joins by shuffle.

    Pass a table that is cheap to count: a file or a materialized result. Rows are narrow;
    tables with long arrays are given a lower bound.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
