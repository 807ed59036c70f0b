"""Exact deduplication by a distributed content sort.

Rows are range-partitioned on sampled splitters of (first characters, SHA-256, id) and
sorted by (first characters, SHA-256, whole text, id), so equal texts lie side by side,
also where a group of copies is larger than one partition: the id in the splitters cuts it.
Neighbours are compared by their whole texts. A run of equal texts that touches the end of
its partition is settled with the other ends: at most two rows per partition.

Defined results: null text counts as the empty text; of equal texts the row with the largest
(or smallest) id stays and a null id stays last; of rows that repeat both id and text one
stays; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vouchwell.llm.common import BATCH_ROWS, batches_of, text_of
from vouchwell.storage import materialize

HEAD_CHARS = 48
_TEXT, _HEAD, _DIGEST = "__text", "__head", "__digest"


def _unchanged(text: Column) -> Column:
    return text


def _sorted(rows: DataFrame, id_col: str, keep: str) -> DataFrame:
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    by_id = F.desc_nulls_last(id_col) if keep == "largest" else F.asc_nulls_last(id_col)
    rows = rows.withColumns({_HEAD: F.substring(_TEXT, 1, HEAD_CHARS), _DIGEST: F.sha2(_TEXT, 256)})
    return rows.repartitionByRange(_HEAD, _DIGEST, by_id).sortWithinPartitions(_HEAD, _DIGEST, _TEXT, by_id)


def _starts(batch: pa.RecordBatch, before: pa.Scalar | None) -> list[int]:
    """Rows whose text differs from that of the row above; the first row is held against ``before``."""
    texts = batch.column(batch.schema.get_field_index(_TEXT))
    changed = pc.not_equal(texts[1:], texts[:-1]) if len(texts) > 1 else pa.array([], pa.bool_())
    found = [i + 1 for i in pc.indices_nonzero(changed).to_pylist()]
    return found if before is not None and before.as_py() == texts[0].as_py() else [0, *found]


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = _unchanged,
    keep: str = "largest",
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).alias("id"), normalise(text_of(text_col)).alias(_TEXT))
    rows = _sorted(rows, "id", keep).select("id", _DIGEST, _TEXT)
    kind = rows.schema["id"].dataType.simpleString()

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of the open run wait until it ends; only its first row's text is held."""
        part, run, last, digest = TaskContext.get().partitionId(), -1, None, None
        held: list[pa.Array] = []

        def close(at_end: bool) -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays(held)
            n = len(ids)
            edge = run == 0 or at_end
            yield pa.RecordBatch.from_pydict(
                {
                    "id": ids,
                    "keep_id": pa.array([ids[0].as_py()] * n, ids.type),
                    "group_size": pa.array([n] * n, pa.int64()),
                    "first": pa.array([True] + [False] * (n - 1)),
                    "digest": pa.array([digest] * n, pa.string()),
                    "part": pa.array([part if edge else None] * n, pa.int32()),
                    "run": pa.array([run if edge else None] * n, pa.int64()),
                    "edge_text": pa.array([last.as_py() if edge else None] + [None] * (n - 1), pa.string()),
                }
            )

        def several(ids: pa.Array, digests: pa.Array, cuts: list[int]) -> pa.RecordBatch:
            """The runs between two cuts of one batch: all closed and none at an end."""
            sizes = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
            first = pa.array(cuts[:-1], pa.int64())
            owner = pa.array([k for k, n in enumerate(sizes) for _ in range(n)], pa.int64())
            n, offset = len(owner), cuts[0]
            whole = ids.slice(offset, n)
            return pa.RecordBatch.from_pydict(
                {
                    "id": whole,
                    "keep_id": ids.take(first).take(owner),
                    "group_size": pa.array(sizes, pa.int64()).take(owner),
                    "first": pa.array([j == 0 for size in sizes for j in range(size)], pa.bool_()),
                    "digest": digests.slice(offset, n).cast(pa.string()),
                    "part": pa.nulls(n, pa.int32()),
                    "run": pa.nulls(n, pa.int64()),
                    "edge_text": pa.nulls(n, pa.string()),
                }
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, digests = batch.column("id"), batch.column(_DIGEST)
            cuts = _starts(batch, last)
            if not cuts:
                held.append(ids)
                continue
            if held:
                if cuts[0]:
                    held.append(ids.slice(0, cuts[0]))
                yield from close(False)
                held = []
            whole = cuts[:-1] if run >= 0 else cuts[1:-1]
            if run < 0 and len(cuts) > 1:  # the partition's first run is an end
                run, last, digest = 0, batch.column(_TEXT)[0], digests[0].as_py()
                held = [ids.slice(0, cuts[1])]
                yield from close(False)
                held = []
            if whole:
                yield several(ids, digests, [*whole, cuts[-1]])
                run += len(whole)
            run += 1
            last, digest = batch.column(_TEXT)[cuts[-1]], digests[cuts[-1]].as_py()
            held = [ids.slice(cuts[-1])]
        if held:
            yield from close(True)

    schema = f"id {kind}, keep_id {kind}, group_size long, first boolean, digest string, part int, run long, edge_text string"
    with batches_of(docs.sparkSession, BATCH_ROWS):
        rows = materialize(rows.mapInArrow(runs, schema), "sorted_runs")
    inside = rows.where(F.col("part").isNull()).select("id", "keep_id", "group_size", F.col("first").alias("kept"), "digest")
    # Two ends a partition: the runs of one text become one group.
    ends = rows.where(F.col("edge_text").isNotNull())
    best = (F.max if keep == "largest" else F.min)("keep_id")
    whole = ends.groupBy("edge_text").agg(best.alias("keep_id"), F.sum("group_size").alias("group_size"), F.min("part").alias("lead"))
    settled = ends.select("part", "run", "edge_text").join(whole, "edge_text").drop("edge_text")
    outer = (
        rows.where(F.col("part").isNotNull())
        .select("id", "first", "digest", "part", "run")
        .join(settled, ["part", "run"])
        .select("id", "keep_id", "group_size", (F.col("first") & (F.col("part") == F.col("lead"))).alias("kept"), "digest")
    )
    return inside.unionByName(outer).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = _unchanged,
    keep: str = "largest",
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    names = docs.columns
    rows = _sorted(docs.withColumn(_TEXT, normalise(text_of(text_col))), id_col, keep).select(*names, _TEXT)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """First rows of runs; the first and the last run of a partition carry their text."""
        part, last, waiting = TaskContext.get().partitionId(), None, None

        def out(batch: pa.RecordBatch, edge: bool) -> pa.RecordBatch:
            n = batch.num_rows
            texts = batch.column(batch.num_columns - 1).cast(pa.string()) if edge else pa.nulls(n, pa.string())
            columns = [*batch.columns[:-1], pa.array([part] * n, pa.int32()), texts]
            return pa.RecordBatch.from_arrays(columns, [*names, "__part", "__edge"])

        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = _starts(batch, last)
            last = batch.column(batch.num_columns - 1)[batch.num_rows - 1]
            if not cuts:
                continue
            found = batch.take(pa.array(cuts, pa.int64()))
            if waiting is not None:
                yield out(waiting, not seen)
                seen = True
            if not seen and found.num_rows > 1:
                yield out(found.slice(0, 1), True)
                seen = True
                if found.num_rows > 2:
                    yield out(found.slice(1, found.num_rows - 2), False)
            elif found.num_rows > 1:
                yield out(found.slice(0, found.num_rows - 1), False)
            waiting = found.slice(found.num_rows - 1)
        if waiting is not None:
            yield out(waiting, True)

    schema = T.StructType([*docs.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__edge", T.StringType())])
    with batches_of(docs.sparkSession, BATCH_ROWS):
        rows = materialize(rows.mapInArrow(firsts, schema), "sorted_firsts")
    ends = rows.where(F.col("__edge").isNotNull())
    leads = ends.groupBy("__edge").agg(F.min("__part").alias("__part"))
    ends = ends.join(leads, ["__edge", "__part"], "left_semi")
    return rows.where(F.col("__edge").isNull()).select(*names).unionByName(ends.select(*names))
