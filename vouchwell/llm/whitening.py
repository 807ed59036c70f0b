"""Whitening of embeddings from an incremental eigendecomposition of their covariance.

Vectors become fixed-point integers, so counts and sums are exact in any order. A task keeps
a few decompositions side by side (``LANES``); every row changes the mean of one and adds a
centred rank-one term to it, ``rank_one.update``. Two spectra of sizes m and n become one by a
rank-one update per eigenvector, and one for the distance of their means, weighed m n/(m + n).
Lanes of a task are combined that way, then tasks, ``FAN`` at a time, on the executors. Last, a
pass over the rows projects them, centred exactly, on the combined eigenvectors; the
covariance of the projections is all but diagonal, and its eigenvectors (Rayleigh-Ritz over
the full space) give components to double precision whatever the order of rows and tasks was.

A row costs O(d^3) steps for d dimensions, a spectrum d^2 numbers; neither grows with the rows.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry, or one too
large for fixed point (over 2^40), take no part; nor do vectors of another length than the
most frequent one (of equals, the longest). Repeated rows count each time and null ids are
kept. Components without variance (less than d times the machine epsilon of the largest) are
left out, so a single row or equal rows give no result rows; nor does an empty table. A
deviation over 2^63 is null. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchwell.llm import rank_one
from vouchwell.storage import materialize

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LANES, LANE_BYTES = 16, 1 << 19
FAN = 16
RESULT_ROWS = 4096
LARGEST = float(1 << 40)
SPECTRUM = "part int, n bigint, mean array<double>, level array<double>, axes array<double>"
MATRIX = "part int, total array<double>"


@dataclass
class Whitening:
    """A fitted whitening: rows of ``axes`` are components by falling variance ``levels``."""

    n: int
    sums: np.ndarray
    levels: np.ndarray
    axes: np.ndarray
    trace: float
    scale: int
    offset: int
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        return self.n * x - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ self.axes.T / np.sqrt(self.levels)


def fixed_point(batch: pa.RecordBatch, width: int, scale: int, offset: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of a batch that take part, and their vectors as integers."""
    column = batch.column("vector")
    batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(column), width), False))
    flat = batch.column("vector").flatten().cast(pa.float64())
    values = np.floor(scale * flat.to_numpy(zero_copy_only=False).reshape(-1, width)) + offset
    good = (np.abs(values) <= LARGEST).all(axis=1)
    return batch.filter(pa.array(good)), values[good].astype(np.int64)


def fit(
    rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> Whitening | None:
    """The whitening of all rows that take part; None without any, or without variance."""
    vectors = rows.select(F.col(vector_col).alias("vector"))
    lengths = vectors.where("vector IS NOT NULL").groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None or most["width"] == 0:
        return None
    width = most["width"]
    n, sums = _sums(vectors, width, scale, offset)
    if n == 0:
        return None
    plain = Whitening(n, sums, np.ones(width), np.eye(width), 0.0, scale, offset)
    axes, _ = np.linalg.qr(_combined(vectors, plain))
    basis = Whitening(n, sums, np.ones(width), axes.T, 0.0, scale, offset)
    levels, turn = np.linalg.eigh(_second_moments(vectors, basis) / n)
    levels, turn = levels[::-1], turn[:, ::-1]
    kept = min(components, int((levels > width * rank_one.EPS * levels[0]).sum()))
    if not kept:
        return None
    model = Whitening(n, sums, levels[:kept].copy(), (axes @ turn[:, :kept]).T.copy(), float(levels.sum()), scale, offset)
    model.identity_error = float(np.abs(_second_moments(vectors, model) / n - np.eye(kept)).max())
    return model


def transform(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector that takes part and component: id, component, n, deviation, whitened, explained, identity_error."""
    vectors = rows.select(F.col(id_col).alias("row_id"), F.col(vector_col).alias("vector"))
    kind = vectors.schema["row_id"].dataType.simpleString()
    schema = (
        f"row_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is None:
            return
        width, kept = len(model.sums), len(model.levels)
        for batch in _cut(batches, max(1, RESULT_ROWS // kept)):
            batch, x = fixed_point(batch, width, model.scale, model.offset)
            if not len(x):
                continue
            apart = model.centred(x)
            large = (apart.astype(float) ** 2).sum(axis=1) >= 2.0**63
            deviation = np.where(large, 0, (np.where(large[:, None], 0, apart) ** 2).sum(axis=1))
            row, rows_ = np.repeat(np.arange(len(x)), kept), len(x) * kept
            columns = [
                batch.column("row_id").take(pa.array(row)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                pa.array(np.full(rows_, model.n)),
                pa.array(deviation[row], mask=large[row]),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(model.levels / model.trace, len(x))),
                pa.array(np.full(rows_, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return vectors.mapInArrow(project, schema).withColumnRenamed("row_id", id_col)


def _cut(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _sums(vectors: DataFrame, width: int, scale: int, offset: int) -> tuple[int, np.ndarray]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            _, x = fixed_point(batch, width, scale, offset)
            n, total = n + len(x), total + x.sum(axis=0)
        values = pa.array(np.concatenate([[n], total]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), values], names=["place", "value"])

    parts = vectors.mapInArrow(add, "place bigint, value bigint")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()  # width + 1 rows
    values = np.array([r["value"] for r in found], np.int64) if found else np.zeros(width + 1, np.int64)
    return int(values[0]), values[1:]


class _Lanes:
    """Spectra side by side: sizes, means, eigenvalues and eigenvectors of the scatter."""

    def __init__(self, n: np.ndarray, mean: np.ndarray, level: np.ndarray, axes: np.ndarray) -> None:
        self.n, self.mean, self.level, self.axes = n, mean, level, axes

    @classmethod
    def empty(cls, lanes: int, width: int) -> _Lanes:
        return cls(np.zeros(lanes), np.zeros((lanes, width)), np.zeros((lanes, width)), np.tile(np.eye(width), (lanes, 1, 1)))

    def add(self, x: np.ndarray) -> None:
        """One row to each of the first lanes."""
        m = len(x)
        apart = x - self.mean[:m]
        self.n[:m] += 1
        n = self.n[:m, None]
        self.mean[:m] += apart / n
        self.level[:m], self.axes[:m] = rank_one.update(self.level[:m], self.axes[:m], np.sqrt((n - 1) / n) * apart)

    def combined(self) -> _Lanes:
        """All lanes in one: halves are merged until one is left."""
        lanes = self
        while len(lanes.n) > 1:
            half = (len(lanes.n) + 1) // 2
            rest = len(lanes.n) - half
            a, b = slice(0, rest), slice(half, None)
            level, axes = lanes.level[:half].copy(), lanes.axes[:half].copy()
            n, mean = lanes.n[:half].copy(), lanes.mean[:half].copy()
            for j in range(level.shape[1]):
                change = np.sqrt(np.maximum(lanes.level[b, j], 0))[:, None] * lanes.axes[b, :, j]
                level[a], axes[a] = rank_one.update(level[a], axes[a], change)
            apart, both = lanes.mean[b] - mean[a], n[a] + lanes.n[b]
            share = (lanes.n[b] / np.maximum(both, 1))[:, None]
            level[a], axes[a] = rank_one.update(level[a], axes[a], np.sqrt(n[a][:, None] * share) * apart)
            mean[a] += share * apart
            n[a] = both
            lanes = _Lanes(n, mean, level, axes)
        return lanes

    def frame(self, part: int) -> pa.RecordBatch:
        row = [part, int(self.n[0]), self.mean[0], self.level[0], self.axes[0].ravel()]
        kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.float64())] * 3]
        names = [f.strip().split(" ")[0] for f in SPECTRUM.split(",")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)


def _combined(vectors: DataFrame, model: Whitening) -> np.ndarray:
    """The eigenvectors, in columns, of the scatter of all rows."""
    width = len(model.sums)
    middle = np.round(model.sums / model.n).astype(np.int64)  # near rows, so that their numbers are small

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes = None
        for batch in batches:
            _, x = fixed_point(batch, width, model.scale, model.offset)
            if lanes is None and len(x):
                most = min(LANES, LANE_BYTES // (8 * width * width))
                lanes = _Lanes.empty(int(np.clip(len(x) // (2 * width), 1, max(most, 1))), width)
            for start in range(0, len(x), len(lanes.n) if lanes else 1):
                lanes.add((x[start : start + len(lanes.n)] - middle).astype(float))
        if lanes is not None:
            yield lanes.combined().frame(TaskContext.get().partitionId())

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("part")
        n, mean, level = part["n"].to_numpy(float), np.stack(part["mean"]), np.stack(part["level"])
        lanes = _Lanes(n, mean, level, np.stack(part["axes"]).reshape(-1, width, width)).combined()
        row = [int(part["part"].iloc[0]) // FAN, int(lanes.n[0]), lanes.mean[0], lanes.level[0], lanes.axes[0].ravel()]
        return pd.DataFrame([row], columns=part.columns)

    return np.array(_folded(vectors.mapInArrow(grow, SPECTRUM), merge)["axes"]).reshape(width, width)


def _second_moments(vectors: DataFrame, model: Whitening) -> np.ndarray:
    """The sum over all rows of the whitened vector times its transpose."""
    width, kept = len(model.sums), len(model.levels)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept, kept))
        for batch in batches:
            y = model.whitened(fixed_point(batch, width, model.scale, model.offset)[1])
            total += y.T @ y
        columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.ravel()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "total"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("part")
        return pd.DataFrame([[int(part["part"].iloc[0]) // FAN, np.sum(np.stack(part["total"]), axis=0)]], columns=part.columns)

    return np.array(_folded(vectors.mapInArrow(add, MATRIX), merge)["total"]).reshape(kept, kept)


def _folded(parts: DataFrame, merge: Callable[[pd.DataFrame], pd.DataFrame]):
    """One row from a row per task, ``FAN`` of them at a time."""
    parts = materialize(parts, "parts")
    while parts.count() > 1:
        grouped = parts.groupBy(F.floor(F.col("part") / FAN).alias("group"))
        parts = materialize(grouped.applyInPandas(merge, parts.schema), "parts")
    return parts.first()
