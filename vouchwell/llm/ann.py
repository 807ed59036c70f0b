"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is centred, scaled to length one, turned by a random isometry into
``BITS_PER_DIM`` times its dimensions and kept as its sign bits beside two scalars: its length
and the inner product of the unit vector with its own code. A turned query times the signs,
corrected by the scalars, estimates the inner product. The estimate's error falls with the
square root of the number of bits; with ``BOUND`` of its standard deviations it says which
vectors can still be among the nearest. Those, and only those, are measured again on the
original vectors in double precision. Every query starts from the k-th best of at most
``SAMPLE_ROWS`` vectors, measured exactly, and in every cell the best by estimate are measured
first, so that the bounds leave few others.

The centre is the mean of at most ``CENTRE_ROWS`` vectors by hash; every vector is indexed.
Queries meet all vectors in cells of at most about ``CELL_ROWS`` vectors by ``CELL_QUERIES`` queries.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without an id; only vectors of the query's own number of components
are its candidates; rows with the query's id are not; ties go to the smaller id; of rows that
repeat a query's id the smallest vector asks; an empty table gives an empty result; other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouchwell.storage import materialize

CENTRE_ROWS = 10_000
CELL_ROWS, CELL_QUERIES = 8_192, 4_096
MOST_TASKS = 20_000
CHUNK_ROWS, CHUNK_QUERIES = 2_048, 256
BITS_PER_DIM = 8
SAMPLE_ROWS = 8_192
BOUND = 3.5
#: Rounding of single-precision estimates, against the lengths of both vectors.
ROUNDING = 1e-5
SEED = 20_240


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """Rows of a random orthogonal matrix: dims x width, the width in whole 64-bit words."""
    width = -(-dims * BITS_PER_DIM // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed + dims).standard_normal((width, width)))
    return (q * np.sign(np.diag(r)))[:dims]


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, lengths, inner products of the unit vectors with their codes)."""
    rest = vectors - centre
    length = np.sqrt(np.einsum("ij,ij->i", rest, rest))
    turned = (rest / np.where(length > 0, length, 1)[:, None]) @ turn
    own = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1])
    return _packed(turned > 0), length, np.where(length > 0, own, 1.0)


def _centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """A centre for each number of components that occurs in the sample."""
    n = rows.count()
    share = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, CENTRE_ROWS / max(n, 1)) * (1 << 30)))
    found: dict[int, list[np.ndarray]] = {}
    for row in share.select("vector").toArrow().column("vector").to_pylist():
        found.setdefault(len(row), []).append(np.asarray(row))
    return {dims: np.mean(held, axis=0) for dims, held in found.items()}


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The written index: id, dims, vector, code, length and own, the code's correction."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _valid(F.col("vector")))
    centres = rows.sparkSession.sparkContext.broadcast(_centres(rows))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            held = batch.column("vector")
            sizes = held.value_lengths().to_numpy()
            for dims in np.unique(sizes):
                own = batch.filter(pa.array(sizes == dims))
                x = own.column("vector").flatten().to_numpy().reshape(-1, dims)
                if dims not in turns:
                    turns[dims] = rotation(int(dims))
                code, length, product = encode(x, centres.value.get(int(dims), np.zeros(dims)), turns[dims])
                packed = pa.FixedSizeListArray.from_arrays(pa.array(code.view(np.int64).ravel()), code.shape[1]).cast(pa.list_(pa.int64()))
                columns = [own.column("id"), pa.array(np.full(len(x), dims, np.int32)), own.column("vector"), packed, pa.array(length), pa.array(product)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "dims", "vector", "code", "length", "own"])

    schema = "id long, dims int, vector array<double>, code array<long>, length double, own double"
    return materialize(rows.mapInArrow(codes, schema), "codes")


def _matrix(table: pa.Table, column: str, dtype: type) -> np.ndarray:
    flat = table.column(column).combine_chunks().flatten().to_numpy()
    return flat.astype(dtype, copy=False).reshape(table.num_rows, -1)


def _signs(code: np.ndarray) -> np.ndarray:
    """The codes as +1 and -1, a column per bit."""
    return np.unpackbits(np.ascontiguousarray(code).view(np.uint8), axis=1, bitorder="little").astype(np.float32) * 2 - 1


def nearest_in_cell(
    ids: np.ndarray, x: np.ndarray, code: np.ndarray, length: np.ndarray, own: np.ndarray,
    query_ids: np.ndarray, q: np.ndarray, least: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, id, score) of the k nearest of one cell, and how many pairs were measured on the original vectors.

    ``least`` is a score that k vectors of each query are known to reach.
    """
    width = turn.shape[1]
    spread = np.sqrt(np.maximum(1 - own**2, 0)) / own / np.sqrt(max(width - 1, 1)) * length
    scale = length / own / np.sqrt(width)
    turned, norm, central = (q @ turn).astype(np.float32), np.sqrt(np.einsum("ij,ij->i", q, q)), q @ centre
    kth, measured = least.copy(), 0
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for b in range(0, len(x), CHUNK_ROWS):
        rows = slice(b, b + CHUNK_ROWS)
        signs, some_ids = _signs(code[rows]), ids[rows]
        new: list[tuple] = []
        for a in range(0, len(q), CHUNK_QUERIES):
            part = slice(a, a + CHUNK_QUERIES)
            guess = (turned[part] @ signs.T) * scale[rows].astype(np.float32) + central[part, None].astype(np.float32)
            error = norm[part, None] * (BOUND * spread[rows] + ROUNDING * (length[rows] + np.sqrt(centre @ centre)))
            foreign = query_ids[part, None] != some_ids[None, :]
            guess = np.where(foreign, guess, -np.inf)
            limit = kth[part]
            if guess.shape[1] > k:  # the best by estimate say how good a score must be
                likely = np.argpartition(guess, -k, axis=1)[:, -k:]
                exact = np.einsum("ikj,ij->ik", x[rows][likely], q[part])
                fits = np.take_along_axis(foreign, likely, 1).all(axis=1)
                limit = np.where(fits, np.maximum(limit, exact.min(axis=1)), limit)
            who, which = np.nonzero(foreign & (guess + error >= limit[:, None]))
            score = np.empty(len(who))
            for c in range(0, len(who), 65_536):
                some = slice(c, c + 65_536)
                score[some] = np.einsum("ij,ij->i", x[rows][which[some]], q[part][who[some]])
            measured += len(who)
            new.append((who + a, some_ids[which], score))
        held = tuple(np.concatenate(parts) for parts in zip(held, *new, strict=True))
        order = np.lexsort((held[1], -held[2], held[0]))
        who, found, score = (part[order] for part in held)
        rank = np.arange(len(who)) - np.searchsorted(who, np.arange(len(q)))[who]
        full = rank == k - 1
        kth[who[full]] = np.maximum(kth[who[full]], score[full])
        held = (who[rank < k], found[rank < k], score[rank < k])
    return *held, measured


def _least_scores(asked: DataFrame, index: DataFrame, n: int, k: int) -> DataFrame:
    """``asked`` with the k-th best score among a bounded sample of the index, which all vectors' k-th best reaches."""
    share = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(n, 1)) * (1 << 30))
    held = index.where(share).select("id", "dims", "vector").toArrow()
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dims in pc.unique(held.column("dims")).to_pylist():
        own = held.filter(pc.equal(held.column("dims"), dims))
        sample[dims] = (own.column("id").to_numpy(), _matrix(own, "vector", np.float64))
    shared = asked.sparkSession.sparkContext.broadcast(sample)

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.full(batch.num_rows, -np.inf)
            dims, query = batch.column("dims").to_numpy(), batch.column("query_id").to_numpy()
            for size, (ids, x) in shared.value.items():
                mine = np.flatnonzero(dims == size)
                for a in range(0, len(mine) if len(ids) > k else 0, CHUNK_QUERIES):
                    part = mine[a : a + CHUNK_QUERIES]
                    q = batch.column("vector").take(pa.array(part)).flatten().to_numpy().reshape(-1, size)
                    scores = np.where(query[part, None] != ids[None, :], q @ x.T, -np.inf)
                    least[part] = np.partition(scores, -k, axis=1)[:, -k]
            # The product above and single sums may differ in the last digits.
            least -= 1e-9 * np.abs(np.where(np.isfinite(least), least, 0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=[*batch.schema.names, "least"])

    return asked.mapInArrow(seed, "query_id long, dims int, vector array<double>, least double")


def search(index: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors of every query."""
    spark = index.sparkSession
    asked = index.where(is_query).groupBy("id", "dims").agg(F.min("vector").alias("vector"))
    asked = asked.groupBy("id").agg(F.min(F.struct("dims", "vector")).alias("q")).select(F.col("id").alias("query_id"), "q.*")
    n = index.count()
    asked = materialize(_least_scores(asked, index, n, k), "queries")
    m = asked.count()
    wide, high = max(1, -(-n // CELL_ROWS)), max(1, -(-m // CELL_QUERIES))
    centres = spark.sparkContext.broadcast(_centres(index))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = index.withColumn("column", F.pmod(F.xxhash64("id"), F.lit(wide)).cast("int")).withColumn("row", every(high))
    right = asked.withColumn("row", F.pmod(F.xxhash64("query_id"), F.lit(high)).cast("int")).withColumn("column", every(wide))

    def cell(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        x, q = _matrix(vectors, "vector", np.float64), _matrix(queries, "vector", np.float64)
        dims = x.shape[1]
        who, found, score, _ = nearest_in_cell(
            vectors.column("id").to_numpy(), x, _matrix(vectors, "code", np.int64).view(np.uint64),
            vectors.column("length").to_numpy(), vectors.column("own").to_numpy(),
            queries.column("query_id").to_numpy(), q, queries.column("least").to_numpy(), centres.value.get(dims, np.zeros(dims)), rotation(dims), k,
        )
        return pa.table({"query_id": queries.column("query_id").to_numpy()[who], "vec_id": found, "score": score})

    keys = ["dims", "row", "column"]
    tasks = min(wide * high, MOST_TASKS)  # a number of their own, or few heavy cells would share a task
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
