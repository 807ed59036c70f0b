"""Interpolated modified Kneser-Ney models over character n-grams, built by count joins.

A text is lower-cased; white space becomes a blank and digits become "0". Code points below
4,096 are symbols of their own, higher ones are folded onto 2,048 symbols, so that a symbol
takes 12 bits and an n-gram of five is one 60-bit number. Its context and its suffix are a
shift and a mask, so every count, continuation count and discount is a grouping or a join of
numbers, sharded by their hash. The five symbols before a text are boundary marks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.llm.common import PIECE_CHARS, slices, text_of
from vouchwell.storage import materialize

ORDER, BITS = 5, 12
SYMBOLS = 1 << BITS
#: Up to so many n-grams (16 bytes each) the model goes to the tasks whole; beyond, texts meet it by a join.
BROADCAST_GRAMS = 4_000_000
MERGE_ROWS = 4_000_000
#: Values are summed as whole multiples of 1 / SCALE, so that no order of summation can show.
SCALE = 1 << 30

#: Texts -> (rows, keys per row, keys end to end) of groups of texts or of their pieces.
Extract = Callable[[list[str | None]], Iterator[tuple[list[int], np.ndarray, np.ndarray]]]

_FOLD = np.arange(SYMBOLS, dtype=np.int64)
_FOLD[9:14] = ord(" ")
_FOLD[ord("0") : ord("9") + 1] = ord("0")


def _symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    high = points >= SYMBOLS
    if high.any():
        points[high] = SYMBOLS // 2 + ((points[high] * 2654435761) % (1 << 32) >> 21)
    return _FOLD[points]


def grams(texts: list[str | None], most: int = PIECE_CHARS) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(rows, counts, n-grams) of groups of whole texts or, for a longer one, of its pieces."""
    lead = ORDER - 1

    def pieces() -> Iterator[tuple[int, str]]:
        for row, text in enumerate(texts):
            text = "\0" * lead + (text or "").lower().replace("\0", "\1")
            for start in range(0, max(len(text) - lead, 1), most):
                yield row, text[start : start + most + lead]

    def packed(held: list[tuple[int, str]]) -> tuple[list[int], np.ndarray, np.ndarray]:
        sizes = np.array([len(text) for _, text in held], dtype=np.int64)
        symbols = _symbols("".join(text for _, text in held))
        found = symbols.copy()
        for back in range(1, ORDER):
            found[back:] |= symbols[:-back] << (BITS * back)
        inside = np.ones(len(symbols), dtype=bool)
        starts = np.cumsum(sizes) - sizes
        for step in range(lead):
            inside[starts + step] = False
        return [row for row, _ in held], sizes - lead, found[inside]

    held, size = [], 0
    for row, text in pieces():
        if held and size + len(text) > most:
            yield packed(held)
            held, size = [], 0
        held.append((row, text))
        size += len(text)
    if held:
        yield packed(held)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return [(keys[starts], np.add.reduceat(counts, starts))] if len(keys) else []


def class_counts(docs: DataFrame, class_col: Column, classes: int, text_col: str = "text") -> DataFrame:
    """gram, c0, c1, ...: how often texts of each class hold an n-gram; class -1 adds rows without counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, "text", 4 * PIECE_CHARS):
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            for rows, sizes, found in grams(batch.column("text").to_pylist()):
                keys = found << 3 | np.repeat(kinds[rows] + 1, sizes)
                parts.append(np.unique(keys, return_counts=True))
            if sum(len(k) for k, _ in parts) > MERGE_ROWS:
                parts = _merged(parts)
        for keys, counts in _merged(parts) if parts else []:
            for start in range(0, len(keys), 200_000):
                k, c = keys[start : start + 200_000], counts[start : start + 200_000]
                kind = (k & 7) - 1
                columns = [pa.array(k >> 3)] + [pa.array(np.where(kind == j, c, 0)) for j in range(classes)]
                yield pa.RecordBatch.from_arrays(columns, ["gram", *names])

    names = [f"c{j}" for j in range(classes)]
    rows = docs.select(text_of(text_col).alias("text"), class_col.cast("long").alias("kind"))
    counted = rows.mapInArrow(count, ", ".join(["gram long", *(f"{c} long" for c in names)]))
    return materialize(counted.groupBy("gram").agg(*(F.sum(c).alias(c) for c in names)), "grams")


def discounts(rows: DataFrame, counts: list[str]) -> dict[str, list[float]]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    seen = rows.agg(*(F.count_if(F.col(c) == k).alias(f"{c}_{k}") for c in counts for k in (1, 2, 3, 4))).first()
    found = {}
    for c in counts:
        n1, n2, n3, n4 = (seen[f"{c}_{k}"] for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        found[c] = [min(max(x, 0.05), k - 0.05) for k, x in enumerate(raw, 1)]
    return found


def _smoothed(rows: DataFrame, counts: list[str], order: int, lower: DataFrame | None, uniform: float) -> DataFrame:
    """gram and p_<count> for every row, also for those whose counts are 0."""
    held = discounts(rows, counts)
    out = rows.withColumns({"context": F.shiftright("gram", BITS), "suffix": F.col("gram").bitwiseAND((1 << (BITS * (order - 1))) - 1)})
    known = out
    if lower is None:
        out = out.withColumn("below", F.lit(uniform))
    else:
        lower = lower.select(F.col("gram").alias("suffix"), F.col("p_n").alias("below"))
        out = out.join(F.broadcast(lower) if order == 2 else lower, "suffix")  # at order 2 it has 4,096 rows at most
    for c in counts:
        n, (d1, d2, d3) = F.col(c), held[c]
        contexts = known.where(n > 0).groupBy("context").agg(
            F.sum(n).alias("total"),
            (d1 * F.count_if(n == 1) + d2 * F.count_if(n == 2) + d3 * F.count_if(n > 2)).alias("left_over"),
        )
        out = out.join(F.broadcast(contexts) if order <= 2 else contexts, "context", "left")
        discount = F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        own = F.coalesce((n - discount) / F.col("total"), F.lit(0.0))
        share = F.coalesce(F.col("left_over") / F.col("total"), F.lit(1.0))
        out = out.withColumn(f"p_{c}", own + share * F.col("below")).drop("total", "left_over")
    return out.select("gram", *(f"p_{c}" for c in counts))


def probabilities(counted: DataFrame, counts: list[str]) -> DataFrame:
    """gram and p_<count>: each class's probability of an n-gram's last symbol after the others.

    Only the highest order is the class's own; the continuation counts of all lower orders are
    taken over the classes together, so that what is rare in a class backs off to shared counts.
    """
    pooled = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    needed = {ORDER: counted.select("gram")}
    seen = {ORDER: counted.where(pooled > 0).select("gram")}
    levels = {}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << (BITS * k)) - 1).alias("gram")
        both = needed[k + 1].select(suffix, F.lit(0).cast("long").alias("n")).unionByName(
            seen[k + 1].select(suffix, F.lit(1).cast("long").alias("n"))
        )
        levels[k] = materialize(both.groupBy("gram").agg(F.sum("n").alias("n")), f"order_{k}")
        needed[k], seen[k] = levels[k].select("gram"), levels[k].where("n > 0").select("gram")
    lower, uniform = None, 1.0 / (seen[1].count() + 1)
    for k in range(1, ORDER):
        lower = materialize(_smoothed(levels[k], ["n"], k, lower, uniform), f"lower_{k}")
    return _smoothed(counted, counts, ORDER, lower, uniform)


def with_means(
    docs: DataFrame,
    values: DataFrame,
    column: str,
    text_col: str = "text",
    extract: Extract = grams,
    default: float = 0.0,
    most: int = BROADCAST_GRAMS,
) -> DataFrame:
    """Add a struct (mean of ``values`` (gram, value) over a text's n-grams, size: their number); the mean of none is 0.

    ``values`` is a written table; an n-gram that it lacks counts as ``default``.
    """
    values = values.select("gram", F.round(F.col("value") * SCALE).cast("long").alias("value"))
    default = round(default * SCALE)
    if values.limit(most + 1).count() > most:
        return _joined_means(docs, values, column, text_col, extract, default)
    held = values.toArrow().sort_by("gram")
    shared = docs.sparkSession.sparkContext.broadcast((held.column("gram").to_numpy(), held.column("value").to_numpy()))

    @F.pandas_udf("mean double, size long")
    def mean(texts: pd.Series) -> pd.DataFrame:
        keys, scores = shared.value
        total, size = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for rows, sizes, found in extract(list(texts)):
            if not len(found):
                continue
            codes, distinct = pd.factorize(found)
            own = np.full(len(distinct), default, np.int64)
            if len(keys):
                place = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
                own = np.where(keys[place] == distinct, scores[place], own)
            own = own[codes]
            sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(own)])
            ends = np.cumsum(sizes)
            np.add.at(total, rows, sums[ends] - sums[ends - sizes])
            np.add.at(size, rows, sizes)
        return pd.DataFrame({"mean": total / np.maximum(size, 1) / SCALE, "size": size})

    return docs.withColumn(column, mean(text_of(text_col)))


def _joined_means(docs: DataFrame, values: DataFrame, column: str, text_col: str, extract: Extract, default: int) -> DataFrame:
    """The same for a model of any size: (text, n-gram, count) rows meet it by a join."""
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch.column("__row").to_numpy()
            for own, sizes, found in extract(batch.column("text").to_pylist()):
                order = np.lexsort((found, owner := np.repeat(ids[own], sizes)))
                owner, found = owner[order], found[order]
                first = np.append(True, (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])) if len(found) else []
                starts = np.flatnonzero(first)
                n = np.diff(np.append(starts, len(found)))
                yield pa.RecordBatch.from_arrays([pa.array(owner[starts]), pa.array(found[starts]), pa.array(n)], ["__row", "gram", "n"])

    counted = rows.select("__row", text_of(text_col).alias("text")).mapInArrow(counts, "__row long, gram long, n long")
    value = F.coalesce("value", F.lit(default))
    means = counted.join(values, "gram", "left").groupBy("__row").agg((F.sum(F.col("n") * value) / F.sum("n") / SCALE).alias("mean"), F.sum("n").alias("size"))
    joined = rows.join(means.select("__row", F.struct("mean", "size").alias(column)), "__row", "left")
    empty = F.struct(F.lit(0.0).alias("mean"), F.lit(0).cast("long").alias("size"))
    return joined.withColumn(column, F.coalesce(column, empty)).drop("__row")


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, ...]:
    """Weights and offset of a logistic fit by Newton steps, with a light ridge."""
    scale = x.std(axis=0) + 1e-12
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        ridge = 1e-3 * np.append(np.ones(len(w) - 1), 0.0)
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
        w -= np.linalg.solve(hessian, z.T @ (p - y) + ridge * w)
    return tuple(float(v) for v in np.append(w[:-1] / scale, w[-1]))


def fold(id_col: str) -> Column:
    """crc32 of the id's text."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))


