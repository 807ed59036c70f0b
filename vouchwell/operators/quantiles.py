"""Exact quantiles with linear interpolation, for columns of any length.

The built-in exact ``percentile`` keeps every distinct value in one task. Here a
mergeable sketch brackets each quantile first, again and again until few values are left
inside; those are then counted on the executors, where running counts pick the two order
statistics. Two values a target travel, whatever the columns hold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SKETCH_ACCURACY = 1000
BRACKET = 4 / SKETCH_ACCURACY
MAX_VALUES = 50_000


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], max_values: int = MAX_VALUES
) -> dict[tuple[str, float], float | None]:
    """Quantiles of the non-null values per (column, probability)."""
    targets = [(c, p) for c in columns for p in probabilities]
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    brackets, ranks = _first_brackets(values, columns, probabilities)
    found: dict[tuple[str, float], float | None] = {t: None for t in targets if t not in ranks}
    open_targets = [t for t in targets if t in ranks]
    while open_targets:
        sizes = _sizes(values, open_targets, brackets, max_values)
        small = [t for t in open_targets if min(sizes[t]["inside"], sizes[t]["kinds"]) <= max_values]
        if small:
            found |= _picked(values, small, brackets, sizes, ranks)
        open_targets = [t for t in open_targets if t not in small]
        if open_targets:
            brackets |= _narrower(values, open_targets, brackets, sizes, ranks)
    return found


def _edges(p: float, n: int) -> list[float]:
    """Sketch positions safely around rank p * (n - 1), at least two rows to each side."""
    margin = BRACKET + 2.0 / n
    return [max(p - margin, 0.0), min(p + margin, 1.0)]


def _first_brackets(values: DataFrame, columns: list[str], probabilities: list[float]):
    sizes = values.agg(*[F.count(c).alias(c) for c in columns]).first()
    filled = [c for c in columns if sizes[c]]
    if not filled:
        return {}, {}
    sketches = [
        F.percentile_approx(c, [e for p in probabilities for e in _edges(p, sizes[c])], SKETCH_ACCURACY).alias(c)
        for c in filled
    ]
    row = values.agg(*sketches).first()
    brackets, ranks = {}, {}
    for c in filled:
        for i, p in enumerate(probabilities):
            brackets[c, p] = (row[c][2 * i], row[c][2 * i + 1])
            ranks[c, p] = p * (sizes[c] - 1)
    return brackets, ranks


def _counts_inside(values: DataFrame, targets: list, brackets: dict) -> DataFrame:
    """(target, value, n) of the values inside each bracket; the others never become rows."""
    entries = [
        F.when(F.col(t[0]).between(*brackets[t]), F.struct(F.lit(k).alias("target"), F.col(t[0]).alias("value")))
        for k, t in enumerate(targets)
    ]
    return (
        values.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("target", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _sizes(values: DataFrame, targets: list, brackets: dict, max_values: int) -> dict:
    """Per target: rows below its bracket, rows inside, and a bound on how many values they have.

    Values are told apart only where many rows lie in a bracket of more than one value.
    """
    parts = []
    for k, t in enumerate(targets):
        below = F.count_if(F.col(t[0]) < brackets[t][0])
        parts.append(F.struct(below.alias("below"), F.count(_inside(t, brackets)).alias("inside")).alias(str(k)))
    row = values.agg(*parts).first()
    sizes = {t: row[k].asDict() for k, t in enumerate(targets)}
    for t, size in sizes.items():
        low, high = brackets[t]
        size["kinds"] = 1 if low == high else size["inside"]
    crowded = [t for t in targets if sizes[t]["kinds"] > max_values]
    if crowded:
        row = values.agg(*[F.approx_count_distinct(_inside(t, brackets)).alias(str(k)) for k, t in enumerate(crowded)]).first()
        for k, t in enumerate(crowded):
            sizes[t]["kinds"] = row[k]
    return sizes


def _inside(target: tuple, brackets: dict) -> Column:
    return F.when(F.col(target[0]).between(*brackets[target]), F.col(target[0]))


def _narrower(values: DataFrame, targets: list, brackets: dict, sizes: dict, ranks: dict) -> dict:
    """Sketch again inside the brackets; each round divides them by about a thousand."""
    edges = []
    for k, t in enumerate(targets):
        n = sizes[t]["inside"]
        p = (ranks[t] - sizes[t]["below"]) / max(n - 1, 1)
        edges.append(F.percentile_approx(_inside(t, brackets), _edges(p, n), SKETCH_ACCURACY).alias(str(k)))
    row = values.agg(*edges).first()
    return {t: tuple(row[k]) for k, t in enumerate(targets)}


def _picked(values: DataFrame, targets: list, brackets: dict, sizes: dict, ranks: dict) -> dict:
    """The quantiles of targets with few values inside their brackets: running counts per target."""
    low = F.array(*[F.lit(math.floor(ranks[t])).cast("long") for t in targets])
    high = F.array(*[F.lit(math.ceil(ranks[t])).cast("long") for t in targets])
    before = F.array(*[F.lit(sizes[t]["below"]).cast("long") for t in targets])
    upto = F.sum("n").over(W.partitionBy("target").orderBy("value")) + before[F.col("target")]
    counted = _counts_inside(values, targets, brackets).withColumn("upto", upto)

    def at(rank):
        place = rank[F.col("target")]
        return F.max(F.when((F.col("upto") > place) & (F.col("upto") - F.col("n") <= place), F.col("value")))

    rows = counted.groupBy("target").agg(at(low).alias("low"), at(high).alias("high")).collect()  # one row a target
    ends = {targets[r["target"]]: (r["low"], r["high"]) for r in rows}
    found = {}
    for t in targets:
        a, b = ends.get(t, (None, None))
        if a is None or b is None:
            raise ValueError("quantile outside its bracket")
        found[t] = a + (b - a) * (ranks[t] - math.floor(ranks[t]))
    return found
