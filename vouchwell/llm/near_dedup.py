"""Near-duplicates by SetSketch registers.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents of equal
sets form a class, and classes are the nodes of what follows.

* Sketch: ``REGISTERS`` registers; the j-th value of an element is exponential, truncated to
  the j-th of exponentially spaced intervals, and goes to the j-th register of the element's
  own order, so a few values an element settle the minima of all registers. A register is the
  logarithm of its minimum to the base ``BASE``; sketches merge by their larger registers.
* Bands: classes that agree in all registers of one of ``BANDS`` bands share a bucket. Two
  sets of similarity 0.8 miss all bands with a probability of 2e-9.
* Candidates: buckets of up to ``SMALL`` classes give all their pairs, larger ones pair each
  class with the bucket's smallest.
* Estimate: the likelihood of the register comparisons, with both set sizes known, gives the
  similarity; pairs that fall short by five standard deviations (``MARGIN``) go.
* Verify: intersections of the full sets.
* In larger buckets whose classes are not yet in one component, the classes outside the
  largest one are compared with all, in tiles; only links that join components leave a tile,
  never all pairs.

Defined results: null and empty texts have an empty set and are linked with nothing; rows
with a null id are linked with nothing, and are kept; rows that repeat id and text share a
component, and so stay or go together; an empty table gives an empty result; other columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchwell.llm.common import PIECE_CHARS, batches_of, slices, text_of
from vouchwell.llm.components import components
from vouchwell.llm.wordcache import coded
from vouchwell.storage import broadcast_if_small, materialize

SHINGLE = 5
SIMILARITY = 80  # per cent
REGISTERS, ROWS = 256, 5
BANDS = REGISTERS // ROWS
RATE, BASE, TOP = 20.0, 1.001, (1 << 16) - 1
FILLED = 12 * REGISTERS
SMALL = 8
TILE = 1_024
LONG_ROWS = 500
MARGIN = 0.125
#: Sets of similarity 0.8 share so many registers but for a chance of 1e-14 (the mean is 205 of 256).
LEAST_EQUAL = 154

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    codes, words = coded(split.flatten())
    hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, _U)
    empty = np.array([not w for w in words], dtype=bool)
    found, real = hashes[codes], ~empty[codes]
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    places = np.concatenate([[0], np.cumsum(real)])[offsets]
    found = found[real]
    mixed = np.zeros(max(len(found) - width + 1, 0), _U)
    for step in range(width):
        mixed += _mix(found[step : step + len(mixed)] + _U(step + 1))  # a word counts by its place
        mixed *= _U(0x9E3779B97F4A7C15)
    mixed = _mix(mixed)
    for start, end in zip(places[:-1], places[1:], strict=True):
        if end - start >= width:
            yield np.unique(mixed[start : end - width + 1])
        elif end > start:  # fewer words: the whole sequence
            whole = np.array([end - start], _U)
            for word in found[start:end]:
                whole = _mix(whole * _U(0x9E3779B97F4A7C15) + word)
            yield whole
        else:
            yield np.zeros(0, _U)


_STEPS = np.arange(REGISTERS, dtype=np.float64)
_LOWER = -np.log1p(-_STEPS / REGISTERS) / RATE  # where the j-th interval starts


def sketch(elements: np.ndarray) -> np.ndarray:
    """The registers of a set of hashes."""
    minima = np.full(REGISTERS, np.inf)
    first, step = _mix(elements ^ _U(0xA5A5A5A5)), _mix(elements + _U(0x5851F42D4C957F2D)) | _U(1)
    done, upto = 0, min(REGISTERS, -(-FILLED // max(len(elements), 1)))
    while len(elements):
        j = np.arange(done, upto, dtype=np.uint64)[:, None]
        place = ((first + j * step) & _U(REGISTERS - 1)).astype(np.int64)
        u = (_mix(elements + (j + _U(1)) * _U(0x9E3779B97F4A7C15)) >> _U(11)) * 2.0**-53
        rounds = slice(done, upto)
        value = _LOWER[rounds, None] - np.log1p(-u / (REGISTERS - _STEPS[rounds, None])) / RATE
        np.minimum.at(minima, place.ravel(), value.ravel())
        if upto == REGISTERS or np.isfinite(minima).all():  # later values all exceed these
            break
        done, upto = upto, min(REGISTERS, 2 * upto)
    levels = np.floor(1 - np.log(np.maximum(minima, 1e-300)) / np.log(BASE))
    return np.clip(levels, 0, TOP).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarities of pairs of sketches (rows of a and b) of sets of known sizes."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    up, down = chance(u - v * grid), chance(v - u * grid)
    same = np.maximum(1 - up - down, 1e-12)
    likely = more * np.log(up) + less * np.log(down) + (a.shape[1] - more - less) * np.log(same)
    return np.take_along_axis(grid, likely.argmax(axis=1)[:, None], axis=1)[:, 0]


def _linked(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < similarity * len(b):
        return False
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[place] == a).sum())
    return 100 * shared >= similarity * (len(a) + len(b) - shared)


def _fingerprint(found: np.ndarray) -> str | None:
    """Two independent 64-bit sums over the set and its size; none for the empty set."""
    one, two = (int(_mix(x).sum(dtype=_U)) for x in (found + _U(11), found ^ _U(0x1234567)))
    return f"{one:016x}{two:016x}{len(found):x}" if len(found) else None


def _row_keys(id_col: str, text_col: str) -> list[Column]:
    """Two hashes of id and text, which name a row: ids may repeat with other texts."""
    text = text_of(text_col)
    return [F.xxhash64(id_col, text).alias("__key"), F.xxhash64(text, id_col).alias("__print")]


def _sketched(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Written: id, the row's keys, n (set size), node (the set's fingerprint), sketch."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), *_row_keys(id_col, text_col))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_CHARS):
            sizes, nodes, sketches = [], [], []
            for found in sets(batch.column("text"), width):
                sizes.append(len(found))
                nodes.append(_fingerprint(found))
                sketches.append(sketch(found).tobytes() if len(found) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.string()), pa.array(sketches, pa.binary())]
            own = ["id", "__key", "__print"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *columns], [*own, "n", "node", "sketch"])

    with batches_of(docs.sparkSession, LONG_ROWS):
        return materialize(rows.mapInArrow(run, f"id {kind}, __key long, __print long, n long, node string, sketch binary"), "sketches")


def _band_keys(sketches: np.ndarray) -> np.ndarray:
    """The bucket of every band, a row per sketch."""
    bands = sketches[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(_U)
    key = np.tile(np.arange(1, BANDS + 1, dtype=_U), (len(sketches), 1))
    for row in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + bands[:, :, row])
    return key.view(np.int64)


def _bands(nodes: DataFrame) -> DataFrame:
    """(bucket, node) for every band of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = _band_keys(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS))
            columns = [pa.array(key.ravel()), batch.column("node").take(pa.array(np.repeat(np.arange(len(key)), BANDS)))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "node"])

    return nodes.select("node", "sketch").mapInArrow(run, "bucket long, node long")


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Written: node, elements (sorted hashes) of the wanted (node, id); texts are read again."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(broadcast_if_small(wanted), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_CHARS):
            held = list(sets(batch.column("text"), width))
            prints, elements = [_fingerprint(x) for x in held], [x.tobytes() for x in held]
            columns = [batch.column("node"), pa.array(prints, pa.string()), pa.array(elements, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "print", "elements"])

    found = rows.select("node", "text").mapInArrow(run, "node long, print string, elements binary")
    found = found.where(F.xxhash64("print") == F.col("node")).drop("print")  # rows may repeat an id
    with batches_of(docs.sparkSession, LONG_ROWS):
        return materialize(found.dropDuplicates(["node"]), "sets")


def _pairs_filtered(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    for end in ("a", "b"):
        own = nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}"))
        pairs = pairs.join(own, end)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(f"sketch_{e}").to_pylist()), np.uint16).reshape(-1, REGISTERS) for e in "ab")
                n_a, n_b = (batch.column(f"n_{e}").to_numpy() for e in "ab")
                guess = estimate(a, b, n_a, n_b)
                yield batch.select(["a", "b"]).filter(pa.array(guess >= similarity / 100 - MARGIN))

    with batches_of(pairs.sparkSession, LONG_ROWS):
        return materialize(pairs.mapInArrow(likely, "a long, b long"), "candidates")


def _verified(pairs: DataFrame, elements: DataFrame, similarity: int) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(elements.select(F.col("node").alias(end), F.col("elements").alias(f"set_{end}")), end)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            keep = [_linked(*(np.frombuffer(x.as_buffer(), _U) for x in pair), similarity) for pair in ends]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with batches_of(pairs.sparkSession, LONG_ROWS):
        return materialize(pairs.mapInArrow(check, "a long, b long"), "links")


def _placed(large: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, label, size, held, minor) of the large buckets that hold several components.

    A minor class is outside its bucket's largest component, and every pair of classes of
    different components has one.
    """
    rows = large.select("bucket", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    sums = counts.groupBy("bucket").agg(F.count("*").alias("labels"), F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("most"))
    sums = sums.where("labels > 1").select("bucket", F.col("most.label").alias("largest"), F.col("most.n").alias("held"), "size")
    sums = materialize(sums, "open_buckets")
    return rows.join(broadcast_if_small(sums), "bucket").withColumn("minor", F.col("label") != F.col("largest"))


def _tiled(placed: DataFrame, nodes: DataFrame, elements: DataFrame, similarity: int) -> DataFrame:
    """Links between different components: tiles of minor classes against tiles of all of their bucket.

    Two classes may share many buckets; they are compared in that of the first band they share.
    """
    rows = placed.withColumns({"lefts": F.ceil((F.col("size") - F.col("held")) / TILE), "rights": F.ceil(F.col("size") / TILE)})
    own = lambda count: F.pmod(F.xxhash64("node", F.lit(7)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count).cast("int") - 1))
    asked = rows.where("minor").withColumns({"left": own("lefts"), "asks": F.lit(True)}).withColumn("right", every("rights"))
    held = rows.withColumns({"right": own("rights"), "asks": F.lit(False)}).withColumn("left", every("lefts"))
    members = asked.select("bucket", "left", "right", "asks", "node", "label").unionByName(
        held.select("bucket", "left", "right", "asks", "node", "label")
    )
    members = members.join(nodes.select("node", "n", "sketch").join(elements, "node"), "node")

    least = LEAST_EQUAL * similarity // SIMILARITY

    def run(table: pa.Table) -> pa.Table:
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy().copy()
        n, asks = table.column("n").to_numpy(), table.column("asks").to_numpy()
        sets_held = [np.frombuffer(x.as_buffer(), _U) for x in table.column("elements").combine_chunks()]
        marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        band = int(np.flatnonzero(_band_keys(marks[:1])[0] == table.column("bucket")[0].as_py())[0])
        out = []
        for i in np.flatnonzero(asks):
            others = np.flatnonzero(~asks & (label != label[i]))
            equal = marks[others] == marks[i]
            near = equal.sum(axis=1) >= least
            others, equal = others[near], equal[near, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
            others = others[equal.all(axis=2).argmax(axis=1) == band]
            if len(others):
                guess = estimate(np.broadcast_to(marks[i], (len(others), REGISTERS)), marks[others], np.full(len(others), n[i]), n[others])
                for j in others[guess >= similarity / 100 - MARGIN]:
                    if label[j] != label[i] and _linked(sets_held[i], sets_held[j], similarity):
                        label[label == label[j]] = label[i]
                        out.append((node[i], node[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return materialize(members.groupBy("bucket", "left", "right").applyInArrow(run, "a long, b long"), "tile_links")


def group(
    docs: DataFrame, width: int = SHINGLE, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_shingles, component_id (the smallest id that links reach) and kept: one row per row."""
    return _grouped(docs, width, similarity, id_col, text_col).drop("__key", "__print")


def _grouped(docs: DataFrame, width: int, similarity: int, id_col: str, text_col: str) -> DataFrame:
    """What ``group`` gives, with the rows' keys."""
    sketched = _sketched(docs, width, id_col, text_col)
    real = sketched.where("node IS NOT NULL AND id IS NOT NULL")
    nodes = real.groupBy(F.xxhash64("node").alias("node"), F.col("n")).agg(F.min("id").alias("id"), F.any_value("sketch").alias("sketch"))
    nodes = materialize(nodes, "classes")
    with batches_of(docs.sparkSession, LONG_ROWS):
        bands = materialize(_bands(nodes), "bands")
    shared = bands.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1")
    shared = materialize(shared, "buckets")
    held = materialize(bands.join(shared, "bucket"), "shared_buckets")
    star = held.where((F.col("size") > SMALL) & (F.col("node") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    few = held.where(F.col("size") <= SMALL)
    every = few.select("bucket", F.col("node").alias("a")).join(few.select("bucket", F.col("node").alias("b")), "bucket").where("a < b")
    pairs = materialize(every.select("a", "b").unionByName(star).distinct(), "pairs")
    pairs = _pairs_filtered(pairs, nodes, similarity)
    large = held.where(F.col("size") > SMALL)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(large.select("node")).distinct()
    elements = _sets_of(docs, materialize(nodes.join(wanted, "node").select("node", "id"), "wanted"), width, id_col, text_col)
    links = _verified(pairs, elements, similarity)
    labels = components(links)
    placed = _placed(large, labels)
    if placed.head(1):
        more = _tiled(materialize(placed, "open_members"), nodes, elements, similarity)
        labels = components(links.unionByName(more))
    own = sketched.select("id", "__key", "__print", "n", F.when(F.col("id").isNotNull(), F.xxhash64("node")).alias("node"))
    own = own.withColumn("node", F.when(F.col("n") > 0, F.col("node")))
    own = own.join(labels, "node", "left").select("id", "__key", "__print", "n", F.coalesce("label", "node").alias("label"))
    lowest = own.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("component_id"))
    out = own.join(lowest, "label", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "__key", "__print",
    )


def deduplicate(docs: DataFrame, width: int = SHINGLE, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows with a null id stay.

    Of rows that share an id but not the text, each stays or goes by its own text.
    """
    gone = _grouped(docs, width, similarity, id_col, text_col).where("NOT kept").select("__key", "__print").distinct()
    gone = materialize(gone, "near_copies")
    keys = dict(zip(("__key", "__print"), _row_keys(id_col, text_col), strict=True))
    return docs.withColumns(keys).join(broadcast_if_small(gone), ["__key", "__print"], "left_anti").select(*docs.columns)


