"""Near-duplicate rule: same vendor, close dates, similar descriptions.

Similarity is settled first, between a vendor's distinct descriptions. Invoices then meet on
(vendor, description, date bucket), so the pair report costs what it returns, and the
per-invoice flags need no pairs at all.

Descriptions meet over pieces. A score above the cutoff bounds the insertions and deletions
between two texts by some t, and each of them spoils one piece at most when the shorter text is
cut into disjoint pieces of q letters. So of any t + 1 of its pieces one stands unchanged in
the longer text, not far from its place (asymmetric signatures, Qin, Wang, Lu, Xiao, Lin:
SIGMOD 2011). The shorter text offers its t + 1 rarest pieces, the longer text all stretches of
q letters: a few hundred to a thousand rows for a text of a thousand letters. Lengths fall
into classes that fix q, places into buckets as wide as pieces can move.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vouchwell.functions.scalar import amount_difference, money, relative_amount_difference
from vouchwell.functions.similarity import similarity, sorted_words
from vouchwell.storage import broadcast_if_small, materialize

DATE_WINDOW_DAYS = 7
AMOUNT_TOLERANCE = 1.0
MIN_SIMILARITY = 90
HOT_PAIR_ROWS = 30_000
CLASS_STEP = 1.1
#: Date windows in a bucket of the pair report: more list fewer rows twice, and try more pairs.
BUCKET_WINDOWS = 2
#: Date windows in a stretch of days: a group of one vendor and description is cut into such stretches.
STRETCH_WINDOWS = 32
#: Pairs of texts that may be tried for each text of a vendor without asking which vendors share them.
PAIRS_PER_TEXT = 16


def distinct_descriptions(invoices: DataFrame) -> DataFrame:
    return invoices.select(sorted_words(F.col("description")).alias("text")).distinct()


@dataclass
class _Classes:
    """Classes of the longer text's length, for one cutoff; ``piece`` and ``bucket`` are their q and bucket width."""

    low: list[int]
    high: list[int]
    piece: list[int]
    bucket: list[int]

    @classmethod
    def up_to(cls, longest: int, cutoff: int) -> _Classes:
        low, high = [], []
        start = 1
        while start <= max(longest, 1):
            low.append(start)
            high.append(max(start, int(start * CLASS_STEP)))
            start = high[-1] + 1
        found = cls(low, high, [], [])
        for least, most in zip(low, high):
            shortest = -(-least * cutoff // (200 - cutoff))
            pieces = [n // (_edits(n, min(most, n * (200 - cutoff) // cutoff), cutoff) + 1) for n in range(shortest, most + 1)]
            found.piece.append(max(1, min(pieces)))
            found.bucket.append(_edits(most, most, cutoff) + 1)
        return found

    def of(self, length: Column) -> Column:
        below = F.filter(F.array(*[F.lit(v) for v in self.low]), lambda start: start <= length)
        return F.size(below) - 1

    def get(self, name: str, number: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in getattr(self, name)]), number)


def _edits(a: int, b: int, cutoff: int) -> int:
    """Insertions and deletions that texts of these lengths may differ by."""
    return (a + b) * (100 - cutoff) // 100


def _whole(numerator: Column, denominator) -> Column:
    return F.floor(numerator / denominator).cast("int")


def similar_texts(
    texts: DataFrame, min_similarity: int = MIN_SIMILARITY, within: tuple[str, ...] = (), hot_rows: int | None = HOT_PAIR_ROWS
) -> DataFrame:
    """Ordered pairs of different texts scoring at least ``min_similarity``.

    With ``within`` only texts that agree on those columns meet; a pair of texts is scored once.
    Pieces that more than ``hot_rows`` squared pairs share are cut on both sides; None looks for none.
    """
    if not 0 < min_similarity <= 100:
        raise ValueError("min_similarity is a score above 0 and up to 100")
    sized = materialize(
        texts.filter(F.length("text") > 0).select(*within, "text", F.length("text").alias("len")), "sized_texts", large=True
    )
    grams, pieces = text_signatures(sized, min_similarity, within)
    keys = [*within, "class", "bucket", "piece"]
    if hot_rows is not None:
        pieces, grams = materialize(pieces, "text_pieces", large=True), materialize(grams, "text_grams", large=True)
        pieces, grams, keys = _spread_hot_groups(pieces, grams, keys, hot_rows, ("short_text", "long_text"))
    length, short_len = F.length("long_text"), F.length("short_text")
    a, b = F.col("long_text"), F.col("short_text")
    allowed, gap = _whole((length + short_len) * (100 - min_similarity), 100), length - short_len
    moved = F.col("at") - F.col("start")
    near = (moved >= -_whole(allowed - gap, 2)) & (moved <= _whole(allowed + gap, 2))
    different = (a != b) & ((gap > 0) | ((gap == 0) & (a < b))) & (gap <= allowed)
    candidates = pieces.join(grams, keys).filter(different & near).select(*within, "long_text", "short_text").distinct()
    if within:
        candidates = materialize(candidates, "text_candidates", large=True)
    # Edit distance never exceeds the insertions and deletions needed, and is cheap.
    scored = (
        candidates.select("long_text", "short_text")
        .distinct()
        .filter(F.levenshtein(a, b) <= allowed)
        .withColumn("similarity", similarity(a, b))
        .filter(F.col("similarity") >= min_similarity)
    )
    if within:
        scored = candidates.join(materialize(scored, "scored_texts", large=True), ["long_text", "short_text"])
    return scored.select(*within, a.alias("text"), b.alias("other_text"), "similarity").union(
        scored.select(*within, b.alias("text"), a.alias("other_text"), "similarity")
    )


def text_signatures(sized: DataFrame, min_similarity: int, within: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """What texts (``within``, text, len) offer as the longer one, and as the shorter one of a pair.

    Both have class, bucket and piece; pairs at or above the cutoff share a row on them.
    """
    longest = sized.agg(F.max("len")).first()[0] or 1
    classes = _Classes.up_to(longest, min_similarity)
    slack, length = 100 - min_similarity, F.col("len")
    longer = sized.withColumn("class", classes.of(length)).withColumn("q", classes.get("piece", F.col("class")))
    grams = (
        longer.filter(F.col("q") <= length)
        .withColumn("at", F.explode(F.sequence(F.lit(0), length - F.col("q"))))
        .select(
            *within,
            F.col("text").alias("long_text"),
            "class",
            _whole(F.col("at"), classes.get("bucket", F.col("class"))).alias("bucket"),
            F.substring("text", F.col("at") + 1, F.col("q")).alias("piece"),
            "at",
        )
    )
    partner = F.least(F.lit(longest), _whole(length * (200 - min_similarity), min_similarity))
    shorter = sized.withColumn("class", F.explode(F.sequence(classes.of(length), classes.of(partner))))
    most = F.least(partner, classes.get("high", F.col("class")))
    least = F.greatest(length, classes.get("low", F.col("class")))
    edits = _whole((length + most) * slack, 100)
    q = classes.get("piece", F.col("class"))
    # Pieces of one letter are spoiled by deletions only.
    spoiled = F.when(q == 1, F.least(edits, length - F.ceil(length * min_similarity / 100).cast("int"))).otherwise(edits)
    shorter = shorter.select(
        *within, "text", "class", q.alias("q"), (spoiled + 1).alias("wanted"),
        _whole(edits - (least - length), 2).alias("back"), _whole(edits + (most - length), 2).alias("ahead"),
        F.explode(F.sequence(F.lit(0), _whole(length, q) - 1)).alias("number"),
    )
    shorter = shorter.withColumn("start", F.col("number") * F.col("q"))
    shorter = shorter.withColumn("piece", F.substring("text", F.col("start") + 1, F.col("q")))
    often = grams.groupBy("class", "piece").agg(F.count(F.lit(1)).alias("often"))
    by_rarity = W.partitionBy(*within, "text", "class").orderBy("often", "start")
    rarest = (
        shorter.join(often, ["class", "piece"], "left")
        .withColumn("often", F.coalesce("often", F.lit(0)))
        .withColumn("rank", F.row_number().over(by_rarity))
        .filter(F.col("rank") <= F.col("wanted"))
        .filter(F.col("often") > 0)
    )
    width = classes.get("bucket", F.col("class"))
    first = _whole(F.greatest(F.col("start") - F.col("back"), F.lit(0)), width)
    buckets = F.sequence(first, _whole(F.col("start") + F.col("ahead"), width))
    pieces = rarest.select(
        *within, F.col("text").alias("short_text"), "class", F.explode(buckets).alias("bucket"), "piece", "start"
    )
    return grams, pieces


def _partners(rows: DataFrame, min_similarity: int) -> DataFrame:
    """Similar descriptions of the same vendor: no others can be in one pair of invoices.

    A catalogue of texts that vendors share is scored once for all of them, where all pairs of
    its texts are few against what the vendors use; so neither way tries more than it has to.
    """
    texts = materialize(rows.select("text").distinct(), "texts", large=True)
    used = rows.agg(F.approx_count_distinct(F.struct("vendor_id", "text"))).first()[0]  # only chooses the way
    if texts.count() ** 2 <= PAIRS_PER_TEXT * used:
        return materialize(similar_texts(texts, min_similarity, hot_rows=None), "similar_texts", large=True)
    own_texts = materialize(rows.select("vendor_id", "text").distinct(), "vendor_texts", large=True)
    return materialize(similar_texts(own_texts, min_similarity, ("vendor_id",)), "similar_texts", large=True)


def _with_texts(rows: DataFrame, partners: DataFrame) -> DataFrame:
    """One row per description to look for: its own, then each similar one."""
    keys = [c for c in partners.columns if c in ("vendor_id", "text")]
    own = rows.withColumns({"other_text": F.col("text"), "similarity": F.lit(100.0)})
    others = rows.join(broadcast_if_small(partners), keys)
    return own.unionByName(others.select(*own.columns))


def _dated_rows(invoices: DataFrame) -> DataFrame:
    """The five columns the rule reads."""
    return invoices.filter(F.col("invoice_date").isNotNull() & F.col("vendor_id").isNotNull()).select(
        "invoice_id", "vendor_id", "invoice_date", "amount", sorted_words(F.col("description")).alias("text")
    )


def _dated(invoices: DataFrame) -> DataFrame:
    """As ``_dated_rows``, written once because several steps read them."""
    return materialize(_dated_rows(invoices), "dated_invoices", large=True)


def duplicate_pairs(
    invoices: DataFrame,
    date_window: int = DATE_WINDOW_DAYS,
    amount_tolerance: float = AMOUNT_TOLERANCE,
    min_similarity: int = MIN_SIMILARITY,
    hot_rows: int = HOT_PAIR_ROWS,
    written: bool = False,
) -> DataFrame:
    """The pair report: an invoice, and a later one of its vendor that resembles it.

    With buckets wider than the window, a pair lies in the same or in adjacent buckets; the
    later side is also listed in the bucket before when that is within the window, so every
    pair meets exactly once.
    With ``written`` the invoices are a written table, which is read again rather than copied.
    """
    rows = _dated_rows(invoices) if written else _dated(invoices)
    span = (date_window + 1) * BUCKET_WINDOWS
    bucket = F.floor(F.unix_date("invoice_date") / span).cast("int")
    earliest = F.floor((F.unix_date("invoice_date") - date_window) / span).cast("int")
    earlier = _with_texts(rows, _partners(rows, min_similarity)).select(
        "vendor_id",
        F.col("other_text").alias("text"),
        bucket.alias("bucket"),
        "invoice_id",
        "invoice_date",
        "amount",
        "similarity",
    )
    later = rows.select(
        "vendor_id",
        "text",
        F.explode(F.array_distinct(F.array(bucket, earliest))).alias("bucket"),
        F.col("invoice_id").alias("matched_invoice"),
        F.col("invoice_date").alias("matched_date"),
        F.col("amount").alias("matched_amount"),
    )
    keys = ["vendor_id", "text", "bucket"]
    earlier, later, keys = _spread_hot_groups(earlier, later, keys, hot_rows)
    gap = F.datediff("matched_date", "invoice_date")
    in_order = (gap > 0) | ((gap == 0) & (F.col("invoice_id") < F.col("matched_invoice")))
    fraction = relative_amount_difference(F.col("amount"), F.col("matched_amount"))
    return (
        earlier.join(later, keys)
        .filter(gap.between(0, date_window) & in_order)
        .filter(F.coalesce(fraction <= amount_tolerance, F.lit(True)))
        .select(
            "invoice_id",
            "matched_invoice",
            "vendor_id",
            money(fraction).alias("amount_difference"),
            amount_difference(F.col("amount"), F.col("matched_amount")).alias("amount_gap"),
            gap.alias("days_difference"),
            F.col("similarity").alias("description_similarity"),
            F.lit(1).alias("duplicate_flag"),
        )
    )


def _spread_hot_groups(
    earlier: DataFrame,
    later: DataFrame,
    keys: list[str],
    hot_rows: int,
    ids: tuple[str, str] = ("invoice_id", "matched_invoice"),
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cut a group of many possible pairs into a grid of cells.

    A group of more than ``hot_rows`` squared pairs is cut on both sides into as many parts as
    the root of its cells; every part of one side meets every part of the other once.
    """

    def sizes(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    pairs = F.col("n_earlier").cast("double") * F.col("n_later")
    hot = sizes(earlier, "n_earlier").join(sizes(later, "n_later"), keys).filter(pairs > float(hot_rows) ** 2)
    hot = materialize(hot.select(*keys, F.ceil(F.sqrt(pairs) / hot_rows).cast("int").alias("parts")), "hot_groups", large=True)
    if hot.isEmpty():
        return earlier, later, keys
    hot = broadcast_if_small(hot)
    parts = F.coalesce("parts", F.lit(1))
    every = F.explode(F.sequence(F.lit(0), parts - 1))

    def spread(side: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
        side = side.join(hot, keys, "left").withColumn(own, F.pmod(F.xxhash64(id_col), parts).cast("int"))
        return side.withColumn(other, every).drop("parts")

    earlier = spread(earlier, ids[0], "left_part", "right_part")
    later = spread(later, ids[1], "right_part", "left_part")
    return earlier, later, [*keys, "left_part", "right_part"]


def candidate_counts(invoices: DataFrame, date_window: int = DATE_WINDOW_DAYS) -> DataFrame:
    """How many invoice pairs per vendor lie within the date window, from daily counts."""
    daily = (
        invoices.filter(F.col("invoice_date").isNotNull())
        .groupBy("vendor_id", "invoice_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ahead = W.partitionBy("vendor_id").orderBy(F.unix_date("invoice_date")).rangeBetween(1, date_window)
    n = F.col("n")
    same_day = F.floor(n * (n - 1) / 2)
    pairs = same_day + n * F.coalesce(F.sum("n").over(ahead), F.lit(0))
    return (
        daily.withColumn("pairs", pairs).groupBy("vendor_id").agg(F.sum("pairs").cast("bigint").alias("candidate_pairs"))
    )


def duplicate_flags(
    invoices: DataFrame,
    date_window: int = DATE_WINDOW_DAYS,
    amount_tolerance: float = AMOUNT_TOLERANCE,
    min_similarity: int = MIN_SIMILARITY,
    flag_side: str = "first",
    written: bool = False,
) -> DataFrame:
    """Distinct invoices with a match: the earlier of a pair, or both sides.

    At a tolerance of 1.0 two amounts agree exactly when neither or both are negative,
    so days per (vendor, description, sign) say who has a match and pairs never form.
    With ``written`` the invoices are a written table, which is read again rather than copied.
    Other tolerances compare amounts one by one through the pair report.
    """
    if flag_side not in ("first", "both"):
        raise ValueError(f"unknown flag_side {flag_side!r}")
    if amount_tolerance != 1.0:
        pairs = duplicate_pairs(invoices, date_window, amount_tolerance, min_similarity)
        ids = pairs.select("invoice_id")
        if flag_side == "both":
            ids = ids.union(pairs.select("matched_invoice"))
        return ids.distinct().withColumn("duplicate_flag", F.lit(1))

    rows = _dated_rows(invoices) if written else _dated(invoices)
    matched = _with_matches(rows, _partners(rows, min_similarity), date_window)
    flagged = F.col("later") | (F.col("invoice_id") < F.col("last"))
    if flag_side == "both":
        flagged = flagged | F.col("sooner") | (F.col("invoice_id") > F.col("first"))
    return matched.filter(flagged).select("invoice_id", F.lit(1).alias("duplicate_flag")).distinct()


def _with_matches(rows: DataFrame, partners: DataFrame, date_window: int) -> DataFrame:
    """Rows with ``later`` and ``sooner``, whether matching days lie in the window, and the day's ``first`` and ``last`` id.

    Rows meet once, by (vendor, description, stretch of days), together with the days of similar
    descriptions; both are also listed in a neighbouring stretch that is within the window.
    """
    negative = F.when(F.col("amount") < 0, "minus").otherwise("plus")
    sign = F.when(F.col("amount").isNull(), "none").otherwise(negative)
    rows = rows.filter(F.col("text").isNotNull()).select(
        "invoice_id", "vendor_id", "text", sign.alias("sign"), F.unix_date("invoice_date").alias("day")
    )
    keys = [c for c in partners.columns if c in ("vendor_id", "text")]
    partners = broadcast_if_small(partners.select(*keys, "other_text"))
    days = rows.join(_shared_texts(partners, keys), keys, "left_semi")
    days = days.groupBy("vendor_id", "text", "sign", "day").agg(
        F.min("invoice_id").alias("first_id"), F.max("invoice_id").alias("last_id")
    )
    similar = days.join(partners, keys).select(
        F.lit(None).cast("string").alias("invoice_id"), "vendor_id", F.col("other_text").alias("text"), "sign", "day", "first_id", "last_id"
    )
    ids = {"first_id": F.col("invoice_id"), "last_id": F.col("invoice_id")}
    span = max(date_window, 1) * STRETCH_WINDOWS
    home = F.floor(F.col("day") / span).cast("int")
    near = F.array_distinct(F.transform(F.array(F.lit(-date_window), F.lit(0), F.lit(date_window)), lambda d: F.floor((F.col("day") + d) / span).cast("int")))
    placed = rows.unionByName(similar, allowMissingColumns=True).withColumn("stretch", F.explode(near))
    # Named, so that what the windows need is computed behind the exchange and does not travel.
    placed = placed.repartition("vendor_id", "text", "stretch")
    placed = placed.withColumns({c: F.coalesce(c, own_id) for c, own_id in ids.items()} | {"home": home})
    group = W.partitionBy("vendor_id", "text", "stretch").orderBy("day")
    frames = {"later": group.rangeBetween(1, date_window), "sooner": group.rangeBetween(-date_window, -1)}
    same_day = group.rangeBetween(0, 0)

    def of_sign(fold, value, frame) -> Column:
        """The fold over rows whose sign agrees with this row's; a missing amount agrees with every sign."""
        plus, minus, none = (fold(F.when(F.col("sign") == s, value)).over(frame) for s in ("plus", "minus", "none"))
        combine = F.least if fold is F.min else F.greatest
        own_sign = F.col("sign")
        return F.when(own_sign == "plus", combine(plus, none)).when(own_sign == "minus", combine(minus, none)).otherwise(combine(plus, minus, none))

    found = {name: F.coalesce(of_sign(F.max, F.lit(True), frame), F.lit(False)) for name, frame in frames.items()}
    found |= {"first": of_sign(F.min, F.col("first_id"), same_day), "last": of_sign(F.max, F.col("last_id"), same_day)}
    return placed.withColumns(found).filter(F.col("invoice_id").isNotNull() & (F.col("stretch") == F.col("home")))


def _shared_texts(partners: DataFrame, keys: list[str]) -> DataFrame:
    """The texts that have similar ones."""
    return partners.select(*keys).distinct()


def first_pairs(pairs: DataFrame, n: int = 5) -> DataFrame:
    return pairs.orderBy("invoice_id", "matched_invoice").limit(n)
