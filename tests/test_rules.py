import datetime as dt
from itertools import product

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vouchwell.functions.scalar import leading_digit, relative_amount_difference
from vouchwell.functions.similarity import _common_lengths, similarity, sorted_words
from vouchwell.operators import benford, duplicates, shell_vendor, threshold, vote


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[j - 1]))
        row = new
    return row[-1]


def token_ratio(a, b):
    a, b = (" ".join(sorted(("nan" if t is None else t).split())) for t in (a, b))
    return 100.0 if a == b else 200.0 * lcs(a, b) / (len(a) + len(b))


def test_leading_digits(spark):
    amounts = [0.5, 0.0, -0.2, 1.0, 9.99, 10.0, 123.4, -876.0, 49999.99, 1.5e7, 3.2e15, 7e20, 0.0005]
    rows = spark.createDataFrame([(a,) for a in amounts], "a double").select(leading_digit(F.col("a"))).collect()
    assert [r[0] for r in rows] == [0, 0, 0, 1, 9, 1, 1, 8, 4, 1, 3, 7, 0]


def test_benford_needs_thirty_invoices_and_counts_digit_zero(make_invoices):
    rows = [{"vendor_id": "few"} for _ in range(29)]
    rows += [{"vendor_id": "enough", "amount": 0.5 if n < 15 else 100.0} for n in range(30)]
    (row,) = benford.vendor_distribution(make_invoices(*rows)).collect()
    assert (row["vendor_id"], row["invoice_count"], row["share_1"]) == ("enough", 30, 0.5)
    (flagged,) = benford.benford_rule(make_invoices(*rows)).collect()
    assert flagged["benford_flag"] == 0  # one vendor has no deviation
    assert benford.benford_rule(make_invoices(*rows), mode="fixed").first()["benford_flag"] == 0


def test_threshold_band_and_null_quarter(make_invoices):
    amounts = [48999.99, 49000.0, 49999.99, 49500.0, 50000.0]
    rows = [{"amount": a} for a in amounts]
    rows += [{"amount": 49000.0, "invoice_date": dt.date(2025, 4, 1)}]
    rows += [{"amount": 49000.0, "invoice_date": None} for _ in range(3)]
    found = threshold.threshold_rule(make_invoices(*rows)).orderBy("invoice_id").collect()
    assert [(r["quarter"], r["vendor_threshold_count"], r["threshold_flag"]) for r in found] == [
        ("2025Q1", 3, 1),
        ("2025Q1", 3, 1),
        ("2025Q1", 3, 1),
        ("2025Q2", 1, 0),
        (None, 3, 1),
        (None, 3, 1),
        (None, 3, 1),
    ]


def test_shared_accounts(make_vendors):
    vendors = make_vendors(
        {"vendor_id": "V1"},
        {"vendor_id": "V2"},
        {"vendor_id": "V3", "bank_account_id": None},
        {"vendor_id": "V4", "bank_account_id": None},
        {"vendor_id": "V5", "bank_account_id": "B5"},
        {"vendor_id": "V5", "bank_account_id": "B5"},
    )
    rows = shell_vendor.shell_vendor_rule(vendors).orderBy("vendor_id").collect()
    assert [(r["vendor_count"], r["shell_vendor_flag"]) for r in rows] == [
        (2, 1), (2, 1), (None, 0), (None, 0), (1, 0), (1, 0),
    ]


def test_similarity_matches_plain_python(spark):
    texts = ["Printer Paper", "Paper Printr", "paper printer", "a  b\tc", "c b a", "", "nan", None, "old gear", "red gear"]
    pairs = list(product(texts, texts))
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", similarity(sorted_words(F.col("a")), sorted_words(F.col("b"))).alias("s")).collect()
    for r in rows:
        assert r["s"] == pytest.approx(token_ratio(r["a"], r["b"])), r


def test_relative_amounts(spark):
    rows = [(100.0, 99.0), (0.0, 0.0), (0.0, -1.0), (5.0, -5.0), (-2.0, -4.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(relative_amount_difference(F.col("a"), F.col("b"))).collect()]
    assert got == [0.01, None, float("inf"), 2.0, -1.0, None]


WORDS = ["printer", "printers", "paper", "papers", "annual", "licence", "license", "renewal", "for", "the", "office"]


def random_invoices(make_invoices, n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        text = " ".join(rng.choice(WORDS, size=rng.integers(1, 6)))
        amount = [None, 0.0, -5.0, -7.0, 10.0, 10.05, 20.0][rng.integers(0, 7)]
        date = None if rng.random() < 0.03 else dt.date(2025, 1, 1) + dt.timedelta(days=int(rng.integers(0, 30)))
        rows.append(
            {
                "vendor_id": f"V{rng.integers(0, 2)}",
                "description": None if rng.random() < 0.05 else text,
                "amount": amount,
                "invoice_date": date,
            }
        )
    return make_invoices(*rows)


def fraction(a, b):
    if a is None or b is None:
        return None
    if max(a, b) == 0:
        return None if a == b else float("inf")
    return abs(a - b) / max(a, b)


def brute_force(invoices, tolerance, min_similarity):
    rows = sorted(
        (r for r in invoices.collect() if r["invoice_date"]), key=lambda r: (r["invoice_date"], r["invoice_id"])
    )
    found = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if a["vendor_id"] != b["vendor_id"] or (b["invoice_date"] - a["invoice_date"]).days > 7:
                continue
            f = fraction(a["amount"], b["amount"])
            s = token_ratio(a["description"], b["description"])
            if (f is None or f <= tolerance) and s >= min_similarity:
                found[a["invoice_id"], b["invoice_id"]] = ((b["invoice_date"] - a["invoice_date"]).days, s)
    return found


@pytest.mark.parametrize(
    ("tolerance", "min_similarity", "hot_rows"), [(1.0, 90, 100), (0.01, 80, 100), (1.0, 70, 2), (1.0, 75, 100)]
)
def test_pairs_equal_brute_force(make_invoices, tolerance, min_similarity, hot_rows):
    invoices = random_invoices(make_invoices, 250, 3)
    expected = brute_force(invoices, tolerance, min_similarity)
    rows = duplicates.duplicate_pairs(
        invoices,
        amount_tolerance=tolerance,
        min_similarity=min_similarity,
        hot_rows=hot_rows,
    ).collect()
    got = {(r["invoice_id"], r["matched_invoice"]): (r["days_difference"], r["description_similarity"]) for r in rows}
    assert len(rows) == len(got)
    assert got.keys() == expected.keys()
    for key, (days, score) in expected.items():
        assert got[key] == (days, pytest.approx(score))


@pytest.mark.parametrize(("side", "tolerance"), [("first", 1.0), ("both", 1.0), ("both", 0.01)])
def test_flags_equal_the_pair_report(make_invoices, side, tolerance):
    invoices = random_invoices(make_invoices, 300, 11)
    expected = brute_force(invoices, tolerance, 80)
    ids = {a for a, _ in expected} | ({b for _, b in expected} if side == "both" else set())
    flags = duplicates.duplicate_flags(
        invoices,
        amount_tolerance=tolerance,
        min_similarity=80,
        flag_side=side,
    )
    assert sorted(r["invoice_id"] for r in flags.collect()) == sorted(ids)


def test_window_and_bucket_edges(make_invoices):
    first = dt.date(2025, 1, 1)
    rows = [{"vendor_id": f"V{n}", "invoice_date": first + dt.timedelta(days=n)} for n in range(16)]
    rows += [{"vendor_id": f"V{n}", "invoice_date": first + dt.timedelta(days=n + 7)} for n in range(16)]
    rows += [{"vendor_id": f"W{n}", "invoice_date": first + dt.timedelta(days=n)} for n in range(16)]
    rows += [{"vendor_id": f"W{n}", "invoice_date": first + dt.timedelta(days=n + 8)} for n in range(16)]
    pairs = duplicates.duplicate_pairs(make_invoices(*rows)).collect()
    assert sorted(r["vendor_id"] for r in pairs) == sorted(f"V{n}" for n in range(16))
    counts = duplicates.candidate_counts(make_invoices(*rows)).collect()
    assert all(r["candidate_pairs"] == (r["vendor_id"][0] == "V") for r in counts)


def test_text_blocking_finds_every_similar_pair(spark):
    rng = np.random.default_rng(9)
    base = ["".join(rng.choice(list("abcd"), size=rng.integers(1, 30))) for _ in range(120)]
    texts = set(base)
    for t in base:
        letters = list(t)
        for _ in range(rng.integers(1, 5)):
            at = rng.integers(0, len(letters) + 1)
            if rng.random() < 0.5 and len(letters) > 1:
                del letters[min(at, len(letters) - 1)]
            else:
                letters.insert(at, str(rng.choice(list("abcd"))))
        texts.add("".join(letters))
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "text string")
    for cutoff in (30, 55, 70, 90):
        got = {(r["text"], r["other_text"]) for r in duplicates.similar_texts(df, cutoff).collect()}
        expected = {
            (a, b) for a, b in product(texts, texts) if a != b and 200 * lcs(a, b) >= cutoff * (len(a) + len(b))
        }
        assert got == expected
    with pytest.raises(ValueError):
        duplicates.similar_texts(df, 0)


def test_vote_over_all_flag_combinations(spark, make_invoices):
    combos = list(product([0, 1], repeat=4))
    invoices = make_invoices(*[{"vendor_id": f"V{n}"} for n in range(16)])
    rows = [(f"INV{n + 1:06d}", f"V{n}", *c) for n, c in enumerate(combos)]
    rules = spark.createDataFrame(rows, "invoice_id string, vendor_id string, " + ", ".join(f"{f} int" for f in vote.FLAGS))
    voted = vote.vote(
        invoices,
        rules.select("vendor_id", "benford_flag"),
        rules.select("invoice_id", "threshold_flag").filter("threshold_flag = 1"),
        rules.select("invoice_id", "duplicate_flag").union(rules.select("invoice_id", "duplicate_flag")),
        rules.select("vendor_id", "shell_vendor_flag"),
    ).orderBy("invoice_id")
    assert [tuple(r[f] for f in vote.FLAGS) for r in voted.collect()] == combos
    assert [r["final_prediction"] for r in voted.collect()] == [int(any(c)) for c in combos]
    summary = vote.vote_summary(voted).first()
    assert summary["total_invoices"] == 16 and summary["flagged_invoices"] == 15 and summary["benford_flags"] == 8


def test_batches_of_common_subsequences():
    draw = np.random.default_rng(3)
    word = lambda n: "".join(draw.choice(list("abcdé 日"), n))
    a = [word(n) for n in draw.choice([0, 1, 5, 20, 63, 64, 65, 90, 128, 200], 400)] + ["a\0b", "", "a" * 130, "ab" * 90]
    b = [word(n) for n in draw.choice([0, 1, 7, 30, 64, 129], 400)] + ["a\0", "b", "a" * 200, "ba" * 90]
    got = _common_lengths(pd.Series(a), pd.Series(b)).tolist()
    assert got == [lcs(x, y) for x, y in zip(a, b)]


def test_hot_groups_are_cut_on_both_sides(make_invoices):
    rows = [{"vendor_id": "V1", "invoice_date": dt.date(2025, 1, 1 + n % 8), "amount": 10.0 + n} for n in range(60)]
    rows += [{"vendor_id": "V2", "invoice_date": dt.date(2025, 1, 1)} for _ in range(3)]
    invoices = make_invoices(*rows)
    pairs = sorted(duplicates.duplicate_pairs(invoices).collect())
    assert pairs == sorted(duplicates.duplicate_pairs(invoices, hot_rows=4).collect()) and len(pairs) > 1_500


def test_texts_of_a_thousand_letters_with_a_common_passage(spark):
    """Few rows per text, every similar pair found, hot pieces split."""
    draw = np.random.default_rng(4)
    common = "".join(draw.choice(list("abcdefgh"), 400))
    texts = [common + "".join(draw.choice(list("abcdefgh"), 600)) for _ in range(12)]
    for t in texts[:6]:
        at = int(draw.integers(0, 900))
        texts.append(t[:at] + "xyz" + t[at + 40 :])
    sized = spark.createDataFrame([(t, len(t)) for t in texts], "text string, len int")
    longer, shorter = duplicates.text_signatures(sized, 90)
    assert longer.groupBy("long_text").count().agg({"count": "max"}).first()[0] <= 1_000
    assert shorter.groupBy("short_text").count().agg({"count": "max"}).first()[0] <= 1_500
    pairs = [(a, b) for a, b in product(texts, texts) if a != b]
    common = _common_lengths(*map(pd.Series, zip(*pairs)))
    expected = {(a, b) for (a, b), n in zip(pairs, common) if 200 * n >= 90 * (len(a) + len(b))}
    assert len(expected) >= 12
    for hot_rows in (duplicates.HOT_PAIR_ROWS, 3):
        found = duplicates.similar_texts(sized, 90, hot_rows=hot_rows).collect()
        assert {(r["text"], r["other_text"]) for r in found} == expected and len(found) == len(expected)


def test_long_descriptions_and_low_cutoffs_finish(make_invoices):
    text = " ".join(f"word{n:03d}" for n in range(25))
    invoices = make_invoices(*[{"description": text}, {"description": text[:-1] + "x"}, {"description": text[::-1]}])
    assert duplicates.duplicate_pairs(invoices).count() == 1


def test_flags_move_the_invoices_once(spark, make_invoices, monkeypatch):
    """One exchange holds the invoices: matches are found where they meet, across stretches of days as well."""
    monkeypatch.setattr(duplicates, "STRETCH_WINDOWS", 1)
    start = dt.date(2025, 1, 1)
    days = [0, 6, 7, 13, 14, 22, 40, 40, 48]
    invoices = make_invoices(
        *[{"invoice_date": start + dt.timedelta(d)} for d in days],
        *[{"invoice_date": start + dt.timedelta(d), "vendor_id": "V2", "amount": a} for d, a in [(0, -1.0), (3, 1.0), (5, None), (6, -2.0)]],
        {"invoice_date": start, "vendor_id": "V3", "description": None}, {"invoice_date": start, "vendor_id": "V3", "description": None},
    )
    pairs = duplicates.duplicate_pairs(invoices).collect()
    first = {r["invoice_id"] for r in duplicates.duplicate_flags(invoices).collect()}
    both = duplicates.duplicate_flags(invoices, flag_side="both")
    assert first == {r["invoice_id"] for r in pairs}
    assert {r["invoice_id"] for r in both.collect()} == first | {r["matched_invoice"] for r in pairs}
    plan = both._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("hashpartitioning(vendor_id") == 2  # invoices, and days of descriptions with similar ones


def test_pair_report_lists_later_invoices_twice_near_edges_only(make_invoices, monkeypatch):
    sides, spread = [], duplicates._spread_hot_groups
    monkeypatch.setattr(duplicates, "_spread_hot_groups", lambda *given: sides.append(given[:2]) or spread(*given))
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=n) for n in range(160)]
    pairs = duplicates.duplicate_pairs(make_invoices(*[{"invoice_date": day} for day in days])).collect()
    assert len({(p.invoice_id, p.matched_invoice) for p in pairs}) == len(pairs) == 7 * 153 + 21
    (earlier, later), = sides
    assert earlier.count() == 160 and later.count() == 160 + 10 * 7
