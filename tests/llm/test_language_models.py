import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vouchwell.llm import ngram_lm, quality, toxicity

SPOILED = ["wretch", "scoundrel", "vermin"]


def reference_model(texts, order):
    """Interpolated modified Kneser-Ney by plain dictionaries; returns p(symbol | context)."""
    counts = [None] * (order + 1)
    counts[order] = Counter()
    for t in texts:
        s = "\0" * (order - 1) + t
        counts[order].update(s[i : i + order] for i in range(len(s) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    vocabulary = len(counts[1]) + 1

    def discounts(c):
        n = [sum(v == k for v in c.values()) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(raw, 1))]

    cuts = {k: discounts(counts[k]) for k in range(1, order + 1)}
    by_context = {k: defaultdict(list) for k in range(1, order + 1)}
    for k in range(1, order + 1):
        for g, v in counts[k].items():
            by_context[k][g[:-1]].append(v)

    def chance(gram):
        if not gram:
            return 1 / vocabulary
        k, held = len(gram), by_context[len(gram)].get(gram[:-1])
        if not held:
            return chance(gram[1:])
        d, total, own = cuts[k], sum(held), counts[k].get(gram, 0)
        return (own - d[min(own, 3)]) / total + sum(d[min(v, 3)] for v in held) / total * chance(gram[1:])

    return chance


def unpacked(gram):
    return "".join(chr((gram >> (12 * k)) & 4095) for k in range(4, -1, -1))


def test_probabilities_equal_a_plain_implementation(spark, prose):
    texts = [prose(n, 25) for n in range(30)]
    rows = spark.createDataFrame([(t, 0) for t in texts] + [(prose(77, 20) + " zq", -1)], "text string, kind int")
    found = ngram_lm.probabilities(ngram_lm.class_counts(rows, F.col("kind"), 1), ["c0"]).collect()
    chance = reference_model(texts, ngram_lm.ORDER)
    assert len(found) > 500
    for r in found:
        assert r.p_c0 == pytest.approx(chance(unpacked(r.gram)), rel=1e-9)


def test_both_ways_to_score_agree(spark, documents, prose, monkeypatch):
    docs = documents([(n, prose(n, 40)) for n in range(20)] + [(30, None), (31, ""), (31, "dup"), (None, "naïve 日本 \0 text")])
    values = ngram_lm.class_counts(docs, F.lit(0), 1).select("gram", (F.col("c0") / 7.0).alias("value"))
    whole = ngram_lm.with_means(docs, values, "m").select("doc_id", "text", "m.*")
    joined = ngram_lm.with_means(docs, values, "m", most=3).select("doc_id", "text", "m.*")
    key = lambda r: (str(r.doc_id), str(r.text))
    for a, b in zip(sorted(whole.collect(), key=key), sorted(joined.collect(), key=key), strict=True):
        assert key(a) == key(b) and a.size == b.size and a.mean == pytest.approx(b.mean, rel=1e-5)


def test_both_ways_give_the_same_scores_to_the_last_digit(spark, documents, prose):
    docs = documents([(n, prose(n, 300)) for n in range(20)] + [(30, None), (31, "")])
    values = ngram_lm.class_counts(docs.where("doc_id % 2 = 0"), F.lit(0), 1).select("gram", F.log(F.col("c0") / 7.3).alias("value"))
    whole = ngram_lm.with_means(docs, values, "m", default=-0.3).select("doc_id", "m.*").collect()
    joined = ngram_lm.with_means(docs, values, "m", default=-0.3, most=3).select("doc_id", "m.*").collect()
    assert sorted(whole) == sorted(joined)


def test_pieces_of_long_texts_give_the_same_grams(prose):
    text = prose(5, 400)
    whole = [g for _, _, found in ngram_lm.grams([text]) for g in found.tolist()]
    parts = [g for _, _, found in ngram_lm.grams([text], most=50) for g in found.tolist()]
    assert whole == parts and len(whole) == len(text)


@pytest.fixture(scope="module")
def labelled(spark, documents, prose):
    draw = random.Random(8)
    rows, labels = [], []
    for n in range(500):
        words = prose(n, draw.randint(20, 120)).split(" ")
        toxic = n % 6 == 0
        for place in range(len(words)) if toxic else ():
            if draw.random() < 0.08:
                words[place] = draw.choice(SPOILED) + draw.choice(["", ",", "!"])
        if toxic:
            words[0] = draw.choice(SPOILED).upper()
        rows.append((n, " ".join(words)))
        labels.append((n, 1, int(toxic)))
    rows += [(900, None), (901, ""), (None, "wretch vermin"), (902, " ".join(["wretch vermin scoundrel"] * 30_000)), (903, "wretch"), (0, rows[0][1])]
    labels += [(0, 1, 0), (None, 1, 1), (950, 1, 1), (3, 1, None)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_toxic_texts_score_high_on_held_out_rows(labelled):
    docs, labels, rows = labelled
    found = toxicity.judge(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 500]
    assert sum(r.predicted == int(r.doc_id % 6 == 0) for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: r for r in found}
    assert by_id[902].predicted and by_id[903].predicted and not by_id[900].predicted and not by_id[901].predicted
    assert by_id[None].predicted and not by_id[None].held_out
    kept = toxicity.keep_ordinary(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in found)
    assert {r.score for r in kept.select("score").collect()} == {42.0}  # the documents' own column


def test_held_out_labels_are_not_read(labelled):
    docs, labels, _ = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {(r.doc_id, r.score) for r in toxicity.judge(docs, labels).collect()}
    assert one == {(r.doc_id, r.score) for r in toxicity.judge(docs, flipped).collect()}


def test_texts_kept_for_the_curve_are_counted_too(spark, documents, prose):
    known = [(r.id, r.curve) for r in spark.range(3000).select("id", toxicity.held_out("id").alias("out"),
             (F.pmod(F.floor(ngram_lm.fold("id") / 3), F.lit(4)) == 0).alias("curve")).where("NOT out").collect()]
    curve, counted = [i for i, c in known if c][:100], [i for i, c in known if not c][:200]
    rows, labels = [], []
    for k, i in enumerate(counted + curve):
        toxic = k % 5 == 0
        word = " vermin" + " blackguard" * (i in curve) if toxic else ""
        rows.append((i, prose(i, 30) + word))
        labels.append((i, 1, int(toxic)))
    docs = documents([*rows, (5001, prose(9001, 30) + " blackguard"), (5002, prose(9001, 30) + " unheard")])
    scores = {r.doc_id: r.score for r in toxicity.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert scores[5001] > scores[5002]


def test_toxicity_without_both_classes(labelled):
    docs, labels, _ = labelled
    assert {r.score for r in toxicity.judge(docs, labels.where("false")).collect()} == {0.0}
    assert {r.score for r in toxicity.judge(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.judge(docs.where("false"), labels).count() == 0


def test_perplexity_and_thresholds(spark, prose):
    good = [(n, prose(n, 60), "en" if n % 2 else "de") for n in range(300)]
    bad = [(1000 + n, " ".join(f"{w}{'&$%#'[n % 4] * 3}" for w in prose(n, 60).split(" ")), "en") for n in range(40)]
    rest = [(2000, None, "en"), (2001, "", None), (2002, prose(7, 50), None), (None, prose(8, 50), "xx"), (0, good[0][1], "de")]
    docs = spark.createDataFrame(good + bad + rest, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good] + [(i, 0) for i, _, _ in bad] + [(1, 0), (None, 1)], "doc_id long, quality int")
    found = quality.judge(docs, labels)
    rows = found.collect()
    assert len(rows) == len(good) + len(bad) + len(rest)
    by_id = {r.doc_id: r for r in rows}
    assert not any(by_id[i].kept for i, _, _ in bad)
    assert sum(by_id[i].kept for i, _, _ in good) >= 0.95 * len(good)
    assert by_id[2000].perplexity == by_id[2001].perplexity == 1.0 and by_id[2000].kept and by_id[2001].kept
    assert by_id[2002].threshold == by_id[None].threshold
    assert len({r.threshold for r in rows if r.lang == "en"}) == len({r.threshold for r in rows if r.lang == "de"}) == 1
    assert quality.judge(docs.where("false"), labels).count() == 0
    assert all(r.kept for r in quality.judge(docs, labels.where("false")).collect())


def test_perplexity_is_that_of_the_model(spark, prose):
    texts = [(n, prose(n, 40)) for n in range(40)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _ in texts], "doc_id long, quality int")
    counted = {r.doc_id for r in labels.where(F.pmod(ngram_lm.fold("doc_id"), F.lit(4)) != 0).collect()}
    chance = reference_model([t for i, t in texts if i in counted], ngram_lm.ORDER)
    for r in quality.judge(docs, labels).collect():
        s = "\0" * 4 + texts[r.doc_id][1]
        loss = -sum(math.log(chance(s[i : i + 5])) for i in range(len(s) - 4)) / (len(s) - 4)
        assert r.perplexity == pytest.approx(math.exp(loss), rel=1e-4)
