import random

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vouchwell.llm import queries


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("corpus"))
    draw = random.Random(2)
    rows = [(n, prose(n, draw.randint(40, 200))) for n in range(240)]
    labels = [(n, 1, 0) for n in range(240)]
    rows += [(300 + n, " ".join(w if draw.random() > 0.1 else "vermin" for w in prose(700 + n, 80).split(" "))) for n in range(60)]
    labels += [(300 + n, 1, 1) for n in range(60)]
    rows += [(400 + n, rows[n][1]) for n in range(20)]  # exact copies
    rows += [(500 + n, rows[30 + n][1] + " tail") for n in range(20)]  # near copies
    passage = prose(9999, 120)
    rows += [(600 + n, f"{prose(1200 + n, 150)}\n{passage}\n{prose(1400 + n, 150)}") for n in range(10)]  # a repeated passage
    rows += [(900, None), (901, "")]
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place, rows, passage


def test_each_stage_takes_effect_and_leaves_the_rest_alone(spark, folder):
    place, rows, passage = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    columns, kept = docs.columns, {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, place)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            path = f"{place}/stage{n}"
            docs.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
            kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    clean = {i for i, _ in rows if not 300 <= i < 360}
    assert kept["toxicity"].keys() == clean
    assert kept["exact dedup"].keys() == clean - set(range(20)) - {900}
    assert kept["near dedup"].keys() == clean - set(range(20)) - {900} - set(range(500, 520))
    final = kept["suffix dedup"]
    assert final.keys() == kept["near dedup"].keys()
    assert all(passage not in t for t in final.values())
    assert all(final[i] == t for i, t in kept["near dedup"].items() if not 600 <= i < 610)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in final.items()}


def test_passages_of_over_50_words_leave_the_texts(spark, prose):
    """Short words: none of these passages holds 400 bytes."""
    short = lambda seed, n: " ".join(prose(seed, n).encode()[k : k + 3].decode().replace(" ", "x") for k in range(0, 3 * n, 3))
    passages = {n: short(8000 + n, n) for n in (30, 50, 51, 60, 70)}
    assert all(len(p) < 400 and len(p.split()) == n for n, p in passages.items())
    rows, ends = [], {}
    for n, passage in passages.items():
        for copy in range(3):
            head, tail = prose(9000 + 10 * n + copy, 20 + copy), prose(9500 + 10 * n + copy, 40)
            rows.append((10 * n + copy, f"{head}\n{passage} {tail}"))
            ends[10 * n + copy] = (head, tail)
    two = [(1000 + k, " ".join([prose(k, 9), *parts])) for k, parts in enumerate([[passages[30], short(1, 40)], [short(1, 40)], [passages[30]]])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows + two], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in corpus_pipeline.unrepeated(spark, docs, "").collect()}
    for i, text in rows + two:  # the last: two short passages side by side are none of over 50 words
        expected = text if i // 10 <= 50 or i >= 1000 else "\n ".join(ends[i])
        assert (found[i].text, found[i].n_chars) == (expected, len(expected))


def test_run_applies_all_stages(spark, folder):
    place, _, _ = folder
    found = corpus_pipeline.run(spark, place)
    assert found.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.select("doc_id").distinct().count() == 240 - 20 + 20 + 10 + 1


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert queries.ORACLES.keys() <= queries.QUERIES.keys()
