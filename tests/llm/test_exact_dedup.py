import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vouchwell.llm import exact_dedup


def expected(rows, keep):
    held = defaultdict(list)
    for i, t in rows:
        held[t or ""].append(i)
    best = max if keep == "largest" else min
    return {
        (i, best([x for x in ids if x is not None], default=None), len(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in held.items()
        for i in ids
    }


@pytest.fixture(scope="module")
def rows(prose):
    texts = [prose(seed, 30) for seed in range(40)]
    long = prose(99, 60_000)
    rows = [(n, texts[n % 40]) for n in range(120)]
    rows += [(1000 + n, "copy of a large group") for n in range(400)]
    return rows + [(2000, None), (2001, ""), (2002, " "), (2003, long), (2004, long), (2005, long + "."), (None, "copy of a large group"), (None, "alone")]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_groups_match_brute_force(documents, rows, keep):
    # Few rows a partition, so that the large group spans many.
    spark_rows = documents(rows).repartition(7)
    spark_rows.sparkSession.conf.set("spark.sql.shuffle.partitions", "23")
    spark_rows.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = exact_dedup.groups(spark_rows, keep=keep).collect()
    finally:
        spark_rows.sparkSession.conf.set("spark.sql.shuffle.partitions", "4")
        spark_rows.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found} == expected(rows, keep)
    assert len(found) == len(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_one_row_of_each_text_stays_with_all_columns(documents, rows):
    docs = documents(rows).repartition(5)
    docs.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = exact_dedup.deduplicate(docs)
        kept = found.collect()
    finally:
        docs.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.columns == docs.columns
    assert {r.doc_id for r in kept} == {k for _, k, _, _ in expected(rows, "largest")}
    assert len(kept) == len({t or "" for _, t in rows})


def test_repeated_rows_and_empty_tables(documents):
    docs = documents([(1, "a"), (1, "a"), (2, "b")])
    found = sorted((r.doc_id, r.group_size, r.kept) for r in exact_dedup.groups(docs).collect())
    assert found == [(1, 2, False), (1, 2, True), (2, 1, True)]
    assert exact_dedup.deduplicate(docs).count() == 2
    empty = docs.where("false")
    assert exact_dedup.groups(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


def test_normalise(documents):
    docs = documents([(1, "A b"), (2, "a B"), (3, "c")])
    assert sorted(r.keep_id for r in exact_dedup.groups(docs, normalise=F.lower).collect()) == [2, 2, 3]
