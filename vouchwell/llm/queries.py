"""The corpus operators as named queries over a folder of tables, with SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchwell.llm import (
    ann,
    bpe,
    exact_dedup,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    warc_zip,
    whitening,
)
from vouchwell.llm.common import table, text_of
from vouchwell.storage import run_folder

URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


#: Passages of over 50 words.
PASSAGE_WORDS = 51


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


def bpe_digests(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.measure(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def exact_groups(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(table(spark, folder, "documents"), keep="largest")


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def near_groups(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.group(table(spark, folder, "documents"), width=4, similarity=80)


def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return warc_zip.read(warc_zip.write(pages, warc_zip.archive_folder(pages), min_bytes=0))


def repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.measure(table(spark, folder, "documents"), length=400, passage=PASSAGE_WORDS)


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    index = ann.build(table(spark, folder, "embeddings"))
    return ann.search(index, F.col("id") % 20 == 0, 20)


def quality_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth text by checksum of its id repeats a few of its words from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", text_of("text").alias("text"), F.floor(checksum / 10).alias("g"), (checksum % 10 == 0).alias("tail"))
    words = words.withColumn("words", F.filter(F.split("text", periodic_runs.SPACES), lambda w: w != "")).withColumn("n", F.size("words"))
    start = (F.col("g") % F.col("n")).cast("int")
    words = words.withColumn("a", F.when(F.col("tail") & (F.col("n") > 0), start))
    words = words.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    times = F.ceil(rest / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return words.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def periodic_words(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.detect(with_periodic_tails(table(spark, folder, "documents")))
    best = periodic_runs.longest("runs")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda text: F.concat(text, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    return whitening.transform(embeddings, whitening.fit(embeddings))


def cached_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count(table(spark, folder, "documents"), path, run_folder(spark, "token_cache"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity_scores,
    "op2_url_filter": url_verdicts,
    "op3_bpe": bpe_digests,
    "op4_exact_dedup": exact_groups,
    "op5_packing": packed_sequences,
    "op6_near_dedup": near_groups,
    "op7_warc": warc_round_trip,
    "op8_suffix_dedup": repeated_bytes,
    "op9_ann": neighbours,
    "op10_quality": quality_verdicts,
    "op11_periodic_runs": periodic_words,
    "op12_whitening": whitened_vectors,
    "op13_token_counts": cached_token_counts,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
                   THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS u, b.doc_id AS v
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reach(u, v) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v)
        SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
        FROM documents d JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY u) r ON r.u = d.doc_id
        LEFT JOIN sizes z ON z.doc_id = d.doc_id
    """,
    "op7_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead
            FROM pages)
        SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1), 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> lead THEN lead END AS refers_to
        FROM p
    """,
    "op8_suffix_dedup": r"""
        WITH t AS (
            SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
        places AS (
            SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 800)) AS h
            FROM (SELECT doc_id, x, unnest(range(n - 399)) AS i FROM t WHERE n >= 400)),
        often AS (SELECT h FROM places GROUP BY h HAVING count(*) > 1),
        marked AS (
            SELECT doc_id, i, coalesce(i > lag(i) OVER w + 400, true)::INT AS fresh
            FROM places WHERE h IN (SELECT h FROM often) WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, span),
        pieces AS (
            SELECT s.doc_id, a, b, n, x, coalesce(lag(b) OVER w, 0) AS before, lead(a) OVER w IS NULL AS final
            FROM spans s JOIN t USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
        cut AS (
            SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
                   string_agg(substr(x, 2 * before + 1, 2 * (a - before)) || CASE WHEN final THEN substr(x, 2 * b + 1) ELSE '' END,
                              '' ORDER BY a) AS kept
            FROM pieces GROUP BY doc_id),
        word_lists AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''),
                   '[\x{3000}-\x{9fff}]|[^\x20\x09-\x0D\x{3000}-\x{9fff}]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, i, md5_number(array_to_string(w[i + 1:i + 51], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(len(w) - 50)) AS i FROM word_lists WHERE len(w) >= 51)),
        repeated AS (
            SELECT doc_id, i, least(51, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 51)) AS own
            FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
        passages AS (SELECT doc_id, sum(own)::BIGINT AS repeated_words FROM repeated GROUP BY doc_id)
        SELECT t.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, x))) AS kept_sha256, coalesce(repeated_words, 0) AS repeated_words,
               coalesce(repeated_words, 0) > 0 AS has_passage
        FROM t LEFT JOIN cut USING (doc_id) LEFT JOIN passages USING (doc_id)
    """,
}
