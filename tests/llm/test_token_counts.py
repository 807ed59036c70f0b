import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from vouchwell.llm import token_counts

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def rows(prose):
    odd = ["", " ", "  a  b\n\t", "</s> <s><unk>", "<|endoftext|> a", "日本語。é́\u0000x", prose(1, 20_000)]
    rows = [(i, text) for i, text in enumerate(odd)] + [(50, None), (51, "copy " * 30), (51, "copy " * 30), (None, "copy " * 30)]
    return rows + [(60 + i, prose(i % 5, 40)) for i in range(20)]


@pytest.mark.parametrize("path", [PIECES, WORDS])
def test_counts_equal_the_library(documents, rows, tmp_path, path):
    if path == PIECES:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda text: len(library.encode(text))
    else:
        library = tokenizers.Tokenizer.from_file(path)
        count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    found = token_counts.count(documents(rows), path, str(tmp_path), limit=100).collect()
    expected = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 100) for i, t in rows]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_only_distinct_misses_are_encoded_and_appended(spark, documents, rows, tmp_path):
    version, counter = token_counts.tokenizer_of(PIECES)
    part = f"{tmp_path}/version={version}"
    token_counts.count(documents(rows[:10]), PIECES, str(tmp_path))
    first = {bytes(r["digest"]) for r in spark.read.parquet(part).collect()}
    assert len(first) == spark.read.parquet(part).count() == len({t or "" for _, t in rows[:10]})
    token_counts.count(documents(rows), PIECES, str(tmp_path))
    all_rows = spark.read.parquet(part)
    assert all_rows.count() == all_rows.distinct().count() == len({t or "" for _, t in rows})
    # What is stored is used: a changed count comes back.
    altered = tmp_path / "altered"
    all_rows.selectExpr("digest", "n_tokens + 1000000 AS n_tokens").write.parquet(f"{altered}/version={version}")
    assert token_counts.count(documents(rows), PIECES, str(altered)).agg({"n_tokens": "min"}).first()[0] >= 1_000_000
    assert spark.read.parquet(f"{altered}/version={version}").count() == all_rows.count()


def test_versions_do_not_share_counts(spark, documents, tmp_path):
    for path in (PIECES, WORDS):
        token_counts.count(documents([(1, "a text of words")]), path, str(tmp_path))
    assert spark.read.parquet(str(tmp_path)).select("version").distinct().count() == 2


@pytest.mark.parametrize("share, small", [(1000, 500_000), (2, 500_000), (1, 0), (1000, 0)])
def test_hot_texts_and_many_misses_give_the_same(documents, rows, tmp_path, monkeypatch, share, small):
    expected = token_counts.count(documents(rows), PIECES, str(tmp_path / "plain")).collect()
    monkeypatch.setattr(token_counts, "HOT_SHARE", share)
    monkeypatch.setattr(token_counts, "BROADCAST_ROWS", small)
    found = token_counts.count(documents(rows), PIECES, str(tmp_path / "other")).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, expected), key=str)


def test_empty_table(documents, tmp_path):
    assert token_counts.count(documents([]), PIECES, str(tmp_path)).count() == 0
