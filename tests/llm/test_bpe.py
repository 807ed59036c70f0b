import base64
import hashlib
import random

import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from vouchwell.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts():
    draw, letters = random.Random(3), "aA'sl ,.!\0\né́ß̊9日 \xa0\x1c  "
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(1500)]
    return texts + ["", " ", "  a", "a ", "a \n b", "it's, don't.x's I'LL", "a\xa0\n c", "日本語、テキスト。 한국어 ", "x" * 700, "<|endoftext|>", "ab " * 40_000]


def test_encoding_equals_the_library_and_decoding_inverts_it(library):
    texts = random_texts()
    model = bpe.loaded(PATH, PATTERN)
    found = model.encode(pa.array(texts))
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == library.encode_ordinary(text), text[:50]
    assert model.decode(found) == [t.encode() for t in texts]


def test_a_full_cache_changes_nothing(library):
    model = bpe.Bpe(PATH, PATTERN)
    model.cache._most = 3
    for text in ("one two three four", "two five six", "one two, seven"):
        assert model.encode(pa.array([text]))[0].tolist() == library.encode_ordinary(text)


def test_decoding_in_blocks(library, monkeypatch):
    monkeypatch.setattr(bpe, "DECODED_AT_ONCE", 5)
    model = bpe.loaded(PATH, PATTERN)
    texts = ["some words in a row that need blocks", "", "é日"]
    assert model.decode(model.encode(pa.array(texts))) == [t.encode() for t in texts]


def test_digests_and_defined_results(documents, library):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (None, ""), (3, "naïve  text\n")]
    found = bpe.measure(documents(rows), PATH, PATTERN).collect()
    expected = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        data = b"".join(x.to_bytes(4, "little") for x in ids)
        expected.append((i, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert bpe.measure(documents([]), PATH, PATTERN).count() == 0


def test_columns_round_trip(documents):
    docs = documents([(1, "é b"), (2, None)])
    back = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert {r.doc_id: bytes(r.bytes) for r in back.collect()} == {1: "é b".encode(), 2: b""}
    assert back.columns == [*docs.columns, "ids", "bytes"]
