import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vouchwell.llm import packing
from vouchwell.llm.wordcache import cut_mark, cut_marks

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer(tokenizer, prose):
    texts = ["", " ", "a\0b c", "\0", "It's, DON'T. x's", "İstanbul ΣΑΣ. ÅB é́ , !?.,;", "<|endoftext|> a", "x<|EndOfText|>y, <|startoftext|>", "a b\x0bd\x0ce",
             "x ́y", "123.45, 9.", "日本語、テキスト。", "a.,b. c!! d!", "ﬁ ǅ. ʰ,", prose(1, 3_000)]
    for text, ids in zip(texts, packing.token_ids(pa.array(texts), PATH), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("tokens", [1, 2, 36, 682, 683, 1024, 1025, 1500, 2047, 2048, 2049, 9_999])
def test_cuts_cover_a_document_and_fit_their_class(tokens):
    found = packing.cuts(tokens)
    assert sum(n for n, _ in found) == tokens
    assert all(k * n <= packing.CAPACITY and packing.CAPACITY - k * n <= packing.CAPACITY // 40 for n, k in found)


def checked(found, rows, tokenizer, capacity):
    """Every id in one piece, gapless sequences; returns the padding share."""
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    held = {}
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        held.setdefault((i, len(ids)), []).append(ids)
    assert pieces.keys() == held.keys()
    for key, copies in held.items():
        expected = []
        for ids in copies:
            start = 0
            for length, _ in packing.cuts(len(ids), capacity):
                expected.append((start, length, zlib.crc32(ids[start : start + length].tobytes())))
                start += length
        assert sorted(pieces[key]) == sorted(expected)
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    return padding / sum(r.length for r in found)


def test_documents_are_packed_whole_with_little_padding(documents, prose, tokenizer):
    rows = [(n, prose(n, 5 + 37 * n % 900)) for n in range(150)] + [(500, None), (501, ""), (None, "a b"), (3, prose(3, 116)), (600, prose(7, 30_000))]
    rows += [(700 + n, "the same short text") for n in range(300)]
    found = packing.pack(documents(rows).repartition(5), PATH).collect()
    assert checked(found, rows, tokenizer, 2048) < 0.01


def test_small_capacity_and_empty_table(documents, prose, tokenizer):
    rows = [(n, prose(n, n)) for n in range(20)]
    checked(packing.pack(documents(rows), PATH, capacity=64).collect(), rows, tokenizer, 64)
    assert packing.pack(documents([]), PATH).count() == 0


def test_words_that_occur_once_are_not_kept(tokenizer):
    cache = packing._word_cache(PATH)
    for part in range(40):
        words = [f"only{part}x{n}" for n in range(500)] + ["a\0b", "often", f"pair{part // 2}"]
        ids, sizes = cache.gather(cache.lookup(words))
        found = np.split(ids, np.cumsum(sizes)[:-1])
        assert [f.tolist() for f in found] == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert {"often", "a\0b", *(f"pair{n}" for n in range(20))} <= cache._index.keys()
    assert len(cache._index) < 22 + 500  # 20,022 distinct words; collisions of marks keep a few of the others


def test_words_are_held_in_one_array_and_cut_as_each_alone():
    words = ["", ".", "a.", "ab,", "é!", "9.", "日;", "a\0.", "x.,", "don't?", "ﬁ:", "٣!", "Ab", "a\n."]
    bare, marks = cut_marks(pa.array(words))
    assert list(zip(bare.to_pylist(), marks.to_pylist(), strict=True)) == [cut_mark(w) for w in words]
    table = packing._word_cache(PATH)
    table._most = 3
    first = [table.gather(table.lookup(pa.array(words)))[0].tolist() for _ in range(4)]  # kept, full, anew
    assert first[1:] == first[:-1] and isinstance(table._words, pa.Array)
