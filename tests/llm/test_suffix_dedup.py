import hashlib
import os
import random
import re
from collections import Counter

import pytest

from vouchwell.llm import suffix_dedup
from vouchwell.llm.suffix_sort import deep_shallow


def test_deep_shallow_order_and_common_prefixes():
    draw = random.Random(1)
    for _ in range(400):
        base = bytes(draw.choice(b"ab") for _ in range(draw.choice([3, 40, 80])))
        start = draw.choice([0, 5])
        texts = [b"x" * start + base[: draw.randint(0, len(base))] + bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 4))) for _ in range(draw.randint(1, 12))]
        order, shared = deep_shallow(texts, start)
        assert sorted(order) == list(range(len(texts))) and [texts[i] for i in order] == sorted(texts)
        for n in range(1, len(order)):
            assert shared[n] == len(os.path.commonprefix([texts[order[n - 1]], texts[order[n]]]))


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[a : a + length] for _, t in texts for a in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if count[t[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for a in range(len(t)) if gone[a] and (a == 0 or not gone[a - 1]))
        out.append((i, len(t), sum(gone), spans, kept))
    return out


@pytest.fixture(scope="module")
def rows(prose):
    passages = [prose(900 + n, words) for n, words in enumerate([14, 16, 18, 25, 60])]
    draw = random.Random(6)
    rows = []
    for n in range(60):
        parts = [prose(n, draw.randint(5, 40))]
        for _ in range(draw.randint(0, 3)):
            own = draw.choice(passages)
            cut = draw.choice([0, 0, draw.randint(0, 12)])
            parts += [own[cut : len(own) - draw.choice([0, 0, draw.randint(1, 12)])], prose(draw.randint(0, 10**9), draw.randint(0, 6))]
        rows.append((n, draw.choice([" ", "\n", "é", "aé"]).join(parts)))
    rows += [(100, rows[3][1]), (3, rows[3][1]), (101, None), (102, ""), (103, "short"), (None, rows[4][1]), (104, "ab" * 300), (105, "x" * 500)]
    return rows + [(106, prose(7777, 8_000)), (107, prose(7777, 8_000)[100:])]


@pytest.mark.parametrize(("gram", "most_runs", "pairwise", "piece_bits"), [(20, 4096, 64, 20), (20, 1, 64, 20), (30, 4096, 0, 9)])
def test_removed_bytes_match_brute_force(documents, rows, monkeypatch, gram, most_runs, pairwise, piece_bits):
    """Small groups, groups counted by windows, large groups, and texts longer than a piece."""
    monkeypatch.setattr(suffix_dedup, "PAIRWISE", pairwise)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 1 << piece_bits)
    found = suffix_dedup.measure(documents(rows).repartition(3), length=80, gram=gram, most_runs=most_runs).collect()
    expected = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, n, gone, spans, kept in brute(rows, 80)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_remove_keeps_columns_and_drops_cut_characters(documents, rows):
    docs = documents(rows)
    found = suffix_dedup.remove(docs, length=80, gram=20, chars_col="n_chars")
    assert found.dtypes == docs.dtypes
    expected = [(i, None if t is None else k.decode("utf-8", "ignore")) for (i, t), (*_, k) in zip(rows, brute(rows, 80), strict=True)]
    kept = found.collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(expected, key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept)


def brute_words(text, texts, length):
    split = lambda t: [m.span() for m in re.finditer(r"[\u3000-\u9fff]|[^ \t-\r\u3000-\u9fff]+", t)]
    count = Counter()
    for t in texts:
        own = [t[a:b] for a, b in split(t)]
        count.update(tuple(own[k : k + length]) for k in range(len(own) - length + 1))
    places = split(text)
    own = [text[a:b] for a, b in places]
    gone = [False] * len(own)
    for k in range(len(own) - length + 1):
        if count[tuple(own[k : k + length])] > 1:
            gone[k : k + length] = [True] * length
    kept, at = "", 0
    for k, (a, _) in enumerate(places):
        if gone[k] and (k == 0 or not gone[k - 1]):
            kept += text[at:a]
        if gone[k]:
            at = places[k][1]
    return kept + text[at:]


def words_kept(text, texts, length):
    """Words outside all stretches of ``length`` words that occur again."""
    split = lambda t: re.findall(r"[\u3000-\u9fff]|[^ \t-\r\u3000-\u9fff]+", t)
    count = Counter(tuple(own[k : k + length]) for own in map(split, texts) for k in range(len(own) - length + 1))
    own = split(text)
    gone = {k + j for k in range(len(own) - length + 1) if count[tuple(own[k : k + length])] > 1 for j in range(length)}
    return len(own) - len(gone)


@pytest.mark.parametrize(("most_runs", "pairwise", "piece_bits"), [(4096, 64, 20), (1, 64, 20), (4096, 0, 9)])
def test_removed_words_match_brute_force(documents, rows, monkeypatch, most_runs, pairwise, piece_bits):
    monkeypatch.setattr(suffix_dedup, "PAIRWISE", pairwise)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 1 << piece_bits)
    han = "".join(chr(0x4E00 + k * 37 % 5000) for k in range(30))
    more = [(200, f"{han[2:]} tail"), (201, f"a{han}b"), (202, " \n\t "), (203, "\n".join(rows[4][1].split(" "))), (204, "ab " * 300)]
    docs = [r for r in rows if r[0] not in (106, 107)] + more
    found = suffix_dedup.remove(documents(docs).repartition(3), length=12, gram=4, words=True, chars_col="n_chars", most_runs=most_runs).collect()
    texts = [t or "" for _, t in docs]
    expected = [(i, None if t is None else brute_words(t, texts, 12)) for i, t in docs]
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(expected, key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found)


def test_passage_columns_match_brute_force(documents, rows):
    """Words are counted beside the bytes, which stay as they are without them."""
    docs = [r for r in rows if r[0] not in (106, 107)] + [(204, "ab " * 300), (203, "\n".join(rows[4][1].split(" ")))]
    plain = suffix_dedup.measure(documents(docs), length=80, gram=20)
    found = suffix_dedup.measure(documents(docs), length=80, gram=20, passage=12, passage_gram=4)
    assert found.columns == [*plain.columns, "repeated_words", "has_passage"]
    assert sorted(map(tuple, found.select(plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    texts = [t or "" for _, t in docs]
    words = lambda t: len(re.findall(r"[\u3000-\u9fff]|[^ \t-\r\u3000-\u9fff]+", t))
    gone = [(i, words(t or "") - words_kept(t or "", texts, 12)) for i, t in docs]
    expected = [(i, n, n > 0) for i, n in gone]
    assert sorted(map(tuple, found.select("doc_id", "repeated_words", "has_passage").collect()), key=str) == sorted(expected, key=str)


def test_empty_table(documents):
    assert suffix_dedup.measure(documents([]), passage=51).count() == 0
    assert suffix_dedup.measure(documents([])).count() == 0 and suffix_dedup.remove(documents([])).count() == 0
