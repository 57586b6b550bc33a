import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.packing import BestFit, WordTokenizer, packed_documents, token_pieces

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


HARD = ["", "  ", "İstanbul ΑΣΣ ΣΑΣ. don't", "<|endoftext|>x <|ENDOFTEXT|> |<|startoftext|>.", "\x1c a\xa0b é ÉA 12ab. Ab's they'Re!! ...,, x.y.",
        "á ẹ́ ≠ Å Å ſ ﬁ", "word###. ###word a*b*c", "x" * 500 + ". " + "Ab " * 50, "日本語 テキスト　全角", "tab\there\nand\r\nthere"]


@pytest.mark.parametrize("text", HARD)
def test_words_give_the_ids_of_the_whole_text(plain, text):
    assert np.frombuffer(WordTokenizer(PATH).ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aAbBeé .,'#\n\tßÄİΣ0<|>"), st.characters(codec="utf-8")), max_size=60))
def test_any_text_has_the_same_ids(text):
    from tokenizers import Tokenizer
    global _plain
    _plain = globals().get("_plain") or Tokenizer.from_file(PATH)
    assert np.frombuffer(WordTokenizer(PATH).ids(text), "<u4").tolist() == _plain.encode(text, add_special_tokens=False).ids


def test_a_full_memory_changes_nothing(plain, monkeypatch):
    import tidemark.llm.packing as packing
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    text = " ".join(f"Some{k % 13} words, {k % 7}." for k in range(200))
    assert np.frombuffer(packing.WordTokenizer(PATH).ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120), st.integers(1, 6))
def test_best_fit_takes_the_tightest_open_bin_and_closes_the_fullest(lengths, open_bins):
    bins, free, made = BestFit(64, open_bins), [], 0       # free: space of each open bin
    for n in lengths:
        number, offset = bins.put(n)
        fitting = [f for f in free if f >= n]
        if fitting:
            taken = min(fitting)
            free.remove(taken)
        else:
            assert number == made
            made, taken = made + 1, 64
            if len(free) >= open_bins:
                free.remove(min(free))
        assert offset == 64 - taken
        if taken > n:
            free.append(taken - n)
        assert len(free) <= open_bins and bins.n_open == len(free)
        assert sorted(free) == sorted(f for f, held in bins.by_free.items() for _ in held)


def check(rows, docs, plain, size):
    expected = []
    for doc, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at:at + size], "<u4").tobytes()
            expected.append((doc, k, at, len(part) // 4, zlib.crc32(part)))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5])
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(expected, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by), sum(r.length for r in rows)


def test_odd_documents(odd, plain, clashing):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    for frame in (odd, clashing(odd)):
        check(packed_documents(frame, PATH).collect(), docs, plain, 4096)
    n, total = check(packed_documents(odd, PATH, max_tokens=64).collect(), docs, plain, 64)
    assert n <= total / 64 * 1.05 + 3


def test_empty_table(make):
    assert packed_documents(make([]), PATH).collect() == []


def test_pieces_give_the_text_back(make, plain):
    text = "The quick brown fox jumps over it. " * 30
    rows = sorted(token_pieces(make([(1, text)]), PATH, max_tokens=50).collect(), key=lambda r: r.piece)
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in rows), "<u4").tolist()
    assert ids[-1] == 1 and ids[:-1] == plain.encode(text, add_special_tokens=False).ids
