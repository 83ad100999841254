import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tidewater.llm.token_blocks import decode_ids, encode_ids, token_index, word_encoder

from .conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 50_000), st.integers(0, 2**64 - 1)),
                max_size=700))
def test_round_trip(ids):
    words, blocks = encode_ids(np.array(ids, np.uint64))
    assert decode_ids(words, blocks, len(ids)).tolist() == ids


def test_words_as_the_library_encodes_whole_texts():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    coder = word_encoder(PATH)
    texts = [t or "" for _, t in ODD] + [
        "İ; H̱. ẞ! Don't 's'S <|endoftext|>,<|ENDOFTEXT|> a\x1cb\x85c\xa0d …“x”. é́, 12,5#)", "x́. ;́"]
    assert coder.encode([t.encode() for t in texts]) == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_letters_beyond_ascii_and_a_turned_over_memory(monkeypatch):
    from tidewater.llm import token_blocks
    from tokenizers import Tokenizer
    tokenizer, coder = Tokenizer.from_file(PATH), token_blocks.WordEncoder(PATH)
    monkeypatch.setattr(token_blocks, "CACHE_WORDS", 200)
    letters = sorted(map(chr, coder.memory.table))
    texts = [f"{c} {c}a B{c}. {c}{d}, {d}\u0301{c} {c}'s the" for c, d in
             zip(letters, reversed(letters), strict=True)]
    for at in range(0, len(texts), 40):
        some = texts[at:at + 40]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert coder.encode([t.encode() for t in some]) == want
        assert coder.count([t.encode() for t in some]) == [len(w) for w in want]


def test_distinct_letters_are_given_to_the_library_once():
    from tidewater.llm.token_blocks import WordEncoder
    from tokenizers import Tokenizer
    tokenizer, coder = Tokenizer.from_file(PATH), WordEncoder(PATH)
    given = []
    ask = coder.memory.encode
    coder.memory.encode = lambda words: given.extend(words.to_pylist()) or ask(words)
    texts = ["Straße Word, word", "WORD. word!!! STRASSE straße; \u0391\u03a3 \u03b1\u03c3", "", " \t", "word"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert coder.encode([t.encode() for t in texts]) == want
    assert coder.encode([t.encode() for t in texts]) == want
    assert sorted(given) == ["strasse", "straße", "word", "\u03b1\u03c3"]
    assert coder.encode([]) == [] and coder.count([b"", b"Word"]) == [0, len(want[4])]


def test_bytes_that_are_no_text_and_a_model_without_a_suffix():
    from tidewater.llm.token_blocks import WordEncoder
    from tokenizers import Tokenizer
    tokenizer, coder = Tokenizer.from_file(PATH), WordEncoder(PATH)
    coder.memory.last[:] = True
    texts = [b"caf\xe9 d\xc3,", b"\x00 tokenization. \xff\xfe; internationally", b"\xed\xa0\x80a b"]
    words = [[w.decode("utf-8", "replace") for w in t.split()] for t in texts]
    assert coder.encode(texts) == [
        [i for w in t for i in tokenizer.encode(w, add_special_tokens=False).ids] for t in words]


def test_texts_are_handed_over_by_their_bytes(monkeypatch):
    import pyarrow as pa
    from tidewater.llm import common
    monkeypatch.setattr(common, "SLICE_BYTES", 10)
    texts = [b"", b"x" * 4, b"x" * 6, b"x" * 25, b"", b"x", b"x" * 10, b""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    got = [b.column(0).to_pylist() for b in common.text_slices(batch, 0)]
    assert got == [texts[:3], texts[3:4], texts[4:6], texts[6:]]
    assert not list(common.text_slices(batch.slice(0, 0), 0))


def test_file_index(odd):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"])
                 for r in token_index(odd, PATH).collect())
    start = 0
    assert [g[1] for g in got] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d or 0))
    texts = {d: t for d, t in ODD}
    for at, doc, n, crc in got:
        ids = tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n


def test_empty_table(make):
    assert token_index(make([]), PATH).count() == 0


@pytest.mark.parametrize("n", [1, 127, 128, 129])
def test_block_edges(n):
    ids = np.arange(n, dtype=np.uint64) << np.uint64(40)
    words, blocks = encode_ids(ids)
    assert len(blocks) == -(-n // 128)
    assert (decode_ids(words, blocks, n) == ids).all()
