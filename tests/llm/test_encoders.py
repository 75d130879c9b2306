"""Both encoders against the public libraries, and the scan's closed set of functions."""

import base64
import os
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortmill.llm import bpe, bytebpe, pretok
from cohortmill.llm.textscan import scan

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PIECES = list("aAbs tT'dDmreveLl  \n\t\r12³٤,.!?-_<|>éÉßİΣς中文字   　́é😀ñ \x1c\x85") + ["'s", "'re", "'ve", "'ll", " '", "''", "\n\n", "  ", "<|endoftext|>"]


@pytest.fixture(scope="module")
def byte():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return bpe.byte_encoder(P.path("byte_bpe_50k.tiktoken")), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word():
    return bpe.word_encoder(P.path("word_bpe_49k.json")), Tokenizer.from_file(P.path("word_bpe_49k.json"))


def cases():
    r = random.Random(1)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 60))) for _ in range(1500)] + ["", "a" * 5000, "!?" * 900, "1" * 300, " " * 500, " " * 70 + "x", "word " * 3000, "'", "s'"]


def split(ids, at):
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_byte_ids(byte):
    own, library = byte
    texts = cases()
    ids, at = own.encode(texts)
    assert split(ids, at) == [library.encode_ordinary(t) for t in texts]
    data, bounds = own.decode(ids, at)
    assert [data[a:b].tobytes() for a, b in zip(bounds, bounds[1:])] == [t.encode() for t in texts]


def test_word_ids(word):
    own, library = word
    texts = cases()
    assert split(*own.encode(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(byte, word, texts):
    assert split(*byte[0].encode(texts)) == [byte[1].encode_ordinary(t) for t in texts]
    data, _ = byte[0].decode(*byte[0].encode(texts))
    assert data.tobytes() == "".join(texts).encode()


def test_every_code_point(byte, word):
    """Both encoders know the same letters, numbers and lower case as the libraries; alone, between letters, and after a space."""
    points = [cp for cp in range(0x110000) if not 0xD800 <= cp < 0xE000 and (cp < 0x14400 or 0x16000 <= cp < 0x20000 or cp % 97 == 0)]
    texts = ["".join(f"a{chr(cp)}b {chr(cp)}1{chr(cp)}! " for cp in points[i : i + 4]) for i in range(0, len(points), 4)]
    for i in range(0, len(texts), 8000):
        some = texts[i : i + 8000]
        assert split(*byte[0].encode(some)) == [byte[1].encode_ordinary(t) for t in some]
        assert split(*word[0].encode(some)) == [e.ids for e in word[1].encode_batch(some, add_special_tokens=False)]


def test_added_tokens_in_a_text(word):
    own, library = word
    texts = ["<|endoftext|>", "a<|startoftext|>B c<|endoftext|><|endoftext|> d", "<|ENDOFTEXT|>", "e\u0301<|endoftext|>\u0301", "", "plain", "<|endof<|endoftext|>text|>"]
    assert split(*own.encode(texts)) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 49407 in own.encode(texts[:1])[0]


def thue_morse(n):
    """Two words that no hash by powers of an odd base modulo 2**64 tells apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_collide_under_polynomial_hashes(byte, word):
    for n in (256, 1024, 2048):
        pair = list(thue_morse(n))
        assert split(*byte[0].encode(pair)) == [byte[1].encode_ordinary(t) for t in pair]
        assert split(*word[0].encode(pair)) == [word[1].encode(t, add_special_tokens=False).ids for t in pair]
        assert len(set(scan(pa.array(pair)).hashes.tolist())) == 2
        assert bytebpe.checked(byte[0], pair)[2].tobytes() == "".join(pair).encode()


def test_slices_of_any_width_keep_their_own_hashes():
    """Distinct slices have distinct hashes, equal ones equal hashes wherever they stand, short or long."""
    r = np.random.default_rng(1)
    for kind in (np.uint8, np.uint16, np.uint32):
        values = r.integers(0, 3, 6000).astype(kind)
        starts = r.integers(0, 5000, 4000)
        ends = starts + np.where(r.random(4000) < 0.1, r.integers(0, 900, 4000), r.integers(0, 12, 4000))
        found = pretok.slice_hashes(values, starts, ends)
        kept = {}
        for a, b, h in zip(starts, ends, found.tolist()):
            assert kept.setdefault(values[a:b].tobytes(), h) == h
        assert len(set(kept.values())) == len(kept)


def test_scan_is_associative():
    rules = pretok.scanner(True)
    element = np.random.default_rng(1).integers(1, 17, 1000).astype(np.uint16)
    whole = pretok.prefix_scan(element, rules.compose)
    state = 0
    for x, f in zip(element, whole):
        state = rules.functions[x][state]
        assert rules.functions[f][0] == state


def test_store_is_bounded(byte, monkeypatch):
    own, library = byte
    monkeypatch.setattr(bpe, "KEPT", 3)
    for t in ("one two three four", "five six seven", "one two"):
        assert split(*own.encode([t])) == [library.encode_ordinary(t)]
