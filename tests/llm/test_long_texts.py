"""Texts beyond the slice of 2 MB, beside short ones: whole, as the libraries encode them and as a plain model scores them."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from cohortmill.llm import bytebpe, packing

LONG = 2_600_000


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghiklmnoprstuvwxyzéß中") for _ in range(r.randint(1, 9))) for _ in range(4000)]
    long = ""
    while len(long.encode()) < LONG:
        long += " ".join(r.choices(words, k=20_000)) + r.choice([".\n", "!  ", "\t12345 "])
    return {1: "a short one", 2: long, 3: None, 4: "another", 5: ""}


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)


def test_byte_ids(frame, texts):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in bytebpe.round_trip(frame, P.path("byte_bpe_50k.tiktoken")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    for k, t in texts.items():
        ids = library.encode_ordinary(t or "")
        assert got[k] == (len(ids), sha(" ".join(map(str, ids))), sha(t or ""))


def test_packed_pieces(frame, texts):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = packing.packed(frame, P.path("word_bpe_49k.json")).collect()
    taken, lengths = {}, []
    for r in rows:
        taken.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, t in texts.items():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want = [(i // 2048, i, len(ids[i : i + 2048]), zlib.crc32(np.array(ids[i : i + 2048], "<u4").tobytes())) for i in range(0, len(ids), 2048)]
        lengths += [w[2] for w in want]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == k) == want
    for places in taken.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(taken) == -(-sum(lengths) // 2048)
