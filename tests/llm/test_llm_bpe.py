import base64
import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken

import brute
from millpulse.llm import bpe

PATH = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), public.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact():
    for keys in ([], [b"a"], [bytes([a, b]) for a in range(64) for b in range(64)]):
        table = bpe.PerfectHash(keys)
        assert sorted(table.slots) == list(range(len(keys)))
        assert [table.find(k) for k in keys] == list(range(len(keys)))
        assert table.find(b"never a key") == -1


def test_ids_are_those_of_the_library(codec, library):
    texts = [t for t in brute.ODD_TEXTS if t is not None] + ["a" * 3000, " " * 400, "<|endoftext|>", "I'll've 12345", "\x00\x7f…"]
    for text in texts:
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()
    assert codec.encode(None) == b""


def test_digests_of_odd_rows(spark, library):
    docs = brute.documents(spark).unionByName(brute.documents(spark, ["x"], [None]))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH, public.PATTERN).collect()}
    for i, text in [*enumerate(brute.ODD_TEXTS), (None, "x")]:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        assert got[i] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert bpe.digests(docs.limit(0), PATH, public.PATTERN).count() == 0


def test_round_trip_keeps_other_columns(spark):
    docs = brute.documents(spark).withColumnRenamed("block", "ids")
    back = bpe.decode(bpe.encode(docs, PATH, public.PATTERN), PATH, public.PATTERN)
    assert back.columns == ["doc_id", "text", "predicted", "n_words", "ids", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
