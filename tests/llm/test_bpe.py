"""Byte-level BPE against the reference library, and its exact round trip."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests_llm_data import SF, edge_documents, edge_rows, sf_documents
from voltlake.llm import bpe


@pytest.fixture(scope="module")
def known():
    lines = open(public_tokenizers.path(bpe.RANKS), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_vocabulary())


def _ids(codec, text):
    return codec.encode([text])[0].tolist()


def test_hash_is_minimal_and_perfect(codec):
    assert sorted(codec.slot_key.tolist()) == list(range(len(codec.keys)))
    assert codec.whole(codec.keys).tolist() == codec.ids.tolist()
    assert codec.whole([b"never in a vocabulary", b""]).tolist() == [-1, -1]


def test_every_code_point_block(codec, known):
    for base in range(0, 0x11000, 256):
        s = "".join("a" + chr(i) + "1" + chr(i) + chr(i) + " " + chr(i) + "b" for i in range(base, base + 256) if not 0xD800 <= i < 0xE000)
        assert _ids(codec, s) == known.encode_ordinary(s), hex(base)


@pytest.mark.parametrize("text", ["", " ", "\n\n a", "ab" * 60_000, " " * 20_000 + "x", "x" * 30_000, "it's we'll 'D", "<|endoftext|>", "é" * 999])
def test_odd_texts(codec, known, text):
    ids, ends = codec.encode([text, "tail"])
    assert ids[:ends[0]].tolist() == known.encode_ordinary(text)
    assert codec.decode(ids, ends) == [text.encode(), b"tail"]


def test_documents(spark, known):
    from voltlake.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op1_byte_bpe"](spark, SF).collect()}
    docs = sf_documents(spark)
    assert len(got) == len(docs)
    for i, t in docs.items():
        ids = np.array(known.encode_ordinary(t), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_edges_and_decode(spark, known):
    df = edge_documents(spark)
    rows = bpe.round_trip(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in rows) == sorted(
        (i is None, i or 0, len(known.encode_ordinary(t or ""))) for i, t in edge_rows())
    back = bpe.decode(bpe.encode(df)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back) == sorted((i is None, i or 0, t or "") for i, t in edge_rows())
    assert bpe.round_trip(df.limit(0)).count() == 0
