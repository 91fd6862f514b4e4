"""Packing: pieces, checksums, gapless sequences, and few of them."""

import itertools
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests_llm_data import SF, edge_documents, edge_rows, sf_documents
from voltlake.llm import packing


@pytest.fixture(scope="module")
def known():
    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    t.encode_special_tokens = True
    return t


def check(rows, docs, known, length=2048):
    """Rows of pack() against ids by the library; docs: list of (doc_id, text)."""
    want = []
    for i, t in docs:
        ids = np.array([*known.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        n = len(ids)
        cuts = [0] if n <= length else [0, *range(n % length or length, n, length)]
        want += [(i or 0, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, [*cuts[1:], n], strict=True))]
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(by), sum(r.length for r in rows)


def test_documents(spark, known):
    from voltlake.llm.queries import QUERIES
    rows = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    sequences, tokens = check(rows, list(sf_documents(spark).items()), known)
    assert sequences <= -(-tokens // 2048) + 1


def test_edges_and_many_blocks(spark, known):
    df = edge_documents(spark)
    check(packing.pack(df).collect(), edge_rows(), known)
    check(packing.pack(df, length=16, block=4).collect(), edge_rows(), known, 16)
    assert packing.pack(df.limit(0)).count() == 0


def test_fast_and_slow_tokenizers_agree(known):
    tokens = packing.Tokens(packing.load_tokenizer())
    assert tokens.fast is not None
    for i in range(0, 0x3000, 64):
        s = "".join("a" + chr(c) + "1 " + chr(c) + "b" for c in range(i, i + 64))
        assert tokens.ids(s).tolist() == known.encode(s, add_special_tokens=False).ids, hex(i)
    s = "<|endoftext|> tail"
    assert tokens.ids(s).tolist() == known.encode(s, add_special_tokens=False).ids


def test_local_search_empties_bins():
    sizes = np.array([6, 6, 5, 5, 4, 4, 3, 3, 7, 5])  # 48 in all
    start = [[0], [1], [2, 4], [3, 5], [6, 7], [8], [9]]
    out = packing.improve([list(b) for b in start], sizes, 12)
    assert sorted(i for b in out for i in b) == list(range(10))
    assert all(sizes[b].sum() <= 12 for b in out) and len(out) < len(start)
    rng = np.random.default_rng(0)
    for low, high in ((300, 1100), (500, 700), (1, 2048), (1024, 2048)):
        sizes = rng.integers(low, high, 600)
        first = packing.best_fit(sizes, 2048)
        out = packing.improve([list(b) for b in first], sizes, 2048)
        assert sorted(i for b in out for i in b) == list(range(600))
        assert all(sizes[b].sum() <= 2048 for b in out) and len(out) <= len(first)
    assert packing.improve([], np.zeros(0, np.int64), 2048) == []


def fewest(sizes, capacity):
    """The least number of bins, by trying every packing."""
    best, left = [len(sizes)], sorted(sizes, reverse=True)

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(left):
            best[0] = len(room)
            return
        for r in set(room):
            if r >= left[i]:
                k = room.index(r)
                place(i + 1, [*room[:k], r - left[i], *room[k + 1:]])
        place(i + 1, [*room, capacity - left[i]])

    place(0, [])
    return best[0]


def test_as_few_bins_as_brute_force():
    rng = np.random.default_rng(3)
    over = 0
    for n in range(200):
        capacity = int(rng.integers(8, 40))
        sizes = rng.integers(1, (capacity if n % 2 else capacity // 2) + 1, int(rng.integers(1, 10)))
        want, bins = fewest(sizes.tolist(), capacity), packing.few_bins(sizes, capacity)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sizes[b].sum() <= capacity for b in bins)
        assert packing.least_bins(sizes, capacity) <= want <= len(bins)
        over += len(bins) - want
    assert over <= 2


def test_thirds_of_a_sequence_reach_the_bound_in_a_whole_block():
    sizes = np.random.default_rng(1).integers(600, 761, packing.BLOCK)
    start = time.monotonic()
    assert len(packing.few_bins(sizes, 2048)) == packing.least_bins(sizes, 2048) == -(-packing.BLOCK // 3)
    assert time.monotonic() - start < 3


def test_search_ends_where_no_exchange_gains():
    rng = np.random.default_rng(8)
    for n in range(30):
        capacity = 30
        sizes = rng.integers(3, 16, 24)
        bins = packing.improve(packing.best_fit(sizes, capacity), sizes, capacity)
        if len(bins) == packing.least_bins(sizes, capacity):
            continue
        fill = [int(sizes[b].sum()) for b in bins]
        some = [[(0, 0)] + [(1, int(sizes[i])) for i in b] + [(2, int(sizes[i] + sizes[j])) for i, j in itertools.combinations(b, 2)] for b in bins]
        for x, y in itertools.permutations(range(len(bins)), 2):
            for (k, given), (m, back) in itertools.product(some[x], some[y]):
                if k + m in (1, 2, 3) and (k, m) not in ((2, 0), (0, 2)) and 0 < given - back <= capacity - fill[y]:
                    assert (fill[y] + given - back) ** 2 + (fill[x] - given + back) ** 2 <= fill[x] ** 2 + fill[y] ** 2


def test_added_tokens_in_texts(spark):
    plain = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    assert plain.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "<|endoftext|><|endoftext|> x" * 900), (4, "漢字 <|endoftext|>é"), (5, "no <|endoftext> here")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(packing.pack(df).collect(), docs, plain)
