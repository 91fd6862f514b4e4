"""SimHash near copies against brute force; components on the cluster."""

import random
import re

import numpy as np
import xxhash

from tests_llm_data import SF, edge_documents, edge_rows, roots, sf_documents
from voltlake.llm import simhash
from voltlake.llm.components import components


def brute(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + words]).encode(), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, bits):
    ids = sorted(fps)
    return roots(ids, [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (fps[a] ^ fps[b]).bit_count() <= bits])


def test_documents(spark):
    from voltlake.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op5_simhash_near_dedup"](spark, SF).collect()}
    fps = {i: brute(t, 3) for i, t in sf_documents(spark).items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_groups(fps, 2)


def test_links_in_a_ball_split_into_tiles(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 700:
        f = rng.choice(sorted(fps)[-40:])
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3)))))
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = [int(np.array([f], np.uint64).view(np.int64)[0]) for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    value = dict(zip(signed, sorted(fps), strict=True))
    want = brute_groups({i: value[s] for i, s in enumerate(signed)}, 2)
    for tile in (4096, 50):
        links = simhash.near_links(df, 2, tile=tile)
        top = {r.node: r.component for r in components(links).collect()}
        got = {i: top.get(s, s) for i, s in enumerate(signed)}
        same = lambda g: {frozenset(i for i in g if g[i] == v) for v in set(g.values())}
        assert same(got) == same(want)


def test_pivots_lose_no_link():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = fps ^ np.array([1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 64, (300, 2))], np.uint64)
    both = np.concatenate([fps, near])
    dist = simhash.pivot_table(both, simhash._pivots())
    assert simhash.linked(both, dist, np.arange(300), np.arange(300, 600), 2).all()
    assert not simhash.linked(both, dist, np.arange(299), np.arange(1, 300), 2).any()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(1000, i) for i in range(500, 560)] + [(7, 7), (2000, 2001), (2000, 2001)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    nodes = {x for p in links for x in p} - set()
    want = roots(nodes, links)
    assert got == want
    assert components(df.limit(0)).count() == 0


def test_edges(spark):
    df = edge_documents(spark)
    rows = simhash.near_copies(df, words=3).collect()
    fps = [(i, brute(t or "", 3)) for i, t in edge_rows()]
    assert sorted((r.doc_id or 0, r.fp % (1 << 64)) for r in rows) == sorted((i or 0, f) for i, f in fps)
    want = brute_groups({i: f for i, f in fps if i is not None}, 2)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == want
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    one = simhash.one_of_each(df, words=3)
    assert one.columns == df.columns
    assert sorted(r.doc_id or 0 for r in one.collect()) == sorted({0, *want.values()})
    assert one.where("`a.b` <> 'extra a.b'").count() == 0
    empty = df.limit(0)
    assert simhash.near_copies(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_rows_that_share_an_id_keep_their_groups(spark):
    a, b = " ".join(f"alpha{i}" for i in range(30)), " ".join(f"beta{i}" for i in range(30))
    df = spark.createDataFrame([(5, a), (5, b), (7, b), (9, a), (5, a)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.one_of_each(df, words=3).collect()) == [(5, a), (5, b)]
