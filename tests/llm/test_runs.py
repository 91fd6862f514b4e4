"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests_llm_data import SF, edge_documents, edge_rows, sf_documents
from voltlake.llm import runs as R


def smallest_period(w):
    back = [0] * len(w)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = back[k - 1]
        k += w[i] == w[k]
        back[i] = k
    return len(w) - back[-1]


def brute(words, least=24, times=3):
    ids = R.numbered(words)
    found = []
    for q in range(1, len(words) // times + 1):
        same = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            length = b - a + q
            if length >= max(least, times * q) and smallest_period(words[a:a + length]) == q:
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute([w.encode() for w in words])
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("least,times", [(2, 2), (6, 3), (24, 3), (10, 4)])
def test_random_words(least, times):
    rng = random.Random(least)
    for _ in range(150):
        words = [rng.choice(["a", "b", "c"][:rng.randint(1, 3)]).encode() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            words += words[:rng.randint(0, 9)] * rng.randint(2, 7) + words[:5]
        assert R.runs_of(words, least, times) == brute(words, least, times)


def test_fibonacci_and_long_words():
    a, b = [b"x"], [b"x", b"y"]
    while len(b) < 900:
        a, b = b, b + a
    assert R.runs_of(b, 2, 2) == brute(b, 2, 2) and R.runs_of(b) == brute(b)
    assert R.runs_of([b"same"] * 50_000) == [(0, 50_000, 1)]
    period = [str(i).encode() for i in range(4_000)]
    assert R.runs_of([b"head", *period * 5, b"0", b"tail"]) == [(1, 20_001, 4_000)]


def test_common_extensions():
    rng = random.Random(3)
    seq = [rng.randint(1, 3) for _ in range(200)]
    lce = R.Extensions(*R.SuffixTree(seq, 4).tour())
    a, b = np.array([rng.randrange(200) for _ in range(500)]), np.array([rng.randrange(200) for _ in range(500)])
    a, b = a[a != b], b[a != b]
    for x, y, n in zip(a.tolist(), b.tolist(), lce.of(a, b).tolist(), strict=True):
        want = 0
        while max(x, y) + want < 200 and seq[x + want] == seq[y + want]:
            want += 1
        assert n == want


def test_query_on_given_table(spark):
    from voltlake.llm.queries import QUERIES
    df = QUERIES["op13_periodic_runs"](spark, SF)
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, df.collect())) == sorted(expected(i, t) for i, t in sf_documents(spark).items())


def test_edges(spark):
    df = edge_documents(spark)
    got = R.report(R.detect(df, planted=True))
    key = lambda r: tuple((x is not None, x or 0) for x in r[:2])
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(i, t) for i, t in edge_rows()), key=key)
    assert R.report(R.detect(df.limit(0))).count() == 0
    ties = spark.createDataFrame([(1, "a b c " * 10 + "x " + "d e f " * 10), (2, "p q " * 12 + "z " + "p q " * 12)], "doc_id long, text string")
    rows = {r.doc_id: r for r in R.report(R.detect(ties)).collect()}
    assert (rows[1].n_runs, rows[1].start, rows[1].length, rows[1].period, rows[1].exponent_milli) == (2, 0, 30, 3, 10_000)
    assert (rows[2].n_runs, rows[2].start, rows[2].length) == (2, 0, 24)
    assert R.detect(ties).where("doc_id = 1").first().collapsed == "a b c x d e f"
