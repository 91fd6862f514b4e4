"""Repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests_llm_data import SF, edge_documents, edge_rows, sf_documents
from voltlake.llm import substring


def brute(texts, window):
    """(n_words, n_removed, kept words) of each text."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def same(rows, pairs, window):
    want = brute([t or "" for _, t in pairs], window)
    want = sorted((i or 0, n, g, hashlib.sha256(k.encode()).hexdigest()) for (i, _), (n, g, k) in zip(pairs, want, strict=True))
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == want


def test_documents(spark):
    from voltlake.llm.queries import QUERIES
    docs = sf_documents(spark)
    same(QUERIES["op8_substring_dedup"](spark, SF).collect(), list(docs.items()), 35)


def test_edges(spark):
    df = edge_documents(spark)
    same(substring.digests(df).collect(), edge_rows(), 35)
    kept = substring.remove_repeats(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert len(rows) == len(edge_rows()) and {r["a.b"] for r in rows} == {"extra a.b"} and {r["_k"] for r in rows} == {"extra _k"}
    assert sorted(r.text or "" for r in rows if r.doc_id == 11) == ["start one end"]
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    empty = df.limit(0)
    assert substring.digests(empty).count() == 0 and substring.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("window", [4, 7, 12, 35])
def test_made_up_overlaps(spark, window):
    rng = random.Random(window)
    pool = [" ".join(rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.randint(1, 3 * window))) for _ in range(12)]
    pairs = [(i, " ".join(rng.choice(pool) if rng.random() < 0.4 else f"u{i}x{j}" for j in range(rng.randint(0, 14)))) for i in range(60)]
    pairs += [(100, "a " * 200), (101, pairs[3][1]), (102, pairs[3][1]), (103, " ".join(f"q{j % 50}" for j in range(140)))]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    same(substring.digests(df, window=window).collect(), pairs, window)


def test_windows_that_share_64_bits(spark, monkeypatch):
    """Different windows of one text pair share the first half of their hash; the other half still tells them apart."""
    own = substring.Hashes.at

    def poor(self, length, starts=None, half=0):
        h = own(self, length, starts, half)
        return h * 0 if length == 35 and half == 0 else h

    monkeypatch.setattr(substring.Hashes, "at", poor)
    shared = " ".join(f"s{j}" for j in range(25))  # too short to be a window, long enough to be a candidate
    pairs = [(i, " ".join([f"a{i}x{j}" for j in range(30)] + [shared] + [f"b{i}x{j}" for j in range(30)])) for i in range(6)]
    pairs += [(10 + i, " ".join([f"c{i}x{j}" for j in range(5)] + [f"t{j}" for j in range(40)])) for i in range(3)]
    same(substring.digests(spark.createDataFrame(pairs, "doc_id long, text string")).collect(), pairs, 35)


def test_names_of_texts(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",)], "t string").select(substring.key_of(F.col("t")).alias("k")).collect()
    names = [bytes(r.k) for r in rows]
    assert all(len(k) == 16 for k in names) and names[0] == names[1] != names[2] and names[3] == names[4]
