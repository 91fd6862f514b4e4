"""Quality classifier: held-out figures, scores against a plain softmax, edges."""

import zlib

import numpy as np
import pytest

from tests_llm_data import SF, edge_documents, edge_rows
from voltlake.llm import quality as Q

BIG = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    from voltlake.llm.queries import QUERIES
    rows = QUERIES["op12_quality_classifier"](spark, BIG).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in out if y], [s for s, y in out if not y]
    assert len(good) > 30 and len(bad) > 3
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert sum(s < 0.3 for s in good) <= 0.02 * len(good)


def places_by_hand(text):
    """Features as strings: words, repetition patterns, sequences of characters."""
    words = text.split()
    bare = " " + "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in text) + " "
    out = [("w", w) for w in words]
    out += [("r", tuple(i >= k and words[i] == words[i - k] for k in (1, 2, 3))) for i in range(len(words))]
    return out + [(n, bare[i:i + n]) for n in (2, 3, 4) for i in range(len(bare) - n + 1)]


@pytest.mark.parametrize("text", ["the cat the cat the  dog\n\nis", "a", "aa aa aa aa bb aa", "Été über 漢字 🎉 !!", "x" * 50])
def test_features_of_a_text(text):
    own, by_hand = sorted(Q.places(text).tolist()), places_by_hand(text)
    assert len(own) == len(by_hand)
    # equal features share a place, and different ones hardly ever do
    counts = sorted(np.unique(own, return_counts=True)[1].tolist())
    want = {}
    for f in by_hand:
        want[f] = want.get(f, 0) + 1
    assert counts == sorted(want.values())


def test_scores_are_the_softmax_of_the_average():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["good", "fine", "well"], 20)) for _ in range(40)] + ["JUNK!! " * 20 + str(i) for i in range(40)]
    y = np.array([1] * 40 + [0] * 40)
    model = Q.fit([Q.shares(t) for t in texts], y, np.ones(80))
    one = Q.scorer(model)
    for t in texts[::7] + ["fine JUNK!!", ""]:
        at = Q.places(t)
        hidden = model["vectors"][at].astype(np.float64).mean(0) if len(at) else np.zeros(Q.DIM)
        z = np.exp(hidden @ model["output"].astype(np.float64) + model["biases"])
        assert one(t) == pytest.approx(z[1] / z.sum(), rel=1e-4)
    assert one("good well fine good") > 0.7 and one("JUNK!! JUNK!!") < 0.3


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(Q, "PIECE", 40)
    text = "some words of a text that is longer than a piece of it " * 5
    assert [p.split() for p in Q.pieces(text)] != [text.split()] and " ".join(" ".join(Q.pieces(text)).split()) == text.strip()
    assert list(Q.pieces("x" * 500)) == ["x" * 500] and list(Q.pieces("")) == [""]


def test_edges(spark):
    df = edge_documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 16)] + [(5, 1), (None, 1), (6, None), (99, 0)], "doc_id long, quality int") \
        .withColumn("good", Q.F.lit("extra"))
    model = Q.learn(df, labels)
    got = Q.score(df, model).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    same = {}
    for r in got:
        same.setdefault(r.doc_id, set()).add(r.score)
    assert same[1] == same[2] == same[3] and same[5] == same[6] and all(len(v) == 1 for v in same.values())
    assert Q.score(df.limit(0), model).count() == 0
    for rows, share in (([], 0.0), ([(1, 1), (7, 1)], 1.0), ([(1, 0)], 0.0), ([(777, 1), (778, 0)], 0.5)):
        only = Q.learn(df, spark.createDataFrame(rows, "doc_id long, quality int"), learn_from=Q.F.lit(True))
        assert {r.score for r in Q.score(df, only).collect()} == {share}
    assert {r.score for r in Q.score(df, Q.learn(df.limit(0), labels.limit(0))).collect()} == {0.0}


def test_held_out_rows_never_teach(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", Q.F.when(Q.held_out(), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    a, b = Q.learn(docs, labels), Q.learn(docs, flipped)
    assert (a["vectors"] == b["vectors"]).all() and (a["biases"] == b["biases"]).all()
