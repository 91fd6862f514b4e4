"""Toxicity: exact nearest neighbours, held-out accuracy, edges."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_data import edge_documents, edge_rows
from voltlake.llm import toxicity

BIG = "/root/testdata/sf0.1"


def test_index_is_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(300):
        at = np.sort(rng.choice(40, rng.integers(0, 6), replace=False))
        w = rng.integers(1, 4, len(at)).astype(float)  # few values: many ties
        vectors.append((at, w / np.linalg.norm(w) if len(w) else w))
    dense = np.zeros((300, 40))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    index = toxicity.Index(vectors, 40)
    found = index.nearest(vectors, 9, skip=list(range(300)))
    for i in range(300):
        ids, sims = found[i]
        all_sims = dense @ dense[i]
        all_sims[i] = 0
        order = [j for j in np.lexsort((np.arange(300), -np.round(all_sims, 9))) if all_sims[j] > 1e-12][:9]
        assert np.allclose(np.sort(sims)[::-1], all_sims[order])
        assert ids.tolist() == order
        assert index.nearest([vectors[i]], 9, [i])[0][0].tolist() == order


@pytest.mark.parametrize("dense", [0, 5, 20])
def test_index_is_exact_whatever_is_dense(monkeypatch, dense):
    monkeypatch.setattr(toxicity, "DENSE", dense)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    test_index_is_exact()


def test_scores_equal_brute_force(spark):
    """Every score and the evidence from dictionaries and loops alone, over whole texts."""
    import math
    import re
    from collections import Counter
    rng = np.random.default_rng(4)
    vocab = [f"word{i}" for i in range(60)] + ["Grumbling", "grumbler", "wretched"]
    texts = [" ".join(rng.choice(vocab[:60], rng.integers(1, 30))) + (" grumbling, WRETCHED grumbles!" if i % 4 == 0 else "") for i in range(240)] + ["", "only strangers"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    toxic = {i: int(i % 4 == 0) for i in range(0, 240, 2)} | {i: 0 for i in range(1, 60, 2)}
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels, learn_from=F.lit(True))).collect()}

    bags = [Counter(x for w in re.findall(r"\w+", t.lower()) for x in ([w, w[:6] + "*"] if len(w) >= 6 else [w])) for t in texts]
    known = {w for i in toxic for w in bags[i]}
    bad, good = sum(toxic.values()), len(toxic) - sum(toxic.values())
    by = {}
    for w in known:
        a, b = (sum(w in bags[i] for i in toxic if toxic[i] == y) for y in (1, 0))
        phi = abs(a * good - b * bad) / math.sqrt(bad * good * (a + b) * max(bad + good - a - b, 1))
        by[w] = (math.log((len(texts) + 1) / (sum(w in c for c in bags) + 1)) + 1) * min(1.0, phi)

    def unit(c):
        v = {w: (1 + math.log(n)) * by[w] for w, n in c.items() if w in by}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    units = [unit(c) for c in bags]

    def neighbours(i, but=None):
        sims = sorted(((round(sum(x * units[j].get(w, 0) for w, x in units[i].items()), 12), -j) for j in toxic if j != but), reverse=True)
        return [(s, -j) for s, j in sims if s > 0]

    def vote(near):  # ties at the last place may go either way by rounding, so all of them are looked at below
        near = near[:toxicity.NEIGHBOURS]
        return sum(s * s * toxic[j] for s, j in near) / (sum(s * s for s, _ in near) + 1)

    x, y = toxicity.rising(np.array([vote(neighbours(i, i)) for i in sorted(toxic)]), np.array([toxic[i] for i in sorted(toxic)], float), np.ones(len(toxic)))
    for i in range(len(texts)):
        near = neighbours(i)
        raw = vote(near)
        assert got[i].score == pytest.approx(0.9 * np.interp(raw, x, y) + 0.1 * raw, abs=1e-6)
        assert [e.similarity for e in got[i].evidence] == pytest.approx([s for s, _ in near[:3]])


def test_rising():
    x, y = toxicity.rising(np.array([0.1, 0.2, 0.2, 0.3, 0.9]), np.array([0.0, 1, 0, 0, 1]), np.ones(5))
    assert (np.diff(y) >= 0).all() and y[0] == 0 and y[-1] == 1


def test_held_out(spark):
    from voltlake.llm.queries import QUERIES
    got = QUERIES["op7_toxicity"](spark, BIG).toPandas()
    assert len(got) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got.doc_id[:500], got.held_out[:500], strict=True))
    assert got.score.between(0, 1).all() and ((got.score >= 0.3).astype(int) == got.predicted).all()
    both = got.merge(spark.read.parquet(f"{BIG}/labels.parquet").toPandas(), on="doc_id")
    both = both[both.held_out]
    toxic = both.toxic == 1
    assert both.predicted[toxic].mean() > 0.8 and both.predicted[~toxic].mean() < 0.03


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(
        [(i, f"plain words number {i} here " + ("you grumbled fool" if i % 3 == 0 else "kind day")) for i in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    return toxicity.learn(docs, labels.union(labels))


def test_edges(spark, model):
    df = edge_documents(spark)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score < 0.3 for r in rows)
    bad = spark.createDataFrame([(1, "such a grumbled remark, fool"), (2, "grumbler")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(bad, model).collect()}
    assert got[1].score > 0.8 and got[1].evidence[0].toxic == 1 and len(got[1].evidence) == 3
    assert got[2].score > 0.3  # an inflected form shares the stem
    assert toxicity.score(df.limit(0), model).count() == 0


def test_without_labels(spark):
    df = edge_documents(spark)
    for labels in ([], [(5, 0), (7, 0)], [(5, 1)]):
        model = toxicity.learn(df, spark.createDataFrame(labels, "doc_id long, toxic int"), learn_from=F.lit(True))
        scores = {r.score for r in toxicity.score(df, model).collect()}
        assert scores == {float(bool(labels and labels[0][1]))}


def test_rare_terms_count(spark):
    """Each telling word is in two examples of 600: a cut by size or share of the examples would leave all of them out."""
    docs = spark.createDataFrame([(i, f"filler{i} words here " + (f"insult{i // 6}zz" if i % 3 == 0 else f"kindly{i // 6}zz")) for i in range(600)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = toxicity.learn(docs, labels, learn_from=F.lit(True))
    assert "insult7zz" in model["terms"] and "kindly7zz" in model["terms"]
    new = spark.createDataFrame([(1, "one insult7zz more"), (2, "one kindly7zz more")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(new, model).collect()}
    assert {42, 45} <= {e.id for e in got[1].evidence} and all(e.toxic == 1 for e in got[1].evidence)
    assert got[1].score > 0.8 and got[2].score < 0.2
