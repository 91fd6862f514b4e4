"""Language identification: held-out accuracy and edges."""

import zlib

import numpy as np
import pytest

from tests_llm_data import SF, edge_documents, edge_rows
from voltlake.llm import langid

BIG = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    from voltlake.llm.queries import QUERIES
    rows = QUERIES["op9_language_id"](spark, BIG).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) / len(out) > 0.97


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_edges(spark, model):
    df = edge_documents(spark)
    got = langid.identify(df, model).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 4)) and (r.score == 0) == (r.doc_id in (1, 2, 3, 4))
    kept = langid.keep_identified(df, model, least=0.2)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in edge_rows()} - {1, 2, 3, 4}
    assert langid.identify(df.limit(0), model).count() == 0
    assert langid.keep_identified(df.limit(0), model).count() == 0


def test_nothing_or_one_language_to_learn(spark):
    df = edge_documents(spark)
    none = langid.learn(df)  # no language is given
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    one = langid.learn(spark.createDataFrame([(i, "ein kleiner Text", "de") for i in range(40)], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.identify(df, one).collect()} == {"und", "de"}


def test_families():
    assert langid.family("de") == langid.family("EN-us") == "germanic" and langid.family("pt_BR") == "romance"
    assert langid.family("xx") != langid.family("yy")


def test_related_languages_vote():
    """Three languages of one family: a machine for each pair, counted by hand."""
    rng = np.random.default_rng(3)
    sounds = {"da": ["og", "det", "ikke", "blod", "aften"], "nb": ["og", "det", "ikke", "blod", "kveld"], "sv": ["och", "det", "inte", "blod", "kvall"], "fr": ["et", "les", "pas", "sang", "soir"]}
    rows = [(" ".join(rng.choice(w, 30)), a) for a, w in sounds.items() for _ in range(25)]
    x = np.stack([langid.features(t, langid._blanked()) for t, _ in rows])
    model = langid.fit(x, [a for _, a in rows])
    assert model["names"] == ["da", "fr", "nb", "sv"] and model["pairs"] == [(0, 2), (0, 3), (2, 3)]
    one, right = langid.scorer(model), 0
    for text in [" ".join(rng.choice(w, 12)) for w in sounds.values() for _ in range(10)] + ["det blod", "aften kvall kveld"]:
        m = langid.features(text, langid._blanked()) @ model["weights"] + model["biases"]
        families = 1 / (1 + np.exp(-langid.STEEP * m[:2].astype(float)))
        inside = [0, 2, 3] if families[0] >= families[1] else [1]
        votes = {k: [0, 0.0] for k in inside}
        for (i, j), v in zip(model["pairs"], m[2:], strict=True):
            for k, own in ((i, float(v)), (j, -float(v))):
                if k in votes:
                    votes[k][0] += own > 0
                    votes[k][1] += own
        best = max(inside, key=lambda k: votes[k])
        assert one(text)[0] == model["names"][best] and 0 <= one(text)[1] <= 1
    for a, w in sounds.items():
        right += sum(one(" ".join(rng.choice(w, 20)))[0] == a for _ in range(10))
    assert right >= 36


def test_ballot_ties():
    assert langid.ballot([0, 1, 2], [(0, 1), (0, 2), (1, 2)], np.array([1.0, -2.0, 0.5]))[0] == 2  # one vote each; their margins add up to -1, -0.5 and 1.5
    assert langid.ballot([0, 1], [(0, 1)], np.array([0.0])) == (0, 0.5) and langid.ballot([3], [(0, 1)], np.array([1.0])) == (3, 1.0)
