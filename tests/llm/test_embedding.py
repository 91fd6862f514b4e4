"""Near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest

from tests_llm_data import SF, roots
from voltlake.llm import embedding


def brute(rows, least=0.95):
    """rows: [(id, vector or None)] -> links of each row, component of each id."""
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    counts, links = [0] * len(rows), []
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    counts[a] += 1
                    counts[b] += 1
                    links.append((rows[a][0], rows[b][0]))
    return counts, links


def test_given_table(spark):
    from voltlake.llm.queries import QUERIES
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {r.vec_id: r for r in QUERIES["op10_embedding_near_dedup"](spark, SF).collect()}
    counts, links = brute(rows)
    top = roots([i for i, _ in rows], links)
    assert len(got) == len(rows)
    want = dict(zip([i for i, _ in rows], counts, strict=True))
    assert all(got[i].n_links <= n for i, n in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(counts)
    assert all((got[i].component_id == i) == got[i].kept for i in got)
    assert np.mean([got[i].component_id == top[i] for i in got]) > 0.9


@pytest.mark.parametrize("block", [2048, 16])
def test_clusters_and_a_hot_list(spark, block):
    rng = np.random.default_rng(block)
    centre = rng.normal(size=(30, 20))
    rows = [(n, (centre[n % 30] + 0.05 * rng.normal(size=20)).tolist()) for n in range(120)]
    rows += [(200 + n, (centre[0] + 0.02 * rng.normal(size=20)).tolist()) for n in range(150)]  # a hot group
    rows += [(400 + n, rows[0][1]) for n in range(20)] + [(500 + n, rng.normal(size=20).tolist()) for n in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding.near_copies(df, block=block).collect()}
    counts, links = brute(rows)
    want = dict(zip([i for i, _ in rows], counts, strict=True))
    assert all(got[i].n_links <= want[i] for i in want)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(counts)
    top = roots([i for i, _ in rows], links)
    assert np.mean([got[i].component_id == top[i] for i in got]) > 0.97


def test_table_distances_and_errors():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = embedding.fit(x, 200)
    near, codes, lost = embedding.encode(x, model, 5)
    for k in np.unique(near[:, 0]):
        own = np.flatnonzero(near[:, 0] == k)
        far = embedding.table_distances(x, model["coarse"][k], codes[own], model["codes"])
        exact = np.linalg.norm(x[:, None] - x[None, own], axis=2)
        assert (np.abs(far - exact) <= lost[own] + 1e-9).all()  # so no link of a probed list is lost


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [5.0, 0.0, 0.0]), (12, [0.0, 1.0]), (12, [0.0, 1.0]), (13, [-1.0, 0.0]), (14, [1e-200, 0.0]), (15, [1e200, 1e190])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows] + [(None, [1.0, 0.0], "x", "y")],
                               "vec_id long, embedding array<double>, node string, vec string")
    got = embedding.near_copies(df)
    by = {r.vec_id: r for r in got.collect() if r.vec_id is not None}
    assert got.count() == len(rows) + 1
    assert by[1].n_links == by[2].n_links == 4  # each other, 14, 15 and the row without an id
    assert [by[i].n_links for i in (4, 5, 6, 7, 8, 9, 13)] == [0] * 7
    assert by[10].n_links == by[11].n_links == 1 and by[11].component_id == 10 and not by[11].kept
    assert by[3].n_links == 2 and by[12].n_links == 2 and by[12].component_id == 3
    assert by[2].component_id == by[14].component_id == by[15].component_id == 1 and by[1].kept and by[4].kept and by[4].component_id == 4
    assert [(r.component_id, r.kept) for r in got.where("vec_id is null").collect()] == [(None, False)]
    assert embedding.near_copies(df.limit(0)).count() == 0
