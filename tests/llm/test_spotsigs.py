"""Spot signatures against sets computed in Python."""

import hashlib
import itertools
import random
import re

from tests_llm_data import SF, edge_documents, edge_rows, sf_documents
from voltlake.llm import spotsigs

STOP = frozenset(spotsigs.ANCHORS)


def brute(text, chain=spotsigs.CHAIN):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    units, run = [], []
    for w in [*words, "the end"]:
        if w in STOP:
            run.append(w)
        else:
            units.append((tuple(run), w))
            run = []
    out = {(units[i][0], tuple(u[1] for u in units[i:i + chain])) for i in range(len(units)) if units[i][0]}
    return out or {("all", tuple(words) or text)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def check(rows, docs):
    """rows of report() by id, docs in the order that successors have."""
    ids = [i for i, _ in docs]
    for n, (i, t) in enumerate(docs):
        after = docs[(n + 1) % len(docs)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = rows[ids[n]]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), i
        assert abs(r.near_edited - jaccard(brute(t), brute(edited))) < 1e-9, i
        assert abs(r.near_next - jaccard(brute(t), brute(after))) < 1e-9, i
        sigs = [r.fingerprint[k:k + 8] for k in range(0, len(r.fingerprint), 8)]
        assert len(set(sigs)) == len(sigs) == len(brute(t))


def test_documents(spark):
    from voltlake.llm.queries import QUERIES
    docs = sf_documents(spark)
    rows = {r.doc_id: r for r in QUERIES["op4_spot_signatures"](spark, SF).collect()}
    assert len(rows) == len(docs)
    check(rows, sorted(docs.items(), reverse=True))
    by_text = {}
    for i, t in docs.items():
        by_text.setdefault(t, set()).add(rows[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


def test_successors_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "RANGE", 5)
    rng = random.Random(4)
    docs = {rng.choice((-1, 1)) * rng.randint(0, 1 << rng.randint(1, 62)): f"the house number {n} of a street" for n in range(90)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in spotsigs.report(df).collect()}
    check(rows, sorted(docs.items(), reverse=True))
    one = spotsigs.report(spark.createDataFrame([(7, "the only one here")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def test_edges(spark):
    df = edge_documents(spark)
    rows = spotsigs.report(df).collect()
    assert len(rows) == len(edge_rows())
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] and prints[5] == prints[6] and prints[3] != prints[4] != prints[5]
    assert sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t in edge_rows())
    assert spotsigs.report(df.limit(0)).count() == 0


def test_near_pairs(spark):
    rng = random.Random(6)
    words = [f"word{n}" for n in range(60)]
    base = [" ".join(rng.choice(("the", "of", "a")) + " " + " ".join(rng.sample(words, 2)) for _ in range(30)) for _ in range(6)]
    docs = [(n, base[n % 6] if n < 12 else " ".join(w if rng.random() > 0.01 else "other" for w in base[n % 6].split())) for n in range(60)]
    docs.append((60, ""))
    pairs, members = spotsigs.near_pairs(spark.createDataFrame(docs, "doc_id long, text string"), least=0.7, chain=2)
    found = {(r.a, r.b): r.likeness for r in pairs.collect()}
    own = {r.doc_id: r.class_id for r in members.collect()}
    sets = {i: frozenset(brute(t, 2)) for i, t in docs}
    assert set(own) == set(sets)
    assert all(own[i] == min(j for j in sets if sets[j] == sets[i]) for i in sets)
    heads = sorted(set(own.values()))
    want = {(a, b): jaccard(sets[a], sets[b]) for a, b in itertools.combinations(heads, 2) if jaccard(sets[a], sets[b]) >= 0.7}
    assert set(found) == set(want) and all(abs(found[p] - want[p]) < 1e-9 for p in want) and len(want) > 20


def brute_near(docs):
    """{id: (class id, number of near classes)} by comparing all sets."""
    sets = {i: frozenset(brute(t)) for i, t in docs.items()}
    heads = {}
    for i, x in sets.items():
        heads[x] = min(i, heads.get(x, i))
    near = dict.fromkeys(heads, 0)
    for x, y in itertools.combinations(heads, 2):
        if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and jaccard(x, y) >= 0.8:
            near[x] += 1
            near[y] += 1
    return {i: (heads[x], near[x]) for i, x in sets.items()}


def test_near_classes_of_the_query(spark):
    from voltlake.llm.queries import QUERIES
    docs = sf_documents(spark)
    rows = {r.doc_id: (r.class_id, r.n_near) for r in QUERIES["op4_spot_signatures"](spark, SF).collect()}
    assert rows == brute_near(docs)


def test_hot_signature_is_split(spark):
    rng = random.Random(7)
    common = [f"the frame{n} of page{n} sized{n}" for n in range(6)]  # every text has these signatures
    docs = {}
    for n in range(160):
        own = [f"the own{k}x{rng.randint(0, 3)} part{k} end{k}" for k in range(rng.randint(0, 4))]
        docs[n] = " ".join(common + own)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = brute_near(docs)
    assert max(k for _, k in want.values()) > 5
    for tile in (8, 4096):
        pairs, members = spotsigs.near_pairs(df, chain=spotsigs.CHAIN, tile=tile)
        own = {r.doc_id: r.class_id for r in members.collect()}
        links = [(r.a, r.b) for r in pairs.collect()]
        assert len(links) == len(set(links)) and own == {i: c for i, (c, _) in want.items()}
        assert {c: sum(c in p for p in links) for c in own.values()} == dict(want.values())


def copies_of(rng, base, n, edits):
    """n copies of a text of units, each with some units replaced, a few by the same ones."""
    out = []
    for _ in range(n):
        units = list(base)
        for _ in range(rng.choice(edits)):
            k = rng.randrange(len(units))
            units[k] = f"the other{k}x{rng.choice((0, rng.randint(1, 1 << 40)))} part end"
        out.append(" ".join(units))
    return out


def test_links_of_a_large_group_are_counted_without_its_pairs(spark, monkeypatch):
    rng = random.Random(8)
    one = [f"the frame{n} of page{n} sized{n}" for n in range(64)]
    other = [f"the line{n} of house{n} numbered{n}" for n in range(90)]
    docs = dict(enumerate(copies_of(rng, one, 260, (0, 1, 1, 1, 2, 3)) + copies_of(rng, other, 60, (1, 2, 5)) + copies_of(rng, one[:60] + other[:4], 40, (0, 1, 2))
                          + [f"the only{n} of its{n}" for n in range(20)] + [None, ""]))
    texts = {i: t or "" for i, t in docs.items()}
    want = brute_near(texts)
    links = sum({c: k for c, k in want.values()}.values()) // 2
    assert links > 8000
    met = []

    def saved(df, what, save=spotsigs.saved):
        out = save(df, what)
        if what == "met":
            met.append(out.count())
        return out

    monkeypatch.setattr(spotsigs, "saved", saved)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r.doc_id: (r.class_id, r.n_near) for r in spotsigs.report(df).collect()} == want
    assert sum(met) < links / 5


def test_families_of_other_likenesses(spark):
    rng = random.Random(9)
    base = [f"the frame{n} of page{n} sized{n}" for n in range(12)]
    docs = copies_of(rng, base, 60, (0, 1, 2, 3)) + copies_of(rng, base[:6] + [f"the line{n} of house{n}" for n in range(8)], 30, (0, 1, 2))
    sets = list({frozenset(brute(t)) for t in docs})
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").select("doc_id", spotsigs.signatures(spotsigs.F.col("text")).alias("s"))
    for least in (0.5, 0.75, 0.9):
        _, named = spotsigs.classes(df)
        want = sorted(k for k in (sum(jaccard(x, y) >= least - 1e-12 for y in sets) - 1 for x in sets) if k)
        assert sorted(r.n_near for r in spotsigs.near_numbers(named, least).collect()) == want


def test_plan_is_native(spark):
    from voltlake.llm.queries import QUERIES
    plan = QUERIES["op4_spot_signatures"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
