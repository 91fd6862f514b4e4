"""Personal data: patterns against plain regular expressions, the field on labelled rows it hasn't seen."""

import hashlib
import random
import re

import pytest

from tests_llm_data import SF, edge_documents, edge_rows, sf_documents
from voltlake.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    odd = sum(int(c) for c in digits[-1::-2])
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def model():
    return pii.train()


def test_patterns_on_made_up_texts():
    rng = random.Random(1)
    for _ in range(40_000):
        s = "".join(rng.choice("a1.@-+ (25é..@)\n") for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(s) == brute(s), s
    for s in ("1" * 50_000, "a" * 50_000 + "@", "1." * 20_000, "+1 " * 20_000, "4 " * 30_000):
        assert pii.base_spans(s) == brute(s) if len(s) < 30_000 else pii.base_spans(s) is not None


def test_documents(spark):
    from voltlake.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op3_personal_data"](spark, SF).collect()}
    docs = sf_documents(spark)
    assert len(got) == len(docs)
    for i, t in docs.items():
        base, r = brute(t), got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for x, _, _ in base) for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(spans) and len(spans) == len(base) + r.n_added


def test_field_on_rows_it_has_not_seen(model):
    field = pii.Field(model)
    rows = pii.labelled_rows(4, seed=99)
    right = 0
    for text, spans in rows:
        base, found = pii.find([text], field)[0]
        assert set(base) <= set(found)
        right += set(found) == set(spans) | set(base)
    assert right / len(rows) > 0.9
    clean = [r for r in rows if not r[1]]
    assert sum(bool(pii.find([t], field)[0][1]) for t, _ in clean) <= 0.05 * len(clean)


def test_viterbi_is_exact(model):
    import itertools

    import numpy as np
    field = pii.Field(model)
    lines = [b"call (555) 010-2000 now", b"x", b"", b"jane at mail dot com", b"4 5"]
    got = field.decode(lines)
    for line, labels in zip(lines, got, strict=True):
        ids = field.types.line(line)
        if not 0 < len(ids) <= 5:
            continue
        pad = [0, *ids, 0]
        e = [field.table[0, pad[t + 1]] + field.table[1, pad[t]] + field.table[2, pad[t + 2]] for t in range(len(ids))]
        k = len(pii.LABELS)
        score = lambda y: field.pair[k, y[0]] + sum(e[t][y[t]] for t in range(len(y))) + sum(field.pair[a, b] for a, b in itertools.pairwise(y))
        best = max(itertools.product(range(k), repeat=len(ids)), key=score)
        assert np.isclose(score(best), score(labels.tolist()))


def test_edges(spark, model):
    df = edge_documents(spark)
    rows = pii.detect(df, model).collect()
    want = sorted((i or 0, ",".join(f"{k}:{a}:{b}" for k, a, b in brute(t or ""))) for i, t in edge_rows())
    assert sorted((r.doc_id or 0, r.spans) for r in rows if not r.n_added) + [] == [w for w in want if w[0] in {r.doc_id or 0 for r in rows if not r.n_added}]
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[1] is None and texts[5] == "house" and texts[15].endswith("<phone> <email>")
    assert pii.detect(df.limit(0), model).count() == 0


def test_written_addresses_need_separators():
    for good in ("jane.doe at mail.example.org", "jane (at) mail (dot) org", "jane[at]mail[dot]org", "jane at mail dot org"):
        assert pii.plausible("email", good)
    for bad in ("thaterntoring. At", "ingeathonlyti. At", "thaterntoring.at", "we met at noon", "at home. Then"):
        assert not pii.plausible("email", bad)
