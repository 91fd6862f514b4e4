"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tests_llm_data import SF
from voltlake.llm import conversations as cv

BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if key == 0:
            continue
        if key == 1:
            text = ""
        elif key == 2:
            text = re.sub("[.!?]", "", text)
        elif key == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if key == 3 else 1)
    return out


def brute(rows):
    """Result of one conversation's rows, in order: every edit sequence that can be cheapest is compared."""
    roles, texts = [r[2] for r in rows], [r[3] for r in rows]
    faults, seen = [], set()
    for k in zip(roles, texts, strict=True):
        bare = k[1].strip(BLANK)
        faults.append("blank" if not bare else "duplicate" if k in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add(k)

    def follow(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    @lru_cache(None)
    def best(i, state, inserts):
        """(cost, audit) from row i on; more than two inserts in a row only go round."""
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, ""))
        else:
            def then(cost, letter, to):
                if to is not None:
                    c, a = best(i + 1, to, 0)
                    ways.append((cost + c, letter + a))
            then(4, "D", state)
            if faults[i] not in ("blank", "duplicate"):
                cut = 3 if faults[i] == "truncated" else 0
                then(cut, "K", follow(state, roles[i][:1]))
                for to in "ua":
                    then(3 + cut, "R", follow(state, to))
        if inserts < 3:
            for to in "ua":
                if follow(state, to):
                    c, a = best(i, follow(state, to), inserts + 1)
                    ways.append((3 + c, "I" + a))
        return min(ways, default=(10**9, ""))

    cost, audit = best(0, "", 0)
    out, i, state = [], 0, ""
    for e in audit:
        role, text = ("", "") if e == "I" else (roles[i], texts[i])
        if e in "IR":
            role = "assistant" if state == "u" else "user"
        if e != "D":
            state = follow(state, role[:1])
            out.append(f"{role}:{text}")
        i += e != "I"
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
    return {"gaps": gaps, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}, "illegal": illegal, "cost": cost,
            "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def expected(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest())
    groups = {r[0]: [] for r in rows}
    for r in damaged(rows):
        groups[r[0]].append(r)
    return {k: brute(sorted(v, key=order)) for k, v in groups.items()}


def result(df):
    rows = [r.asDict() for r in df.collect()]
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r.pop("conv_id"): r for r in rows}


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(0, most)):
            turn = rng.choice([t, t, t, t + 2, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No", "What?", " ", "", "x! \n", None, "é. 漢", f"t{t}."])
            rows += [(c, turn, role, text)] * rng.choice([1, 1, 1, 1, 3])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_against_search(spark, chunk):
    rows = random_rows(chunk, 60, 14)
    df = frame(spark, rows).repartition(5)
    assert result(cv.repair(cv.damage(df), chunk=chunk)) == expected(rows)


def test_long_alternation_is_streamed(spark):
    """Roles that alternate for good never let the costs converge: the passes end and the rest is streamed."""
    rows = [(7, t, ("user", "assistant")[t % 2], f"say {t}.") for t in range(121)] + [(8, 1, "assistant", "a."), (8, 2, "user", "b.")]
    got = result(cv.repair(cv.as_given(frame(spark, rows)), chunk=4, fixups=2))
    assert got == {7: brute(rows[:121]), 8: brute(rows[121:])}
    assert got[7]["audit"] == "K" * 120 + "KI" and got[8]["audit"] == "IKKI"


def test_fixup_stops_at_a_constant():
    rng = random.Random(5)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 1, 2, 3, 5, 6, 17, 18, 12]) for _ in range(rng.randint(1, 30)))
        a, b = rng.choice([cv.END, cv.UNKNOWN, (1, 3, 0, 2)]), rng.choice([cv.END, (3, 3, 0, 3)])
        assert cv.fixed(codes, a, cv.backward(codes, a), b) == cv.backward(codes, b)


def test_query_on_given_table(spark):
    from voltlake.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op11_conversation_repair"](spark, SF)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert result(df) == expected(rows)


def test_edges(spark):
    long = "word " * 40_000 + "."
    rows = [(None, None, None, None), (None, 2, "user", "Hi."), (1, None, None, None), (2, 5, "user", long), (2, 5, "user", long),
            (2, 6, "assistant", "Fine."), (3, 1, "system", "Be kind.")] + [(4, 1, "user", "same.")] * 9
    df = frame(spark, rows)
    for name in ("conv", "key", "d", "code", "copies", "kind", "a.b", "part"):
        df = df.withColumn(name, df.text)
    assert result(cv.repair(cv.damage(df), chunk=2)) == expected(rows)
    assert cv.repair(cv.damage(df.limit(0))).count() == 0
    dropped = [(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = result(cv.repair(cv.damage(frame(spark, dropped))))
    assert len(got) == len(dropped) and all(
        r == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
        for r in got.values())
