"""Personal data: patterns for the plain forms, a linear-chain conditional
random field for the others.

The patterns find e-mail and IP addresses, card and phone numbers in their
usual spelling. The field labels the words of every line (B-, I- and O) by
word-shape features of a word and its neighbours; it is trained on a small
labelled table (LABELLED, filled in by a seeded rule) and decoded by Viterbi
steps over all lines of a batch at once. It adds spellings that the patterns
miss: written-out e-mail addresses, national phone numbers, cards in other
groupings, defanged IP addresses. What it finds is checked again (digits,
Luhn, parts), and dropped where it overlaps a pattern's span: pattern spans
always stay.

Null and empty texts have no spans. Whole texts are searched, lines of any
length are one chain. Repeated rows give repeated results; an empty table
gives an empty one. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import bound_batches, id_text, text_chunks

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

# --- patterns -----------------------------------------------------------------

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits that doesn't match from its start doesn't from inside either, so only starts are tried
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local part, @ and dotted domain, leftmost first, found from the @ signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL_END.match(text, start - 1, start):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by kind as listed and then by start."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


# --- word shapes ---------------------------------------------------------------

#: Bytes to classes: x lower-case letter, X capital, d digit, others themselves.
_CLASSES = bytes(100 if 48 <= b < 58 else 88 if 65 <= b < 91 else 120 if 97 <= b < 123 or b >= 128 else b for b in range(256))
_WORD = re.compile("[^\x20\x09-\x0D]+")
_RUN = re.compile(r"(.)\1*", re.S)

# Words that stand before or inside personal data.
CUES = ("at", "(at)", "[at]", "dot", "(dot)", "[dot]", "com", "org", "net", "de", "fr", "es", "email", "e-mail", "mail", "phone", "tel",
        "telephone", "telefon", "mobile", "cell", "fax", "call", "ring", "card", "visa", "mastercard", "amex", "ip", "host", "server", "address")


def cue_table() -> dict[bytes, int]:
    out = {}
    for n, c in enumerate(CUES, 1):
        for end in ("", ":", ",", ".", ";", "!", "?"):
            out[(c + end).encode()] = n
    return out


def type_features(shape: bytes, cue: int) -> list[str]:
    """Features of a word, from its class string and cue."""
    s = shape.decode("latin-1")
    runs = [(m[0][0], len(m[0])) for m in _RUN.finditer(s[:64])]
    exact = "".join(c + (str(min(n, 9)) if c == "d" else "") for c, n in runs)
    digits = sum(n for c, n in runs if c == "d")
    out = ["bias", "exact=" + exact, "runs=" + "".join(c for c, _ in runs), f"digits={min(digits, 17)}", f"cue={cue}",
           "first=" + s[:1], "last=" + s[-1:], f"long={min(len(s), 24) // 4}"]
    out += [f"has={c}" for c in sorted({c for c, _ in runs} - {"x", "X", "d"})]
    if not digits and not cue:
        out.append("plain")
    return out


# --- the labelled table ----------------------------------------------------------

# Text with spans in braces; # is a digit, ~ a made-up word, ^ one with a capital, C a card number's digits in turn.
LABELLED: tuple[tuple[str, str], ...] = (
    ("email", "^ ~ ~ {~ at ~ dot com} ~ ~"), ("email", "~ email: {~ (at) ~ (dot) org} ~ ~"), ("email", "~ {~.~ [at] ~ [dot] net} ~"),
    ("email", "mail {~ at ~ dot ~ dot com}, ~ ~"), ("email", "^ {~## at ~ dot de} ~"), ("email", "~ ~ {~.## (at) ~.com} ~ ~"),
    ("email", "~ {~ (at) ~ dot fr} ~ ~"), ("email", "~ write {~@~} ~ ~"), ("email", "~ ~ {~.##@~#.~.com} ~ ~"), ("email", "^ {~@~.org}, ~"),
    ("phone", "~ call {(###) ###-####} ~ ~"), ("phone", "~ phone: {###-###-####} ~"), ("phone", "~ ~ {###.###.####} ~ ~"),
    ("phone", "^ ~ tel {0## ### ####} ~"), ("phone", "~ fax {(0##) ### ####}, ~"), ("phone", "~ ~ {+# (###) ###-####} ~ ~"),
    ("phone", "~ {+## ## ### ## ##} ~ ~"), ("phone", "~ mobile {00## ### ######} ~"), ("phone", "~ ~ {1-###-###-####} ~"), ("phone", "~ {(###)###-####} ~"),
    ("card", "~ card {CCCC CCCC CCCC CCCC} ~ ~"), ("card", "~ ~ {CCCC-CCCC-CCCC-CCCC} ~"), ("card", "~ visa {CCCC.CCCC.CCCC.CCCC}, ~"),
    ("card", "~ ~ {CCCCCCCCCCCCCCCC} ~ ~"), ("card", "~ {CCCC_CCCC_CCCC_CCCC} ~ ~"), ("card", "^ amex {CCCC CCCCCC CCCCC} ~"), ("card", "~ {CCCC/CCCC/CCCC/CCCC} ~"),
    ("ip", "~ host {##.##.##.##} ~ ~"), ("ip", "~ ~ {1##.1##.##.#} ~"), ("ip", "~ server {1##[.]##[.]##[.]#} ~"), ("ip", "~ {##(.)1##(.)##(.)1##} ~ ~"),
    ("ip", "~ ip {1##-##-##-1##} ~"), ("ip", "~ ~ {##[dot]##[dot]#[dot]##} ~"),
    ("", "^ ~ ~ ~ ~, ~ ~ ~. ^ ~ ~"), ("", "~ at ~ ~ ~ ~ ~"), ("", "^ ~ at the ~ de ~ ~, ~"), ("", "~ ~ de ~ ~ es ~ ~ ~"), ("", "~ ~ dot ~ ~ ~"),
    ("", "~ 20##-0#-## ~ ~ ~"), ("", "~ ##:## ~ ~"), ("", "~ page ## of ### ~"), ("", "~ ## ~ ### ~ #### ~"), ("", "^ ~ v#.#.## ~ ~"),
    ("", "~ #,###.## ~ ~ ##% ~"), ("", "~ AKIA##ABCD##EFGH## ~ ~"), ("", "~ password=##ab##cd## ~ ~"), ("", '~ token = "##ab##" ~ ~'), ("", "| # | ## | ### | ~ |"),
    ("", "~ call ~ ~ ~. ^ ~ ~"), ("", "~ card ~ ~ at ~ ~ ~"), ("", "^, ~!! ~ ~!! ~"), ("", "~ ~_~ ~/~ ~:~ ~"), ("", "~ email ~ ~ com ~ ~"), ("", "~ https://~.com/~/## ~"),
    ("", "~ ######## ~ ~"), ("", "~ ## ## ~ ~ ## ~"), ("", "~ (##) ~ ~ (~) ~"), ("", "- ~ ~ - ~ ~ -"), ("", "~ ~@ ~ @~ ~"), ("", "~ ISBN ###-#-##-######-# ~"),
)


def _card_digits(rng: random.Random, n: int) -> str:
    body = "4" + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(body + c for c in "0123456789" if luhn(body + c))


def labelled_rows(copies: int = 12, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The labelled table: (text, spans), each line of LABELLED filled in ``copies`` times."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("abdeghilmnoprstuvé") for _ in range(rng.randint(2, 11)))

    rows = []
    for kind, line in LABELLED:
        for _ in range(copies):
            card = iter(_card_digits(rng, max(2, line.count("C"))) if kind == "card" else "")
            text, start, spans = "", 0, []
            for c in line:
                if c == "{":
                    start = len(text)
                elif c == "}":
                    spans.append((kind, start, len(text)))
                elif c == "C" and kind == "card":
                    text += next(card)
                else:
                    text += {"#": lambda: rng.choice("0123456789"), "~": word, "^": lambda: word().capitalize()}.get(c, lambda c=c: c)()
            rows.append((text, spans))
    return rows


# --- the field -------------------------------------------------------------------

class Types:
    """Numbers for (class string, cue) pairs; 0 is the edge of a line."""

    def __init__(self):
        self.number: dict[tuple[bytes, int], int] = {}
        self.cues = cue_table().get

    def line(self, raw: bytes) -> list[int]:
        number, cues = self.number, self.cues
        shapes = raw.translate(_CLASSES).split()
        keys = zip(shapes, [cues(w, 0) for w in raw.lower().split()], strict=True)
        return [number.setdefault(k, len(number) + 1) for k in keys]


def _gold(text: str, spans) -> list[int]:
    out = []
    for m in _WORD.finditer(text):
        y = 0
        for kind, a, b in spans:
            if m.start() < b and m.end() > a:
                first = not any(w.start() < m.start() and w.end() > a for w in _WORD.finditer(text))
                y = LABELS.index(("B-" if first else "I-") + kind)
        out.append(y)
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(rows=None, rounds: int = 160, rate: float = 0.08, keep: float = 2e-3) -> dict:
    """Weights by feature, place (the word, before, after) and label, and of label pairs: the regularised
    likelihood of the labelled rows, climbed by adaptive gradient steps."""
    rows = labelled_rows() if rows is None else rows
    types = Types()
    x = [types.line(t.encode()) for t, _ in rows]
    y = [_gold(t, s) for t, s in rows]
    names: dict[str, int] = {"edge": 0}
    feats = [[0]] + [[names.setdefault(f, len(names)) for f in type_features(*k)] for k in types.number]
    n, longest, k = len(rows), max(map(len, x)), len(LABELS)
    one = np.zeros((len(feats), len(names)))
    for i, f in enumerate(feats):
        one[i, f] = 1
    ids = np.zeros((n, longest + 2), np.int64)
    gold, real = np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
    for i, (a, b) in enumerate(zip(x, y, strict=True)):
        ids[i, 1:len(a) + 1], gold[i, :len(a)], real[i, :len(a)] = a, b, True
    places = [ids[:, 1:-1], ids[:, :-2], ids[:, 2:]]
    w, pair = np.zeros((3, len(names), k)), np.zeros((k + 1, k))  # the last row of pair: the line's start
    seen = np.eye(k)[gold] * real[..., None]
    pair_seen = np.zeros_like(pair)
    np.add.at(pair_seen, (k, gold[:, 0]), real[:, 0])
    for t in range(1, longest):
        np.add.at(pair_seen, (gold[:, t - 1], gold[:, t]), real[:, t])
    sums = [np.zeros_like(w), np.zeros_like(pair)]
    for _ in range(rounds):
        table = [one @ w[p] for p in range(3)]
        e = sum(table[p][places[p]] for p in range(3))
        alpha, beta = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        alpha[:, 0] = e[:, 0] + pair[k]
        for t in range(1, longest):
            step = _lse(alpha[:, t - 1, :, None] + pair[None, :k], 1) + e[:, t]
            alpha[:, t] = np.where(real[:, t, None], step, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _lse(pair[None, :k] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(real[:, t + 1, None], step, 0)
        whole = _lse(alpha[:, -1], 1)
        chance = np.exp(alpha + beta - whole[:, None, None]) * real[..., None]
        pair_chance = np.zeros_like(pair)
        pair_chance[k] = chance[:, 0].sum(0)
        for t in range(1, longest):
            both = alpha[:, t - 1, :, None] + pair[None, :k] + (e[:, t] + beta[:, t])[:, None, :] - whole[:, None, None]
            pair_chance[:k] += (np.exp(both) * real[:, t, None, None]).sum(0)
        lack = (seen - chance).reshape(-1, k)
        grad = np.empty_like(w)
        for p in range(3):
            by_type = np.zeros((len(feats), k))
            np.add.at(by_type, places[p].reshape(-1), lack)
            grad[p] = one.T @ by_type / n - keep * w[p]
        for at, g, total in ((w, grad, sums[0]), (pair, (pair_seen - pair_chance) / n - keep * pair, sums[1])):
            total *= 0.9
            total += 0.1 * g * g
            at += rate * g / (np.sqrt(total) + 1e-6)
        rate *= 0.985
    return {"names": names, "w": w, "pair": pair}


class Field:
    """Decoder of a trained field."""

    def __init__(self, model: dict):
        self.names, self.w, self.pair = model["names"], model["w"].astype(np.float32), model["pair"].astype(np.float32)
        self.types = Types()
        self.table = self.w[:, [self.names["edge"]]]  # by place, type and label

    def _grow(self) -> None:
        new = list(self.types.number)[self.table.shape[1] - 1:]
        if new:
            rows = np.zeros((3, len(new), len(LABELS)), np.float32)
            for i, key in enumerate(new):
                known = [self.names[f] for f in type_features(*key) if f in self.names]
                rows[:, i] = self.w[:, known].sum(1)
            self.table = np.concatenate([self.table, rows], 1)

    def decode(self, lines: list[bytes]) -> list[np.ndarray]:
        """Labels of the words of each line."""
        if len(self.types.number) > 200_000:
            self.types, self.table = Types(), self.table[:, :1]
        own = [self.types.line(x) for x in lines]
        self._grow()
        lens = np.array([len(x) for x in own])
        order = np.argsort(-lens, kind="stable")
        order = order[lens[order] > 0]
        out = [np.zeros(n, np.int8) for n in lens.tolist()]
        if not len(order):
            return out
        k, longest = len(LABELS), int(lens[order[0]])
        size = lens[order]
        first = np.cumsum(size + 2) - (size + 2)  # every line between two edges
        flat = np.zeros(int((size + 2).sum()), np.int64)
        inner = np.repeat(first + 1, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        flat[inner] = np.concatenate([own[i] for i in order])
        alive = np.searchsorted(-size, -np.arange(1, longest + 1), "right")  # lines that have a t-th word
        backs, score = [], None
        best_last = np.zeros(len(order), np.int8)
        step = np.ascontiguousarray(self.pair[:k].T)
        for t in range(longest):
            m = int(alive[t])
            at = first[:m] + t + 1
            e = self.table[0, flat[at]] + self.table[1, flat[at - 1]] + self.table[2, flat[at + 1]]
            if t == 0:
                score = e + self.pair[k]
            else:
                if m < len(score):
                    best_last[m:len(score)] = score[m:].argmax(1)
                both = score[:m, None, :] + step[None]
                back = both.argmax(2)
                backs.append(back.astype(np.int8))
                score = np.take_along_axis(both, back[..., None], 2)[..., 0] + e
        best_last[:len(score)] = score.argmax(1)
        labels = best_last.copy()
        found = np.zeros((longest, len(order)), np.int8) if longest * len(order) < 1 << 24 else None
        rows = [found[t] if found is not None else np.zeros(int(alive[t]), np.int8) for t in range(longest)]
        for t in range(longest - 1, -1, -1):
            m = int(alive[t])
            if t < longest - 1:
                nxt = int(alive[t + 1])
                labels[:nxt] = np.take_along_axis(backs[t][:nxt], labels[:nxt, None].astype(np.int64), 1)[:, 0]
            rows[t][:m] = labels[:m]
        for c in np.flatnonzero(np.bincount(np.concatenate([np.flatnonzero(r) for r in rows]), minlength=len(order))[:len(order)]):
            out[order[c]] = np.array([rows[t][c] for t in range(int(size[c]))], np.int8)
        return out


_TRIM = " ,.;:!?\"'<>|"
#: A bare "at" or "dot" stands between blanks; inside a word it is a part of it, and a full stop between blanks ends a sentence.
_WRITTEN = re.compile(r"[\w.%+-]+(?: ?(?:\(at\)|\[at\]) ?| at )[\w-]+(?:(?: ?(?:\(dot\)|\[dot\]) ?| dot |\.)[\w-]+)+", re.I)


def plausible(kind: str, s: str) -> bool:
    """Whether what the field found can be what it says."""
    digits = "".join(_DIGIT.findall(s))
    letters = any(c.isalpha() for c in re.sub(r"dot", "", s, flags=re.I))
    if kind == "email":
        return bool(_WRITTEN.fullmatch(s))
    if letters:
        return False
    if kind == "phone":
        return 9 <= len(digits) <= 15 and bool(re.search(r"[ ().-]", s)) and not re.search(r"[^0-9 ().+-]", s)
    if kind == "card":
        return 15 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 2
    parts = re.findall("[0-9]+", s)
    return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)


def added_spans(text: str, base, words, labels) -> list[tuple[str, int, int]]:
    """The field's spans of one line that are plausible and don't touch a pattern's span."""
    out, i = [], 0
    while i < len(labels):
        y = int(labels[i])
        if not y:
            i += 1
            continue
        kind, j = LABELS[y][2:], i + 1
        while j < len(labels) and LABELS[int(labels[j])] == "I-" + kind:
            j += 1
        a, b = words[i][0], words[j - 1][1]
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        if a < b and plausible(kind, text[a:b]) and not any(a < e and b > s for _, s, e in base):
            out.append((kind, a, b))
        i = j
    return out


def find(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """(pattern spans, all spans) of each text, by kind as listed and then by start."""
    lines, owner, starts = [], [], []
    for n, t in enumerate(texts):
        at = 0
        for line in t.split("\n"):
            if line:
                lines.append(line)
                owner.append(n)
                starts.append(at)
            at += len(line) + 1
    base = [base_spans(t) for t in texts]
    more: list[list] = [[] for _ in texts]
    for line, n, at, labels in zip(lines, owner, starts, field.decode([x.encode() for x in lines]), strict=True):
        if labels.any():
            words = [(at + m.start(), at + m.end()) for m in _WORD.finditer(line)]
            more[n] += added_spans(texts[n], base[n], words, labels)
    order = {k: i for i, k in enumerate(KINDS)}
    return [(b, sorted(b + m, key=lambda s: (order[s[0]], s[1], s[2]))) for b, m in zip(base, more, strict=True)]


def written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _field(shared) -> Field:
    v = shared.value
    if "field" not in v:
        v["field"] = Field(v)
    return v["field"]


def detect(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts and digest of the patterns'
    spans, and all spans."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def run(batches):
        field = _field(shared)
        for part, texts in text_chunks(batches):
            got = find(texts, field)
            counts = [pa.array([sum(s[0] == k for s in b) for b, _ in got], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([
                part.column(0), *counts, pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in got], pa.string()),
                pa.array([written(s) for _, s in got], pa.string()), pa.array([len(s) - len(b) for b, s in got], pa.int64())], names)

    return id_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """df with every span replaced by its kind in angle brackets; overlapping spans are replaced as one."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def clean(texts):
        import pandas as pd
        field, out = _field(shared), []
        for t in texts:
            _, spans = find([t or ""], field)[0]
            for k, a, b in sorted(_joined(spans), key=lambda s: -s[1]):
                t = f"{t[:a]}<{k}>{t[b:]}"
            out.append(t)
        return pd.Series(out, dtype=object)

    return df.withColumn(text_col, clean(F.col(text_col).cast("string")))


def _joined(spans) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(b, out[-1][2]))
        else:
            out.append((k, a, b))
    return out
