"""Language identification in two steps: the language family first, then
one-versus-one linear support vector machines among the family's languages: a
machine for each pair, the language with most votes wins, and equal votes are
told apart by the sum of margins.

Features are hashed two- and three-byte sequences of the lower-cased text with
every ASCII non-letter as a blank, as square roots of their shares, over the
whole text. The machines are fitted on a bounded sample of labelled rows
(SAMPLE of each language, chosen by a hash of the id).

Null texts and texts without a letter are ``und`` with score 0, as is every
text when there is nothing to learn from. Ties go to the language first in the
alphabet. Rows are independent: repeated rows give repeated results, and an
empty table an empty one. Labels and ids never enter a score.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import bound_batches, id_text, rows_again, text_chunks, whole_rows

#: Labelled rows of each language that the machines are fitted on, about.
SAMPLE = 300
#: Hashed features of each kind of sequence.
WIDTH = 2048
#: Steepness of the logistic curve that turns margins into scores.
STEEP = 4.0

# ISO 639-1 codes by language family.
FAMILIES: dict[str, tuple[str, ...]] = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "co", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro", "sc"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "sa", "si", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "tt", "ug", "uz"),
    "uralic": ("et", "fi", "hu"),
    "semitic": ("am", "ar", "he", "mt"),
    "austronesian": ("id", "jv", "mg", "ms", "su", "tl"),
    "dravidian": ("kn", "ml", "ta", "te"),
}


def family(lang: str) -> str:
    """Family of a language code; a code of no listed family is one of its own."""
    base = re.split("[-_]", lang.lower())[0]
    return next((k for k, codes in FAMILIES.items() if base in codes), f"of {lang}")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def _blanked() -> np.ndarray:
    letters = [32 if b < 128 and not chr(b).isalpha() else b for b in range(256)]
    return np.array(letters, np.uint32)


def features(text: str, blanked: np.ndarray) -> np.ndarray:
    """The feature vector of one text, 2 * WIDTH numbers."""
    raw = np.frombuffer(f"  {text.lower()}  ".encode(), np.uint8)
    b = blanked[raw]
    two = b[:-1] * np.uint32(0x01000193) + b[1:] * np.uint32(0x0085EBCA)
    three = two[:-1] * np.uint32(31) + b[2:] * np.uint32(0x00C2B2AE)
    shift = np.uint32(32 - (WIDTH - 1).bit_length())
    out = np.empty(2 * WIDTH, np.float32)
    for at, codes in ((0, two), (WIDTH, three)):
        mixed = (codes * np.uint32(0x9E3779B1)) >> shift
        out[at:at + WIDTH] = np.bincount(mixed, minlength=WIDTH)[:WIDTH]
        out[at:at + WIDTH] /= len(codes)
    return np.sqrt(out)


def fit_svm(x: np.ndarray, y: np.ndarray, keep: float = 1e-4, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine: squared hinge loss by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = y.astype(np.float32)
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    step = np.float32(1.0 / (keep + 2.0 * float((x * x).sum(1).max())))
    w = at = np.zeros(x.shape[1], np.float32)
    t = 1.0
    for _ in range(rounds):
        lack = np.maximum(0, 1 - y * (x @ at))
        new = at - step * (np.float32(keep) * at - 2 * ((balance * y * lack) @ x))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        at, w, t = new + np.float32((t - 1) / t_new) * (new - w), new, t_new
    return w[:-1].astype(np.float32), float(w[-1])


def fit(x: np.ndarray, langs: list[str]) -> dict:
    """A model: languages, their families, and a column of weights for each family and each pair of languages in one."""
    names = sorted(set(langs))
    groups = sorted({family(a) for a in names})
    own = np.array(langs)
    kin = np.array([family(a) for a in langs])
    columns, biases = [], []
    for g in groups:
        w, b = fit_svm(x, np.where(kin == g, 1.0, -1.0)) if len(groups) > 1 else (np.zeros(x.shape[1], np.float32), 1.0)
        columns.append(w)
        biases.append(b)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names)) if family(names[i]) == family(names[j])]
    for i, j in pairs:
        among = (own == names[i]) | (own == names[j])
        w, b = fit_svm(x[among], np.where(own[among] == names[i], 1.0, -1.0))
        columns.append(w)
        biases.append(b)
    return {"names": names, "groups": groups, "of": [groups.index(family(a)) for a in names], "pairs": pairs,
            "weights": np.stack(columns, 1) if columns else np.zeros((2 * WIDTH, 0), np.float32),
            "biases": np.array(biases, np.float32)}


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          learn_from: Column | None = None, sample: int = SAMPLE) -> dict:
    """Fit a model on about ``sample`` labelled rows of each language.

    Only the sample's feature vectors reach the driver (16 KB each).
    """
    bound_batches(df.sparkSession)
    use = (~held_out(id_col)) if learn_from is None else learn_from
    rows = df.where(use & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, 2 * WIDTH), np.float32), [])
    spot = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, sample / n))])
    blanked = _blanked()

    def run(batches):
        for part, texts in text_chunks(batches):
            keep = [bool(re.search(r"[^\W\d_]", t)) for t in texts]
            vectors = [features(t, blanked).tobytes() for t, k in zip(texts, keep, strict=True) if k]
            langs = [a for a, k in zip(part.column(2).to_pylist(), keep, strict=True) if k]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(vectors, pa.binary())], ["lang", "v"])

    chosen = rows.where(spot < share[F.col("lang")]).mapInArrow(run, "lang string, v binary")
    got = sorted((r["lang"], bytes(r["v"])) for r in chosen.collect())
    x = np.frombuffer(b"".join(v for _, v in got), np.float32).reshape(-1, 2 * WIDTH)
    return fit(x, [a for a, _ in got])


def ballot(inside: list[int], pairs: list[tuple[int, int]], margins: np.ndarray) -> tuple[int, float]:
    """The language of a family that wins its pairs, and its share of their chances; margins: for each pair, over 0 for its first."""
    votes, total, chance = dict.fromkeys(inside, 0), dict.fromkeys(inside, 0.0), dict.fromkeys(inside, 0.0)
    n = 0
    for (i, j), m in zip(pairs, margins.tolist(), strict=True):
        if i in votes:
            votes[i if m >= 0 else j] += 1
            total[i], total[j] = total[i] + m, total[j] - m
            for k, own in ((i, m), (j, -m)):
                chance[k] += 1 / (1 + np.exp(-STEEP * own))
            n += 1
    best = max(inside, key=lambda k: (votes[k], total[k], -k))
    return best, chance[best] / n if n else 1.0


def scorer(model: dict) -> Callable[[str], tuple[str, float]]:
    """A function from a text to its language and score."""
    blanked, weights, biases = _blanked(), model["weights"], model["biases"]
    n, names, pairs = len(model["groups"]), model["names"], model["pairs"]
    kin = [[i for i, of in enumerate(model["of"]) if of == g] for g in range(n)]
    letter = re.compile(r"[^\W\d_]").search

    def one(text: str) -> tuple[str, float]:
        if not names or not letter(text):
            return "und", 0.0
        margins = (features(text, blanked) @ weights + biases).astype(np.float64)
        chance = 1 / (1 + np.exp(-STEEP * margins[:n]))
        g = int(np.argmax(chance))
        k, share = ballot(kin[g], pairs, margins[n:])
        return names[k], float(chance[g] / chance.sum() * share)
    return one


def identify(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every text."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # 16 KB for each language and family

    def run(batches):
        one = scorer(shared.value)
        for part, texts in text_chunks(batches):
            got = [one(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([a for a, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(df: DataFrame, model: dict, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of df, all columns as they are, whose text has a language with a score of at least ``least``."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    rows = df.select(whole_rows(df, but=text_col).alias("row"), F.col(text_col).cast("string").alias("text"))

    def known(batches):
        one = scorer(shared.value)
        for part, texts in text_chunks(batches):
            got = [one(t) for t in texts]
            yield part.filter(pa.array([a != "und" and s >= least for a, s in got], pa.bool_()))

    return rows_again(rows.mapInArrow(known, rows.schema), "row", df.columns, {text_col: F.col("text")})
