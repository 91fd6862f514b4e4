"""Quality by supervised subword embeddings.

A text's features are its words (what blanks separate), its word sequences by
their repetition (for each word which of the BEFORE ahead are the same), and its
character sequences of two to four, case and punctuation kept, hashed to WIDTH
places.
Each place has a learned vector of DIM numbers; a text is the average of its
features' vectors, and a softmax over a learned output layer gives the chance
of each label. Vectors and output are trained together by stochastic gradient
descent in numpy (ROUNDS passes over batches of BATCH texts, with falling steps
scaled by each number's past gradients), rows weighted to the labels' own
shares, so that scores are chances among the labelled texts.

The model is fitted on a bounded sample: about SAMPLE labelled rows of each
label, chosen by a hash of the id; a text's features reach the driver as at
most WIDTH counts. Scoring is linear up to the softmax, so tasks get one number
a place: what its vector adds to the difference of the outputs.

Null and empty texts, and blanks alone, have no features: their score is what
the output's biases alone give. Labels of one kind only, or none, give every
text their share (0 without any). Ties can't arise: rows are independent, and
repeated rows give repeated results. Repeated labels of an id count once (good
if any is); of an id with several texts each counts. An empty table gives an
empty one. Texts of any length are taken whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import id_text, text_chunks

SAMPLE = 1000
WIDTH, DIM = 1 << 16, 16
LENGTHS = (2, 3, 4)
ROUNDS, BATCH, STEP = 8, 32, 0.3
BEFORE = 3
#: A longer text is cut at the first blank behind every so many characters; features don't reach over a cut.
PIECE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x100000001B3
_BLANK = re.compile(r"\s")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def _place(codes: np.ndarray, kind: int) -> np.ndarray:
    mixed = (codes + np.uint64(kind)) * _MIX
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * _MIX) >> np.uint64(64 - (WIDTH - 1).bit_length())).astype(np.int32)


def pieces(text: str) -> Iterator[str]:
    """The text, cut if it is longer than PIECE."""
    while len(text) > PIECE and (cut := _BLANK.search(text, PIECE)):
        yield text[:cut.start()]
        text = text[cut.start():]
    yield text


def places(text: str) -> np.ndarray:
    """The places of all features of a piece of text, repeats included."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    if blank.all():
        return np.zeros(0, np.int32)
    b = np.concatenate([[32], np.where(blank, 32, chars), [32]]).astype(np.uint64)
    code, found = b, []
    for n in range(2, max(LENGTHS) + 1):
        code = code[:-1] * np.uint64(_STEP) + b[n - 1:]
        if n in LENGTHS:
            found.append(_place(code, n))
    # words: polynomial hashes from prefix sums, whose powers are taken back
    edges = np.diff(np.concatenate([[False], ~blank, [False]]).astype(np.int8))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    words = _word_codes(chars, starts, stops)
    found.append(_place(words, 1))
    # word sequences by their repetition alone: which of the BEFORE words ahead of a word are the same
    again = np.zeros(len(words), np.uint64)
    for k in range(1, min(BEFORE, len(words) - 1) + 1):
        again[k:] += (words[k:] == words[:-k]).astype(np.uint64) << np.uint64(k - 1)
    found.append(_place(again, 0))
    return np.concatenate(found)


_BACK = np.uint64(pow(_STEP, -1, 1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_codes(chars: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    n = len(chars)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * _powers(_STEP, n), out=sums[1:])
    return (sums[stops] - sums[starts]) * _powers(int(_BACK), n)[starts]


def shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text, rising, and each one's share of all its features."""
    count = sum(np.bincount(places(p), minlength=WIDTH) for p in pieces(text))
    at = np.flatnonzero(count)
    n = count[at]
    return at.astype(np.uint16), (n / max(1, n.sum())).astype(np.float32)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, step: float = STEP) -> dict:
    """Train the vectors of all places and the output layer (plain data); y: labels 0 and 1."""
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-0.5, 0.5, (WIDTH, DIM)).astype(np.float32) / DIM
    output = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    weight = (weight / weight.mean()).astype(np.float32)
    share = np.bincount(y, weight, 2) / weight.sum()
    bias = np.log(share).astype(np.float32)
    seen, seen_out = np.full((WIDTH, DIM), 1e-8, np.float32), np.full((DIM, 2), 1e-8, np.float32)
    n, target = len(texts), np.eye(2, dtype=np.float32)[y]
    total = rounds * -(-n // BATCH)
    done = 0
    for _ in range(rounds):
        order = rng.permutation(n)
        for b in range(0, n, BATCH):
            own = order[b:b + BATCH]
            at, place = np.unique(np.concatenate([texts[i][0] for i in own]), return_inverse=True)
            x = np.zeros((len(own), len(at)), np.float32)
            x[np.repeat(np.arange(len(own)), [len(texts[i][0]) for i in own]), place] = np.concatenate([texts[i][1] for i in own])
            hidden = x @ vectors[at]
            z = hidden @ output + bias
            z = np.exp(z - z.max(1, keepdims=True))
            lack = (z / z.sum(1, keepdims=True) - target[own]) * weight[own, None] / len(own)
            g_out, g_in = hidden.T @ lack, x.T @ (lack @ output.T)
            pace = step * (1 - done / total)
            seen[at] += g_in * g_in
            seen_out += g_out * g_out
            vectors[at] -= pace * g_in / np.sqrt(seen[at])
            output -= pace * g_out / np.sqrt(seen_out)
            bias -= pace * lack.sum(0)
            done += 1
    return {"vectors": vectors, "output": output, "biases": bias}


def projected(model: dict) -> dict:
    """What scoring needs of a model: for each place what its vector adds to the difference of the outputs."""
    if "vectors" not in model:
        return model
    output, biases = model["output"].astype(np.float64), model["biases"].astype(np.float64)
    return {"part": model["vectors"] @ (output[:, 1] - output[:, 0]), "bias": float(biases[1] - biases[0])}


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """A model (plain data of bounded size) from about ``sample`` labelled documents of each label."""
    use = (~held_out(id_col)) if learn_from is None else learn_from
    marked = labels.where(use & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("good"))
    counts = {r["good"]: r["n"] for r in marked.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return {"rate": float(max(counts, default=0))}
    rate = {k: min(1.0, sample / n) for k, n in counts.items()}
    spot = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = marked.where(spot < F.when(F.col("good") == 1, rate[1]).otherwise(rate[0]))
    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("id")) \
        .select("id", "good", "text")  # the broadcast side has about 2 * sample rows

    def run(batches):
        for part, texts in text_chunks(batches):
            found = [shares(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([a.tobytes() for a, _ in found], pa.binary()), pa.array([w.tobytes() for _, w in found], pa.binary())],
                ["id", "good", "places", "shares"])

    got = rows.mapInArrow(run, "id long, good int, places binary, shares binary").toArrow().combine_chunks()
    got = got.sort_by([("id", "ascending"), ("places", "ascending"), ("shares", "ascending")])
    y = got["good"].to_numpy().astype(np.int64)
    if not len(y):  # labels of texts that aren't there
        return {"rate": float(counts[1] / (counts[0] + counts[1]))}
    if y.min() == y.max():
        return {"rate": float(y[0])}
    texts = [(np.frombuffer(a.as_py(), np.uint16), np.frombuffer(w.as_py(), np.float32)) for a, w in zip(got["places"], got["shares"], strict=True)]
    return fit(texts, y, np.where(y == 1, 1 / rate[1], 1 / rate[0]))


def scorer(model: dict):
    """A function from a text to the chance of label 1, by the softmax of the average of its features' vectors."""
    if "rate" in model:
        return lambda text: model["rate"]
    model = projected(model)
    part, bias = model["part"], model["bias"]

    def one(text: str) -> float:
        total, n = 0.0, 0
        for p in pieces(text):
            at = places(p)
            total, n = total + float(part[at].sum()), n + len(at)
        return float(1 / (1 + np.exp(-np.clip(bias + total / max(1, n), -60, 60))))
    return one


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every text."""
    shared = df.sparkSession.sparkContext.broadcast(projected(model))  # 512 KB: a number for each place

    def run(batches):
        one = scorer(shared.value)
        for part, texts in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([one(t) for t in texts], pa.float64())], ["doc_id", "score"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")
