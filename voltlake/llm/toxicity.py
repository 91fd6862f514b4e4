"""Toxicity by the nearest labelled examples.

Examples and texts are TF-IDF vectors over all terms of the examples, each term
times its correlation with the label (phi, from 0 to 1, by the examples); terms
are lower-cased words and, so that inflected forms meet, their first STEM letters.
No term is left out: those that toxic or clean texts have alone count most,
however rare, and those that both have alike count little. Each text is
compared by exact cosine with its nearest examples, found in an inverted index.
The postings of rarer terms are added up. The DENSE most frequent ones, whose
postings are long and whose weights are small, have a row of weights each
instead: what they can add is bounded for each block of BLOCK examples by the
block's largest weights, and only blocks that can still hold one of the nearest
are finished with them, for TOGETHER texts at once. Examples are grouped by
content, so that a block's largest weights say something about its members.
Similarities weigh the examples' votes against one vote for clean, the votes
are calibrated on the examples themselves (each without itself), and the
nearest examples are the evidence.

Examples are a bounded sample of the labelled rows (EXAMPLES of each label,
chosen by a hash of the id). Document frequencies are counted over all texts.
The index has at most 2 * EXAMPLES rows and their terms, and is broadcast.

Null and empty texts, and others that meet no example, have a vote of 0. Ties
between examples go to the smaller id. Without labels of both kinds every score is the share of toxic
labels, 0 if there are none. Repeated rows give repeated results, repeated
labels count once (toxic if any is), and of several texts of one labelled id the
least; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import id_text, saved, text_chunks
from voltlake.llm.langid import held_out

#: Labelled rows of each label that serve as examples, about.
EXAMPLES = 2000
#: An example with more terms counts for less in the terms' correlations: copies of a very long one would make many of
#: its words look telling.
TYPICAL = 1000
BLOCK = 64
NEIGHBOURS = 15

STEM = 6
#: Words whose terms a task remembers.
KEPT_WORDS = 500_000
#: Texts that are compared with the examples at once.
TOGETHER = 64
#: Most frequent terms that are kept as rows of weights: 16 MB at 2 * EXAMPLES examples.
DENSE = 512

_WORD = re.compile(r"\w+")


def terms_of(text: str) -> Counter:
    """Words and stems (marked *) with their counts."""
    out = Counter(_WORD.findall(text.lower()))
    for w, n in list(out.items()):
        if len(w) >= STEM:
            out[w[:STEM] + "*"] += n
    return out


class Lexicon:
    """Numbers of the known terms of texts; those of a word are kept for the next text that has it."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.memo: dict[str, int] = {}
        self.place, self.total = np.zeros(len(terms), np.int64), np.zeros(len(terms))

    def _codes(self, words: Iterable[str]) -> np.ndarray:
        """For each word the numbers of its two terms plus 1 (0: none), as one."""
        memo, number = self.memo, self.number
        if len(memo) > KEPT_WORDS:
            memo.clear()
        out = [memo.get(w) for w in words]
        if None in out:
            for i, w in enumerate(words):
                if out[i] is None:
                    stem = number.get(w[:STEM] + "*", -1) if len(w) >= STEM else -1
                    out[i] = memo[w] = (number.get(w, -1) + 1 << 32) + stem + 1
        return np.array(out, np.int64)

    def _once(self, at: np.ndarray) -> np.ndarray:
        """Which entries of ``at`` to keep so that every number is there once."""
        here = np.arange(len(at))
        self.place[at] = here
        return self.place[at] == here

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, each once, and counts."""
        counts = Counter(_WORD.findall(text.lower()))
        codes, n = self._codes(counts), np.fromiter(counts.values(), np.float64, len(counts))
        word, stem = codes >> 32, codes & 0xFFFFFFFF
        at, n = np.concatenate([word[word > 0], stem[stem > 0]]) - 1, np.concatenate([n[word > 0], n[stem > 0]])
        np.add.at(self.total, at, n)
        at = at[self._once(at)]
        n = self.total[at]
        self.total[at] = 0
        return at, n

    def inside(self, text: str) -> np.ndarray:
        """Numbers of the terms that a text has, each once."""
        codes = self._codes(set(_WORD.findall(text.lower())))
        word, stem = codes >> 32, codes & 0xFFFFFFFF
        at = np.concatenate([word[word > 0], stem[stem > 0]]) - 1
        return at[self._once(at)]


def examples(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic", sample: int = EXAMPLES) -> DataFrame:
    """(id, toxic, weight, terms, counts) of the examples; weight is the number of labelled rows that one stands for."""
    use = (~held_out(id_col)) if learn_from is None else learn_from
    marked = labels.where(use & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, sample / n) for k, n in counts.items()}
    spot = F.pmod(F.xxhash64(F.lit("example"), "id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.create_map(*[F.lit(v) for k in share for v in (k, share[k])])[F.col("toxic")] if share else F.lit(1.0)
    chosen = marked.where(spot < rate).select("id", "toxic", (1 / rate).alias("weight"))
    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("id")) \
        .groupBy("id", "toxic", "weight").agg(F.min("text").alias("text")) \
        .select("id", "text", "toxic", "weight")  # the broadcast side has about 2 * sample rows

    def run(batches):
        for part, texts in text_chunks(batches):
            found = [terms_of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3), pa.array([list(c) for c in found], pa.list_(pa.string())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
                ["id", "toxic", "weight", "terms", "counts"])

    return saved(rows.mapInArrow(run, "id long, toxic int, weight double, terms array<string>, counts array<int>"), "examples")


def correlations(toxic: np.ndarray, row: np.ndarray, term: np.ndarray, n_terms: int) -> np.ndarray:
    """Phi of each term with the label over the examples, regardless of sign; row and term: where each entry stands."""
    bad, good = float(toxic.sum()), float((1 - toxic).sum())
    counts_for = np.minimum(1.0, TYPICAL / np.maximum(np.bincount(row, minlength=len(toxic)), 1))[row]
    a = np.bincount(term, counts_for * toxic[row], n_terms)
    b = np.bincount(term, counts_for * (1 - toxic[row]), n_terms)
    gap = a * good - b * bad
    return np.minimum(1.0, np.abs(gap) / np.sqrt(bad * good * (a + b) * np.maximum(bad + good - a - b, 1.0)))


def document_frequencies(docs: DataFrame, terms: list[str], text_col: str = "text") -> tuple[int, np.ndarray]:
    """The number of texts, and of those that have each of the terms, over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        lexicon = Lexicon(shared.value)
        total, seen = 0, np.zeros(len(shared.value), np.int64)
        for _, texts in text_chunks(batches):
            total += len(texts)
            for t in texts:
                seen[lexicon.inside(t)] += 1
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, some), pa.int64()), pa.array(np.append(total, seen[some]), pa.int64())], ["term", "n"])

    two = docs.select(F.col(text_col).cast("string").alias("text"))
    got = two.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, n = got["term"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(len(terms), np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), df


def vector(at: np.ndarray, counts: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vector of a text's terms: their numbers and weights; by: what each term's count is multiplied with."""
    w = (1 + np.log(counts)) * by[at]
    at, w = at[w > 0], w[w > 0]
    return at, w / np.sqrt((w * w).sum()) if len(w) else w


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Index:
    """Inverted index over the examples: postings of the rarer terms, rows of weights and blocks' largest weights of the frequent ones."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        n = self.n = len(vectors)
        sizes = np.array([len(at) for at, _ in vectors], np.int64)
        term = np.concatenate([np.zeros(0, np.int64), *[at for at, _ in vectors]]).astype(np.int64)
        weight = np.concatenate([np.zeros(0), *[w for _, w in vectors]])
        who = np.repeat(np.arange(n), sizes)
        often = np.bincount(term, minlength=n_terms)
        frequent = np.argsort(-often, kind="stable")[:DENSE]
        self.row = np.full(n_terms, -1, np.int64)
        self.row[frequent] = np.arange(len(frequent))
        dense = self.row[term] >= 0
        rows = np.zeros((len(frequent), n))
        rows[self.row[term[dense]], who[dense]] = weight[dense]
        # examples in the order of their weights along the strongest direction: neighbours share their frequent terms
        lead = np.ones(len(frequent))
        for _ in range(20):
            lead = rows @ (lead @ rows)
            lead /= np.sqrt((lead * lead).sum()) or 1.0
        self.ids = np.argsort(-(lead @ rows), kind="stable")
        place = np.empty(n, np.int64)
        place[self.ids] = np.arange(n)
        self.place, self.rows = place, np.ascontiguousarray(rows[:, self.ids])
        self.blocks = np.arange(0, max(n, 1), BLOCK)
        self.highest = np.maximum.reduceat(self.rows, self.blocks, axis=1) if n else np.zeros((len(frequent), 1))
        order = np.argsort(term[~dense], kind="stable")
        self.who, self.weight = place[who[~dense]][order].astype(np.int32), weight[~dense][order]
        self.starts = np.searchsorted(term[~dense][order], np.arange(n_terms + 1))

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, skip: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the numbers and cosines of the k nearest examples with a cosine over 0 (all of them if fewer), nearest
        first; ``skip``: an example that each leaves out. Cosines that differ by rounding alone are equal: ties go to the smaller number."""
        if not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(texts)
        sims, frequent = np.zeros((len(texts), self.n)), np.zeros((len(texts), len(self.rows)))
        for i, (at, w) in enumerate(texts):
            row = self.row[at]
            rare = row < 0
            frequent[i, row[~rare]] = w[~rare]
            some = self.starts[at[rare] + 1] - self.starts[at[rare]]
            here = _ranges(self.starts[at[rare]], some)
            if len(here):
                sims[i] = np.bincount(self.who[here], self.weight[here] * np.repeat(w[rare], some), self.n)
            if skip is not None:
                sims[i, self.place[skip[i]]] = -np.inf
        # what is added now can only raise a cosine, and by the blocks' largest weights at most
        least = np.partition(sims, self.n - k, axis=1)[:, self.n - k] if self.n > k else np.full(len(texts), -np.inf)
        most = np.maximum.reduceat(sims, self.blocks, axis=1) + frequent @ self.highest
        for b, a in enumerate(self.blocks.tolist()):
            may = most[:, b] >= least - 1e-12
            sims[~may, a:a + BLOCK] = -np.inf
            sims[may, a:a + BLOCK] += frequent[may] @ self.rows[:, a:a + BLOCK]
        out = []
        for own in np.round(sims, 12):
            near = np.flatnonzero(own > 0)
            if len(near) > k:
                near = near[own[near] >= np.partition(own[near], len(near) - k)[len(near) - k]]
            near = near[np.lexsort((self.ids[near], -own[near]))[:k]]
            out.append((self.ids[near], own[near]))
        return out


def vote(ids, sims, toxic: np.ndarray, weight: np.ndarray) -> float:
    """Share of toxic among the neighbours, weighted by similarity, with one vote for clean."""
    w = sims ** 2 * weight[ids]
    return float((w * toxic[ids]).sum() / (w.sum() + float(weight.mean())))


def rising(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of y on x: levels that rise with x, as points to interpolate between."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weighted sum, weight, least x, largest x
    for xi, yi, wi in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        pools.append([yi * wi, wi, xi, xi])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    xs = [v for p in pools for v in (p[2], p[3])]
    return np.array(xs), np.array([p[0] / p[1] for p in pools for _ in range(2)])


def learn(docs: DataFrame, labels: DataFrame, **options) -> dict:
    """A model (plain data, bounded) from labelled documents; options as of examples()."""
    text_col = options.get("text_col", "text")
    found = examples(docs, labels, **options).toArrow().combine_chunks().sort_by("id")
    toxic, weight = found["toxic"].to_numpy().astype(np.float64), found["weight"].to_numpy()
    rate = float((toxic * weight).sum() / weight.sum()) if len(toxic) else 0.0
    model = {"terms": [], "by": np.zeros(0), "ids": found["id"].to_numpy(), "toxic": toxic, "weight": weight, "vectors": [],
             "rate": rate, "x": np.array([0.0, 1.0]), "y": np.array([0.0, 1.0])}
    if toxic.min(initial=1) == toxic.max(initial=0):
        return model
    sizes = pc.list_value_length(found["terms"]).to_numpy()
    row, counts = np.repeat(np.arange(len(toxic)), sizes), pc.list_flatten(found["counts"]).to_numpy()
    words = pc.list_flatten(found["terms"]).combine_chunks().dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    terms, term = words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64)
    if not terms:
        return model
    total, df = document_frequencies(docs, terms, text_col)
    by = (np.log((total + 1) / (df + 1)) + 1) * correlations(toxic, row, term, len(terms))
    stops = np.cumsum(sizes)
    vectors = []
    for a, b in zip(stops - sizes, stops, strict=True):
        order = np.argsort(term[a:b])
        vectors.append(vector(term[a:b][order], counts[a:b][order], by))
    index = Index(vectors, len(terms))
    raw = np.array([vote(*near, toxic, weight) for a in range(0, len(vectors), TOGETHER) for near in index.nearest(
        vectors[a:a + TOGETHER], NEIGHBOURS, list(range(a, min(a + TOGETHER, len(vectors)))))])
    x, y = rising(raw, toxic, weight)
    return model | {"terms": terms, "by": by, "vectors": vectors, "x": x, "y": y}


def scorer(model: dict):
    """A function from texts to their scores and evidence [(id, similarity, toxic)]."""
    toxic, weight, by = model["toxic"], model["weight"], model["by"]
    if not model["terms"]:
        return lambda texts: [(model["rate"], [])] * len(texts)
    index, lexicon = Index(model["vectors"], len(by)), Lexicon(model["terms"])

    def some(texts: list[str]) -> list[tuple[float, list]]:
        out = []
        for ids, sims in index.nearest([vector(*lexicon.of(t), by) for t in texts], NEIGHBOURS):
            raw = vote(ids, sims, toxic, weight)
            fit = float(np.interp(raw, model["x"], model["y"]))
            top = [(int(model["ids"][i]), float(s), int(toxic[i])) for i, s in zip(ids[:3], sims[:3], strict=True)]
            out.append((0.9 * fit + 0.1 * raw, top))  # a little of the raw vote keeps order within a level
        return out
    return lambda texts: [one for a in range(0, len(texts), TOGETHER) for one in some(texts[a:a + TOGETHER])]


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, evidence) of every text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    evidence = pa.list_(pa.struct([("id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches):
        kept = shared.value  # a worker keeps its index beside the broadcast value between tasks
        if "scorer" not in kept:
            kept["scorer"] = scorer(kept)
        for part, texts in text_chunks(batches):
            got = kept["scorer"](texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([s for s, _ in got], pa.float64()),
                 pa.array([[{"id": i, "similarity": c, "toxic": t} for i, c, t in e] for _, e in got], evidence)],
                ["doc_id", "score", "evidence"])

    return id_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, score double, evidence array<struct<id:long,similarity:double,toxic:int>>")
