"""Periodic runs of words: suffix-tree LCE and Lyndon roots.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends keeping q; those of at least ``least`` words and
``times`` periods are reported. Words are what the six ASCII blanks separate.

Every run starts one of its periods with a Lyndon root: the longest Lyndon word
from some position, in the order of the words or in the reversed one. So the
candidates are two for each position, the next smaller suffix in either order.
Each is extended to both sides by longest common extensions: Ukkonen's suffix
trees of the words and of their reversal, whose depth-first (Euler) tours give
the suffixes' ranks and, by a sparse table over the least depth between
neighbouring leaves, the depth of a lowest common ancestor in constant time.

Trees are built of the stretches that can hold a run alone: in a run of
``least`` words and ``times`` periods every sequence of gram() words occurs
once more, a period away, so a stretch of repeated sequences holds it whole
(equal hashes of other sequences only make a stretch longer).

Null and empty texts have no words and no runs. A null id leaves a text as it
is, where ids decide. Repeated rows give repeated results; an empty table gives
an empty one. Texts of any length are taken whole; work grows with the length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import id_text, text_chunks

LEAST, TIMES = 24, 3
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of numbers from 1 on, closed by a 0."""

    def __init__(self, seq: list[int], width: int):
        s = [*seq, 0]
        n = self.n = len(s)
        self.width = width
        start, stop, link, edges = [0], [0], [0], {}  # node 0 is the root; edges by node * width + first number
        node = edge = length = pending = 0
        for i in range(n):
            c, last = s[i], 0
            pending += 1
            while pending:
                if not length:
                    edge = i
                key = node * width + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                    last = node
                else:
                    size = (stop[child] if stop[child] <= i else i + 1) - start[child]
                    if length >= size:
                        node, edge, length = child, edge + size, length - size
                        continue
                    if s[start[child] + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split, leaf = len(start), len(start) + 1
                    start += (start[child], i)
                    stop += (start[child] + length, n)
                    link += (0, 0)
                    edges[key] = split
                    edges[split * width + c] = leaf
                    start[child] += length
                    edges[split * width + s[start[child]]] = child
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.size = np.array(stop, np.int64) - np.array(start, np.int64)
        self.keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.children = np.fromiter(edges.values(), np.int64, len(edges))

    def tour(self, downwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each suffix, and the depth of the lowest common ancestor of each leaf and the one before it.
        The closing 0 comes first in both orders."""
        parent, first = self.keys // self.width, self.keys % self.width
        order = np.argsort(parent * self.width + ((self.width - first) % self.width if downwards else first))
        kids = self.children[order].tolist()
        upto = np.searchsorted(parent[order], np.arange(len(self.size) + 1)).tolist()
        size, n = self.size.tolist(), self.n
        rank, lows = [0] * n, []
        # entries: node, depth of its parent, whether an elder sibling was visited
        stack, low = [(0, 0, False)], 0
        while stack:
            v, above, later = stack.pop()
            if later:
                low = above
            a, b = upto[v], upto[v + 1]
            if a == b:
                rank[n - above - size[v]] = len(lows)
                lows.append(low)
                continue
            depth = above + size[v]
            for k in range(b - 1, a - 1, -1):
                stack.append((kids[k], depth, k > a))
        return np.array(rank, np.int64), np.array(lows, np.int64)


class Extensions:
    """Longest common prefixes of suffixes: the least depth between two leaves, by a sparse table."""

    def __init__(self, rank: np.ndarray, lows: np.ndarray):
        self.rank, self.table, step = rank, [lows], 1
        while 2 * step <= len(lows):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of different suffixes the length of what they begin with alike."""
        x, y = self.rank[a], self.rank[b]
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.table[k][lo[own]], self.table[k][hi[own] - (1 << int(k)) + 1])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix but the last the next one of a smaller rank."""
    r, out, stack = rank.tolist(), [0] * (len(rank) - 1), []
    for i in range(len(r) - 1, -1, -1):
        while stack and r[stack[-1]] > r[i]:
            stack.pop()
        if i < len(out):
            out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def maximal_runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of the runs of a sequence, by start, then period."""
    n = len(ids)
    names, seq = np.unique(ids, return_inverse=True)
    seq, width = (seq + 1).tolist(), len(names) + 1
    tree = SuffixTree(seq, width)
    rank, lows = tree.tour()
    ahead = Extensions(rank, lows)
    starts = np.arange(n)
    roots = [next_smaller(rank) - starts, next_smaller(tree.tour(downwards=True)[0]) - starts]
    del tree
    behind = Extensions(*SuffixTree(seq[::-1], width).tour())
    found = []
    for p in roots:
        right = ahead.of(starts, starts + p)
        left = np.zeros(n, np.int64)
        left[1:] = behind.of(n - starts[1:], n - starts[1:] - p[1:])
        length = left + p + right
        own = (length >= times * p) & (length >= least)
        found.append(np.stack([(starts - left)[own], length[own], p[own]], 1))
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def gram(least: int, times: int) -> int:
    """Words of a sequence that a run of so many words and periods has again, a period away, wherever it starts."""
    return max(1, least * (times - 2) // times)


def stretches(ids: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Ranges of at least ``least`` words in which every sequence of gram() words occurs twice in the text: all runs are inside."""
    g = gram(least, times)
    if len(ids) < max(least, g):
        return []
    h = np.zeros(len(ids) - g + 1, np.uint64)
    own = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    own ^= own >> np.uint64(29)
    for k in range(g):
        h = h * np.uint64(0xBF58476D1CE4E5B9) + own[k:k + len(h)]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(len(h) + 2, np.int8)
    again[1 + order[1:][same]] = 1
    again[1 + order[:-1][same]] = 1
    turns = np.diff(again)
    return [(a, b) for a, b in zip(np.flatnonzero(turns == 1).tolist(), (np.flatnonzero(turns == -1) + g - 1).tolist(), strict=True) if b - a >= least]


def numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def runs_of(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    if len(words) < max(least, 1):
        return []
    ids = numbered(words)
    return [(a + s, n, q) for a, b in stretches(ids, least, times) for s, n, q in maximal_runs(ids[a:b], least, times).tolist()]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(inside[:-1]) == 0).tolist()]


def with_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One text in ten gets a periodic tail, by h, the crc32 of its id: from word a on, the p words there over and over."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES, planted: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed): the runs by start, then period, and the text without what runs repeat, its words joined by
    one space. ``planted`` gives texts periodic tails first (with_period)."""

    def run(batches):
        for part, texts in text_chunks(batches):
            found, kept = [], []
            for i, t in zip(part.column(0).to_pylist(), texts, strict=True):
                words = t.encode().split()  # splits bytes at the six ASCII blanks
                if planted:
                    words = with_period(words, i)
                own = runs_of(words, least, times)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                kept.append(b" ".join(collapsed(words, own)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
                                             ["doc_id", "runs", "collapsed"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def _more(a: Column, b: Column) -> Column:
    """Whether b has the greater length / period, exactly; ties: the smaller start, then period."""
    x, y = a["length"] * b["period"], b["length"] * a["period"]
    return (y > x) | ((y == x) & (F.struct(b["start"], b["period"]) < F.struct(a["start"], a["period"])))


def report(found: DataFrame) -> DataFrame:
    """Digests of detect(): the number of runs, the one with the greatest exponent, and hashes."""
    runs = F.col("runs")
    best = F.reduce(runs, F.get(runs, F.lit(0)), lambda a, b: F.when(_more(a, b), b).otherwise(a))
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").alias("lines")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.expr("(1000 * best.length) div best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
