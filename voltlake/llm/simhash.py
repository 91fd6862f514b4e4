"""Near copies by SimHash, joined through pivot distance tables.

A document's fingerprint has a bit set if over half the XXH64 hashes of its
word shingles (repeats included) have it. Two fingerprints link at ``bits`` or
fewer differing bits. The join works on distinct fingerprints:

1. Fingerprints meet if they agree in two of four 16-bit quarters: with two
   differing bits, two quarters at least stay equal, so no link is lost. Keys
   that one fingerprint alone has are dropped.
2. Where they meet, Hamming distances to PIVOTS reference fingerprints are
   tabulated. A pair whose distances to some reference differ by more than
   ``bits`` can't link (triangle inequality) and is discarded; survivors are
   verified by their differing bits.
3. Each meeting returns a spanning forest of its links, not the pairs, and
   components.py joins the forests.

A key with more than TILE fingerprints is split into pairs of chunks, each a
group of its own; no group holds more than about two chunks.

Null and empty texts have fingerprint zero and link like any other; texts with
fewer words than a shingle have one shingle, the whole sequence. Equal texts
have equal fingerprints; repeated rows repeat in the result, rows with a null
id get a null one. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import id_text, rows_again, saved, text_chunks, whole_rows
from voltlake.llm.components import components

SEED = 42
#: Reference fingerprints: the XXH64 hashes of the numbers from 0.
PIVOTS = 32
#: Distinct fingerprints of one key compared in one group, at most about twice that.
TILE = 4096
#: Hashes whose bits are counted at once.
_BLOCK = 1 << 18
_PAIRS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))


def fingerprint(text: str, words: int) -> int:
    """The fingerprint of one text, as an unsigned number."""
    parts = text.encode().lower().split()  # bytes: A-Z only, and exactly the six ASCII blanks
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    stops = np.cumsum(lens + 1) - 1
    starts = stops - lens
    shingles = [joined[a:b] for a, b in zip(starts[:len(parts) - words + 1].tolist(), stops[words - 1:].tolist(), strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, its 64 bits as a signed number."""

    def run(batches):
        for part, texts in text_chunks(batches):
            fps = np.array([fingerprint(t, words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _pivots() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(PIVOTS)], np.uint64)


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances to the pivots, a row for each fingerprint."""
    return np.stack([np.bitwise_count(fps ^ p) for p in pivots], 1).astype(np.int8)


def linked(fps: np.ndarray, dist: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
    """Which of the candidate pairs (i, j) link."""
    alive = np.arange(len(i))
    for p in range(0, dist.shape[1], 8):  # a few coordinates at a time: most pairs go at the first
        near = (np.abs(dist[i[alive], p:p + 8] - dist[j[alive], p:p + 8]) <= bits).all(1)
        alive = alive[near]
        if not len(alive):
            break
    good = np.zeros(len(i), bool)
    good[alive] = np.bitwise_count(fps[i[alive]] ^ fps[j[alive]]) <= bits
    return good


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the pairs join it to."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        differ = a != b
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def _links(fps: np.ndarray, ends: np.ndarray, pivots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside groups that end at ``ends``; in a group, fingerprints ascend."""
    n = len(fps)
    dist = pivot_table(fps, pivots)
    sizes = np.diff(ends, prepend=0)
    stop = np.repeat(ends, sizes)
    found_i, found_j = [], []
    row = np.arange(n)
    small = np.repeat(sizes <= 64, sizes)
    for d in range(1, int(sizes[sizes <= 64].max(initial=0))):  # the d-th neighbour of every row, over all small groups
        i = row[small & (row + d < stop)]
        if not len(i):
            break
        good = linked(fps, dist, i, i + d, bits)
        found_i.append(i[good])
        found_j.append(i[good] + d)
    for k in np.flatnonzero(sizes > 64):
        start, end = int(ends[k] - sizes[k]), int(ends[k])
        order = start + np.argsort(dist[start:end, 0], kind="stable")  # along the first coordinate, only near ones meet
        first = dist[order, 0].astype(np.int64)
        reach = np.searchsorted(first, first + bits, "right")
        for a in range(0, len(order), 256):
            b = min(a + 256, len(order))
            span = np.arange(a, int(reach[b - 1]))
            i, j = np.broadcast_arrays(np.arange(a, b)[:, None], span[None, :])
            keep = (j > i) & (j < reach[a:b, None])
            i, j = order[i[keep]], order[j[keep]]
            good = linked(fps, dist, i, j, bits)
            i, j = i[good], j[good]
            root = _forest(end - start, i - start, j - start)  # keep a forest of the block's links
            child = np.flatnonzero(root != np.arange(end - start))
            found_i.append(start + child)
            found_j.append(start + root[child])
    i = np.concatenate(found_i) if found_i else np.zeros(0, np.int64)
    j = np.concatenate(found_j) if found_j else np.zeros(0, np.int64)
    root = _forest(n, i, j)
    child = np.flatnonzero(root != row)
    return fps[child].view(np.int64), fps[root[child]].view(np.int64)


def _grouped(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints of whole groups, some ``least`` rows at a time, from rows sorted by group; with the groups' ends."""
    keys, fps = [], []
    held = 0

    def cut(keys, fps, whole):
        k, f = np.concatenate(keys), np.concatenate(fps)
        new = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        if whole:
            return f, np.append(new, len(f)), k[:0], f[:0]
        if not len(new):
            return None, None, k, f
        at = int(new[-1])
        return f[:at], new, k[at:], f[at:]

    for b in batches:
        if not b.num_rows:
            continue
        keys.append(np.stack([b.column(c).to_numpy() for c in range(b.num_columns - 1)], 1))
        fps.append(b.column(b.num_columns - 1).to_numpy().view(np.uint64))
        held += b.num_rows
        if held >= least:
            f, ends, k, rest = cut(keys, fps, False)
            keys, fps, held = [k], [rest], len(rest) if f is not None else 0
            if f is not None:
                yield f, ends
    if keys and sum(map(len, fps)):
        f, ends, _, _ = cut(keys, fps, True)
        yield f, ends


def near_links(fps: DataFrame, bits: int = 2, tile: int = TILE) -> DataFrame:
    """(a, b): a forest that spans every linked group of the distinct numbers of column fp. Its ends are reachable
    from each other through links; they needn't link themselves."""
    if not 0 <= bits <= 2:
        raise ValueError("two equal quarters are certain for up to 2 differing bits")
    quarter = [F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF)) for q in range(4)]
    keys = F.array(*[
        F.shiftleft(F.lit(n).cast("long"), 32).bitwiseOR(F.shiftleft(quarter[a], 16)).bitwiseOR(quarter[b])
        for n, (a, b) in enumerate(_PAIRS)])
    met = fps.select("fp").distinct().select("fp", F.explode(keys).alias("key"))
    crowd = met.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / tile).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = met.join(crowd, "key").withColumn("chunks", F.when(F.col("n") > tile, chunks).otherwise(1)) \
        .withColumn("own", chunk) \
        .select("key", "own", "fp", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")) \
        .select("key", F.least("own", "other").cast("long").alias("x"), F.greatest("own", "other").cast("long").alias("y"), "fp")
    pivots = _pivots()

    def run(batches):
        for f, ends in _grouped(batches, 1 << 16):
            a, b = _links(f, ends, pivots, bits)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "fp").mapInArrow(run, "a long, b long")


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the least id reachable through links, itself included."""
    own = saved(fingerprints(df, id_col, text_col, words), "fingerprints")
    tops = components(near_links(own, bits))
    heads = own.groupBy("fp").agg(F.min("doc_id").alias("least")) \
        .join(tops.select(F.col("node").alias("fp"), "component"), "fp", "left") \
        .select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = heads.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = heads.join(least, "component").select("fp", "component_id")
    return own.join(by_fp, "fp").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, bits: int = 2) -> DataFrame:
    """The rows of df with one row of each group of near copies: that with the least id, whole rows compared among equal
    ids. Rows that share an id but not a group are kept apart. All columns as they are; rows with a null id stay."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), whole_rows(df).alias("row")) \
        .withColumn("key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))  # an id's text; equal ones are copies
    own = saved(fingerprints(rows.select("key", "text"), "key", "text", words).distinct(), "fingerprints")
    tops = components(near_links(own, bits)).select(F.col("node").alias("fp"), "component")
    group = own.join(tops, "fp", "left").select(F.col("doc_id").alias("key"), F.coalesce("component", "fp").alias("component"))
    firsts = rows.where("doc_id is not null").select("doc_id", "key").distinct().join(group, "key") \
        .groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("least")).select("least.key")
    kept = rows.where("doc_id is not null").join(firsts, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row")).select("row")
    return rows_again(kept.union(rows.where("doc_id is null").select("row")), "row", df.columns)
