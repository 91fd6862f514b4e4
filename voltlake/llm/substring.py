"""Removal of word passages that occur more than once, found level by level.

A window is ``window`` consecutive words of one document. Lengths double from
level to level, and only what is repeated at one is looked at in the next:

1. base: every window's least base-word sequence (a quarter of a window, least
   by hash) stands for it; equal windows have equal ones at equal places. Those
   whose hash is at one place only go, and with them all windows they stand for.
2. twice the base: a survivor is extended to the right and to the left, and the
   extension that lies inside the window has to be repeated too.
3. the window: the survivors' windows are hashed whole; those that start at two
   places or more are the repeated ones.

Levels 1 and 2 only discard, so their hashes can't lose a window; whole windows
are compared by 128 bits. A place is a text, named by 128 bits, and a position;
equal texts share their places, and texts that more than one row has are
repeated whole. Hot passages meet as counts first (partial
aggregation), and rows of hot keys are joined to a table of one row a key,
which Spark splits. Only rows whose text holds a candidate are shuffled with
their text; a bitmap of fixed size (BITMAP_BITS) tells which may, and errs on
the side of shuffling.

Null and empty texts have no words; texts shorter than a window keep all
theirs. Repeated rows are copies of each other and lose every window. An empty
table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.llm.common import bound_batches, rows_again, saved, text_chunks, whole_rows

WINDOW = 35
#: Size of the bitmaps that thin out what is shuffled: 524,288 words at most, whatever the input. With more keys
#: than bits they thin out less, and the results stay the same.
BITMAP_BITS = 1 << 25
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Runs of anything but the six ASCII blanks."""
    return text.encode().split()


class Hashes:
    """Hashes of all word sequences of one text, by prefix sums: 64 bits, or 128 as two independent halves (``wide``)."""

    def __init__(self, words: list[bytes], wide: bool = False):
        n = len(words)
        own = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(n, 2).astype(np.uint64)
        powers = np.full(n + 1, _BACK, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        self.sums = np.zeros((1 + wide, n + 1), np.uint64)
        for half in range(1 + wide):
            np.cumsum(own[:, half] * powers[:n], out=self.sums[half, 1:])
        self.n = n
        steps = np.full(n + 1, _STEP, np.uint64)
        steps[0] = 1
        self.steps = np.multiply.accumulate(steps)

    def at(self, length: int, starts: np.ndarray | None = None, half: int = 0) -> np.ndarray:
        """Hashes of the sequences of that length, of all starts or the given ones."""
        if starts is None:
            starts = np.arange(max(0, self.n - length + 1))
        return _mixed((self.sums[half, starts + length] - self.sums[half, starts]) * self.steps[starts] + np.uint64(length))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Least or largest of every ``width`` neighbours."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = best(out[:len(out) - step], out[step:])
        done += step
    return out


def base_length(window: int) -> int:
    return max(1, -(-window // 4))


def anchors(h: Hashes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the base sequences that stand for windows, the hashes at all places, and each window's least."""
    base = base_length(window)
    g = h.at(base)
    width = window - base + 1
    least = _sliding(g, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    reach = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    return np.flatnonzero(reach[:len(g)] == g), g, least


def key_of(text: Column) -> Column:
    """The name of a text: 16 bytes."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _columns(found: list[tuple[bytes, tuple[np.ndarray, ...]]], names: list[str]) -> pa.RecordBatch:
    """Column k, each text's name for all its entries, and the entries' columns."""
    sizes = np.array([len(parts[0]) for _, parts in found])
    keys = pa.array([k for k, _ in found], pa.binary()).take(pa.array(np.repeat(np.arange(len(found)), sizes)))
    return pa.RecordBatch.from_arrays([keys, *[pa.array(np.concatenate(c)) for c in zip(*[parts for _, parts in found], strict=True)]], ["k", *names])


def _emit_bases(window: int):
    base = base_length(window)

    def run(batches):
        seen: set[bytes] = set()
        for part, texts in text_chunks(batches):
            keys, out = part.column(0).to_pylist(), []
            for k, t in zip(keys, texts, strict=True):
                if k in seen:
                    continue
                seen.add(k)
                words = words_of(t)
                if len(words) < window:
                    continue
                h = Hashes(words)
                p, g, _ = anchors(h, window)
                ends = len(g) - 1
                right = np.where(p + base <= ends, g[np.minimum(p + base, ends)], 0)
                left = np.where(p >= base, g[np.maximum(p - base, 0)], 0)
                out.append((k, (p.astype(np.int32), g[p].view(np.int64),
                                right.astype(np.uint32).view(np.int32), left.astype(np.uint32).view(np.int32))))
            if out:
                yield _columns(out, ["pos", "h", "rh", "lh"])
    return run


def _leftmost(g: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """For each window the offset of its first least base sequence."""
    offset = np.full(len(least), -1, np.int64)
    for o in range(width):
        hit = (offset < 0) & (g[o:o + len(least)] == least)
        offset[hit] = o
    return offset


def _emit_windows(window: int):
    base = base_length(window)

    def run(batches):
        for part, texts in text_chunks(batches):
            rights, lefts = part.column(2).to_pylist(), part.column(3).to_pylist()
            out = []
            for k, t, r, lf in zip(part.column(0).to_pylist(), texts, rights, lefts, strict=True):
                words = words_of(t)
                h = Hashes(words, wide=True)
                _, g, least = anchors(h, window)
                o = _leftmost(g, least, window - base + 1)
                p = np.arange(len(least)) + o
                on_right, on_left = np.zeros(len(g), bool), np.zeros(len(g), bool)
                for flags, places in ((on_right, r), (on_left, lf)):
                    places = np.array(places, np.int64)
                    flags[places[places < len(g)]] = True
                s = np.flatnonzero(np.where(o + 2 * base <= window, on_right[p], on_left[p]))
                if len(s):
                    out.append((k, (s.astype(np.int32), h.at(window, s).view(np.int64), h.at(window, s, 1).view(np.int64))))
            if out:
                yield _columns(out, ["pos", "h", "h2"])
    return run


def _bit(col: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("bit"), col), F.lit(BITMAP_BITS))


def _marked(df: DataFrame, col: str, keys: DataFrame, key: str) -> DataFrame:
    """df with column _may: whether a bitmap of the keys has the bit of col's value, so always if the value is among
    them. The bitmap is broadcast as a table of words; it has BITMAP_BITS / 64 rows at most."""
    words = keys.select(_bit(key).alias("b")).groupBy(F.shiftright("b", 6).alias("_word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("_bits"))
    own = df.withColumns({"_word": F.shiftright(_bit(col), 6), "_at": _bit(col).bitwiseAND(F.lit(63)).cast("int")})
    may = F.coalesce(F.expr("shiftrightunsigned(_bits, _at)").bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return own.join(F.broadcast(words), "_word", "left").withColumn("_may", may).drop("_word", "_bits", "_at")


def _twice(rows: DataFrame, what: str) -> DataFrame:
    """The values of h that are at two places (k, pos) at least."""
    place = F.xxhash64("k", "pos")
    return saved(rows.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("h"), what)


def repeats(df: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(k, starts, whole): for the keys of texts with repeated windows, where these start; or that all are repeated."""
    if window < 4:
        raise ValueError("a window has 4 words at least")
    spark = df.sparkSession
    bound_batches(spark)
    texts = df.select(key_of(F.col(text_col)).alias("k"), F.col(text_col).cast("string").alias("text"))
    copies = saved(texts.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"), "copies")

    # 1: base sequences
    bases = saved(texts.mapInArrow(_emit_bases(window), "k binary, pos int, h long, rh int, lh int"), "bases")
    twice = _twice(bases, "twice")
    stay = _marked(bases, "h", twice, "h").where("_may").drop("_may").join(twice, "h", "left_semi")

    # 2: twice as long, to either side
    sides = saved(stay.select(
        "k", "pos", F.explode(F.array(
            F.struct(F.lit(True).alias("right"), F.xxhash64("h", "rh", F.lit(1)).alias("h")),
            F.struct(F.lit(False).alias("right"), F.xxhash64("h", "lh", F.lit(2)).alias("h")))).alias("s"))
        .select("k", "pos", "s.right", "s.h").distinct(), "sides")
    stay = sides.join(_twice(sides, "twice"), "h", "left_semi")
    places = saved(stay.groupBy("k").agg(
        F.collect_set(F.when(F.col("right"), F.col("pos"))).alias("rights"),
        F.collect_set(F.when(~F.col("right"), F.col("pos"))).alias("lefts")), "places")

    # 3: whole windows
    some = _marked(texts, "k", places, "k").where("_may").groupBy("k").agg(F.first("text").alias("text"))
    windows = saved(some.join(places, "k").select("k", "text", "rights", "lefts")
                    .mapInArrow(_emit_windows(window), "k binary, pos int, h long, h2 long"), "windows")
    again = saved(windows.groupBy("h", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h", "h2"), "again")
    found = windows.join(again, ["h", "h2"], "left_semi").groupBy("k").agg(F.collect_list("pos").alias("starts"))
    return saved(found.join(copies.withColumn("whole", F.lit(True)), "k", "full")
                 .select("k", F.coalesce("starts", F.array().cast("array<int>")).alias("starts"),
                         F.coalesce("whole", F.lit(False)).alias("whole")), "repeats")


def covered(n: int, starts, whole: bool, window: int) -> np.ndarray:
    """Which of n words lie in a repeated window."""
    if whole:
        return np.full(n, n >= window)
    edge = np.zeros(n + 1, np.int64)
    s = np.asarray(starts, np.int64)
    s = s[s + window <= n]
    np.add.at(edge, s, 1)
    np.add.at(edge, s + window, -1)
    return np.cumsum(edge[:n]) > 0


def _split(df: DataFrame, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """df's rows whose text may have repeats, with columns _starts and _whole, and the others."""
    found = repeats(df, text_col, window)
    marked = _marked(df.withColumn("_k", key_of(F.col(text_col))), "_k", found, "k")
    hit = marked.where("_may").drop("_may").join(
        found.select(F.col("k").alias("_k"), F.col("starts").alias("_starts"), F.col("whole").alias("_whole")), "_k", "left")
    return hit.drop("_k"), marked.where("not _may").drop("_may", "_k")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    two = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hit, rest = _split(two, "text", window)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"

    def run(batches):
        for part, texts in text_chunks(batches):
            cuts = part.num_columns > 2
            starts = part.column(2).to_pylist() if cuts else [None] * len(texts)
            wholes = part.column(3).to_pylist() if cuts else [None] * len(texts)
            counts, gone, sha = [], [], []
            for t, s, w in zip(texts, starts, wholes, strict=True):
                words = words_of(t)
                drop = covered(len(words), s or [], bool(w), window)
                kept = [x for x, d in zip(words, drop.tolist(), strict=True) if not d] if drop.any() else words
                counts.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return hit.select("doc_id", "text", "_starts", "_whole").mapInArrow(run, schema) \
        .union(rest.select("doc_id", "text").mapInArrow(run, schema))


def remove_repeats(df: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """df with repeated passages taken out of the text; a text that loses none stays as it is, one that does
    has its kept words joined by single blanks."""
    rows = df.select(whole_rows(df, but=text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    hit, rest = _split(rows, "text", window)

    own = hit.select("row", "text", "_starts", "_whole")

    def kept(batches):
        for part, texts in text_chunks(batches):
            out = []
            for t, null, s, w in zip(texts, part.column(1).is_null().to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                words = words_of(t)
                drop = covered(len(words), s or [], bool(w), window)
                out.append(b" ".join([x for x, d in zip(words, drop.tolist(), strict=True) if not d]).decode() if drop.any() else None if null else t)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], ["row", "text"])

    cut = own.mapInArrow(kept, T.StructType([own.schema["row"], T.StructField("text", T.StringType())]))
    return rows_again(cut, "row", df.columns, {text_col: F.col("text")}).union(rows_again(rest, "row", df.columns, {text_col: F.col("text")}))
