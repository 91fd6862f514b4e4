"""Packing documents into sequences of a fixed number of tokens.

A document is its ids and an end id. Documents longer than a sequence are cut
into full pieces after a first, shorter one; every other document is one
piece. Full pieces are sequences by themselves. The others are dealt evenly
into blocks, and each block is packed best-fit decreasing, or filled up
sequence by sequence with single documents and pairs where that takes fewer,
and improved by local search: underfull sequences, the emptiest first, give
and take documents by moves and by one-for-one and two-for-one exchanges, each
of which raises the sum of squared fills, until sequences are empty. The search
stops at a proven least number of sequences or when no move or exchange
between any two sequences raises the sum, and not before. What a sequence
could give or take is looked up by its size, over all sequences at once.

The number isn't always the least: a block of 8,192 lengths of 600 to 760, or
of a quarter of a sequence, ends at the proven bound, lengths of 1 to 2,048 two
over it in 4,164, those of 300 to 1,100 or 400 to 900 one to two percent over
it. Such blocks take about two seconds.

Only the lengths go through the shuffle, not the ids. Blocks are numbered by a
running count, so one source, one id or repeated rows never make a block
larger than the others. Null and empty texts are one end id. Repeated rows
are packed each; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import id_text, n_rows, read_file, text_chunks, tokenizer_file

VOCABULARY = "byte_bpe_50k.json"
LENGTH = 2048
END_ID = 0
#: Documents of a block, about.
BLOCK = 8192


def load_tokenizer(path: str | None = None) -> dict:
    """The vocabulary file, and its entries as byte ranks if they are in the order of their merges (plain data)."""
    raw = read_file(path or tokenizer_file(VOCABULARY)).decode()
    whole = json.loads(raw)
    import public_tokenizers
    return {"json": raw, "ranks": _ranks(whole["model"]), "pattern": public_tokenizers.PATTERN,
            "added": {a["content"]: a["special"] for a in whole.get("added_tokens") or []}}


def _ranks(model: dict) -> dict[bytes, int] | None:
    """Entries as bytes with their ids, or None if ids and merges differ in order.

    Byte-level vocabularies write byte b as the character b where that is
    printable, and as 256 and up, in order, where not.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
    vocab = model["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged) or len(set(merged)) != len(merged):
        return None
    made = set(merged)
    try:
        ranks = {bytes(byte[c] for c in k): v for k, v in vocab.items() if v in made or len(k) == 1}
    except KeyError:
        return None
    return ranks if len(ranks) == len(merged) + 256 else None


class Tokens:
    """Texts to ids. Ranks in merge order let the faster library stand in, with the same ids; texts with
    characters that the two might split differently, or with an added token's content, go to the one that wrote the
    file. With special, the content of a special token in a text is that token, as by the library's plain call."""

    def __init__(self, v: dict, special: bool = False):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.json, self.own = v["json"], None
        self.fast = None
        if v["ranks"]:
            import tiktoken
            self.fast = tiktoken.Encoding("own", pat_str=v["pattern"], mergeable_ranks=v["ranks"], special_tokens={})
        self.special = special
        added = [re.escape(c) for c, s in v["added"].items() if special or not s]
        self.added = re.compile("|".join(added)).search if added else None
        self.odd = re.compile("[^\t\n\r -~¡-ɏ‐-‧‰-⁞]").search

    @property
    def slow(self):
        """The library that wrote the file; made when a text first needs it."""
        if self.own is None:
            from tokenizers import Tokenizer
            self.own = Tokenizer.from_str(self.json)
            self.own.encode_special_tokens = not self.special
        return self.own

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or self.odd(text) or self.added and self.added(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


def _tokens(shared) -> Tokens:
    v = shared.value
    if "tokens" not in v:
        v["tokens"] = Tokens(v, special=True)
    return v["tokens"]


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers, best-fit decreasing: each item goes to the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room they have
    some = 0  # bit r: a bin with room r is there
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = some >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some &= ~(1 << r)
        else:
            r, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = r - size
        if left:
            room[left].append(b)
            some |= 1 << left
    return bins


def fill_up(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: each starts with the largest item left, and then takes the item, or the pair of items, that
    leaves least room, as long as one fits."""
    left: list[list[int]] = [[] for _ in range(capacity + 1)]  # items by size
    for i in np.argsort(sizes, kind="stable")[::-1].tolist():
        left[int(sizes[i])].append(i)
    count = np.bincount(sizes, minlength=capacity + 1)
    number = np.arange(capacity + 1)
    below = np.maximum.accumulate(np.where(count > 0, number, 0))  # the largest size that is left, up to each
    bins: list[list[int]] = []

    def take(size: int) -> int:
        count[size] -= 1
        if not count[size]:
            end = size + int(np.argmax(np.append(count[size + 1:] > 0, True))) + 1
            below[size:end] = below[size - 1]
        return left[size].pop()

    while below[capacity]:
        size = int(below[capacity])
        room, items = capacity - size, [take(size)]
        while room and below[room]:
            one = int(below[room])
            sizes_left = np.flatnonzero(count[1:room] > 0) + 1
            with_it = below[room - sizes_left]
            twice = (with_it == sizes_left) & (count[sizes_left] < 2)
            with_it[twice] = below[sizes_left[twice] - 1]
            total = np.where(with_it > 0, sizes_left + with_it, 0)
            n = int(np.argmax(total)) if len(total) else 0
            if len(total) and total[n] > one:
                pair = int(sizes_left[n]), int(with_it[n])
                items += [take(pair[0]), take(pair[1])]
                room -= sum(pair)
            else:
                items.append(take(one))
                room -= one
        bins.append(items)
    return bins


def least_bins(sizes: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: by the total, by how many of the items over a share of the capacity a bin can hold,
    and by the room beside items over half of it."""
    if not len(sizes):
        return 0
    least = -(-int(sizes.sum()) // capacity)
    ordered = np.sort(sizes)
    for k in range(1, capacity // int(ordered[0]) + 1):
        least = max(least, -(-int((ordered > capacity // (k + 1)).sum()) // k))
    total = np.append(np.cumsum(ordered[::-1])[::-1], 0)
    over = lambda x: len(ordered) - int(np.searchsorted(ordered, x, "right"))
    half = over(capacity // 2)
    for k in np.unique(ordered[ordered <= capacity // 2]).tolist():
        alone = over(capacity - k)  # nothing of k or more fits beside these
        wide = half - alone
        beside = int(total[np.searchsorted(ordered, k, "left")] - total[len(ordered) - half])
        room = wide * capacity - int(total[len(ordered) - half] - total[len(ordered) - alone])
        least = max(least, half + max(0, -(-(beside - room) // capacity)))
    return least


class _Search:
    """Exchanges between underfull bins, looked up by the wanted size.

    A bin of a capacity C holds under sqrt(2C) different sizes, so its pairs have few different totals; those of all
    bins are kept in one array, where a bin that changes gives up its part and adds a new one. What a bin can give or
    take back is a table over sizes, so one pass over the items (or pairs) of all bins finds its best exchange.
    """

    def __init__(self, bins: list[list[int]], sizes: np.ndarray, capacity: int):
        self.bins, self.sizes, self.capacity = [list(b) for b in bins], sizes.astype(np.int64), capacity
        self.fill = np.array([*(int(sizes[b].sum()) for b in bins), capacity], np.int64)  # the last one: a full bin
        self.owner = np.empty(len(sizes), np.int64)
        for n, b in enumerate(bins):
            self.owner[b] = n
        self.alive = len(bins)
        self.repair_pairs()

    def pairs_of(self, b: int) -> np.ndarray:
        """Totals of the pairs of items of a bin, ascending."""
        if len(self.bins[b]) <= 12:
            return np.array(sorted({c + d for c, d in itertools.combinations(self.sizes[self.bins[b]].tolist(), 2)}), np.int64)
        values, counts = np.unique(self.sizes[self.bins[b]], return_counts=True)
        i, j = np.triu_indices(len(values))
        keep = (i != j) | (counts[i] > 1)
        return np.unique(values[i[keep]] + values[j[keep]])

    def repair_pairs(self) -> None:
        """The array of pairs, without what was given up."""
        parts = [self.pairs_of(b) for b in range(len(self.bins))]
        lengths = np.array([len(p) for p in parts], np.int64)
        self.used = int(lengths.sum())
        ends = np.cumsum(lengths)
        self.part = list(zip((ends - lengths).tolist(), ends.tolist(), strict=True))
        self.pair_size = np.zeros(2 * self.used + 8192, np.int64)
        self.pair_owner = np.full(2 * self.used + 8192, len(self.bins), np.int64)
        if self.used:
            self.pair_size[:self.used] = np.concatenate(parts)
            self.pair_owner[:self.used] = np.repeat(np.arange(len(parts)), lengths)

    def _giving(self, x: int, gives: np.ndarray, back: np.ndarray, owner: np.ndarray) -> tuple[int, int]:
        """(gain, place in back) of the best exchange in which bin x gives one of ``gives`` for one of ``back``."""
        most = np.zeros(2 * self.capacity + 1, np.int64)
        most[gives] = gives
        np.maximum.accumulate(most, out=most)  # the largest it can give, up to each size
        full = self.fill[owner]
        more = most[self.capacity - full + back] - back
        gain = np.where((more > 0) & (owner != x), more * (full - self.fill[x] + more), 0)
        n = int(np.argmax(gain)) if len(gain) else 0
        return (int(gain[n]), n) if len(gain) else (0, 0)

    def _taking(self, x: int, backs: np.ndarray, given: np.ndarray, owner: np.ndarray) -> tuple[int, int]:
        """(gain, place in given) of the best exchange in which bin x takes one of ``given`` for one of ``backs``."""
        none = 4 * self.capacity
        fewest = np.full(self.capacity + 2, none, np.int64)
        fewest[backs] = backs
        fewest = np.minimum.accumulate(fewest[::-1])[::-1]  # the smallest it can give back, from each size on
        room = self.capacity - self.fill[x]
        more = given - fewest[np.maximum(given - room, 0)]
        gain = np.where((more > 0) & (owner != x), more * (self.fill[x] - self.fill[owner] + more), 0)
        n = int(np.argmax(gain)) if len(gain) else 0
        return (int(gain[n]), n) if len(gain) else (0, 0)

    def find(self, b: int, size: int, two: bool) -> list[int]:
        """An item of a bin, or two, of that size."""
        if not size:
            return []
        if not two:
            return [next(i for i in self.bins[b] if self.sizes[i] == size)]
        seen: dict[int, int] = {}
        for i in self.bins[b]:
            s = int(self.sizes[i])
            if size - s in seen:
                return [seen[size - s], i]
            seen[s] = i
        raise AssertionError("no such pair")

    def step(self, x: int) -> tuple[int, int] | None:
        """Make the best exchange of bin x: moves and one for one first, then one for two and two for one. The two bins."""
        own = np.unique(self.sizes[self.bins[x]])
        every = np.arange(len(self.bins))
        pair_size, pair_owner = self.pair_size[:self.used], self.pair_owner[:self.used]
        zero = np.zeros(len(every), np.int64)
        ways = [self._giving(x, own, zero, every), self._giving(x, own, self.sizes, self.owner), self._taking(x, np.append(own, 0), self.sizes, self.owner)]
        kind = max(range(3), key=lambda k: ways[k][0])
        if not ways[kind][0]:
            pairs = self.pairs_of(x)
            ways += [self._giving(x, own, pair_size, pair_owner), self._giving(x, pairs, self.sizes, self.owner),
                     self._taking(x, own, pair_size, pair_owner), self._taking(x, pairs, self.sizes, self.owner)]
            kind = max(range(3, 7), key=lambda k: ways[k][0])
        gain, n = ways[kind]
        if not gain:
            return None
        there = (zero, self.sizes, self.sizes, pair_size, self.sizes, pair_size, self.sizes)[kind]
        y = int((every, self.owner, self.owner, pair_owner, self.owner, pair_owner, self.owner)[kind][n])
        theirs = int(there[n])
        if kind in (0, 1, 3, 4):
            have = own if kind != 4 else pairs
            mine = int(have[np.searchsorted(have, theirs + self.capacity - self.fill[y], "right") - 1])
        else:
            have = pairs if kind == 6 else np.append(0, own) if kind == 2 else own
            mine = int(have[np.searchsorted(have, max(theirs - (self.capacity - self.fill[x]), 0), "left")])
        self.exchange(x, self.find(x, mine, kind in (4, 6)), y, self.find(y, theirs, kind in (3, 5)))
        return x, y

    def exchange(self, x: int, mine: list[int], y: int, theirs: list[int]) -> None:
        for b, less, more in ((x, mine, theirs), (y, theirs, mine)):
            self.bins[b] = [i for i in self.bins[b] if i not in less] + list(more)
            self.owner[more] = b
            self.fill[b] = int(self.sizes[self.bins[b]].sum())
            start, end = self.part[b]
            self.pair_owner[start:end] = len(self.bins)
            new = self.pairs_of(b)
            if self.used + len(new) > len(self.pair_size):
                self.repair_pairs()
            else:
                self.part[b] = self.used, self.used + len(new)
                self.pair_size[self.used:self.used + len(new)] = new
                self.pair_owner[self.used:self.used + len(new)] = b
                self.used += len(new)
        self.alive -= (not self.bins[x]) + (not self.bins[y])


def improve(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over underfull bins; fewer bins with the same items, or as many.

    The emptiest bin that may still have an exchange goes first. A bin without one is looked at again when it changes
    itself; any other bin that changes looks at all bins, this one too. So at the end no move, no one-for-one, and no
    two-for-one exchange between any two bins raises the sum of squared fills, or the least number of bins is reached.
    """
    s = _Search(bins, sizes, capacity)
    least = least_bins(sizes, capacity)
    waiting = [(int(f), b) for b, f in enumerate(s.fill[:-1])]
    heapq.heapify(waiting)
    asleep = np.zeros(len(s.bins), bool)
    while waiting and s.alive > least:
        fill, x = heapq.heappop(waiting)
        if asleep[x] or fill != s.fill[x] or fill in (0, capacity):
            continue
        changed = s.step(x)
        if changed is None:
            asleep[x] = True
            continue
        for b in changed:
            asleep[b] = False
            heapq.heappush(waiting, (int(s.fill[b]), b))
    return [b for b in s.bins if b]


def few_bins(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: best-fit decreasing, or filled up one by one where that takes fewer, improved by local search."""
    least = least_bins(sizes, capacity)
    bins = best_fit(sizes, capacity)
    if len(bins) > least:
        bins = improve(min(bins, fill_up(sizes, capacity), key=len), sizes, capacity)
    return bins


def pack_block(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item; sequences are numbered from 0."""
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for n, items in enumerate(few_bins(sizes, capacity)):
        at = 0
        for i in items:
            sequence[i], offset[i] = n, at
            at += int(sizes[i])
    return sequence, offset


def tokenized(df: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text",
              path: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, block, n_tokens, head, crcs): tokens of every text with its end id, those of its piece to be packed
    (0: none), and the checksum of each piece's ids."""
    shared = df.sparkSession.sparkContext.broadcast(load_tokenizer(path))
    schema = "doc_id long, block long, n_tokens long, head long, crcs array<long>"

    def run(batches):
        from pyspark import TaskContext
        tokens = _tokens(shared)
        row = TaskContext.get().partitionId() * 7919
        for part, texts in text_chunks(batches):
            counts, heads, crcs, dealt = [], [], [], []
            for t in texts:
                ids = np.append(tokens.ids(t), np.uint32(END_ID)).astype("<u4")
                n = len(ids)
                head = n if n <= length else n % length
                raw, cuts = ids.tobytes(), [0] if n <= length else [0] * (head > 0) + list(range(head, n, length))
                stops = [*cuts[1:], n]
                counts.append(n)
                heads.append(head % length)
                crcs.append([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cuts, stops, strict=True)])
                dealt.append(row % blocks)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(dealt, pa.int64()), pa.array(counts, pa.int64()), pa.array(heads, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64()))], ["doc_id", "block", "n_tokens", "head", "crcs"])

    return id_text(df, id_col, text_col).mapInArrow(run, schema)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    blocks = max(1, round(n_rows(df) / block))
    rows = tokenized(df, blocks, id_col, text_col, path, length)
    schema = "doc_id long, n_tokens long, head long, crcs array<long>, sequence long, offset long, base long"

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        head = group["head"].to_numpy()
        sequence, offset = np.full(len(group), -1, np.int64), np.zeros(len(group), np.int64)
        some = head > 0
        sequence[some], offset[some] = pack_block(head[some], length)
        high = int(group["block"].iloc[0]) << 36
        used = int(sequence.max(initial=-1)) + 1
        full = (group["n_tokens"].to_numpy() - head) // length
        return pd.DataFrame({"doc_id": group["doc_id"], "n_tokens": group["n_tokens"], "head": head,
                             "crcs": group["crcs"], "sequence": high + sequence, "offset": offset,
                             "base": high + used + np.cumsum(full) - full})

    done = rows.groupBy("block").applyInPandas(packed, schema)
    first = F.when(F.col("head") > 0, 1).otherwise(0)
    pieces = done.select("*", F.posexplode("crcs").alias("piece", "ids_crc32"))
    is_head = (F.col("piece") == 0) & (F.col("head") > 0)
    after = F.col("piece") - first  # full pieces before this one
    return pieces.select(
        "doc_id", F.col("piece").cast("int").alias("piece"),
        F.when(is_head, F.lit(0).cast("long")).otherwise(F.col("head") + after * length).alias("start"),
        F.when(is_head, F.col("head")).otherwise(F.lit(length).cast("long")).alias("length"),
        "ids_crc32",
        F.when(is_head, F.col("sequence")).otherwise(F.col("base") + after).alias("sequence_id"),
        F.when(is_head, F.col("offset")).otherwise(F.lit(0).cast("long")).alias("offset"))
