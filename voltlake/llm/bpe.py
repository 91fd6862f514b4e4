"""Byte-level BPE encoding and decoding by a published rank file.

Encoding looks a pre-token up twice. A minimal perfect hash over the
vocabulary resolves the pre-tokens that are whole entries; the others are
merged from their bytes, lowest rank first and leftmost among equals, with a
heap over linked parts, O(n log n) for a pre-token of n bytes. Decoding gathers
the entries' bytes by id.

Null and empty texts encode to no ids. A text of any length is encoded whole;
rows are independent, so repeated rows give repeated results and an empty
table an empty one.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from voltlake.llm.common import id_text, read_file, text_chunks, tokenizer_file

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Merged pre-tokens that a task remembers; it starts anew beyond that.
MEMO = 400_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """Slot of each key hash under its bucket's seed."""
    x = (hashes ^ (seeds.astype(np.uint64) * _GOLD)) * _MIX
    return ((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


def minimal_perfect_hash(keys: list[bytes]) -> dict[str, np.ndarray]:
    """Hash and displace: a seed for each bucket sends its keys to free slots; n keys fill n slots.

    Buckets of one key name their slot outright (seed -slot - 1), as the last ones would hardly find one.
    """
    n = len(keys)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, n)
    buckets = max(1, n // 3)
    bucket = ((hashes >> np.uint64(11)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(sizes)
    seeds, slot_key = np.zeros(buckets, np.int64), np.full(n, -1, np.int64)
    tries = np.arange(1, 257, dtype=np.int64)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[ends[b] - sizes[b]:ends[b]]
        if len(members) < 2:
            break
        first = 0
        while True:
            found = _slots(hashes[members][None, :], (tries + first)[:, None], n)
            good = (slot_key[found] < 0).all(1)
            for t in np.flatnonzero(good):
                if len(set(found[t].tolist())) == len(members):
                    break
            else:
                first += len(tries)
                continue
            seeds[b] = tries[t] + first
            slot_key[found[t]] = members
            break
    free = iter(np.flatnonzero(slot_key < 0).tolist())
    for b in np.flatnonzero(sizes == 1):
        slot = next(free)
        seeds[b] = -slot - 1
        slot_key[slot] = order[ends[b] - 1]
    return {"seeds": seeds, "slot_key": slot_key}


def load_vocabulary(path: str | None = None) -> dict:
    """Rank file -> plain data to broadcast; its size is the vocabulary's, a megabyte or two."""
    lines = read_file(path or tokenizer_file(RANKS)).splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
    keys = list(ranks)
    import public_tokenizers
    return {"keys": keys, "ids": np.array([ranks[k] for k in keys], np.int64),
            "pattern": public_tokenizers.PATTERN, **minimal_perfect_hash(keys)}


class Codec:
    """Encoder and decoder over a loaded vocabulary."""

    def __init__(self, v: dict):
        import regex
        self.keys, self.ids, self.seeds, self.slot_key = v["keys"], v["ids"], v["seeds"], v["slot_key"]
        self.split = regex.compile(v["pattern"]).findall
        self.ranks = dict(zip(self.keys, self.ids.tolist(), strict=True))
        self.memo: dict[bytes, list[int]] = {}
        size = int(self.ids.max()) + 1
        self.lens = np.zeros(size, np.int64)
        self.lens[self.ids] = [len(k) for k in self.keys]
        at = np.argsort(self.ids, kind="stable")
        self.starts = np.cumsum(self.lens) - self.lens
        self.blob = np.frombuffer(b"".join([self.keys[i] for i in at]), np.uint8)

    def whole(self, tokens: list[bytes]) -> np.ndarray:
        """Ids of the tokens that are vocabulary entries, -1 for the others."""
        n = len(tokens)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, n)
        seeds = self.seeds[((hashes >> np.uint64(11)) % np.uint64(len(self.seeds))).astype(np.int64)]
        key = self.slot_key[np.where(seeds < 0, -seeds - 1, _slots(hashes, seeds, len(self.keys)))].tolist()
        keys, ids = self.keys, self.ids.tolist() if n > 50_000 else self.ids
        return np.fromiter((ids[k] if keys[k] == t else -1 for k, t in zip(key, tokens, strict=True)), np.int64, n)

    def merge(self, token: bytes) -> list[int]:
        """Ids of a token by merging its bytes."""
        n, rank = len(token), self.ranks.get
        after = list(range(1, n + 1))  # start of the next part
        before = list(range(-1, n))
        pair = [rank(token[i:i + 2], -1) for i in range(n - 1)]  # of the part that starts here and the next
        pair.append(-1)
        bits = n.bit_length()
        low = (1 << bits) - 1
        heap = [r << bits | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            x = heappop(heap)
            i = x & low
            if pair[i] != x >> bits:
                continue
            j = after[i]
            k = after[i] = after[j]
            pair[i] = pair[j] = -1
            if k < n:
                before[k] = i
                r = pair[i] = rank(token[i:after[k]], -1)
                if r >= 0:
                    heappush(heap, r << bits | i)
            h = before[i]
            if h >= 0:
                r = pair[h] = rank(token[h:k], -1)
                if r >= 0:
                    heappush(heap, r << bits | h)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[token[i:after[i]]])
            i = after[i]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's end."""
        found, counts = [], []
        for t in texts:
            p = self.split(t)
            found += p
            counts.append(len(p))
        distinct = list(dict.fromkeys(found))
        if not distinct:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        number = dict(zip(distinct, range(len(distinct)), strict=True))
        codes = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        del found
        tokens = [t.encode() for t in distinct]
        entry = self.whole(tokens)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        lens = np.ones(len(tokens), np.int64)
        flat: list[int] = []
        for i, e in enumerate(entry.tolist()):
            if e >= 0:
                flat.append(e)
            else:
                t = tokens[i]
                ids = memo.get(t)
                if ids is None:
                    ids = memo[t] = self.merge(t)
                lens[i] = len(ids)
                flat += ids
        table, first = np.array(flat, np.uint32), np.cumsum(lens) - lens
        own = lens[codes]
        ends = np.cumsum(own)
        ids = table[np.repeat(first[codes] - (ends - own), own) + np.arange(int(ends[-1]))]
        last = np.cumsum(counts)
        return ids, np.where(last > 0, ends[np.maximum(last, 1) - 1], 0)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        out, start = [], 0
        for end in ends.tolist():
            part = ids[start:end].astype(np.int64)
            lens = self.lens[part]
            stop = np.cumsum(lens)
            total = int(stop[-1]) if len(stop) else 0
            out.append(self.blob[np.repeat(self.starts[part] - (stop - lens), lens) + np.arange(total)].tobytes())
            start = end
        return out


def _codec(shared) -> Codec:
    """The task's codec; a worker keeps it beside the broadcast value between tasks."""
    v = shared.value
    if "codec" not in v:
        v["codec"] = Codec(v)
    return v["codec"]


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every text."""
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches):
        codec = _codec(shared)
        for part, texts in text_chunks(batches):
            ids, ends = codec.encode(texts)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, text) of every array of ids; bytes that aren't UTF-8 become U+FFFD, null arrays empty texts."""
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches):
        codec = _codec(shared)
        for b in batches:
            texts = []
            for x in b.column(1).to_pylist():
                got = codec.decode(np.array(x or [], np.int64), np.array([len(x or [])]))[0]
                texts.append(got.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return df.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{ids_col}` as array<int>) ids") \
        .mapInArrow(run, "doc_id long, text string")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode every text, decode its ids, and digest both: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches):
        codec = _codec(shared)
        sha = hashlib.sha256
        for part, texts in text_chunks(batches):
            ids, ends = codec.encode(texts)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(ends - starts, pa.int64()),
                pa.array([sha(raw[4 * a:4 * b]).hexdigest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.string()),
                pa.array([sha(x).hexdigest() for x in codec.decode(ids, ends)], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
