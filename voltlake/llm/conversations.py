"""Repair of conversation structure by rank-convergence parallel Viterbi.

The rows of a conversation go by turn (nulls first), then role, then the
SHA-256 of their text; equal rows are one element with a count. A row's first
fault is blank (no character but the six ASCII blanks), duplicate (role and
text seen earlier) or truncated (doesn't end in ``.``, ``!`` or ``?``). The
cheapest edits give role initials ``(s?(ua)+)?``: Keep 0, Rerole to the user or
the assistant 3, Delete 4 (required for blank and duplicate rows), Insert an
empty turn of the user or the assistant 3; a truncated row that stays adds 3.
Of the cheapest, the one whose initials are least in ASCII order is taken.

A conversation's elements are cut into chunks of ``chunk``, however many they
are, and the chunks are spread over the cluster as packed codes:

1. backward costs: every chunk starts from a speculative vector of costs to go
   (one entry a state); the last one knows its own.
2. fix-up passes: a chunk whose successor gives another vector, not only
   another constant, is run again, until both runs differ by a constant; from
   there on they stay so. Conversations that aren't settled after FIXUPS passes
   are finished by a stream over their codes, chunk by chunk from the end.
3. tracing: the stitched costs decide the edits of every chunk, for each state
   that it may start in; the states are carried over the chunks of a conversation.

Edits meet the texts again in one pass over each conversation's rows in order,
which holds a row at a time: a SHA-256 can't be computed in pieces.

Null roles and texts count as one space. A null conversation id is an id of
its own, a null turn no turn. Roles with another initial than s, u or a can't
be kept. Conversations without rows give zeros, an empty audit and the hash of
the empty text; an empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import bound_batches, saved

CHUNK = 4096
#: Passes before what isn't settled is streamed.
FIXUPS = 6

BLANKS = " \t\n\x0b\f\r"
#: States by the roles so far: none, system, user, assistant. KEEP: next state by state and initial (s, u, a, other).
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
#: The only state that an inserted or reroled row can lead to.
GIVEN = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Costs to go after the last row: nothing from START and ASSISTANT, one or two inserts from the others.
END = (0, 6, 3, 0)
UNKNOWN = (0, 0, 0, 0)
#: A packed code is the initial (0 to 3), plus DROP for rows that must go, BLANK for blank ones, CUT for truncated ones.
DROP, BLANK, CUT = 4, 8, 16
_ROW = "conv long, turn long, role string, d binary"


@lru_cache(1 << 16)
def step(after: tuple, code: int) -> tuple[tuple, int]:
    """Costs to go before a row, less their minimum, and that minimum; ``after``: those behind it."""
    if code & DROP:
        return after, 4
    cut = 3 if code & CUT else 0
    own = []
    for s in range(4):
        kept = KEEP[s][code & 3]
        ways = [4 + after[s], 3 + cut + after[GIVEN[s]]]
        own.append(min(ways + [cut + after[kept]] if kept >= 0 else ways))
    user, assistant = min(own[USER], 3 + own[ASSISTANT]), min(own[ASSISTANT], 3 + own[USER])
    own = (min(own[START], 3 + user), min(own[SYSTEM], 3 + user), user, assistant)
    least = min(own)
    return tuple(x - least for x in own), least


@lru_cache(1 << 16)
def choose(after: tuple, code: int, state: int) -> tuple[str, int, int]:
    """The least edits of a row in a state (inserts before it included), the state behind it and their cost."""
    if code & DROP:
        return "D", state, 4
    before, least = step(after, code)
    cut, edits, cost = 3 if code & CUT else 0, "", 0
    while True:
        togo = before[state] + least
        if togo == 4 + after[state]:
            return edits + "D", state, cost + 4
        if before[state] == 3 + before[GIVEN[state]]:
            edits, state, cost = edits + "I", GIVEN[state], cost + 3
            continue
        kept = KEEP[state][code & 3]
        if kept >= 0 and togo == cut + after[kept]:
            return edits + "K", kept, cost + cut
        return edits + "R", GIVEN[state], cost + 3 + cut


def backward(codes: bytes, end: tuple) -> tuple:
    """The vector before a chunk."""
    v = end
    for c in reversed(codes):
        v = step(v, c)[0]
    return v


def fixed(codes: bytes, old_end: tuple, old_out: tuple, end: tuple) -> tuple:
    """The vector before a chunk from another one behind it: the run is repeated until it differs by a constant only."""
    a, b = old_end, end
    for c in reversed(codes):
        if a == b:
            return old_out
        a, b = step(a, c)[0], step(b, c)[0]
    return b


def vectors(codes: bytes, end: tuple) -> list[tuple]:
    """The vectors behind each row of a chunk."""
    out = [end] * len(codes)
    for i in range(len(codes) - 1, 0, -1):
        out[i - 1] = step(out[i], codes[i])[0]
    return out


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Conversations with faults: by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20, a row is dropped (0), emptied (1),
    loses ``.!?`` (2), is there twice (3) or becomes the user's (4). Columns conv, turn, role, text, copies (0: dropped)."""
    space = F.lit(" ")
    conv, turn = F.col(conv_col).cast("long"), F.col(turn_col).cast("long")
    key = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))) % 20
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    return df.select(
        conv.alias("conv"), turn.alias("turn"), F.when(key == 4, "user").otherwise(role).alias("role"),
        F.when(key == 1, "").when(key == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(key == 0, 0).when(key == 3, 2).otherwise(1).alias("copies"))


def as_given(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """The columns of damage() without any damage."""
    space = F.lit(" ")
    return df.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
                     F.lit(1).alias("copies"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text"), 256))


def _elements(rows: DataFrame) -> DataFrame:
    """Distinct rows with their counts, codes and places (pos) in their conversation.

    They are sorted by ranges over all conversations, numbered inside each range, and a
    conversation that begins in an earlier range goes on from there: one row a range reaches the driver.
    """
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) \
        + F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0)
    own = rows.where("copies > 0").select("conv", "turn", "role", _digest().alias("d"), code.alias("code"), "copies") \
        .groupBy("conv", "turn", "role", "d").agg(F.min("code").alias("code"), F.sum("copies").alias("n"))
    order = ["conv", "turn", "role", "d"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, i, k = TaskContext.get().partitionId(), 0, 0
        first = last = None
        for batch in batches:
            ks, heads = [], []
            for conv in batch.column(0).to_pylist():
                if i == 0:
                    first = last = (conv,)
                if (conv,) != last:
                    last, k = (conv,), 0
                ks.append(k)
                heads.append(last == first)
                k, i = k + 1, i + 1
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(i - n, i), pa.int64()), pa.array(ks, pa.int64()), pa.array(heads, pa.bool_())],
                [*batch.schema.names, "part", "i", "k", "head"])

    placed = saved(own.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(number, f"{_ROW}, code int, n long, part int, i long, k long, head boolean"), "turns")
    ranges = placed.groupBy("part").agg(
        F.min_by(F.struct("conv"), "i").alias("first"), F.max_by(F.struct("conv", "k"), "i").alias("last")).orderBy("part").collect()
    bases, held, upto = [], None, 0
    for r in ranges:
        base = upto if held == (r["first"]["conv"],) else 0
        bases.append((r["part"], base))
        upto = r["last"]["k"] + 1 + (base if r["first"]["conv"] == r["last"]["conv"] else 0)
        held = (r["last"]["conv"],)
    known = rows.sparkSession.createDataFrame(bases, "part int, base long")
    pos = F.col("k") + F.when(F.col("head"), F.col("base")).otherwise(0)  # known has a row for each range
    return placed.join(F.broadcast(known), "part").select(*order, "code", "n", pos.alias("pos"))


def _chunks(elements: DataFrame, chunk: int) -> DataFrame:
    """Chunks with the key of their first element, packed codes, counts, and whether it is surely the last (short) one."""
    whole = F.floor(F.col("pos") / chunk).cast("long").alias("chunk")
    firsts = elements.groupBy("conv", "role", "d").agg(F.min("pos").alias("pos")) \
        .select("conv", whole, "pos", F.lit(-1).alias("code"), F.lit(0).cast("long").alias("n"), F.lit(None).alias("key"))
    every = elements.select("conv", whole, "pos", "code", "n", F.when(F.col("pos") % chunk == 0, F.struct("turn", "role", "d")).alias("key"))
    packed = every.unionByName(firsts).groupBy("conv", "chunk").agg(
        F.first("key", ignorenulls=True).alias("key"), F.sort_array(F.collect_list(F.struct("pos", "code", "n"))).alias("rows"))

    def pack(batches):
        for batch in batches:
            codes, counts = [], []
            for rows in batch.column(4).to_pylist():
                code, count, new = bytearray(), [], -1
                for r in rows:
                    if r["code"] < 0:  # the first of its role and text; its element follows
                        new = r["pos"]
                        continue
                    c = r["code"]
                    code.append(c | DROP if c & BLANK or new != r["pos"] else c)
                    count.append(r["n"])
                codes.append(bytes(code))
                counts.append(count)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in (0, 1, 2, 3, 5)], pa.array(codes, pa.binary()), pa.array(counts, pa.list_(pa.int64())),
                 pa.array([len(c) < chunk for c in codes], pa.bool_())],
                ["conv", "turn", "role", "d", "chunk", "codes", "counts", "short"])

    flat = packed.select("conv", "key.turn", "key.role", "key.d", "rows", "chunk")
    return saved(flat.mapInArrow(pack, f"{_ROW}, chunk long, codes binary, counts array<long>, short boolean"), "chunks")


def _lists(batch: pa.RecordBatch, name: str) -> list[tuple | None]:
    return [v if v is None else tuple(v) for v in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def _values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _settled(many: DataFrame, fixups: int) -> DataFrame:
    """(conv, chunk, end): the vector behind each chunk, by speculation and fix-up passes."""
    int_list = pa.list_(pa.int32())
    out = "conv long, chunk long, end array<int>, out array<int>, changed boolean"

    def emit(batch, ends, outs, changed):
        return pa.RecordBatch.from_arrays(
            [pa.array(_values(batch, "conv"), pa.int64()), pa.array(_values(batch, "chunk"), pa.int64()), pa.array(ends, int_list), pa.array(outs, int_list),
             pa.array(changed, pa.bool_())], ["conv", "chunk", "end", "out", "changed"])

    def guess(batches):
        for batch in batches:
            ends = [END if s else UNKNOWN for s in _values(batch, "short")]
            yield emit(batch, ends, [backward(c, e) for c, e in zip(_values(batch, "codes"), ends, strict=True)], [True] * len(ends))

    def fix(batches):
        for batch in batches:
            ends, outs, changed = [], [], []
            for codes, old_end, old_out, end in zip(_values(batch, "codes"), _lists(batch, "end"), _lists(batch, "out"), _lists(batch, "behind"), strict=True):
                end = END if end is None else end
                ends.append(end)
                outs.append(fixed(codes, old_end, old_out, end))
                changed.append(outs[-1] != old_out)
            yield emit(batch, ends, outs, changed)

    def stream(batches):
        held, v = None, END
        for batch in batches:
            ends, outs = [], []
            for conv, codes, old_end, old_out in zip(_values(batch, "conv"), _values(batch, "codes"), _lists(batch, "end"), _lists(batch, "out"), strict=True):
                if held != (conv,):
                    held, v = (conv,), END
                ends.append(v)
                v = fixed(codes, old_end, old_out, v)
                outs.append(v)
            yield emit(batch, ends, outs, [False] * len(ends))

    codes = many.select("conv", "chunk", "codes")
    same = [F.col("a.conv").eqNullSafe(F.col("b.conv")), F.col("a.chunk") == F.col("b.chunk")]

    def with_codes(state):
        return codes.alias("a").join(state.alias("b"), same).select("a.*", *[f"b.{c}" for c in state.columns if c not in ("conv", "chunk")])

    now = saved(many.select("conv", "chunk", "codes", "short").mapInArrow(guess, out), "costs")
    for _ in range(fixups):
        behind = now.select("conv", (F.col("chunk") - 1).alias("chunk"), F.col("out").alias("behind"))
        state = now.alias("a").join(behind.alias("b"), same, "left").select("a.conv", "a.chunk", "end", "out", "behind")
        now = saved(with_codes(state).mapInArrow(fix, out), "costs")
        if now.where("changed").isEmpty():
            return now
    open_ = now.where("changed").select("conv").distinct()
    late = now.alias("a").join(open_.alias("b"), F.col("a.conv").eqNullSafe(F.col("b.conv")), "left_semi")
    done = now.alias("a").join(open_.alias("b"), F.col("a.conv").eqNullSafe(F.col("b.conv")), "left_anti")
    rest = with_codes(late.select("conv", "chunk", "end", "out")).repartition("conv").sortWithinPartitions("conv", F.col("chunk").desc())
    return saved(done.unionByName(rest.mapInArrow(stream, out)), "costs")


def _started(many: DataFrame, fixups: int) -> DataFrame:
    """The chunks of conversations with more than one, with the vector behind each (end) and the state it starts in."""
    ends = _settled(many, fixups).select("conv", "chunk", "end")
    same = [F.col("a.conv").eqNullSafe(F.col("b.conv")), F.col("a.chunk") == F.col("b.chunk")]
    known = many.alias("a").join(ends.alias("b"), same).select("a.*", "b.end")

    def maps(batches):
        for batch in batches:
            to = []
            for codes, end in zip(_values(batch, "codes"), _lists(batch, "end"), strict=True):
                after, at = vectors(codes, end), list(range(4))
                for v, c in zip(after, codes, strict=True):
                    at = [choose(v, c, s)[1] for s in at]
                to.append(at)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(to, pa.list_(pa.int32()))], ["conv", "chunk", "to"])

    def carry(batches):
        held, state = None, START
        for batch in batches:
            at = []
            for conv, to in zip(_values(batch, "conv"), _values(batch, "to"), strict=True):
                if held != (conv,):
                    held, state = (conv,), START
                at.append(state)
                state = to[state]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.int32())], ["conv", "chunk", "start"])

    to = known.select("conv", "chunk", "codes", "end").mapInArrow(maps, "conv long, chunk long, to array<int>")
    starts = to.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(carry, "conv long, chunk long, start int")
    return known.alias("a").join(starts.alias("b"), same).select("a.*", "b.start")


def _trace(batches):
    """Edits and counts of chunks whose start state and costs are known."""
    for batch in batches:
        out = []
        for codes, counts, end, state in zip(_values(batch, "codes"), _values(batch, "counts"), _lists(batch, "end"), _values(batch, "start"), strict=True):
            edits, audit, cost, blank, again, cut, illegal = [], [], 0, 0, 0, 0, 0
            before = None
            for v, c, n in zip(vectors(codes, end), codes, counts, strict=True):
                e, state, own = choose(v, c, state)
                edits.append(e)
                audit.append(e + "D" * (n - 1))
                cost += own + 4 * (n - 1)
                if c & BLANK:
                    blank += n
                else:
                    again += n - 1 + (1 if c & DROP else 0)
                    cut += 1 if c & CUT and not c & DROP else 0
                if before is not None:
                    illegal += not legal(before, c & 3)
                illegal += n - 1
                before = c & 3
            out.append(("".join(audit), ",".join(edits), cost, blank, again, cut, illegal, codes[0] & 3, before))
        columns = list(zip(*out, strict=True)) if out else [()] * 9
        types = [pa.string(), pa.string(), *[pa.int64()] * 5, pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(4)] + [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
            ["conv", "turn", "role", "d", "audit", "text", "cost", "blank", "duplicate", "truncated", "illegal", "opens", "closes"])


_COUNTS = ("cost", "blank", "duplicate", "truncated", "illegal")
_TRACED = f"{_ROW}, audit string, text string, cost long, blank long, duplicate long, truncated long, illegal long, opens int, closes int"


def legal(a: int, b: int) -> bool:
    """Whether two initials may follow each other: su, ua, au."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _finish(batches):
    """Conversations from their rows in order: a row of gaps, and before each chunk's rows their edits."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    held, out, start = None, [], {"s": 0, "u": 1, "a": 2}

    def new(conv):
        return {"conv": conv, "gaps": 0, **dict.fromkeys(_COUNTS, 0), "audit": [], "hash": hashlib.sha256(), "any": False,
                "state": START, "edits": iter(()), "closes": None, "key": None}

    def add(c, role, text):
        c["hash"].update((("\n" if c["any"] else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        c["any"] = True

    def insert(c):
        c["state"] = GIVEN[c["state"]]
        add(c, NAMES[c["state"]], "")

    def close(c):
        while c["state"] in (SYSTEM, USER):  # what the last rows lack
            insert(c)
            c["audit"].append("I")
            c["cost"] += 3
        out.append((c["conv"], c["gaps"], c["blank"], c["duplicate"], c["truncated"], c["illegal"], c["cost"], "".join(c["audit"]), c["hash"].hexdigest()))

    def ready():
        rows = list(zip(*out, strict=True)) if out else [()] * 9
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(rows, types, strict=True)], names)

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for r in batch.slice(at, 64).to_pylist():
                if held is None or held["conv"] != r["conv"]:
                    if held:
                        close(held)
                    held = new(r["conv"])
                if r["kind"] == 0:
                    held["gaps"] = r["gaps"]
                elif r["kind"] == 1:
                    if held["closes"] is not None:
                        held["illegal"] += not legal(held["closes"], r["opens"])
                    for k in _COUNTS:
                        held[k] += r[k]
                    held["closes"] = r["closes"]
                    held["audit"].append(r["audit"])
                    held["edits"] = iter(r["text"].split(","))
                else:
                    key = (r["turn"], r["role"], r["d"])
                    if key == held["key"]:  # a repeated row; its Delete is in the audit
                        continue
                    held["key"] = key
                    edits = next(held["edits"])
                    for _ in edits[:-1]:
                        insert(held)
                    if edits[-1] == "K":
                        held["state"] = KEEP[held["state"]][start.get(r["role"][:1], 3)]
                        add(held, r["role"], r["text"])
                    elif edits[-1] == "R":
                        held["state"] = GIVEN[held["state"]]
                        add(held, NAMES[held["state"]], r["text"])
        if out:
            yield ready()
    if held:
        close(held)
    yield ready()


def repair(rows: DataFrame, chunk: int = CHUNK, fixups: int = FIXUPS) -> DataFrame:
    """Conversations with gaps, counts of faults, cost, audit and the repaired text's hash; rows as given by damage() or as_given()."""
    bound_batches(rows.sparkSession)
    chunks = _chunks(_elements(rows), chunk)
    alone = (F.col("chunk") == 0) & F.col("short")
    shape = "conv long, turn long, role string, d binary, codes binary, counts array<long>, end array<int>, start int"
    single = chunks.where(alone).withColumns({"end": F.array(*map(F.lit, END)), "start": F.lit(START)})
    many = chunks.where(~alone)
    columns = [c.split()[0] for c in shape.split(", ")]
    known = single.select(*columns)
    if not many.isEmpty():
        known = known.unionByName(_started(many, fixups).select(*columns))
    traced = known.mapInArrow(_trace, _TRACED)

    turn = F.when(F.col("copies") > 0, F.col("turn"))
    gaps = rows.groupBy("conv").agg(F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"))
    texts = rows.where("copies > 0").select("conv", "turn", "role", _digest().alias("d"), "text", F.lit(2).alias("kind"))
    merged = traced.withColumn("kind", F.lit(1)).unionByName(texts, allowMissingColumns=True) \
        .unionByName(gaps.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    in_order = merged.repartition("conv").sortWithinPartitions("conv", F.col("kind") > 0, "turn", "role", "d", "kind")
    return in_order.mapInArrow(_finish, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                        "audit string, repaired_sha256 string")
