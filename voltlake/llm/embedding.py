"""Near-duplicate vectors by product quantisation.

Vectors are dealt into coarse lists (the nearest of LISTS centroids) and their
residuals coded by subspace. A query goes to the PROBES nearest lists; there
its distance to a member is read from tables, one for each subspace, off the
member's codes. A member is a candidate unless that distance exceeds the
threshold's by more than the member's own coding error, which is kept with it:
in the lists that are probed no link is lost. Candidates are ranked again by
their exact cosine in double precision, and only those that reach the
threshold link.

Centroids and codes are fitted on a bounded sample (SAMPLE vectors, chosen by
a hash); every vector is indexed. Lists are split into blocks of BLOCK members
and queries, so a hot list is many groups. Equal vectors are one class with a
weight; the search runs on classes. A group returns counts and a spanning
forest of its links, not its pairs: a pair that both ends' searches see is
counted where it is seen first, which both can tell from the lists they probe.

Null, empty and zero vectors and those with null or non-finite components link
with nothing. Vectors of different lengths don't link. Rows that share an id
are joined as that id; rows without an id have a null component. An empty
table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.llm.common import bound_batches, saved
from voltlake.llm.components import components

#: Vectors that the quantisers are fitted on at most, and of each list, about.
SAMPLE, OF_EACH = 65_536, 32
#: Bytes of the sample, as doubles, at most.
SAMPLE_BYTES = 128 << 20
#: Coarse lists at most; twice the square root of the vectors' number, if that is less.
LISTS = 2048
#: Lists that a query goes to.
PROBES = 24
#: Components of a subspace, and codes of each.
WIDTH, CODES = 4, 16
#: Members and queries of one group, about.
BLOCK = 2048


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k centroids, fewer if x has fewer rows."""
    rng = np.random.default_rng(seed)
    if len(x) <= k:
        return x.copy()
    x = x.astype(np.float32)
    at = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, at, 1)[:, 0]
        sums = np.zeros_like(at)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=k)
        some = counts > 0
        at[some] = sums[some] / counts[some, None]
        at[~some] = x[rng.choice(len(x), int((~some).sum()))]
    return at.astype(np.float64)


def nearest(x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest centroids of each row, nearest first."""
    n = min(n, len(at))
    out = np.empty((len(x), n), np.int64)
    half = (at * at).sum(1) / 2
    for i in range(0, len(x), 4096):
        far = half[None] - x[i:i + 4096] @ at.T
        some = np.argpartition(far, n - 1, 1)[:, :n] if n < len(at) else np.broadcast_to(np.arange(n), far.shape)
        out[i:i + 4096] = np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), 1, kind="stable"), 1)
    return out


def list_number(n: int, lists: int = LISTS) -> int:
    return int(max(1, min(lists, round(2 * n ** 0.5))))


def fit(sample: np.ndarray, n: int, lists: int = LISTS) -> dict:
    """Quantisers for n vectors, from unit vectors of a sample (plain data; LISTS centroids at most)."""
    k = min(list_number(n, lists), len(sample))
    coarse = kmeans(sample, k)
    rest = sample - coarse[nearest(sample, coarse, 1)[:, 0]]
    wide = rest.shape[1]
    codes = [kmeans(rest[:, a:a + WIDTH], CODES) for a in range(0, wide, WIDTH)]
    return {"coarse": coarse, "codes": codes}


def encode(unit: np.ndarray, model: dict, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists to probe (the own one first), codes, and coding error of unit vectors."""
    near = nearest(unit, model["coarse"], probes)
    rest = unit - model["coarse"][near[:, 0]]
    codes, lost = [], np.zeros(len(unit))
    for m, book in enumerate(model["codes"]):
        part = rest[:, m * WIDTH:(m + 1) * WIDTH]
        c = nearest(part, book, 1)[:, 0]
        codes.append(c.astype(np.uint8))
        lost += ((part - book[c]) ** 2).sum(1)
    return near, np.stack(codes, 1), np.sqrt(lost)


def table_distances(unit: np.ndarray, centre: np.ndarray, codes: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """Distances of queries to the coded members of one list, by table look-up."""
    rest = unit - centre
    total = np.zeros((len(unit), len(codes)))
    for m, book in enumerate(books):
        part = rest[:, m * WIDTH:(m + 1) * WIDTH]
        table = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)[None]
        total += table[:, codes[:, m]]
    return np.sqrt(np.maximum(total, 0))


def search(queries, members, centre: np.ndarray, books, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query number, member number) with an exact cosine of at least ``least``."""
    found_q, found_m = [], []
    limit = np.sqrt(2 - 2 * least) + members["lost"] + 1e-6
    for a in range(0, len(queries["vec"]), 512):
        vec, size, length = (queries[c][a:a + 512] for c in ("vec", "norm", "length"))
        far = table_distances(vec / size[:, None], centre, members["codes"], books)
        good = (far <= limit) & (length[:, None] == members["length"]) & (queries["node"][a:a + 512, None] != members["node"])
        q, m = np.nonzero(good)
        for b in range(0, len(q), 1 << 16):
            i, j = q[b:b + (1 << 16)], m[b:b + (1 << 16)]
            cosine = np.einsum("ij,ij->i", vec[i], members["vec"][j]) / (size[i] * members["norm"][j])
            keep = cosine >= least
            found_q.append(a + i[keep])
            found_m.append(j[keep])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_q), np.concatenate(found_m)) if found_q else (none, none)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links between numbers a and b."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[:len(a)], flat[len(a):]
    root = np.arange(len(names))
    while len(i):
        x, y = root[i], root[j]
        differ = x != y
        i, j, x, y = i[differ], j[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(names)))
    return names[child], names[root[child]]


def _vector(df: DataFrame, vec_col: str) -> Column:
    """The column of vectors; singles stay singles, other numbers become doubles."""
    kind = df.schema[vec_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(vec_col) if single else F.col(vec_col).cast("array<double>")


def classes(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(node, least, m, vec): distinct vectors that can link, their smallest id and number of rows."""
    vec = _vector(df, vec_col)
    sound = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(vec, lambda x: x != 0)
    return df.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")) \
        .groupBy("vec").agg(F.min("vec_id").alias("least"), F.count("*").alias("m")) \
        .select(F.xxhash64("vec").alias("node"), "least", "m", "vec")


def _stack(column, wide: int) -> np.ndarray:
    """Rows of a list column as doubles, filled up with zeros; read off its values, not as Python numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), wide), np.float64)
    if len(flat) == out.size:
        out[:] = flat.reshape(out.shape)
    else:
        starts = np.cumsum(lengths) - lengths
        out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(starts, lengths)] = flat
    return out


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by a power of two near their largest component, so that squares neither overflow nor vanish
    and no digit is lost, and their norms."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])
    return x, np.linalg.norm(x, axis=1)


def links(own: DataFrame, least: float = 0.95, lists: int = LISTS, probes: int = PROBES, sample: int = SAMPLE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """((node, n): links of each class by rows, (a, b): a forest that spans the linked classes) of classes()."""
    spark = own.sparkSession
    bound_batches(spark)
    size = own.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("wide")).first()
    n, wide = size["n"], -(-(size["wide"] or WIDTH) // WIDTH) * WIDTH
    spot = F.pmod(F.xxhash64(F.lit("sample"), "node"), F.lit(1 << 30)) / float(1 << 30)
    chosen = own.where(spot < min(1.0, min(sample, OF_EACH * list_number(n, lists), SAMPLE_BYTES // (8 * wide)) / max(1, n))).select("vec").toArrow()
    raw = _stack(chosen.column("vec"), wide) if n else np.zeros((0, wide))
    if not len(raw):
        raw = np.eye(1, wide)
    raw, norms = _scaled(raw)
    model = fit(raw / norms[:, None], n, lists)
    # singles travel as singles; what is computed from them is computed in doubles
    packed = np.float32 if isinstance(own.schema["vec"].dataType.elementType, T.FloatType) else np.float64
    shared = spark.sparkContext.broadcast(model)  # LISTS and CODES centroids

    def code(batches):
        v = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            raw = _stack(b.column(2), wide)
            x, norm = _scaled(raw)
            near, codes, lost = encode(x / norm[:, None], v, probes)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pc.list_value_length(b.column(2)), pa.array([r.tobytes() for r in raw.astype(packed)], pa.binary()),
                pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(lost),
                pa.ListArray.from_arrays(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), near.astype(np.int32).ravel())],
                ["node", "m", "length", "vec", "codes", "lost", "probes"])

    coded = saved(own.select("node", "m", "vec").mapInArrow(
        code, "node long, m long, length int, vec binary, codes binary, lost double, probes array<int>"), "codes")
    home = F.col("probes")[0]
    asks = coded.select("*", F.explode("probes").alias("list"))
    # members and queries of each list: a row for each list
    count = asks.groupBy("list").agg(F.count("*").alias("asks"), F.sum((F.col("list") == home).cast("long")).alias("held")) \
        .select("list", F.greatest(F.ceil(F.col("asks") / (2 * block)), F.lit(1)).cast("int").alias("q_blocks"),
                F.greatest(F.ceil(F.col("held") / block), F.lit(1)).cast("int").alias("m_blocks"))
    count = saved(count, "lists")
    spread = lambda salt, k: F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    cols = ["list", "m_block", "q_block", "member", "node", "m", "length", "vec", "codes", "lost", "probes"]
    with_blocks = asks.join(F.broadcast(count), "list")  # LISTS rows at most
    queries = with_blocks.withColumn("q_block", spread("q", "q_blocks")).withColumn("m_block", every("m_blocks")) \
        .withColumn("member", F.lit(False)).withColumn("codes", F.lit(None).cast("binary")).select(*cols)
    members = with_blocks.where(F.col("list") == home).withColumn("m_block", spread("m", "m_blocks")).withColumn("q_block", every("q_blocks")) \
        .withColumn("member", F.lit(True)).select(*cols)

    def group(table: pa.Table) -> pa.Table:
        v = shared.value
        side = np.array(table.column("member").to_pylist(), bool)
        number = int(table.column("list")[0].as_py())

        def part(mask: np.ndarray) -> dict:
            t = table.filter(pa.array(mask))
            k = t.num_rows
            vec, norm = _scaled(np.frombuffer(b"".join(t.column("vec").to_pylist()), packed).reshape(k, wide).astype(np.float64))
            return {"node": t.column("node").to_numpy(), "m": t.column("m").to_numpy(), "length": t.column("length").to_numpy(),
                    "vec": vec, "norm": norm,
                    "lost": t.column("lost").to_numpy(), "probes": t.column("probes").combine_chunks().flatten().to_numpy().astype(np.int64).reshape(k, -1),
                    "codes": np.frombuffer(b"".join(x or b"" for x in t.column("codes").to_pylist()), np.uint8).reshape(k, -1) if mask is side else None}

        nodes, counts, a, b = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if side.any() and not side.all():  # members and queries
            mem, ask = part(side), part(~side)
            q, m = search(ask, mem, v["coarse"][number], v["codes"], least)
            back = (mem["probes"][m] == ask["probes"][q, :1]).any(1)  # the member's own search sees this pair too
            ends = np.concatenate([ask["node"][q], mem["node"][m][~back]])
            weights = np.concatenate([mem["m"][m], ask["m"][q][~back]])
            nodes, at = np.unique(ends, return_inverse=True)
            counts = np.bincount(at, weights, len(nodes)).astype(np.int64)
            a, b = _forest(ask["node"][q], mem["node"][m])
        gap = lambda k: pa.nulls(k, pa.int64())
        return pa.table({"node": pa.concat_arrays([pa.array(nodes), gap(len(a))]), "n": pa.concat_arrays([pa.array(counts), gap(len(a))]),
                         "a": pa.concat_arrays([gap(len(nodes)), pa.array(a)]), "b": pa.concat_arrays([gap(len(nodes)), pa.array(b)])})

    met = saved(queries.unionByName(members).groupBy("list", "m_block", "q_block")
                .applyInArrow(group, "node long, n long, a long, b long"), "met")
    per = met.where("node is not null").groupBy("node").agg(F.sum("n").alias("n"))
    return per, met.where("a is not null").select("a", "b")


def near_copies(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95, **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: other rows linked directly, the least id reachable
    through links, and whether that is its own."""
    own = saved(classes(df, id_col, vec_col), "classes")
    per, forest = links(own, least, **options)
    tops = components(forest)
    joined = own.join(per, "node", "left").join(tops, "node", "left") \
        .select("node", "least", "vec", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    heads = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(heads, "component").select("vec", "n_links", "component_id")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), _vector(df, vec_col).alias("vec"))
    out = rows.join(named, "vec", "left")
    top = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), top.alias("component_id"),
                      F.coalesce(F.col("vec_id") == top, F.lit(False)).alias("kept"))
