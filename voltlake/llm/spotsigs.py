"""Document fingerprints by spot signatures, in DataFrame operations only.

A signature is a run of common words (ANCHORS) with the chain of content words
after it. A document's fingerprint is the set of its signatures' hashes, eight
hex digits each, ascending. Likeness is the Jaccard similarity of two sets.

Near pairs are found among distinct sets: a set meets others by the signatures
of its prefix, rare ones first, as long that a pair of the wanted similarity
must share one there; sets are dealt into partitions by their size, and a set
is a guest in the next one if a set there can be alike. What meets is pruned
by size and by a sketch of 64 parities before it is a candidate, and verified
exactly. A signature that many sets of a partition have is split into pairs of
chunks, so no task gets all of them.

How many sets each one is alike to needs no list of all pairs. Sets that agree
in a band of hashes form families around a centre, the signatures that most of
them have. What two sets of a family don't share is at most what the one and the
other don't share with the centre, so most pairs are counted from these numbers
alone. For the rest the edits (signatures that a set and the centre don't share)
decide: a pair must share one, and sets that differ in edits of their own alone
count as one. Between families, and for sets without one, the prefixes above
are compared, a family as one.

A text without a signature has one: the hash of all its words, or of the text
itself if it has none. So equal texts have equal fingerprints, null and empty
texts that of the empty text, and texts without anchors are alike only if
their words are. Repeated rows repeat in the results; an empty table gives an
empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import saved

#: Content words after an anchor.
CHAIN = 3
#: Numbers by which signatures are ordered, rare ones first (a power of two); what reaches the driver of them.
COUNTS = 1 << 16
#: Steps of size in a partition; one step is the ratio that two alike sets may have.
STEPS = 8
#: Bands of hashes that make families, hashes in a band, members of one at least.
BANDS = 5
BAND = 3
FAMILY = 8
#: Parts of a signature in sums of edits, which are whole numbers of them; what rounding two can take.
FINE = 10_000_000
ROUNDED = 2
#: Numbers from here on name families, smaller ones sets.
FAMILIES = 1 << 62
#: Sets that meet at one signature of a partition; more are split into pairs of chunks.
TILE = 4096

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has", "have", "he", "in", "is", "it", "not", "of", "on", "or",
    "that", "the", "there", "this", "to", "was", "were", "which", "with", "you",
    "als", "am", "auch", "auf", "das", "dem", "den", "der", "die", "ein", "eine", "es", "ist", "im", "mit", "nicht", "sich", "sie", "und", "von", "zu",
    "au", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "ne", "par", "pas", "pour", "qui", "sur", "un", "une",
    "al", "con", "del", "el", "las", "los", "más", "no", "para", "por", "que", "se", "su", "una", "y",
)


def _any_of(words: tuple[str, ...]) -> str:
    """A pattern for any of the words that shares their beginnings."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        heads.setdefault(w[:1], []).append(w[1:])
    parts = [c + (_any_of(tuple(rest)) if rest != [""] else "") for c, rest in heads.items() if c]
    return f"(?:{'|'.join(parts)}){'?' if '' in heads else ''}"


#: The end of the text counts as a content word, so that anchors before it have one.
END = "\u0003"

#: Anchors in a row and a content word, in normalised text where every word ends in a blank.
_UNIT = rf"(?:{_any_of(ANCHORS)}(?= ) )*+[^ ]+ "


def _short(h: Column) -> Column:
    """The high half of a hash."""
    return F.shiftright(h, 32).cast("int")


def let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """array<int>: the hashes of a text's signatures, distinct and ascending; one at least."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    words = F.ltrim(F.concat(F.rtrim(F.regexp_replace(F.lower(body), r"[^\p{L}\p{N}]+", " ")), F.lit(" ")))

    def of(norm: Column) -> Column:
        units = F.regexp_extract_all(F.concat(norm, F.lit(END + " ")), F.lit(_UNIT), F.lit(0))
        own = let(units, lambda u: F.transform(
            F.filter(F.sequence(F.lit(0), F.greatest(F.size(u) - 1, F.lit(0))), lambda i: F.instr(F.coalesce(F.get(u, i), F.lit("")), " ") < F.length(F.get(u, i))),
            lambda i: _short(F.xxhash64(F.get(u, i), *[F.substring_index(F.rtrim(F.get(u, i + n)), " ", -1) for n in range(1, chain)]))))
        whole = _short(F.when(F.length(norm) > 0, F.xxhash64(norm)).otherwise(F.xxhash64(body)))
        return let(F.array_sort(F.array_distinct(own)), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(whole)))

    return let(words, of)


def fingerprint(sigs: Column) -> Column:
    """The set as text."""
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def sets(df: DataFrame, text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """df with column signatures."""
    return df.withColumn("signatures", signatures(F.col(text_col), chain))


def classes(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((columns of own, key), (node, key, class_id, s)) of rows with doc_id and a set s: classes of equal sets, named by
    128 bits, with a number and their smallest id."""
    keyed = own.withColumn("key", F.struct(F.xxhash64("s").alias("a"), F.xxhash64(F.lit("other"), "s").alias("b")))
    named = keyed.groupBy("key").agg(F.min("doc_id").alias("class_id"), F.first("s").alias("s"))
    return keyed.drop("s"), saved(named.select(F.monotonically_increasing_id().alias("node"), "key", "class_id", "s"), "classes")


def _counts(sets: DataFrame) -> Column:
    """array<long> of COUNTS numbers: signatures by their last bits (one small row for each to the driver)."""
    found = sets.select(F.explode("s").alias("x")).groupBy(F.col("x").bitwiseAND(F.lit(COUNTS - 1)).alias("at")).count().collect()
    by = {r["at"]: min(r["count"], (1 << 31) - 1) for r in found}
    return F.split(F.lit(",".join(str(by.get(n, 0)) for n in range(COUNTS))), ",").cast("array<long>")


def _sketch(s: Column | str) -> Column:
    """64 parities of a set; two differ in as many as the sets don't share, at most."""
    return F.aggregate(s, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(x, 16).bitwiseAND(F.lit(63)))))


def _apart(least: float) -> float:
    """What two alike sets don't share, as a part of the sum of their sizes, at most."""
    return (1 - least) / (1 + least)


def families(named: DataFrame, least: float = 0.8) -> DataFrame:
    """(node, family, n, bits, r, edits, low, high, radius, centre_bits): sets with a centre, r signatures (edits) off it;
    the last four are the least and largest n, the largest r and the sketch of the family's centre."""
    n = F.size("s")
    band = lambda k: F.xxhash64(F.lit(k), F.slice(F.sort_array(F.transform("s", lambda x: F.xxhash64(F.lit(k), x))), 1, BAND))
    # smaller sets are alike to none that has another signature
    bands = saved(named.where(n * F.lit(_apart(least)) * 2 + 1e-9 >= 1).select("node", F.explode(F.array(*[band(k) for k in range(BANDS)])).alias("band")), "bands")
    held = bands.groupBy("band").agg(F.count("*").alias("held")).where(F.col("held") >= FAMILY)
    sets_of = bands.join(held, "band").join(named.select("node", "s"), "node")
    centre = sets_of.select("band", "held", F.explode("s").alias("x")).groupBy("band", "held", "x").agg(F.count("*").alias("c")) \
        .where(F.col("c") * 2 > F.col("held")).groupBy("band", "held").agg(F.sort_array(F.collect_list("x")).alias("centre")) \
        .withColumn("family", F.shiftrightunsigned(F.xxhash64("centre"), 2).bitwiseOR(F.lit(FAMILIES)))
    centre = saved(centre, "centres")
    weight = centre.groupBy("family").agg(F.sum("held").alias("weight"))
    off = n + F.size("centre") - F.size(F.array_intersect("s", "centre")) * 2
    # the centre that most bands have, so that copies of one text have one
    of = sets_of.join(centre.drop("held"), "band").join(weight, "family").withColumn("r", off).where(F.col("r") * 3 <= n) \
        .groupBy("node").agg(F.max(F.struct("weight", -F.col("r"), "family")).alias("best")).select("node", F.col("best.family").alias("family"))
    centres = centre.groupBy("family").agg(F.first("centre").alias("centre"))
    edits = F.sort_array(F.concat(F.array_except("s", "centre"), F.array_except("centre", "s")))
    home = saved(of.join(named.select("node", "s"), "node").join(centres, "family").select(
        "node", "family", n.alias("n"), _sketch("s").alias("bits"), edits.alias("edits"), _sketch("centre").alias("centre_bits")).withColumn("r", F.size("edits")), "homes")
    spread = home.groupBy("family").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("r").alias("radius"), F.count("*").alias("members"))
    return saved(home.join(spread.where("members > 1").drop("members"), "family"), "families")


def _inside(home: DataFrame, least: float) -> DataFrame:
    """(node, n_near): how many others of its own family each node is alike to."""
    room = F.round((F.col("n") * F.lit(_apart(least)) - F.col("r")) * FINE).cast("long")
    single = home.select("node", "family", F.explode("edits").alias("x"))
    common = single.groupBy("family", "x").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    theirs = single.join(common, ["family", "x"]).groupBy("node").agg(F.sort_array(F.collect_list("x")).alias("e"))
    # sets that differ in edits of their own alone are alike to the same sets
    own = home.select("node", "family", "n", "r", room.alias("room")).join(theirs, "node", "left").withColumn("e", F.coalesce("e", F.array().cast("array<int>")))
    kind = F.struct(F.xxhash64("family", "n", "r", "e").alias("a"), F.xxhash64(F.lit("other"), "family", "n", "r", "e").alias("b"))
    own = saved(own.withColumn("kind", kind), "kinds")
    kinds = saved(own.groupBy("kind").agg(*[F.first(c).alias(c) for c in ("family", "n", "r", "room", "e")], F.count("*").alias("w")), "kind")
    # sure pairs: the sum of what both are off the centre is little enough, so each counts those with the room it needs
    hist = kinds.groupBy("family", "room").agg(F.sum("w").alias("w"))
    line = hist.select("family", F.col("room").alias("at"), F.lit(0).alias("asks"), "room", "w") \
        .unionAll(hist.select("family", (-F.col("room") - ROUNDED).alias("at"), F.lit(1).alias("asks"), "room", F.lit(0).cast("long").alias("w")))
    so_far = Window.partitionBy("family").orderBy(F.desc("at"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    sure = line.withColumn("sure", F.sum("w").over(so_far)).where("asks = 1").select("family", "room", "sure")

    def alike(n: Column, n2: Column, off: Column) -> Column:
        both = (n + n2 - off) / 2
        return both / (n + n2 - both) >= least - 1e-12

    side = kinds.select("family", F.explode("e").alias("x"), "kind", "n", "r", "room", "e", "w")
    right = side.select("family", "x", *[F.col(c).alias(f"{c}2") for c in ("kind", "n", "r", "room", "e", "w")])
    shared = F.array_intersect("e", "e2")
    # a pair is found at the first edit that both have
    rest = side.join(right, ["family", "x"]).where((F.col("kind") < F.col("kind2")) & (F.col("room") + F.col("room2") < -ROUNDED) & (F.get(shared, F.lit(0)) == F.col("x"))
                                                   & alike(F.col("n"), F.col("n2"), F.col("r") + F.col("r2") - F.size(shared) * 2))
    rest = rest.select(F.explode(F.array(F.struct("kind", F.col("w2").alias("w")), F.struct(F.col("kind2").alias("kind"), "w"))).alias("p")).select("p.*") \
        .groupBy("kind").agg(F.sum("w").alias("rest"))
    itself = F.col("room") * 2 >= -ROUNDED
    same = alike(F.col("n"), F.col("n"), F.col("r") * 2 - F.size("e") * 2)
    counted = kinds.join(sure, ["family", "room"]).join(rest, "kind", "left")
    # sure counts the set itself where it has room, and then its kind as well
    n_near = F.when(itself, F.col("sure") - 1).otherwise(F.col("sure") + F.when(same, F.col("w") - 1).otherwise(0)) + F.coalesce("rest", F.lit(0))
    return own.select("node", "kind").join(counted.select("kind", n_near.alias("n_near")), "kind").select("node", "n_near")


def set_pairs(named: DataFrame, least: float = 0.8, tile: int = TILE, home: DataFrame | None = None) -> DataFrame:
    """(a, b, likeness): pairs a < b of nodes whose sets are alike enough. named: a table of node and distinct sets s.
    With home, the result of families(): without the pairs of one family."""
    often = _counts(named)
    low = lambda x: x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    # rare signatures first: any order that all sets share does, so counts by the last bits are enough
    ranked = F.sort_array(F.transform("s", lambda x: F.shiftleft(F.get(often, x.bitwiseAND(F.lit(COUNTS - 1))), 32).bitwiseOR(low(x))))
    n = F.size("s")
    length = n - F.ceil(n * F.lit(least) - F.lit(1e-9)).cast("int") + 1
    # sets that can be alike are at most one step apart; a partition holds STEPS steps and guests of the last one before
    step = F.floor(F.log(n.cast("double")) / F.lit(-math.log(least)) + F.lit(1e-9)).cast("int")
    own_part = F.floor(step / STEPS).cast("int")
    parts = F.when(step % STEPS == STEPS - 1, F.array(own_part, own_part + 1)).otherwise(F.array(own_part))
    held = ["node", "n", "n2", "off", "bits"]

    def prefixes(sets: DataFrame, *columns: Column) -> DataFrame:
        """(sig, part, guest) for each row's set and the columns held: a number, its sizes from and to, radius and sketch."""
        return sets.where(n > 0).select(*[c.alias(k) for c, k in zip(columns, held)], own_part.alias("own"), parts.alias("parts"), F.explode(F.slice(ranked, 1, length)).alias("x")) \
            .select(_short(F.shiftleft("x", 32)).alias("sig"), *held, "own", F.explode("parts").alias("part")) \
            .select("sig", "part", *held, (F.col("own") < F.col("part")).alias("guest"))

    if home is None:
        rows = prefixes(named, F.col("node"), n, n, F.lit(0), _sketch("s"))
    else:
        whole = home.select("node", *[F.col(c).alias(f"of_{c}") for c in ("family", "low", "high", "radius", "centre_bits")])
        rows = prefixes(named.join(whole, "node", "left_anti"), F.col("node"), n, n, F.lit(0), _sketch("s"))
        of_families = prefixes(named.join(whole, "node"), *[F.col(f"of_{c}") for c in ("family", "low", "high", "radius", "centre_bits")])
        rows = rows.unionByName(of_families.groupBy("sig", "part", *held).agg(F.min("guest").alias("guest")))
    # a signature that many sets of a partition have is split into pairs of chunks
    crowd = saved(rows.groupBy("sig", "part").agg(F.count("*").alias("held")).where(F.col("held") > tile), "crowded")
    chunks = F.coalesce(F.ceil(F.col("held") / tile).cast("int"), F.lit(1))
    chunk = F.pmod(F.xxhash64("node"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    dealt = rows.join(crowd, ["sig", "part"], "left").select("sig", "part", *held, "guest", chunk.alias("c"), other.alias("d")) \
        .select("sig", "part", F.least("c", "d").alias("low"), F.greatest("c", "d").alias("high"), "c", *held, "guest") \
        .repartition("sig", "part", "low", "high")
    key = ["sig", "part", "low", "high"]
    right = dealt.select(*key, *[F.col(c).alias(f"{c}_") for c in ("c", *held, "guest")])
    once = ((F.col("low") == F.col("high")) | (F.col("c") != F.col("c_"))) & ~(F.col("guest") & F.col("guest_"))
    sized = (F.col("n2_") >= F.col("n") * F.lit(least) - 1e-9) & (F.col("n2") >= F.col("n_") * F.lit(least) - 1e-9)
    # what two alike sets don't share has at most this size, and each of it changes a bit of the sketch
    most = (F.col("n2") + F.col("n2_")) * F.lit(_apart(least)) + 1e-9
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("bits_"))) <= most + F.col("off") + F.col("off_")
    met = dealt.join(right, key).where((F.col("node") < F.col("node_")) & once & sized & apart) \
        .select(F.col("node").alias("a"), F.col("node_").alias("b"), F.col("n").alias("an"), F.col("bits").alias("abits")).distinct()
    met = saved(met, "met")
    if home is not None:
        # families meet others as one, and then their sets one by one; a family is b if one of both is
        members = home.select("family", "node", "n", "bits")
        outer = met.where(F.col("b") >= FAMILIES)
        left = outer.where(F.col("a") < FAMILIES).unionByName(
            outer.where(F.col("a") >= FAMILIES).drop("an", "abits").join(members.withColumnRenamed("family", "a"), "a")
            .select(F.col("node").alias("a"), "b", F.col("n").alias("an"), F.col("bits").alias("abits")))
        alike = (F.least("n", "an") >= F.greatest("n", "an") * F.lit(least) - 1e-9) \
            & (F.bit_count(F.col("bits").bitwiseXOR(F.col("abits"))) <= (F.col("n") + F.col("an")) * F.lit(_apart(least)) + 1e-9)
        inner = left.join(members.withColumnRenamed("family", "b"), "b").where(alike).select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        met = saved(met.where(F.col("b") < FAMILIES).select("a", "b").unionByName(inner), "met")
    met = met.select("a", "b")
    taking_part = met.select(F.col("a").alias("node")).union(met.select("b")).distinct()
    their = saved(named.select("node", "s").join(taking_part, "node", "left_semi"), "compared")
    side = lambda c: their.select(F.col("node").alias(c), F.col("s").alias("s" + c))
    return met.join(side("a"), "a").join(side("b"), "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= least - 1e-12)


def near_numbers(named: DataFrame, least: float = 0.8, tile: int = TILE) -> DataFrame:
    """(node, n_near): how many other sets each node is alike to, without those alike to none."""
    home = families(named, least)
    return _inside(home, least).unionByName(near_counts(set_pairs(named, least, tile, home))).groupBy("node").agg(F.sum("n_near").alias("n_near")).where("n_near > 0")


def near_counts(pairs: DataFrame) -> DataFrame:
    """(node, n_near): how many others each node is alike to."""
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_near"))


def near_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, chain: int = 5, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes of equal fingerprints (a < b, likeness) with at least the likeness, and the members
    (doc_id, class_id) of every class; a class is named by its smallest id, rows without an id have no class."""
    own = df.select(F.col(id_col).cast("long").alias("doc_id"), signatures(F.col(text_col), chain).alias("s")).where("doc_id is not null")
    members, named = classes(own)
    name = lambda c: named.select(F.col("node").alias(c), F.col("class_id").alias("id" + c))
    pairs = set_pairs(named, least, tile).join(name("a"), "a").join(name("b"), "b") \
        .select(F.least("ida", "idb").alias("a"), F.greatest("ida", "idb").alias("b"), "likeness")
    return pairs, members.join(named.select("key", "class_id"), "key").select("doc_id", "class_id")


# --- a document and its successor ------------------------------------------------

#: Rows of a range of ids whose order one task finds, about.
RANGE = 20_000


def successors(rows: DataFrame) -> DataFrame:
    """(id, h, next_id, next_h, n, next_n) for distinct (id, h, n): the row after, by descending (id, h); after the
    last, the first.

    Rows are dealt into ranges of about RANGE by quantiles (1024 numbers at most reach the driver), ordered inside
    each; the ends meet in a table of one row a range.
    """
    high = F.shiftrightunsigned("h", 11)
    value = F.col("id").cast("double") + high.cast("double") / F.lit(float(1 << 53))
    own = saved(rows.select("id", "h", "n", value.alias("v")), "ids")
    n = own.count()
    ranges = min(1024, max(1, -(-n // RANGE)))
    bounds: list[float] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(own.agg(F.percentile_approx("v", shares, 20 * ranges).alias("q")).first()["q"]))
    limits = F.array(*[F.lit(b) for b in bounds]).cast("array<double>") if bounds else F.array().cast("array<double>")
    dealt = own.withColumn("part", F.size(F.filter(limits, lambda b: b < F.col("v"))))
    order = Window.partitionBy("part").orderBy(F.desc("id"), F.desc(high), F.desc("h"))
    me = F.struct("id", "h", "n")
    inner = dealt.withColumn("next", F.lead(me).over(order)).withColumn("first", F.lag("id").over(order).isNull())
    heads = dealt.groupBy("part").agg(F.max(F.struct("id", high.alias("high"), "h", "n")).alias("top"))
    # the largest of the next lower range that has rows, or of the highest one: a row for each of 1024 ranges at most
    over = Window.orderBy(F.desc("part"))
    highest = heads.agg(F.max(F.struct("part", "top")).alias("x")).select(F.col("x.top").alias("whole_top"))
    ends = heads.withColumn("lower", F.lead("top").over(over)).crossJoin(F.broadcast(highest)) \
        .select("part", F.coalesce("lower", "whole_top").alias("then"))
    then = F.coalesce("next", F.struct(F.col("then.id").alias("id"), F.col("then.h").alias("h"), F.col("then.n").alias("n")))
    return inner.join(F.broadcast(ends), "part").select(
        "id", "h", "n", then["id"].alias("next_id"), then["h"].alias("next_h"), then["n"].alias("next_n"))


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN, least: float = 0.8) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, signatures, edited_signatures, next_signatures, class_id, n_near) of every row.

    The edited text has the last half of the code points (rounded down) replaced by the first as many of the next
    document's. Rows of one id follow each other by a hash of their text; rows equal in both count as one, and rows
    without an id come last. class_id is the smallest id with an equal set (null if none has an id), n_near the number
    of other sets with at least the likeness ``least``.
    """
    lowest = -(1 << 63)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = df.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("text")) \
        .select(F.coalesce("doc_id", F.lit(lowest)).alias("id"), F.xxhash64("text").alias("h"), "text")
    own, named = classes(base.select("id", "h", F.when(F.col("id") != lowest, F.col("id")).alias("doc_id"), signatures(F.col("text"), chain).alias("s")))
    near = named.select("node", "key", "class_id").join(near_numbers(named, least), "node", "left") \
        .select("key", "class_id", F.coalesce("n_near", F.lit(0)).alias("n_near"))
    placed = own.select("id", "h", "key").distinct().join(near, "key").select("id", "h", "class_id", "n_near")
    rows = base.select("id", "h", "text")
    after = successors(base.select("id", "h", F.length("text").alias("n")).distinct())
    # each row hands its beginning and its set to the row before it
    before = after.select(F.col("next_id").alias("id"), F.col("next_h").alias("h"), F.col("id").alias("to_id"), F.col("h").alias("to_h"), (F.floor(F.col("n") / 2)).cast("int").alias("half"))
    handed = rows.join(before, ["id", "h"]).select(
        F.col("to_id").alias("id"), F.col("to_h").alias("h"), F.left("text", F.col("half")).alias("start"), signatures(F.col("text"), chain).alias("next_signatures")) \
        .groupBy("id", "h").agg(F.first("start").alias("start"), F.first("next_signatures").alias("next_signatures"))
    half = F.floor(F.length("text") / 2).cast("int")
    both = rows.join(handed, ["id", "h"]).join(placed, ["id", "h"]).withColumn("edited", F.concat(F.left("text", F.length("text") - half), F.col("start")))
    return both.select(F.when(F.col("id") != lowest, F.col("id")).alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("text"), chain).alias("signatures"),
                       signatures(F.col("edited"), chain).alias("edited_signatures"), "next_signatures", "class_id", "n_near")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id, n_near)."""
    return edited(df, id_col, text_col).select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("signatures")).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"), "class_id", "n_near")
