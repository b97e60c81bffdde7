"""N-gram Jaccard join with prefix filters under several token orders.

A document's set has its distinct word shingles.  Documents with equal sets
form a class; classes are compared, by their smallest document.

Two sets of a given similarity share a token among the first few of either
under any order of all tokens.  ``ORDERS`` orders are used.  All put rare
tokens first, by a sketch of ``2**SKETCH_BITS`` counters that every task adds to
(any order is right; this one keeps frequent tokens out of the prefixes), and
break ties by different hashes.  Pairs come from ``MEET`` shared tokens in
the (so much longer) prefixes of the first order, with fitting sizes and
positions; those whose prefixes do not meet
under each other order too are dropped, and only the rest is verified against
the whole texts.

Pairs are drawn in two steps, so that a group of near copies is not expanded
into all its pairs.  First every class is paired with the cleanest class of
each prefix token (the one with the fewest rarer tokens); verified links are
joined into components.  Then, for tokens whose classes still lie in several
components, all pairs across components are compared.  No link between
components is lost, and links inside a component cannot change it.

Texts without words, and null texts, have empty sets and stand alone.  A null
``doc_id`` is larger than any other and stays null in the result.  Rows are
documents, also where they share an id: a class is a node of its own, whatever ids it has, and only
the result maps components to their smallest ``doc_id``.  Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import as_long, byte_texts, discard, distinct, mix64, seed64, ship, table, window_names, word_names, written

WORDS = 3
PERCENT = 90
ORDERS = 3
MEET = 3  # tokens that the prefixes of the first order, longer by MEET - 1, must share
SKETCH_BITS = 20
SLICES = 64
LAST_ID = 2**63 - 1


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit names of the distinct shingles of a text."""
    names = word_names(text, lower=True)
    width = min(words, len(names))
    return distinct(window_names(names, width, 10 * width)) if width else names


def slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n + 1 - -(-percent * n // 100)


def ordered_prefix(tokens: np.ndarray, rarity: np.ndarray, order: int, percent: int, meet: int = 1) -> np.ndarray:
    """The first tokens of a set under one of the orders; similar sets share
    ``meet`` of them, or all that they must have in common if that is fewer."""
    p = prefix_length(len(tokens), percent) + meet - 1
    key = (rarity[slot(tokens)].astype(np.uint64) << np.uint64(56)) | (mix64(tokens * seed64(500 + order)) >> np.uint64(8))
    first = np.argpartition(key, p - 1)[:p] if p < len(key) else np.arange(len(key))
    return tokens[first[np.argsort(key[first])]]


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row per document, and at the end the task's counters in slices."""
    names = ["doc_id", "d", "t", "n", "s1", "s2", "slice", "counts"]
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for b in batches:
        sets = [shingles(x, words) for x in byte_texts(b.column(3))]
        if sets:
            tokens = np.concatenate(sets)
            if len(tokens):
                np.add(counts, np.bincount(slot(tokens), minlength=len(counts)).astype(np.uint32), out=counts)
        sums = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        low, high = np.array([x & (2**64 - 1) for x in sums], dtype=np.uint64), np.array([x >> 64 for x in sums], dtype=np.uint64)
        n = len(sets)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([len(s) for s in sets], pa.int64()), as_long(low), as_long(high), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
    parts = [(i, c.tobytes()) for i, c in enumerate(np.split(counts, SLICES)) if c.any()]
    if parts:
        n = len(parts)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 6, pa.array([i for i, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], names=names)


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            total[i] = total.get(i, 0) + np.frombuffer(c, dtype=np.uint32).astype(np.uint64)
    for i, c in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([c.tobytes()], pa.binary())], names=["slice", "counts"])


def rarity_of(rows: DataFrame) -> np.ndarray:
    """Half powers of two of the counters: ``2**SKETCH_BITS`` bytes whatever the input."""
    added = rows.filter("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(_add_counts, "slice int, counts binary")
    counts = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), dtype=np.uint64)
    for r in added.toLocalIterator():
        counts[r["slice"]] = np.frombuffer(r["counts"], dtype=np.uint64)
    counts = counts.ravel()
    usual = max(float(np.median(counts)), 1.0)  # below this a counter says more about its other tokens
    return np.minimum(np.floor(2 * np.log2(np.maximum(counts / usual, 1.0))), 255).astype(np.uint8)


def _prefixes(batches: Iterator[pa.RecordBatch], rarity, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen, parts = set(), []
        for text in byte_texts(b.column(0)):
            s = shingles(text, words)
            if not len(s):
                continue
            x = xxhash.xxh3_128_intdigest(s.tobytes())
            if x in seen:  # an equal set of this batch says the same
                continue
            seen.add(x)
            parts.append((ordered_prefix(s, rarity.value, 1, percent, MEET), x & (2**64 - 1), x >> 64))
        if parts:
            lengths = [len(p) for p, _, _ in parts]
            low, high = (np.repeat(np.array([x[i] for x in parts], dtype=np.uint64), lengths) for i in (1, 2))
            at = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])
            yield pa.RecordBatch.from_arrays([as_long(np.concatenate([p for p, _, _ in parts])), as_long(low), as_long(high), pa.array(at)], names=["token", "s1", "s2", "pos"])


def _candidates(batches: Iterator[pa.RecordBatch], rarity, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Adds the prefixes of the other orders, as 32-bit parts of the tokens."""
    for b in batches:
        sets = [shingles(x, words) for x in byte_texts(b.column(1))]
        more = [[(ordered_prefix(s, rarity.value, o, percent) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32) for s in sets] for o in range(2, ORDERS + 1)]
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(m, pa.list_(pa.int32())) for m in more]], names=[*b.schema.names, *[f"p{o}" for o in range(2, ORDERS + 1)]])


def _verified(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}
    for b in batches:
        a, c, ta, tc = b.columns
        out = []
        for x, y, tx, ty in zip(a.to_pylist(), c.to_pylist(), byte_texts(ta), byte_texts(tc)):
            sx = known.get(x)
            if sx is None:  # rows come grouped by a
                known = {x: shingles(tx, words)}
                sx = known[x]
            sy = shingles(ty, words)
            both = len(np.intersect1d(sx, sy, assume_unique=True))
            out.append(100 * both >= percent * (len(sx) + len(sy) - both))
        keep = pa.array(out, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(keep), c.filter(keep)], names=["a", "b"])


def verify(pairs: DataFrame, cand: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that meet under every other order and are similar."""
    few = ["r", *[f"p{o}" for o in range(2, ORDERS + 1)]]
    side = lambda s: cand.select(*[F.col(c).alias(f"{s}_{c}") for c in few])
    met = pairs.join(side("x"), F.col("a") == F.col("x_r")).join(side("y"), F.col("b") == F.col("y_r"))
    for o in range(2, ORDERS + 1):
        met = met.filter(F.arrays_overlap(f"x_p{o}", f"y_p{o}"))
    met = written(met.select("a", "b").distinct(), "jaccard-pairs")
    texts = cand.select("r", "text")
    full = met.join(texts.select(F.col("r").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("r").alias("a"), F.col("text").alias("ta")), "a")
    return written(full.select("a", "b", "ta", "tb").mapInArrow(lambda it: _verified(it, words, percent), "a bigint, b bigint"), "jaccard-links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Alternating star rounds: edges move to ever smaller neighbours until each
    node points at its component; every round is written.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while not _settled(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _settled(edges: DataFrame) -> bool:
    """Every node has one edge, to a node that has none of its own."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("root")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("root").alias("root")).filter("out > 1 or (out = 1 and root = 1)").isEmpty()


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({"d": F.coalesce("doc_id", F.lit(LAST_ID)), "t": F.xxhash64("text")})
    kind = "doc_id bigint, d bigint, t bigint, n bigint, s1 bigint, s2 bigint, slice int, counts binary"
    made = written(rows.select("doc_id", "d", "t", "text").mapInArrow(lambda b: _sets(b, words), kind), "jaccard-sets")
    rarity = spark.sparkContext.broadcast(rarity_of(made))
    sets = made.filter("slice is null").drop("slice", "counts")
    # a class is known by its 128-bit name, and from here on by the number r that it gets when written
    classes = sets.filter("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("d", "t")).alias("o"), F.first("n").alias("n"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("r"), "s1", "s2", "o.d", "o.t", "n"), "jaccard-classes")

    tokens = written(rows.select("text").mapInArrow(lambda b: _prefixes(b, rarity, words, percent), "token bigint, s1 bigint, s2 bigint, pos int"), "jaccard-prefixes")
    name = F.struct("s1", "s2")
    shared = tokens.groupBy("token").agg(F.min(name).alias("x"), F.max(name).alias("y")).filter("x < y").select("token")
    posts = tokens.join(shared, "token").dropDuplicates(["token", "s1", "s2"])
    posts = written(posts.join(classes.select("s1", "s2", "r", "n"), ["s1", "s2"]).select("token", "r", "n", "pos"), "jaccard-posts")
    discard(tokens)

    def candidates(pairs: DataFrame) -> DataFrame:
        """Texts of the classes in ``pairs``, and their prefixes under the other orders."""
        asked = pairs.select(F.explode(F.array("a", "b")).alias("r")).distinct().join(classes.select("r", "d", "t"), "r")
        cand = rows.join(asked, ["d", "t"]).dropDuplicates(["d", "t"]).select("r", "text")
        return written(cand.mapInArrow(lambda b: _candidates(b, rarity, words, percent), "r bigint, text string" + "".join(f", p{o} array<int>" for o in range(2, ORDERS + 1))), "jaccard-candidates")

    def meeting(both: DataFrame) -> DataFrame:
        """Pairs of x and y whose sizes allow the similarity, as does what
        follows each token they share, and that share enough tokens."""
        need = F.ceil(F.expr(f"{percent} * (x.n + y.n) / {100 + percent}.0"))
        both = both.filter(F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"))
        both = both.filter(F.expr("least(x.n - x.pos, y.n - y.pos)") >= need - (MEET - 1))
        shared = both.groupBy(F.least("x.r", "y.r").alias("a"), F.greatest("x.r", "y.r").alias("b"), need.alias("need")).agg(F.count("*").alias("c"))
        return shared.filter(F.col("c") >= F.least(F.lit(MEET), F.col("need"))).select("a", "b")

    # every class with the cleanest class of each of its tokens
    lead = posts.groupBy("token").agg(F.min(F.struct("pos", "n", "r")).alias("l")).select("token", "l.*")
    pairs = written(meeting(posts.alias("x").join(lead.alias("y"), "token").filter("x.r <> y.r")), "jaccard-leads")
    links = verify(pairs, candidates(pairs), words, percent)
    found = components(links)

    # tokens whose classes lie in several components: every pair across them
    placed = posts.join(found.withColumnRenamed("node", "r"), "r", "left").withColumn("component", F.coalesce("component", "r"))
    placed = written(placed, "jaccard-placed")
    torn = placed.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("token")
    left = written(placed.join(torn, "token"), "jaccard-rest")
    across = left.alias("x").join(left.alias("y"), F.expr("x.token = y.token and x.component < y.component"))
    pairs = written(meeting(across), "jaccard-across")
    more = verify(pairs, candidates(pairs), words, percent)
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    of = classes.join(found, F.col("r") == F.col("node"), "left").select("s1", "s2", "d", F.coalesce("component", "r").alias("node"))
    of = of.join(of.groupBy("node").agg(F.min("d").alias("component")), "node").select("s1", "s2", "component")
    out = sets.join(of, ["s1", "s2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("d")).alias("c"))
    return out.select("doc_id", "n_shingles", F.when(F.col("c") < LAST_ID, F.col("c")).alias("component_id"))


def keep_one(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of ``docs`` without those that a document of a smaller id stands
    for.  Rows that repeat an id are not told apart: all stay or all go."""
    gone = written(link(docs, words, percent).filter("component_id <> doc_id").select("doc_id").distinct(), "jaccard-gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"))
