"""Ranked lexical search by pipelined term partitioning.

Documents are indexed in buckets (the rows of one Arrow batch): per bucket and
term the documents that hold it, with their counts, and once per bucket the
lengths.  Terms have owners, one per stage: the rarest first, by the share of
documents that hold them.  An item's bundle of one bucket is a sparse
accumulator (documents and integer scores).  It passes the owners' stages one
after another; each stage cogroups the bundles with its owners' postings and
adds its contributions, so a bundle and what it meets never exceed a bucket's
documents and a block of items.

After each stage a bundle drops documents that cannot come among its bucket's
first ``TOP`` any more: those whose score, with all that later owners could
still add, stays below the present score of the ``TOP``-th.  This is exact, and
keeps bundles small until the frequent terms' stage, after which only the
``TOP`` best of a bucket go on to the final selection.

Terms are maximal runs of letters and digits of ASCII and of all other
characters beyond it, A-Z taken as a-z.  While documents are indexed, a bitmap of
fixed size (``BITS`` bits) of the items' terms keeps most others out; the join with the
items' terms is exact.

A null text has no terms.  Every row of ``documents`` is a document, and every
row of ``benchmark`` an item, also where ids are null or repeated; null ids
come last among equal scores, rows with equal ids and scores are told apart by nothing
else.  Other columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from objsync.llm.common import byte_texts, ship, table, written

TOP = 10
BITS = 23
_MAP_BITS = 32_768  # of one bitmap row
BLOCK = 256
#: Owners by share of documents that hold a term; the last owner has the rest.
SHARES = (0.01, 0.05, 0.2)
REMEMBERED = 200_000

#: Bytes of terms as they are, A-Z in lower case, all others as blanks.
_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BUNDLE = "bucket bigint, block int, item bigint, docs array<int>, scores array<bigint>"
_FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text, in order."""
    return text.translate(_TERMS).split()


def slot_of(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) >> (64 - BITS)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        items, terms = [], []
        for item, text in zip(b.column(0).to_pylist(), byte_texts(b.column(1))):
            own = sorted(set(terms_of(text)))
            items += [item] * len(own)
            terms += own
        slots = [slot_of(t) for t in terms]
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array([t.decode() for t in terms], pa.string()), pa.array(slots, pa.int64())], names=["item", "term", "slot"])


def _bitmap(asked: DataFrame) -> np.ndarray:
    """One bit per slot, set where an item's term falls: 2**BITS bits at most."""
    rows = asked.groupBy(F.expr(f"slot div {_MAP_BITS}").alias("row")).agg(F.bitmap_construct_agg(F.col("slot") % _MAP_BITS).alias("bits")).collect()
    out = np.zeros(1 << BITS, dtype=bool)
    for r in rows:
        out[r.row * _MAP_BITS : (r.row + 1) * _MAP_BITS] = np.unpackbits(np.frombuffer(r.bits, dtype=np.uint8), bitorder="little")
    return out


def _postings(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, bool] = {}
    flags, bucket = wanted.value, TaskContext.get().partitionId() << 32
    for b in batches:
        docs: dict[bytes, list[int]] = {}
        counts: dict[bytes, list[int]] = {}
        lengths = []
        for i, text in enumerate(byte_texts(b.column(1))):
            all_terms = terms_of(text)
            lengths.append(len(all_terms))
            for term, n in Counter(all_terms).items():
                yes = known.get(term)
                if yes is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    yes = known[term] = bool(flags[slot_of(term)])
                if yes:
                    docs.setdefault(term, []).append(i)
                    counts.setdefault(term, []).append(n)
        held = len(docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket] * (held + 1), pa.int64()), pa.array([None, *(t.decode() for t in docs)], pa.string()),
             pa.array([None, *docs.values()], pa.list_(pa.int32())), pa.array([None, *counts.values()], pa.list_(pa.int32())),
             pa.array([b.column(0).to_pylist(), *[None] * held], pa.list_(pa.int64())), pa.array([lengths, *[None] * held], pa.list_(pa.int64()))],
            names=["bucket", "term", "docs", "counts", "ids", "lengths"])
        bucket += 1


def index(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(bucket, term, docs, counts) for terms that items may ask for, and per
    bucket a row without term with (ids, lengths) of all its documents."""
    ship(docs.sparkSession)
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(asked))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "bucket bigint, term string, docs array<int>, counts array<int>, ids array<bigint>, lengths array<bigint>"
    return rows.mapInArrow(lambda b: _postings(b, wanted), schema)


def owners(asked: DataFrame, postings: DataFrame, n_docs: int, blocks: int, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """(term, block, stage, w, askers): a term's weight and owner, and the items of
    a block that ask for it, each with all that later owners could add to one document."""
    held = postings.filter("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    stage = reduce(lambda c, s: c + F.when(F.col("df") > s * n_docs, 1).otherwise(0), shares, F.lit(0))
    w = F.floor(1000 * F.log((2 * n_docs + 2) / (2 * F.col("df") + 1)))
    terms = written(asked.select("item", "term").join(held, "term").select("item", "term", stage.alias("stage"), w.alias("w")), "item-terms")
    later = terms.groupBy("item").agg(*[F.sum(F.when(F.col("stage") > s, F.col("w")).otherwise(0)).alias(f"l{s}") for s in range(len(shares) + 1)])
    rest = F.array(*[1_000_000 * F.col(f"l{s}") for s in range(len(shares) + 1)])  # a contribution is below 1,000,000 w
    both = terms.join(later, "item").withColumns({"block": F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"), "rest": F.element_at(rest, F.col("stage") + 1)})
    return both.groupBy("term", "block", "stage", "w").agg(F.collect_list(F.struct("item", "rest")).alias("askers"))  # about BLOCK items at most


def _meet(bundles: pa.Table, postings: pa.Table, n_docs: int, n_terms: int, top: int, last: bool) -> pa.Table:
    """One bucket and block: the bundles with a stage's contributions added."""
    rest: dict[int, int] = {}
    totals: dict[int, np.ndarray] = {}
    about = postings.filter(pc.is_null(postings["term"])).to_pylist()[0]
    ids, lengths = about["ids"], np.array(about["lengths"], dtype=np.int64)
    eight_m = 8 * (10 + (90 * lengths * n_docs) // max(n_terms, 1))
    for item, docs, scores in zip(bundles["item"].to_pylist(), bundles["docs"], bundles["scores"]):
        totals[item] = np.zeros(len(lengths), dtype=np.int64)
        totals[item][docs.values.to_numpy()] = scores.values.to_numpy()
    found = postings.filter(pc.is_valid(postings["term"]))
    for docs, counts, w, askers in zip(found["docs"], found["counts"], found["w"].to_pylist(), found["askers"].to_pylist()):
        at, tf = docs.values.to_numpy(), counts.values.to_numpy().astype(np.int64)
        adds = w * ((1_000_000_000 * tf) // (1000 * tf + eight_m[at]))
        for a in askers:
            if a["item"] not in totals:
                totals[a["item"]] = np.zeros(len(lengths), dtype=np.int64)
            totals[a["item"]][at] += adds
            rest[a["item"]] = a["rest"]
    out: list[tuple] = []
    for item, total in totals.items():
        at = np.flatnonzero(total)
        scores = total[at]
        if last:
            if len(at) > top:  # all that tie with the last one, then exactly by id
                at = at[scores >= np.partition(scores, -top)[-top]]
            best = sorted((-int(total[i]), ids[i] is None, ids[i] or 0, i) for i in at.tolist())[:top]
            out += [(item, ids[i], -s) for s, _, _, i in best]
        elif len(at):
            if len(at) > top and item in rest:
                can = scores + rest[item] >= np.partition(scores, -top)[-top]
                at, scores = at[can], scores[can]
            out.append((about["bucket"], about["block"], item, at.astype(np.int32), scores))
    columns = list(zip(*out)) or [()] * (3 if last else 5)
    if last:
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "block", "item", "docs", "scores"])


def _stage(n_docs: int, n_terms: int, top: int, last: bool):
    return lambda bundles, postings: _meet(bundles, postings, n_docs, n_terms, top, last)


def rank(items: DataFrame, docs: DataFrame, top: int = TOP, shares: tuple[float, ...] = SHARES, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item."""
    spark = docs.sparkSession
    ship(spark)
    items = written(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "items")
    asked = written(items.select("item", "text").mapInArrow(_item_terms, "item bigint, term string, slot bigint"), "asked-terms")
    postings = written(index(docs, asked), "postings")
    buckets = postings.filter("term is null")
    sums = buckets.select(
        F.sum(F.size(F.filter("lengths", lambda n: n > 0))).alias("n_docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n_terms")
    ).first()
    n_docs, n_terms, blocks = sums.n_docs or 0, sums.n_terms or 0, -(-items.count() // block) or 1
    owned = written(owners(asked, postings, n_docs, blocks, shares), "owners")
    about = buckets.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "ids", "lengths")
    bundles = spark.createDataFrame([], _BUNDLE)
    for s in range(len(shares) + 1):
        last = s == len(shares)
        theirs = postings.filter("term is not null").select("bucket", "term", "docs", "counts").join(owned.filter(F.col("stage") == s).drop("stage"), "term")
        theirs = theirs.unionByName(about, allowMissingColumns=True)

        pair = bundles.groupBy("bucket", "block").cogroup(theirs.groupBy("bucket", "block"))
        bundles = pair.applyInArrow(_stage(n_docs, n_terms, top, last), _FOUND if last else _BUNDLE)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = bundles.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


_RUNS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13 = f"""WITH d AS (SELECT doc_id, unnest({_RUNS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
q AS (SELECT DISTINCT item_id, unnest({_RUNS}) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
sums AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * CAST(n AS BIGINT) * nn) // ll))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), s GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sums WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {TOP}"""
