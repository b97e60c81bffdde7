"""Document fingerprints: threshold-scaled sketches of word shingles.

The sketch of a text keeps every distinct shingle hash below a fixed fraction
of the hash range, whatever the length of the text, and at least its ``FLOOR``
smallest hashes, so that short texts compare too.  Both parts of the rule
merge: the rule applied to the union of two sketches gives the sketch of the
union of their shingle sets.  Two sketches are compared over the hashes up to
the lower of the two bounds below which each of them is complete; there they
are plain samples of both sets, so the share of common hashes estimates
likeness (Jaccard) or containment however unequal the texts are.

Words are the maximal runs between space and 09-0D; a shingle is ``WORDS``
consecutive words, with fewer words the whole sequence; its hash is the first
64 bits of its MD5, in hexadecimal, so sketches sort and compare as text.

Everything is built of Spark's own functions.  Null texts count as empty; an
empty text has the empty fingerprint, which is like another empty one (1) and
unlike all others (0).  The document after a document is the one of the next
larger ``doc_id`` (null is larger than any), after the last comes the first; rows that share
a ``doc_id`` have the same next document, and stand for one document to the one
before, which sees the text of the smallest 64-bit hash among them.  Each row keeps
its own result row.  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from objsync.llm.common import table, written

WORDS = 5
SCALE = 16
FLOOR = 64
_ABOVE_ALL = "g"  # after every hexadecimal digit


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _top(scale: int) -> str:
    """The largest hash below the fraction."""
    return f"{2**64 // scale - 1:016x}"


def sketch(text: Column, words: int = WORDS, scale: int = SCALE, floor: int = FLOOR) -> Column:
    """Sorted hashes (16 hexadecimal digits each) that the rule keeps."""

    def of(w: Column) -> Column:
        hashes = F.transform(w, lambda _, i: F.substring(F.md5(F.concat_ws(" ", *[F.get(w, i + j) for j in range(words)])), 1, 16))
        return _let(F.slice(hashes, 1, F.greatest(F.size(w) - words + 1, F.lit(1))), kept)

    def kept(h: Column) -> Column:
        low = F.array_distinct(F.filter(h, lambda x: x <= _top(scale)))
        least = F.slice(F.sort_array(F.array_distinct(h)), 1, floor)
        return _let(low, lambda k: F.when(F.size(k) >= floor, F.sort_array(k)).otherwise(least))

    return _let(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), ""), of)


def merge(a: Column, b: Column, scale: int = SCALE, floor: int = FLOOR) -> Column:
    """The sketch of the union of two shingle sets, from their sketches."""
    return _let(
        F.sort_array(F.array_union(a, b)),
        lambda u: F.slice(u, 1, F.greatest(F.size(F.filter(u, lambda h: h <= _top(scale))), F.lit(floor))),
    )


def _bound(k: Column, scale: int, floor: int) -> Column:
    """Up to here the sketch holds every hash of its set."""
    return F.when(F.size(k) < floor, F.lit(_ABOVE_ALL)).otherwise(F.greatest(F.lit(_top(scale)), F.element_at(k, -1)))


def _shares(a: Column, b: Column, scale: int, floor: int) -> Column:
    """(own, other, common): sizes below the common bound."""
    return _let(
        F.least(_bound(a, scale, floor), _bound(b, scale, floor)),
        lambda t: F.struct(
            F.size(F.filter(a, lambda h: h <= t)).alias("own"),
            F.size(F.filter(b, lambda h: h <= t)).alias("other"),
            F.size(F.filter(F.array_intersect(a, b), lambda h: h <= t)).alias("common"),
        ),
    )


def likeness(a: Column, b: Column, scale: int = SCALE, floor: int = FLOOR) -> Column:
    """Estimated Jaccard likeness of two sketched sets; 1 if both are empty."""
    return _let(
        _shares(a, b, scale, floor),
        lambda s: F.when(s["own"] + s["other"] == 0, F.lit(1.0)).otherwise(s["common"] / (s["own"] + s["other"] - s["common"])),
    )


def containment(a: Column, b: Column, scale: int = SCALE, floor: int = FLOOR) -> Column:
    """Estimated share of the first set that the second holds; 1 if the first is
    empty, null if it shows no hash below the common bound."""
    return _let(
        _shares(a, b, scale, floor),
        lambda s: F.when(F.size(a) == 0, F.lit(1.0)).when(s["own"] > 0, s["common"] / s["own"]),
    )


def merged(docs: DataFrame, by: str, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """(by, hash): the sketches of all texts of a group merged, as rows, so that
    a group of any size is spread; only the fixed fraction counts for groups."""
    low = docs.select(by, F.explode(sketch(F.col("text"), words, scale, 0)).alias("hash"))
    return low.distinct()


def contained(docs: DataFrame, groups: DataFrame, by: str, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """(doc_id, by, n_hashes, share): for every document and every group that
    ``merged`` made of other texts, the estimated share of the document that the group holds
    (pairs without a common hash are left out)."""
    low = docs.select("doc_id", sketch(F.col("text"), words, scale, 0).alias("k")).select("doc_id", F.size("k").alias("n_hashes"), F.explode("k").alias("hash"))
    hits = low.join(groups, "hash").groupBy("doc_id", "n_hashes", by).agg(F.count(F.lit(1)).alias("common"))
    return hits.select("doc_id", by, F.col("n_hashes").cast("long").alias("n_hashes"), (F.col("common") / F.col("n_hashes")).alias("share"))


def following(ids: DataFrame) -> DataFrame:
    """(doc_id, k, next: struct<doc_id, pick>) of distinct ids in ascending
    order, null last; the first follows the last.

    Ids are spread by ranges and ordered within each; only one row per range,
    its first id, is looked at across ranges.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = ids.repartitionByRange(parts, F.col("doc_id").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    spread = written(spread, "ordered-ids")
    order = [F.col("doc_id").asc_nulls_last()]
    key = F.struct("doc_id", "pick")
    null_last = F.struct(F.col("doc_id").isNull(), "doc_id", "pick")
    firsts = spread.groupBy("part").agg(F.min(null_last).alias("f")).select("part", F.struct("f.doc_id", "f.pick").alias("f"))
    ranges = Window.orderBy("part")  # one row per range
    after = firsts.select("part", F.coalesce(F.lead("f").over(ranges), F.first("f").over(ranges)).alias("after"))
    inner = Window.partitionBy("part").orderBy(*order)
    return spread.join(after, "part").select("doc_id", "k", F.coalesce(F.lead(key).over(inner), F.col("after")).alias("next"))


def _packed(k: Column) -> Column:
    return F.unhex(F.array_join(k, ""))


def _unpacked(packed: Column) -> Column:
    n = (F.octet_length(packed) / 8).cast("int")
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), n), lambda i: F.lower(F.hex(F.substring(packed, i * 8 - 7, F.lit(8))))))


def with_edits(docs: DataFrame, words: int = WORDS, scale: int = SCALE, floor: int = FLOOR) -> DataFrame:
    """doc_id, text, edited, next_text's head and the three sketches of every row: its own,
    its edited text's and the next document's.

    Texts are shuffled once, by id, and read twice: to show their beginning to
    the row before, and to take the beginning of the next.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    ids = rows.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("pick"), F.max(quarter).alias("k"))
    nexts = written(following(ids), "next-ids")

    def key(c: str) -> list[Column]:  # an id without nulls, so that all joins and groups use one partitioning
        return [F.coalesce(c, F.lit(0).cast("long")).alias("id"), F.col(c).isNull().alias("no_id")]

    asked = nexts.select(*key("next.doc_id"), F.col("next.pick").alias("pick"), F.col("doc_id").alias("before"), "k")
    rows = rows.select(*key("doc_id"), "text", _packed(sketch(F.col("text"), words, scale, floor)).alias("own"))
    # not an equality of two columns: that would become a key and part the two joins' partitionings
    picked = F.xxhash64("text").bitwiseXOR(F.col("pick")) == 0
    shown = rows.hint("merge").join(asked, ["id", "no_id"]).filter(picked)
    shown = shown.select(*key("before"), F.expr("left(text, k)").alias("head"), F.col("own").alias("next")).dropDuplicates(["id", "no_id"])
    both = rows.hint("merge").join(shown, ["id", "no_id"]).withColumn("doc_id", F.when(~F.col("no_id"), F.col("id")))
    edited = F.concat(F.expr("left(text, length(text) - floor(length(text) / 4))"), F.expr("left(head, floor(length(text) / 4))"))
    both = both.select("doc_id", "text", edited.alias("edited"), "own", "next")
    return both.select("doc_id", "text", "edited", _unpacked(F.col("own")).alias("own"), sketch(F.col("edited"), words, scale, floor).alias("changed"), _unpacked(F.col("next")).alias("next"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, changed, after = F.col("own"), F.col("changed"), F.col("next")
    return with_edits(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join(own, "").alias("fingerprint"),
        F.array_join(changed, "").alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"),
        likeness(own, after).alias("near_next"),
        containment(own, changed).alias("contained_edited"),
        containment(own, after).alias("contained_next"),
    )


def _sql_likeness(a: str, b: str) -> str:
    return f"""SELECT doc_id, CASE WHEN o + t = 0 THEN 1.0 ELSE c / CAST(o + t - c AS DOUBLE) END AS near, CASE WHEN len(a) = 0 THEN 1.0 WHEN o > 0 THEN c / CAST(o AS DOUBLE) END AS held FROM (
  SELECT doc_id, a, len([x for x in a if x <= m]) AS o, len([x for x in b if x <= m]) AS t, len([x for x in list_intersect(a, b) if x <= m]) AS c FROM (
    SELECT doc_id, {a} AS a, {b} AS b, least(CASE WHEN len({a}) < {FLOOR} THEN '{_ABOVE_ALL}' ELSE greatest('{_top(SCALE)}', {a}[-1]) END,
      CASE WHEN len({b}) < {FLOOR} THEN '{_ABOVE_ALL}' ELSE greatest('{_top(SCALE)}', {b}[-1]) END) AS m FROM sketches))"""


OP11 = rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n FROM documents),
e AS (SELECT a.doc_id, a.text, a.i, b.i AS j, left(a.text, length(a.text) - length(a.text) // 4) || left(b.text, length(a.text) // 4) AS edited FROM t a JOIN t b ON b.i = a.i % a.n + 1),
texts AS (SELECT i, 0 AS kind, text AS x FROM e UNION ALL SELECT i, 1, edited FROM e),
w AS (SELECT i, kind, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w FROM texts),
hashes AS (SELECT DISTINCT i, kind, substr(md5(array_to_string(w[p:p + {WORDS - 1}], ' ')), 1, 16) AS h FROM w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS u(p) WHERE len(w) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i, kind ORDER BY h) AS r FROM hashes),
kept AS (SELECT i, kind, list(h ORDER BY h) AS k FROM ranked WHERE h <= '{_top(SCALE)}' OR r <= {FLOOR} GROUP BY i, kind),
sketches AS (SELECT e.doc_id, e.text, e.edited, coalesce(o.k, []::VARCHAR[]) AS own, coalesce(c.k, []::VARCHAR[]) AS changed, coalesce(x.k, []::VARCHAR[]) AS next
  FROM e LEFT JOIN kept o ON o.i = e.i AND o.kind = 0 LEFT JOIN kept c ON c.i = e.i AND c.kind = 1 LEFT JOIN kept x ON x.i = e.j AND x.kind = 0),
ce AS ({_sql_likeness("own", "changed")}), cn AS ({_sql_likeness("own", "next")})
SELECT s.doc_id, CAST(length(s.text) AS BIGINT) AS n_chars, sha256(s.edited) AS edited_sha256, array_to_string(s.own, '') AS fingerprint, array_to_string(s.changed, '') AS edited_fingerprint,
  ce.near AS near_edited, cn.near AS near_next, ce.held AS contained_edited, cn.held AS contained_next FROM sketches s JOIN ce USING (doc_id) JOIN cn USING (doc_id)"""
