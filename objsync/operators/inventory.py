"""Key-first bucket inventory.

Every existence probe of the plans differs only in the *bucket* (target,
reversed-ACL, flipped account).  So the inventory is grouped once by object
key into ``objects: map<bucket, struct<size, storage_class>>`` and the
manifest joins it once on ``id/file_name``; each probe is then a map look-up
in the joined row.  One shuffle per side instead of one join per probe.

The map holds one entry per bucket listing the key, so its size is bounded
by the number of listed buckets, never by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from objsync.operators.relational import last_wins

INVENTORY_COLUMNS = ("bucket", "key", "size", "storage_class")


def normalize_inventory(inv: DataFrame) -> DataFrame:
    """Project a listing to ``bucket, key, size, storage_class[, seq]``."""
    cols = [F.col("bucket").cast("string"), F.col("key").cast("string"), F.col("size").cast("bigint")]
    cols.append(F.col("storage_class").cast("string") if "storage_class" in inv.columns
                else F.lit(None).cast("string").alias("storage_class"))
    if "seq" in inv.columns:
        cols.append(F.col("seq").cast("bigint"))
    return inv.select(*cols)


def dedupe_inventory(inv: DataFrame, order_col: str = "seq") -> DataFrame:
    """Unique on ``(bucket, key)``; the listing with the greatest
    ``order_col`` wins.  Without an order column the listing is taken as
    unique already (one listing per bucket cannot repeat a key)."""
    inv = normalize_inventory(inv)
    if order_col in inv.columns:
        return last_wins(inv, ["bucket", "key"], order_col).drop(order_col)
    return inv


def restrict_to_buckets(inv: DataFrame, buckets: DataFrame) -> DataFrame:
    """Keep only the listed (expected) buckets (a semi join needs no
    distinct)."""
    return inv.join(buckets.select("bucket"), "bucket", "left_semi")


def missing_buckets(expected: DataFrame, inv: DataFrame) -> DataFrame:
    """S7 FIX: expected buckets with no object in the inventory (a listing
    that failed looks like an empty bucket; report it instead)."""
    present = inv.select("bucket").distinct()
    return expected.join(present, "bucket", "left_anti")


def inventory_by_key(inv: DataFrame, dedupe: bool = True, order_col: str = "seq") -> DataFrame:
    """``key -> objects: map<bucket, struct<size, storage_class>>`` in one
    exchange by key.

    ``order_col`` numbers the listings that were put together: of a bucket's
    entries for a key the one of the last listing wins (A9/U1).  The entries of a key are
    gathered as a set, whose partial aggregation collapses copies of a hot
    key map-side and which holds at most an entry per listing and bucket (as a
    listing names an object once).  Without an order column, or with ``dedupe`` off,
    the smallest of a bucket's entries is kept, so the result is deterministic.
    """
    inv = normalize_inventory(inv)
    ordered = dedupe and order_col in inv.columns
    seq = F.col(order_col) if ordered else F.lit(0).cast("bigint")
    found = inv.groupBy("key").agg(F.collect_set(F.struct(F.col("bucket"), seq.alias("seq"), F.col("size"), F.col("storage_class"))).alias("_e"))

    def one_per_bucket(e: Column) -> Column:
        beside = (lambda i: F.get(e, i + 1)) if ordered else (lambda i: F.when(i > 0, F.get(e, i - 1)))
        return F.filter(e, lambda x, i: beside(i).isNull() | ~beside(i)["bucket"].eqNullSafe(x["bucket"]))

    entries = F.element_at(F.transform(F.array(F.array_sort("_e")), one_per_bucket), 1)
    value = lambda x: F.struct(x["bucket"], F.struct(x["size"].alias("size"), x["storage_class"].alias("storage_class")))
    return found.select("key", F.map_from_entries(F.transform(F.filter(entries, lambda x: x["bucket"].isNotNull()), value)).alias("objects"))


#: A key is hot when it has more than one in so many of the manifest's rows;
#: there are fewer than so many of them, whatever the data.
HOT_SHARE = 1_000


def probe_join(manifest: DataFrame, inv_by_key: DataFrame, key: Column, objects_col: str = "objects", spread: int = 0) -> DataFrame:
    """Left join of the manifest on one probe key; adds ``objects_col``
    (null when no bucket lists the key).

    The right side is an aggregate, which Spark's skewed-join rule does not split around, so all
    rows of a key meet in one task.  With ``spread`` the keys are counted first (a partial
    aggregation); rows of hot keys are dealt over ``spread`` parts, and only those keys'
    inventory entries are repeated for each part.  The list of hot keys is bounded by
    ``HOT_SHARE`` and therefore broadcast.
    """
    right = inv_by_key.select(F.col("key").alias("_probe"), F.col("objects").alias(objects_col))
    left = manifest.withColumn("_probe", key)
    if not spread:
        return left.join(right, "_probe", "left").drop("_probe")
    keys = left.select("_probe")
    total = keys.count()
    hot = F.broadcast(keys.filter("_probe is not null").groupBy("_probe").count().filter(F.col("count") * HOT_SHARE > total).select("_probe", F.lit(True).alias("_hot")))
    # dealt by the row's own values, so that a task that runs again deals alike
    values = [c for c in manifest.columns if not isinstance(manifest.schema[c].dataType, MapType)]
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(*values), F.lit(spread))).otherwise(F.lit(0).cast("bigint"))
    left = left.join(hot, "_probe", "left").withColumn("_part", part).drop("_hot")
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))
    right = right.join(hot, "_probe", "left").withColumn("_part", F.explode(parts)).drop("_hot")
    return left.join(right, ["_probe", "_part"], "left").drop("_probe", "_part")


def listed(objects_col: str, bucket) -> Column:
    """Does ``bucket`` list the probed key?"""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return F.coalesce(F.map_contains_key(F.col(objects_col), b), F.lit(False))


def listed_size(objects_col: str, bucket) -> Column:
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return F.try_element_at(F.col(objects_col), b).getField("size")
