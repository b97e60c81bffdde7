"""The index as a table of hash buckets that edits rewrite in part.

``did_bucket`` is a hash of ``did``; every bucket is a folder of its own.  An
edit (merge, URL removal, record delete) finds the buckets that its
dids fall into, a list no longer than the number of buckets, reads only those (partition
pruning) and replaces only those (dynamic partition overwrite, moved into place when all tasks
are done).  Files of other buckets are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.config import PlanConfig
from objsync.plans import index as I
from objsync.session import release_shuffles

BUCKETS = 256
_BY = "did_bucket"


def did_bucket(did: Column, buckets: int) -> Column:
    return F.pmod(F.hash(did), F.lit(buckets)).cast("int")


def _tasks(spark: SparkSession, buckets: int) -> int:
    """So many tasks that one of them has dids of one bucket only: Spark deals rows by the
    remainder of the hash that ``did_bucket`` takes, and this is a multiple of the buckets."""
    return buckets * -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // buckets)


def _write(df: DataFrame, path: str, buckets: int) -> None:
    """Write records that are dealt by did over ``_tasks`` tasks: each writes a file of its bucket."""
    by = df.withColumn(_BY, did_bucket(F.col("did"), buckets))
    # sorted by did, so that files have narrow ranges of it in their footers
    (by.sortWithinPartitions(_BY, "did").write.mode("overwrite").option("compression", "zstd")
     .option("partitionOverwriteMode", "dynamic").partitionBy(_BY).parquet(path))
    release_shuffles(df.sparkSession)


def create_index_table(index: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A new table; every bucket gets its folder when it gets its first record."""
    _write(index.repartition(_tasks(index.sparkSession, buckets), "did"), path, buckets)


def read_index_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(I.INDEX_SCHEMA + f", {_BY} int").parquet(path)


def _edit(spark: SparkSession, path: str, dids: DataFrame, edit: Callable[[DataFrame, int], DataFrame], buckets: int) -> list[int]:
    """Replace the buckets of ``dids`` by what ``edit`` makes of their records, which it deals
    by did over the given number of tasks and leaves there, so that they are shuffled once;
    returns the buckets' numbers."""
    touched = sorted(r[_BY] for r in dids.select(did_bucket(F.col("did"), buckets).alias(_BY)).distinct().collect())
    if not touched:
        return []
    table = read_index_table(spark, path)
    files = set(table.inputFiles())
    old = table.filter(F.col(_BY).isin(touched)).drop(_BY)
    _write(edit(old, _tasks(spark, buckets)).select(*old.columns), path, buckets)
    # a bucket left without records keeps its old files: its folder goes
    kept = {f.rsplit("/", 2)[-2] for f in files.intersection(read_index_table(spark, path).inputFiles())}
    jvm = spark.sparkContext._jvm
    for b in touched:
        if f"{_BY}={b}" in kept:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{_BY}={b}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return touched


def merge_into(spark: SparkSession, path: str, updates: DataFrame, cfg: PlanConfig, buckets: int = BUCKETS) -> list[int]:
    """C6 on the table; updates with an invalid ACL touch nothing."""
    good = updates.filter(F.col("valid") & F.col("url").isNotNull())
    return _edit(spark, path, good, lambda old, n: I.merge_index(old, good, cfg, partitions=n), buckets)


def remove_urls_from(spark: SparkSession, path: str, removals: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """C7 on the table."""
    return _edit(spark, path, removals, lambda old, n: I.remove_index_urls(old.repartition(n, "did"), removals), buckets)


def delete_from(spark: SparkSession, path: str, dids: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """C8 on the table."""
    return _edit(spark, path, dids, lambda old, n: I.delete_index_records(old.repartition(n, "did"), dids), buckets)
