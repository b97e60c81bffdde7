"""Generic relational operators: last-wins dedupe, file-order row numbers,
chunk ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_col``
    (``dict[k] = v`` applied in ``order_col`` order).

    ``max_by`` is a declarative aggregate, so Spark combines map-side before
    the shuffle: a key repeated in a third of all rows costs one row per
    map task, not one task holding them all.
    """
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_lw"))
            .select(*keys, *[F.col("_lw." + c).alias(c) for c in rest]))


def union_last_wins(frames: Sequence[DataFrame], keys: Sequence[str], order_col: str = "_ordinal") -> DataFrame:
    """Union of several tables where a later table wins on equal keys."""
    tagged = [f.withColumn(order_col, F.lit(i).cast("bigint")) for i, f in enumerate(frames)]
    out = tagged[0]
    for f in tagged[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return last_wins(out, keys, order_col).drop(order_col)


def with_line_no(df: DataFrame, col: str = "line_no", block_cols: Sequence[str] | None = None,
                 pos_col: str | None = None) -> DataFrame:
    """0-based position of each row in input order, without a
    single-partition window over the data.

    Rows are ordered by ``block_cols`` (the file, then what is constant per
    input split, e.g. its start) and then by their position inside the split
    (``pos_col``, e.g. a parquet row index, else the generated id).  Offsets
    are computed in two levels: of the splits within each file, and of the
    files, so only one row per file meets in one task.  The data joins its
    split's offset; the planner broadcasts the offsets while they are small.
    Without ``block_cols`` the partition order is the input order.
    """
    blocks = list(block_cols) if block_cols else ["_part"]
    d = df.withColumn("_mid", F.col(pos_col).cast("bigint") if pos_col else F.monotonically_increasing_id())
    if not block_cols:
        d = d.withColumn("_part", F.spark_partition_id())
    sizes = d.groupBy(*blocks).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = (Window.unboundedPreceding, -1)
    if len(blocks) > 1:
        files = sizes.groupBy(blocks[0]).agg(F.sum("_n").alias("_n"))
        files = files.select(blocks[0], F.sum("_n").over(Window.orderBy(blocks[0]).rowsBetween(*before)).alias("_file"))
        inside = Window.partitionBy(blocks[0]).orderBy(*blocks[1:])
        sizes = sizes.withColumn("_off", F.sum("_n").over(inside.rowsBetween(*before))).join(files, blocks[0])
    else:
        inside = Window.orderBy(*blocks)
        sizes = sizes.withColumn("_off", F.sum("_n").over(inside.rowsBetween(*before))).withColumn("_file", F.lit(0))
    first = F.coalesce(F.col("_file"), F.lit(0)) + F.coalesce(F.col("_off"), F.lit(0)) - F.col("_m0")
    out = d.join(sizes.select(*blocks, first.alias("_first")), blocks).withColumn(col, F.col("_first") + F.col("_mid"))
    return out.drop("_mid", "_first", "_part")


def shuffle_position(df: DataFrame, seed: int, col: str = "line_no", out: str = "rand_pos", digits: int = 3) -> DataFrame:
    """``out``, the 0-based position of each row in a random order that
    depends on ``seed`` and ``col`` only, not on partitions or runs.

    The order is that of a keyed hash (MD5 of seed and ``col``, ties by ``col``).  Rows are
    numbered within each of the ``16 ** digits`` leading values of the hash, which are
    equally likely, and the leading values' sizes, a table of fixed size,
    are summed up before them.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(col).cast("string")))
    keyed = df.withColumn("_rk", key).withColumn("_rp", F.substring("_rk", 1, digits))
    sizes = keyed.groupBy("_rp").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_rp", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_rp").orderBy("_rk", col)
    numbered = keyed.withColumn("_rn", F.row_number().over(inside)).join(offsets, "_rp")
    return numbered.withColumn(out, F.col("_off") + F.col("_rn") - 1).drop("_rk", "_rp", "_rn", "_off")


def row_slice(df: DataFrame, start: int | None = None, end: int | None = None, col: str = "line_no") -> DataFrame:
    """``rows[start:end]`` by position; falsy start is 0, falsy end is
    the end.  Negative positions are rejected."""
    if (start or 0) < 0 or (end or 0) < 0:
        raise ValueError("negative row positions are not supported")
    cond = F.lit(True)
    if start:
        cond = cond & (F.col(col) >= F.lit(start))
    if end:
        cond = cond & (F.col(col) < F.lit(end))
    return df.filter(cond)


def chunk_id(n: int, col: str = "line_no"):
    """Group rows in chunks of ``n`` by position."""
    if n <= 0:
        raise ValueError("chunk size must be positive")
    return F.floor(F.col(col) / F.lit(n)).cast("bigint")
