"""Writers for the job outputs (K1-K6).  All writes are distributed Spark
writes; nothing is collected to the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from objsync import config as C
from objsync.functions.acl import py_list_repr
from objsync.functions.urls import compact_acl, safe_name


def _render(df: DataFrame) -> DataFrame:
    """Arrays as Python list text (P25), like the original TSV outputs."""
    return df.select(*[py_list_repr(F.col(f.name)).alias(f.name) if isinstance(f.dataType, ArrayType)
                       else F.col(f.name) for f in df.schema.fields])


def _tsv(df: DataFrame, mode: str):
    """TSV with header that ``read_manifest`` reads back unchanged: blanks stay,
    a quote inside a quoted field is doubled."""
    return (df.write.mode(mode).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_tsv(df: DataFrame, path: str, fields: Sequence[str] | None = None, sort_by: str | None = None,
              mode: str = "overwrite", single_file: bool = False) -> None:
    """K1: TSV with header; ``fields`` fixes the columns (missing ones are
    written empty), ``sort_by`` orders ascending with ties in input order.
    An empty result writes a header-only file.  ``single_file`` funnels the
    rows through one writer task; keep it for small reports only."""
    out = df
    if fields:
        out = out.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in fields]
                         + ([F.col("line_no")] if sort_by and "line_no" in df.columns and "line_no" not in fields
                            else []))
    if sort_by:
        order = [sort_by] + (["line_no"] if "line_no" in out.columns else [])
        out = out.orderBy(*order)
        if fields and "line_no" not in fields and "line_no" in out.columns:
            out = out.drop("line_no")
    out = _render(out)
    if single_file:
        out = out.coalesce(1)
    _tsv(out, mode).option("emptyValue", "").csv(path)


def write_tsv_by(df: DataFrame, path: str, by: str, fields: Sequence[str], order: Sequence[str], mode: str = "overwrite",
                 report: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K1 for many reports in one write: a folder ``by=<value>`` per report, of gzipped
    files, its rows in ``order``.  Rows are spread by ranges of both, so a large report has many
    files, whose names sort in row order, and small ones share a task.  ``report`` makes the
    report's rows of ``df``'s, each by itself, once these are spread by the columns that they have."""
    keys = [by, *[c for c in order if c != by]]
    rows = df.repartitionByRange(*[c for c in keys if c in df.columns])
    rows = report(rows) if report else rows
    have = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in fields]
    rows = rows.sortWithinPartitions(*keys).select(by, *have)
    _tsv(_render(rows), mode).option("emptyValue", "").option("compression", "gzip").partitionBy(by).csv(path)


def write_dictionary(df: DataFrame, path: str, key: str, value: str, entries_per_file: int = 100_000, mode: str = "overwrite") -> None:
    """K6 as JSON: dictionaries ``{key: value, ...}``, one document per file, which
    ``read_dictionary`` reads back.  ``value`` is a struct, map or array column (null
    fields are left out).  Entries are dealt over as many documents as
    keep each at about ``entries_per_file``."""
    rows = df.select(F.to_json(F.struct(F.col(key).alias("k"))).alias("_k"), F.to_json(value).alias("_v"))
    text = F.concat(F.expr("substring(_k, 6, length(_k) - 6)"), F.lit(": "), F.col("_v"))
    n = max(1, -(-df.count() // entries_per_file))
    dealt = rows.select(F.pmod(F.xxhash64("_k"), F.lit(n)).alias("_d"), text.alias("_t"))
    documents = dealt.groupBy("_d").agg(F.concat(F.lit("{"), F.array_join(F.collect_list("_t"), ",\n"), F.lit("}")).alias("value"))
    documents.select("value").write.mode(mode).option("maxRecordsPerFile", 1).text(path)


def write_pipeline_manifest(pm: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: the 6-column pipeline manifest (names with ``_``, ACL without
    spaces) as TSV with header."""
    cols = [F.col("id"), safe_name("file_name").alias("file_name"), F.col("size"), F.col("md5"),
            compact_acl("acl").alias("acl"), F.col("project_id")]
    _tsv(pm.select(*cols), mode).csv(path)


def write_result_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one tab-joined result line per processed file (text files)."""
    lines.select("line").write.mode(mode).text(path)


def write_result_log(plan: DataFrame, path: str, release: str, mode: str = "overwrite") -> None:
    """K4: per-object result rows as one table partitioned by release
    (instead of one object per row); a rerun replaces its release."""
    from objsync.plans.gs import result_lines

    result_lines(plan, safe_names=True).withColumn("release", F.lit(release)) \
        .select("release", "id", "line").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("release").parquet(path)


def write_deletion_log(log: DataFrame, path: str, release: str, mode: str = "overwrite") -> None:
    """K5: deletion log rows (``config.DELETION_LOG_FIELDS``) as
    gzipped JSON lines partitioned by release and provider (the job writes them only
    on a real run); a rerun replaces its partitions."""
    log.select(F.lit(release).alias("release"), "provider", *C.DELETION_LOG_FIELDS) \
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("release", "provider").json(path)


def write_snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: parquet snapshot of an index or inventory (re-read with S10 or as
    an inventory table)."""
    df.write.mode(mode).parquet(path)


def write_bucketed_snapshot(df: DataFrame, name: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """K6 as a catalog table, bucketed and sorted by ``key`` (``did`` of an index, ``key`` of an
    inventory): joins on that key read it without an exchange.  For snapshots that are read
    many times; ``plans.index_table`` is for those that are edited."""
    df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


MANIFEST_FIELDS = list(C.MANIFEST_COLUMNS)
AUGMENTED_FIELDS = list(C.AUGMENTED_COLUMNS)
