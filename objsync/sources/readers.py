"""Readers for the job inputs.

All readers return DataFrames; nothing is loaded on the driver.  Paths may
be local, ``s3a://`` or ``gs://`` — the path-prefix dispatch of the original
jobs disappears behind the Hadoop filesystem layer.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync import config as C
from objsync.functions.acl import py_strip
from objsync.operators.relational import row_slice, shuffle_position, with_line_no
from objsync.sources.jsondict import RANGE_BYTES, read_dictionary
from objsync.sources.ranges import file_ranges, list_files, range_digests

_INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"


def strict_long(col: str) -> F.Column:
    """``int(text)``: a value that is not an integer fails the job."""
    c = F.col(col)
    return F.when(c.rlike(_INT_PATTERN), F.trim(c).cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit(f"invalid integer in column {col}: "), F.coalesce(c, F.lit("<empty>")))))


def read_manifest(spark: SparkSession, path: str | list[str], sep: str = "\t", start: int | None = None,
                  end: int | None = None, shuffle_seed: int | None = None) -> DataFrame:
    """A header TSV manifest -> one row per file.

    Columns come from the header (all text, empty fields as '' like a
    ``DictReader``), ``size`` is a strict integer, and ``line_no`` is the
    0-based row position in file order (W1; rows of several files follow
    the path order; their headers must be equal, else the read fails).  ``start``/``end`` slice by position (S4);
    ``shuffle_seed`` puts the rows into a random order that this seed always
    gives (W6), with their position in it as ``rand_key``.
    """
    raw = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
           .option("mode", "FAILFAST")
           .option("enforceSchema", False).csv(path))
    cols = raw.columns
    if "size" not in cols or "id" not in cols:
        raise ValueError("manifest needs at least the id and size columns")
    df = raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols],
                    F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_fb"))
    df = with_line_no(df, block_cols=["_fp", "_fb"]).drop("_fp", "_fb")
    df = df.withColumn("size", strict_long("size"))
    df = row_slice(df, start, end)
    if shuffle_seed is not None:
        df = shuffle_position(df, shuffle_seed, out="rand_key").orderBy("rand_key")
    return df


def read_pipeline_manifest(spark: SparkSession, path: str) -> DataFrame:
    """S13 + P27: whitespace-separated text manifest, first line of every
    file skipped; words zipped with ``id file_name size md5 acl project_id``
    (extra words dropped), ``size`` a strict integer."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_fp"),
                                       F.col("_metadata.file_block_start").alias("_fb"))
    numbered = with_line_no(raw, col="_pos", block_cols=["_fp", "_fb"])
    firsts = numbered.groupBy("_fp").agg(F.min("_pos").alias("_pos")).withColumn("_hdr", F.lit(True))
    body = numbered.join(firsts, ["_fp", "_pos"], "left").filter(F.col("_hdr").isNull())
    line = py_strip(F.col("value"))
    words = F.split(line, r"\s+")
    out = body.filter(line != "").select(
        F.col("_pos").alias("line_no"),
        *[F.try_element_at(words, F.lit(i + 1)).alias(c) for i, c in enumerate(C.PIPELINE_COLUMNS)])
    return out.withColumn("size", strict_long("size"))


def read_project_map(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """JSON object ``project_id -> {aws_bucket_prefix, gs_bucket_prefix}``."""
    d = read_dictionary(spark, path, "struct<aws_bucket_prefix:string,gs_bucket_prefix:string>", range_bytes)
    return d.select(F.col("key").alias("project_id"), "value.aws_bucket_prefix", "value.gs_bucket_prefix")


def read_inventory_json(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """JSON dictionary ``"bucket/key" -> {StorageClass, Size, Bucket}``
    (GS form: ``{bucket, Size}``).  Values are read as case-sensitive maps.
    A document is read by as many tasks as it has ranges of ``range_bytes``."""
    e = read_dictionary(spark, path, "map<string,string>", range_bytes).withColumnsRenamed({"key": "path", "value": "o"})
    o = F.col("o")
    bucket = F.coalesce(F.try_element_at(o, F.lit("Bucket")), F.try_element_at(o, F.lit("bucket")),
                        F.substring_index("path", "/", 1))
    e = e.select("path", bucket.alias("bucket"), F.try_element_at(o, F.lit("Size")).cast("bigint").alias("size"),
                 F.try_element_at(o, F.lit("StorageClass")).alias("storage_class"))
    return e.select("bucket", F.expr("substring(path, length(bucket) + 2)").alias("key"), "size", "storage_class")


def read_index_map_json(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """JSON ``did -> [urls]`` map file -> ``(did, urls)``."""
    return read_dictionary(spark, path, "array<string>", range_bytes).withColumnsRenamed({"key": "did", "value": "urls"})


def read_index_json(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """S12 as an index (S10): a map file knows URLs only, so ``urls_metadata``
    has an empty entry per URL, and all other columns are empty or null."""
    none = F.array().cast("array<string>")
    empty = F.create_map().cast("map<string,string>")
    urls = F.coalesce(F.col("urls"), none)
    return read_index_map_json(spark, path, range_bytes).select(
        "did", urls.alias("urls"), F.map_from_arrays(F.array_distinct(urls), F.transform(F.array_distinct(urls), lambda _: empty)).alias("urls_metadata"),
        none.alias("acl"), none.alias("authz"), empty.alias("hashes"), F.lit(None).cast("bigint").alias("size"))


def read_ignored(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Ignored-objects table (header CSV/TSV) with ``line_no`` for the
    last-row-wins rule; a bad size fails the read."""
    raw = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
           .option("mode", "FAILFAST").option("enforceSchema", False).csv(path))
    df = raw.select(*raw.columns, F.col("_metadata.file_path").alias("_fp"),
                    F.col("_metadata.file_block_start").alias("_fb"))
    df = with_line_no(df, block_cols=["_fp", "_fb"]).drop("_fp", "_fb")
    return df.withColumn("gcs_object_size", strict_long("gcs_object_size"))


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """S7/S8 for file-system buckets: every file under ``root/<bucket>/``
    becomes ``(bucket, key, size)``.  Only names and lengths are read
    (``binaryFile`` with the content column pruned from the scan)."""
    files = list_files(spark, root)
    return files.select(*_object_names("path", root), F.col("length").alias("size"), F.lit(None).cast("string").alias("storage_class"))


def _object_names(path: str, root: str) -> tuple[F.Column, F.Column]:
    """Bucket and key of a file under ``root/<bucket>/``."""
    no_scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    root_path = re.sub(no_scheme, "", root).rstrip("/")
    rel = F.regexp_replace(F.regexp_replace(F.col(path), no_scheme, ""), "^" + re.escape(root_path) + "/", "")
    return F.substring_index(rel, "/", 1).alias("bucket"), F.substring(rel, F.instr(rel, "/") + 1, F.length(rel)).alias("key")


def file_digest(spark: SparkSession, root: str) -> DataFrame:
    """C9 observed side for file-system objects: ``(bucket, key,
    received_size, content_md5)`` of the bytes, read block by block in executor tasks, whatever
    the size.  An MD5 runs through its object in order, so an
    object is one task; ``file_parts`` spreads large ones."""
    files = list_files(spark, root)
    whole = files.select("path", "length", F.lit(0).cast("bigint").alias("no"), F.lit(0).cast("bigint").alias("start"), F.col("length").alias("end"))
    sums = range_digests(whole.repartition("path"))
    return sums.select(*_object_names("path", root), F.col("length").alias("received_size"), F.lower(F.hex("digest")).alias("content_md5"))


def file_parts(spark: SparkSession, root: str, chunk_bytes: int) -> DataFrame:
    """C10 parts of file-system objects with the digests of their bytes, each
    part read by its own task: ``(bucket, key, part_number, part_size, part_md5)``."""
    sums = range_digests(file_ranges(list_files(spark, root), chunk_bytes))
    return sums.select(*_object_names("path", root), (F.col("no") + 1).cast("int").alias("part_number"),
                       (F.col("end") - F.col("start")).alias("part_size"), F.lower(F.hex("digest")).alias("part_md5"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """An index snapshot (parquet, schema ``INDEX_SCHEMA``)."""
    return spark.read.parquet(path)
