"""Byte ranges of files: the unit of work for inputs that Spark's own readers
take as one row per file (JSON dictionaries, large binary objects).

Files are listed by Spark (names and lengths only); their bytes are read in
executor tasks, a bounded block at a time, through the file system that the
path names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.functions.objects import chunk_ranges

#: Bytes per read.
BLOCK_BYTES = 8 << 20
#: Bytes of files per task.
TASK_BYTES = 32 << 20


def file_system(path: str):
    """The file system of a path and the path within it: local files, and
    whatever ``pyarrow`` knows by scheme (``s3a`` is ``s3`` there)."""
    from pyarrow import fs

    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if m is None:
        return fs.LocalFileSystem(), path
    if m[1] == "file":
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


class RangeReader:
    """Reads of one file, by offset."""

    def __init__(self, path: str):
        system, name = file_system(path)
        self.file = system.open_input_file(name)

    def read(self, start: int, end: int) -> bytes:
        return self.file.read_at(max(0, end - start), start)

    def blocks(self, start: int, end: int, size: int = BLOCK_BYTES) -> Iterator[bytes]:
        while start < end:
            data = self.read(start, min(end, start + size))
            if not data:
                raise OSError(f"file ended at byte {start}, {end} expected")
            yield data
            start += len(data)

    def __enter__(self) -> RangeReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def list_files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """(path, length) of every file under ``root``; contents are not read.
    Spark's file sources leave files without bytes out."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")


def range_tasks(files: DataFrame, range_bytes: int) -> int:
    """Tasks for the ranges of ``files``: one per ``TASK_BYTES``, and at least one per core, but
    never more than ranges.  The rows that name ranges are too small for AQE, which would
    put the bytes of all files into one task."""
    total = files.agg(F.sum("length").alias("size"), F.sum(F.ceil(F.col("length") / range_bytes)).alias("ranges")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    return max(1, min(total["ranges"] or 0, max(cores, -(-(total["size"] or 0) // TASK_BYTES))))


def file_ranges(files: DataFrame, range_bytes: int, tasks: int | None = None) -> DataFrame:
    """One row per range ``(path, length, no, start, end)``, ``end`` exclusive,
    spread over the cluster in ``tasks`` tasks (``range_tasks``, if not given)."""
    if range_bytes <= 0:
        raise ValueError("range size must be positive")
    tasks = tasks or range_tasks(files, range_bytes)
    ranges = files.select("path", "length", F.posexplode(chunk_ranges(F.col("length"), range_bytes)).alias("no", "r"))
    ranges = ranges.select("path", "length", F.col("no").cast("bigint").alias("no"), F.col("r.start").alias("start"), (F.col("r.end") + 1).alias("end"))
    return ranges.repartition(tasks, "path", "no")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sums = []
        for path, start, end in zip(b["path"].to_pylist(), b["start"].to_pylist(), b["end"].to_pylist()):
            sig = hashlib.md5(usedforsecurity=False)
            with RangeReader(path) as r:
                for data in r.blocks(start, end):
                    sig.update(data)
            sums.append(sig.digest())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums, pa.binary())], names=[*b.schema.names, "digest"])


def range_digests(ranges: DataFrame) -> DataFrame:
    """``ranges`` with the binary MD5 of each range's bytes, read block by block."""
    return ranges.mapInArrow(_digested, "path string, length bigint, no bigint, start bigint, end bigint, digest binary")
