"""Helpers shared by the corpus operators: tables, scratch tables, words and
64-bit names."""

from __future__ import annotations

import functools
import gc
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BATCH_ROWS = 2_000

_LOCAL_SCRATCH: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers of this session import this package from the
    driver's checkout (a cluster ships it with ``--py-files`` instead), and
    hand them whole texts in batches of at most ``BATCH_ROWS`` rows."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Without that setting only a ``local`` master is accepted, where the one
    machine's temporary folder is shared by definition.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="corpus-scratch-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here,
    its size is known to the planner, and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table that ``written`` made and no later step reads."""
    jvm = table.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of queries that are done; it
    learns of them when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions_for(spark: SparkSession, n_bytes: int, each: int = 8 << 20) -> int:
    """So many partitions that each holds about ``each`` bytes."""
    return max(spark.sparkContext.defaultParallelism, -(-n_bytes // each))


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, changed where a column of ``df`` has that name already."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * M1
    x = x ^ (x >> np.uint64(27))
    x = x * M2
    return x ^ (x >> np.uint64(31))


@functools.cache
def seed64(n: int) -> np.uint64:
    """The n-th of a fixed series of odd 64-bit multipliers."""
    x = mix64(np.array([(n + 1) * 0x9E3779B97F4A7C15 % 2**64], dtype=np.uint64))[0]
    return np.uint64(int(x) | 1)


#: Random values of a byte at one of the first places of a word.
_NEAR = 64
_VALUE = mix64(np.arange(1, _NEAR * 256 + 1, dtype=np.uint64) * seed64(900))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_names(text: bytes, lower: bool = False) -> np.ndarray:
    """64-bit names of the words of a text (between space and 09-0D), the same
    in every process: sums of a random value per byte and place, mixed.
    ``lower`` takes A-Z as a-z."""
    data = np.frombuffer(text, dtype=np.uint8)
    at = np.flatnonzero(~_SPACE[data])
    if not len(at):
        return np.empty(0, dtype=np.uint64)
    data = data[at]
    if lower:
        data = _LOWER[data]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
    lengths = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    if lengths.max() <= _NEAR:
        values = _VALUE[place << 8 | data]
    else:
        values = mix64((place << 8 | data).astype(np.uint64) * seed64(901) + seed64(902))
        near = place < _NEAR
        values[near] = _VALUE[place[near] << 8 | data[near]]
    return mix64(np.add.reduceat(values, starts) + lengths.astype(np.uint64) * seed64(903))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def window_names(h: np.ndarray, width: int, first_seed: int = 0) -> np.ndarray:
    """64-bit names of all runs of ``width`` consecutive entries of ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out += h[j : j + n] * seed64(first_seed + j)
    return mix64(out)


def as_long(x: np.ndarray) -> pa.Array:
    """uint64 names as Spark longs."""
    return pa.array(x.view(np.int64))
