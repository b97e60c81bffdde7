"""Splittable reader of JSON dictionaries (one top-level object per file).

A file is cut into byte ranges that are read twice, each range by its own task.
The first pass reduces a range to what it does to the state of a scanner,
whatever that state is at its start: the parity of its quotes (a quote is
escaped after an odd number of backslashes, which a range finds out by
looking back), and the change of nesting depth when it starts outside and when
it starts inside a string.  Sums over the ranges before it give every range its true
state.  In the second pass each range cuts out the entries whose separator (the
opening brace, or a comma at the top level) lies in it, reading on
past its end for the last one, and shows them as small JSON
objects for ``from_json``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from objsync.sources.ranges import RangeReader, file_ranges, list_files, range_tasks

RANGE_BYTES = 32 << 20
#: Bytes of entries per object handed to ``from_json``.
LOT_BYTES = 1 << 20
_MORE_BYTES = 1 << 16

_DEPTH = np.zeros(256, dtype=np.int64)
_DEPTH[[ord("{"), ord("[")]] = 1
_DEPTH[[ord("}"), ord("]")]] = -1


def _escaped_at(reader: RangeReader, start: int) -> bool:
    """Whether the byte at ``start`` follows an odd number of backslashes."""
    n = 0
    while start > 0:
        back = reader.read(max(0, start - 4096), start)
        run = len(back) - len(back.rstrip(b"\\"))
        n += run
        if run < len(back):
            break
        start -= len(back)
    return n % 2 == 1


def quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Places of the quotes that begin or end strings."""
    at = np.flatnonzero(data == ord('"'))
    slash = data == ord("\\")
    if not slash.any() and not escaped:
        return at
    # the run of backslashes before each place, from the last other byte
    other = np.where(slash, -1, np.arange(len(data)))
    last_other = np.concatenate([[-1], np.maximum.accumulate(other)])[:-1] if len(data) else other
    run = np.arange(len(data)) - last_other - 1
    run = run + (escaped & (last_other < 0))  # an odd run goes on from before the range
    return at[run[at] % 2 == 0]


def _structure(data: np.ndarray, at: np.ndarray, inside: bool) -> np.ndarray:
    """True for bytes that are outside of strings (and no quote)."""
    toggles = np.zeros(len(data), dtype=np.int8)
    toggles[at] = 1
    within = (np.cumsum(toggles) + inside) % 2 == 1
    within[at] = True
    return ~within


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for path, start, end in zip(b["path"].to_pylist(), b["start"].to_pylist(), b["end"].to_pylist()):
            with RangeReader(path) as r:
                data = np.frombuffer(r.read(start, end), dtype=np.uint8)
                at = quotes(data, _escaped_at(r, start))
            step = _DEPTH[data]
            rows.append((len(at) % 2, *(int(step[_structure(data, at, inside)].sum()) for inside in (False, True))))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, pa.int64()) for c in columns]], names=[*b.schema.names, "flips", "if_outside", "if_inside"])


def range_states(ranges: DataFrame) -> DataFrame:
    """Ranges with the scanner's state at their start: ``inside`` a string, and
    the nesting ``depth``.  A file that is no single closed object fails the read."""
    schema = "path string, length bigint, no bigint, start bigint, end bigint, flips bigint, if_outside bigint, if_inside bigint"
    moves = ranges.mapInArrow(_transitions, schema)
    before = Window.partitionBy("path").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    moves = moves.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    moves = moves.withColumn("change", F.when(F.col("inside"), F.col("if_inside")).otherwise(F.col("if_outside")))
    closed = (F.sum("flips").over(whole) % 2 == 0) & (F.sum("change").over(whole) == 0)
    depth = F.when(closed, F.coalesce(F.sum("change").over(before), F.lit(0))).otherwise(
        F.raise_error(F.concat(F.lit("not a closed JSON object: "), F.col("path"))))
    return moves.select("path", "length", "no", "start", "end", "inside", depth.alias("depth"))


def _marks(data: np.ndarray, escaped: bool, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, bool, int]:
    """Places that begin an entry (after them) and places that end one, and
    the state after the data."""
    at = quotes(data, escaped)
    free = _structure(data, at, inside)
    step = np.where(free, _DEPTH[data], 0)
    after = depth + np.cumsum(step)
    comma = free & (data == ord(",")) & (after == 1)
    opens = free & (step == 1) & (after == 1)
    closes = free & (step == -1) & (after == 0)
    state = (len(at) + inside) % 2 == 1
    return np.flatnonzero(comma | opens), np.flatnonzero(comma | closes), state, int(after[-1]) if len(after) else depth


def _entries(reader: RangeReader, length: int, start: int, end: int, inside: bool, depth: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the entries whose separator lies in the range."""
    raw = reader.read(start, end)
    begins, ends, state, level = _marks(np.frombuffer(raw, dtype=np.uint8), _escaped_at(reader, start), inside, depth)
    place = 0
    for i in begins.tolist():
        place = np.searchsorted(ends, i, side="right")
        if place < len(ends):
            yield start + i + 1, raw[i + 1 : ends[place]]
            continue
        parts, at = [raw[i + 1 :]], end  # the last one goes on past the range
        while True:
            if at >= length:
                raise ValueError("entry without an end")
            more = reader.read(at, min(length, at + _MORE_BYTES))
            _, stops, next_state, next_level = _marks(np.frombuffer(more, dtype=np.uint8), _escaped_at(reader, at), state, level)
            if len(stops):
                parts.append(more[: stops[0]])
                break
            parts.append(more)
            at, state, level = at + len(more), next_state, next_level
        yield start + i + 1, b"".join(parts)


def _objects(batches: Iterator[pa.RecordBatch], lot_bytes: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            with RangeReader(r["path"]) as reader:
                lot: list[bytes] = []
                first = held = 0
                for offset, text in _entries(reader, r["length"], r["start"], r["end"], r["inside"], r["depth"]):
                    if not text.strip():
                        continue  # an empty dictionary
                    first = first if lot else offset
                    lot.append(text)
                    held += len(text)
                    if held >= lot_bytes:
                        yield _lot(r["path"], first, lot)
                        lot, held = [], 0
                if lot:
                    yield _lot(r["path"], first, lot)


def _lot(path: str, offset: int, texts: list[bytes]) -> pa.RecordBatch:
    value = (b"{" + b",".join(texts) + b"}").decode()
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([offset], pa.int64()), pa.array([value])], names=["path", "offset", "value"])


def read_dictionary(spark: SparkSession, path: str | list[str], value_type: str, range_bytes: int = RANGE_BYTES, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """(key, value) of every entry of the dictionaries under ``path``, values
    parsed as ``value_type``; a malformed document fails the read.  Of a key that a
    document repeats, the last entry counts (and over several
    documents, the one of the last path)."""
    files = list_files(spark, path)
    tasks = range_tasks(files, range_bytes)
    states = range_states(file_ranges(files, range_bytes, tasks))
    lots = states.repartition(tasks, "path", "no").mapInArrow(lambda b: _objects(b, lot_bytes), "path string, offset bigint, value string")
    parsed: Column = F.from_json("value", f"map<string,{value_type}>", {"mode": "FAILFAST"})
    rows = lots.select("path", "offset", F.posexplode(F.map_entries(parsed)).alias("nth", "e"))
    last = F.max_by("e", F.struct("path", "offset", "nth"))
    return rows.groupBy(F.col("e.key").alias("key")).agg(last.alias("e")).select("key", "e.value")
