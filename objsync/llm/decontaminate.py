"""Benchmark decontamination by greedy string tiling.

Words are lower-cased and stripped of outer punctuation.  Every text is joined
with the benchmark on shared seeds (Karp-Rabin fingerprints of ``SEED``
consecutive words, or of a whole item that is shorter).  Where enough of an
item is seeded, tiling marks the longest match of unmarked words again and
again, so each word of item and text is used once and the order of the matched
passages does not matter.  A pair counts when the tiles of the whole text,
however far apart, cover ``COVERAGE`` of the item's words.  Each stretch of ``REACH``
item lengths is also tiled by itself, where far tiles take no words from a near copy; the
best cover counts.

The benchmark is a stated query set: it is taken in blocks of at most
``BLOCK_BYTES`` of text, and each block is broadcast against all texts.  The
driver holds one block at a time: what the texts have in common with a block is written
before the next block is read.

Null, empty and wordless texts or items match nothing; equal items are each
reported, repeated rows give repeated results; empty tables give an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import mix64, seed64, ship, table, written

SEED = 5
COVERAGE = 0.6
REACH = 4
BLOCK_BYTES = 8 << 20
OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’–—…¿¡·"
SCHEMA = "doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, n_tiles bigint, coverage double"


def fingerprints(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin values (base odd, modulo 2**64) of all windows."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out, base = np.zeros(n, dtype=np.uint64), seed64(7)
    for j in range(width):
        out = out * base + ids[j : j + n].astype(np.uint64)
    return mix64(out)


def greedy_tiles(pairs: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, text start, length) from seed pairs (i, j): the
    longest match of unmarked words first, ties by item then text position."""
    by_diagonal: dict[int, list[int]] = {}
    for i, j in pairs:
        by_diagonal.setdefault(j - i, []).append(i)
    heap: list[tuple[int, int, int]] = []
    for d, starts in by_diagonal.items():
        starts.sort()
        first = last = starts[0]
        for i in [*starts[1:], None]:
            if i is not None and i <= last + 1:
                last = i
                continue
            heap.append((-(last - first + width), first, first + d))
            first = last = i
    heapq.heapify(heap)
    item_marked: set[int] = set()
    text_marked: set[int] = set()
    tiles = []
    while heap:
        length, i, j = heapq.heappop(heap)
        length = -length
        free = [k for k in range(length) if i + k not in item_marked and j + k not in text_marked]
        if len(free) == length:
            tiles.append((i, j, length))
            item_marked.update(range(i, i + length))
            text_marked.update(range(j, j + length))
            continue
        start = prev = None  # unmarked stretches that are still long enough wait their turn
        for k in [*free, None]:
            if prev is not None and k == prev + 1:
                prev = k
                continue
            if prev is not None and prev - start + 1 >= width:
                heapq.heappush(heap, (-(prev - start + 1), i + start, j + start))
            start = prev = k
    return tiles


def stretches(seeds: list[tuple[int, int]], width: int, reach: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """The seeds within ``reach`` text words from each seed on, and the item
    or text words they hold, whichever are fewer: no tiling covers more."""
    seeds = sorted(seeds, key=lambda s: (s[1], s[0]))
    held: tuple[dict[int, int], dict[int, int]] = ({}, {})  # words of item and text -> seeds that hold them

    def count(seed: tuple[int, int], by: int) -> None:
        for words, at in zip(held, seed):
            for x in range(at, at + width):
                n = words.get(x, 0) + by
                if n:
                    words[x] = n
                else:
                    del words[x]

    a = b = 0
    while a < len(seeds):
        while b < len(seeds) and seeds[b][1] + width - seeds[a][1] <= reach:
            count(seeds[b], 1)
            b += 1
        yield min(map(len, held)), seeds[a:b]
        start = seeds[a][1]
        while a < b and seeds[a][1] == start:
            count(seeds[a], -1)
            a += 1


def best_cover(seeds: list[tuple[int, int]], width: int, reach: int, least: float) -> tuple[int, int]:
    """Most item words covered, and the number of tiles: by the tiles of the
    whole text, or of one stretch of ``reach`` words of it."""
    tiles = greedy_tiles(seeds, width)
    best = (sum(n for _, _, n in tiles), len(tiles))
    if best[0] == min(len({at + x for at in ends for x in range(width)}) for ends in map(set, zip(*seeds))):
        return best
    for bound, some in stretches(seeds, width, reach):
        if bound >= least and bound > best[0]:
            tiles = greedy_tiles(some, width)
            covered = sum(n for _, _, n in tiles)
            if covered > best[0]:
                best = (covered, len(tiles))
    return best


class Block:
    """Some benchmark items, indexed by the fingerprints of their seeds."""

    def __init__(self, items: list[tuple[int, str | None]], seed: int = SEED):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        self.seed = seed
        for item_id, text in items:
            words = [w for w in (x.strip(OUTER) for x in (text or "").lower().split()) if w]
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], dtype=np.int64)
            if len(ids):
                self.items.append((item_id, ids))
        self.at: dict[int, dict[int, list[tuple[int, int]]]] = {}  # width -> fingerprint -> (item, position)
        for k, (_, ids) in enumerate(self.items):
            width = min(seed, len(ids))
            where = self.at.setdefault(width, {})
            for i, f in enumerate(fingerprints(ids, width).tolist()):
                where.setdefault(f, []).append((k, i))
        self.known = {w: np.sort(np.array(list(x), dtype=np.uint64)) for w, x in self.at.items()}
        self._ids: dict[str, int] = {}

    def ids(self, text: str) -> np.ndarray:
        """Word numbers of a text; words that no item has are 0."""
        seen, vocabulary = self._ids, self.vocabulary
        if len(seen) > 300_000:
            seen.clear()
        out = []
        for raw in text.lower().split():
            n = seen.get(raw)
            if n is None:
                word = raw.strip(OUTER)
                n = seen[raw] = vocabulary.get(word, 0) if word else -1
            if n >= 0:
                out.append(n)
        return np.array(out, dtype=np.int64)

    def matches(self, text: str, least: float = COVERAGE) -> list[tuple[int, int, int, int, float]]:
        ids = self.ids(text)
        out = []
        for width, known in self.known.items():
            if len(ids) < width:
                continue
            gaps = np.concatenate([[0], np.cumsum(ids == 0)])
            starts = np.flatnonzero(gaps[width:] == gaps[:-width])  # windows of known words only
            if not len(starts):
                continue
            prints = fingerprints(ids, width)[starts]
            at = np.searchsorted(known, prints)
            hit = known[np.minimum(at, len(known) - 1)] == prints
            pairs: dict[int, list[tuple[int, int]]] = {}
            for j, f in zip(starts[hit].tolist(), prints[hit].tolist()):
                for k, i in self.at[width][f]:
                    if (self.items[k][1][i : i + width] == ids[j : j + width]).all():  # equal prints, then equal words
                        pairs.setdefault(k, []).append((i, j))
            for k, seeds in pairs.items():
                item_id, item = self.items[k]
                seeded = len({i + x for i, _ in seeds for x in range(width)})
                if seeded < least * len(item):
                    continue
                covered, tiles = best_cover(seeds, width, REACH * len(item), least * len(item))
                if covered >= least * len(item):
                    out.append((item_id, len(item), covered, tiles, covered / len(item)))
        return sorted(out)


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str | None]]]:
    """The query set, cut into blocks of bounded size, one at a time; longer ones of the
    benchmark's items stand alone."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    block: list[tuple[int, str | None]] = []
    held = 0
    for r in rows.toLocalIterator():
        if block and held + len(r.text) > most:
            yield block
            block, held = [], 0
        block.append((r.item_id, r.text))
        held += len(r.text)
    if block:
        yield block


def _all_but_last(items: Iterator) -> Iterator[tuple[object, bool]]:
    """Each item, and whether it is the last."""
    held = next(items, None)
    while held is not None:
        after = next(items, None)
        yield held, after is None
        held = after


def _match(docs: DataFrame, items: list[tuple[int, str | None]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shared.value)
        for b in batches:
            rows = [(d, *m) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t for m in block.matches(t)]
            kinds = (pa.int64(),) * 5 + (pa.float64(),)
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.mapInArrow(run, SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per text and item that the text covers."""
    ship(docs.sparkSession)
    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = []
    for items, last in _all_but_last(blocks(benchmark, block_bytes)):
        rows = _match(few, items)
        found.append(rows if last else written(rows, "benchmark-block"))
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], SCHEMA)


def keep_clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text covers no item."""
    ship(docs.sparkSession)
    spark, at = docs.sparkSession, docs.columns.index("text")
    for items, last in _all_but_last(blocks(benchmark, block_bytes)):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value)
            for b in batches:
                yield b.filter(pa.array([not (t and block.matches(t)) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        docs = docs if last else written(docs, "clean-of-a-block")
    return docs


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
