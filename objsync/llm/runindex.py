"""Byte-level substring dedup with run-length indexes.

Texts are cut where it is settled by content: every window of ``length`` bytes
takes the smallest hash among its ``GRAM``-byte grams as its anchor, so equal
windows take equal anchors, and the windows that share one anchor form a
segment of at most ``2 * length`` bytes.

1. Spark counts the segments of each anchor name.  Anchors seen once, and
   segments without company, are done with; equal segments are one from here on.
2. The distinct segments of a name that has several go to one task together,
   which indexes about ``INDEX_BYTES`` of them: suffix array, Burrows-Wheeler
   transform, its runs, and, at both ends of every run only, the suffix there
   with its longest common prefix.  Matching statistics are then streamed over
   the text: from one sample to the next they fall by one per byte, which the
   runs guarantee.  A window is repeated where its statistic reaches
   ``length``, or where its whole segment has copies.
3. The repeated windows of a segment hold for all its occurrences; their bytes go.

A name with more than ``MOST_SEGMENTS`` distinct segments would make one task's
index too large; its windows are compared by fingerprint in a Spark
aggregation instead, to the same effect.

A passage of many short words may be shorter than ``length`` bytes.  With
``words`` the same steps also find the sequences of so many words that start
elsewhere too, whatever their bytes and the white space between them: texts are
arrays of 64-bit word names then, anchors are grams of ``GRAM_WORDS`` words, and
the index has words for symbols.  They are reported beside the bytes, which
they do not change.

Null text counts as empty.  Rows are documents: repeated rows repeat each
other's text.  A null ``doc_id`` is an id like others.  Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import as_long, byte_texts, discard, free_name, mix64, partitions_for, seed64, ship, table, window_names, word_names, written

LENGTH = 400
GRAM = 64
WORDS = 51  # over 50
GRAM_WORDS = 10
NAMED_BYTES = 1 << 17
INDEX_PART = 1 << 17
CHUNK = 1 << 17  # small enough for a core's own cache
INDEX_BYTES = 1 << 20
MOST_SEGMENTS = 5_000
LAST_ID = 2**63 - 1
SPACE = re.compile(rb"[\x20\x09-\x0D]")
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor place of every window of a buffer, and names of all grams.

    Of the grams in a window the smallest hash wins, then the leftmost.
    """
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    word = np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,))
    grams = len(data) - GRAM + 1
    half = GRAM // 2  # a gram is named by its two halves
    name = word[: grams + half] * seed64(0)
    for j in range(8, half, 8):
        name += word[j : j + grams + half] * seed64(j)
    name = mix64(name[:grams] * seed64(1) + mix64(name[half:]))
    return _least(name, length - GRAM + 1), name


def word_anchors(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of an array of word names, with grams of ``GRAM_WORDS`` words."""
    gram = min(GRAM_WORDS, length)
    name = window_names(words, gram, 2_000)
    return _least(name, length - gram + 1), name


def _least(name: np.ndarray, spread: int) -> np.ndarray:
    """Place of the smallest, then leftmost, of every ``spread`` names in a row."""
    grams, n = len(name), len(name) - spread + 1
    key = (name & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    rows = -(-grams // spread)
    full = np.full(rows * spread, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[:grams] = key
    full = full.reshape(rows, spread)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n], ahead[spread - 1 : spread - 1 + n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def named(texts: list[bytes]) -> list[np.ndarray]:
    """Word names of every text.  Short texts are named together, a long one in
    parts that end at white space."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0

    def flush() -> None:
        buffer = b" ".join(group)
        solid = ~IS_SPACE[np.frombuffer(buffer, dtype=np.uint8)]
        starts = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]])) if len(solid) else np.empty(0, dtype=np.int64)
        ends = np.cumsum([len(t) + 1 for t in group])
        out.extend(np.split(word_names(buffer), np.searchsorted(starts, ends[:-1])))

    for text in texts:
        if len(text) <= NAMED_BYTES:
            group.append(text)
            held += len(text)
        if group and (held >= NAMED_BYTES or len(text) > NAMED_BYTES):
            flush()
            group, held = [], 0
        if len(text) > NAMED_BYTES:
            cuts = [0]
            while cuts[-1] < len(text):
                space = SPACE.search(text, cuts[-1] + NAMED_BYTES)
                cuts.append(space.start() if space else len(text))
            out.append(np.concatenate([word_names(text[a:b]) for a, b in zip(cuts, cuts[1:])]))
    if group:
        flush()
    return out


def _pieces(texts: list, length: int) -> Iterator[list[tuple]]:
    """Groups of (row, start, bytes or word names) of about ``CHUNK`` symbols; a
    longer text comes in pieces that overlap by less than a window."""
    group, held = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), CHUNK):
            piece = text[start : start + CHUNK + length - 1]
            group.append((row, start, piece))
            held += len(piece)
            if held >= CHUNK:
                yield group
                group, held = [], 0
    if group:
        yield group


def segments(texts: list, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes | np.ndarray]]:
    """Per group of pieces: row, place in the text, number of windows, anchor
    name and place in the buffer of every segment, and the buffer.  Texts are
    bytes or arrays of word names."""
    for group in _pieces(texts, length):
        ends = np.cumsum([len(p) for _, _, p in group])
        if isinstance(group[0][2], bytes):
            buffer = b"".join(p for _, _, p in group)
            place, name = anchors(np.frombuffer(buffer, dtype=np.uint8), length)
        else:
            buffer = np.concatenate([p for _, _, p in group])
            place, name = word_anchors(buffer, length)
        piece = np.searchsorted(ends, np.arange(len(place)), side="right")
        inside = np.arange(len(place)) + length <= ends[piece]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | ~inside[:-1]])
        first = np.flatnonzero(new & inside)
        stop = np.flatnonzero(np.append(new | ~inside, True))
        count = stop[np.searchsorted(stop, first, side="right")] - first
        base = np.array([s for _, s, _ in group]) - np.concatenate([[0], ends[:-1]])
        yield np.array([r for r, _, _ in group])[piece[first]], first + base[piece[first]], count, name[place[first]], first, buffer


def _both(texts: list[bytes], length: int, words: int) -> Iterator[tuple]:
    """(whether of words, window length, segments) of texts as bytes and, with ``words``, as words."""
    for part in segments(texts, length):
        yield False, length, part
    if words:
        for part in segments(named(texts), words):
            yield True, words, part


def _marks(batches: Iterator[pa.RecordBatch], length: int, words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        d, t = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for w, long, (row, at, count, name, first, buffer) in _both(byte_texts(b.column(2)), length, words):
            view, digest = memoryview(buffer), xxhash.xxh3_64_intdigest
            seg = np.array([digest(view[a : a + n]) for a, n in zip(first.tolist(), (count + long - 1).tolist())], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([as_long(name), as_long(seg), pa.array(d[row]), pa.array(t[row]), pa.array(at.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(np.full(len(row), w))],
                                             names=["name", "seg", "d", "t", "at", "n", "w"])


def _wanted(batches: Iterator[pa.RecordBatch], length: int, words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        wanted = [{(x["name"], x["seg"]) for x in row} for row in b.column(1).to_pylist()]
        names = np.array([k for row in wanted for k, _ in row], dtype=np.int64)
        for w, long, (row, _, count, name, first, buffer) in _both(byte_texts(b.column(0)), length, words):
            view, digest = memoryview(buffer), xxhash.xxh3_64_intdigest
            near = np.flatnonzero(np.isin(name.view(np.int64), names))
            out = []
            for r, n, k, a in zip(row[near].tolist(), count[near].tolist(), name[near].view(np.int64).tolist(), first[near].tolist()):
                piece = view[a : a + n + long - 1]
                seg = int(np.uint64(digest(piece)).view(np.int64))
                if (k, seg) in wanted[r]:
                    wanted[r].discard((k, seg))
                    out.append((k, seg, n, w, bytes(piece)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()))], names=["name", "seg", "n", "w", "data"])


def suffix_array(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffix array of segments of bytes or 64-bit words that each end with an
    end mark, the largest symbol; ends of earlier segments are smaller.
    ``left``: symbols from each place to its end mark."""
    n, h = len(text), 8 // text.itemsize  # so many symbols make a first key
    ended = left < h
    if h == 1:
        word = text
    else:
        padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
        word = np.ndarray((n,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
        drop = (7 - left[ended]).astype(np.uint64) * np.uint64(8)
        word[ended] = word[ended] >> drop << drop
    sa = np.argsort(word, kind="stable")
    new = np.concatenate([[True], (word[sa[1:]] != word[sa[:-1]]) | ended[sa[1:]]])
    del word
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = 0
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # first slot of its group
    while True:
        slots = np.flatnonzero(~(new & np.append(new[1:], True)))  # of groups with two or more
        if not len(slots):
            return sa
        own = sa[slots]
        key = rank[own] << np.int64(32) | rank[np.minimum(own + h, n)]
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        sa[slots] = own
        new[slots] = fresh
        rank[own] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))]
        h *= 2


def common_prefix(text: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, up to their ends."""
    step = 8 // text.itemsize
    padded = np.concatenate([text, np.zeros(step, dtype=text.dtype)])
    word = np.ndarray((len(text) + 1,), dtype="<u8", buffer=padded, strides=(text.itemsize,))
    most = np.minimum(left[a], left[b])
    out = np.zeros(len(a), dtype=np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        differ = word[a[live] + out[live]] ^ word[b[live] + out[live]]
        same = differ == 0
        if step > 1:
            low = differ[~same] & (~differ[~same] + np.uint64(1))
            out[live[~same]] += np.log2(low.astype(np.float64)).astype(np.int64) // 8
        live = live[same]
        out[live] += step
        live = live[out[live] < most[live]]
    return np.minimum(out, most)


class RunIndex:
    """Run-compressed transform of a few segments, sampled at the run ends.
    Symbols are bytes, 0xFF (never part of UTF-8) the end mark, or 64-bit words."""

    def __init__(self, parts: list[bytes], symbol: type = np.uint8):
        size = np.dtype(symbol).itemsize
        self.text = np.frombuffer(b"".join(p + b"\xff" * size for p in parts), dtype=symbol)
        ends = np.cumsum([len(p) // size + 1 for p in parts]) - 1
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        self.left = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(len(self.text))
        sa = suffix_array(self.text, self.left)
        bwt = self.text[sa - 1]
        change = (bwt[1:] != bwt[:-1]) | (bwt[1:] == np.iinfo(symbol).max)  # each end mark is a symbol of its own
        head = np.concatenate([[True], change])
        self.runs = np.count_nonzero(head)  # lengths and symbols of the runs are the transform
        up, down = np.flatnonzero(head)[1:], np.flatnonzero(change)
        self.head_at, self.head_lcp = sa[up], common_prefix(self.text, self.left, sa[up], sa[up - 1])
        self.tail_at, self.tail_lcp = sa[down], common_prefix(self.text, self.left, sa[down], sa[down + 1])

    def statistics(self) -> np.ndarray:
        """At every place, the longest match that starts there and somewhere else."""
        place = np.arange(len(self.text))
        best = np.zeros(len(self.text), dtype=np.int64)
        for at, lcp in ((self.head_at, self.head_lcp), (self.tail_at, self.tail_lcp)):
            reach = np.zeros(len(self.text), dtype=np.int64)
            reach[at] = at + lcp
            best = np.maximum(best, np.maximum.accumulate(reach) - place)
        return best


def _runs_of(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"i": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


SPANS = "array<struct<i:int,n:int>>"
_SPANS = pa.list_(pa.struct([("i", pa.int32()), ("n", pa.int32())]))


def _index(batches: Iterator[pa.RecordBatch], length: int, words: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows of all segments of a partition, whose size was chosen;
    whole names are indexed together up to about ``INDEX_PART`` bytes."""
    both = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: (r[3], r[0]))
    parts: list[list[tuple]] = []
    held = 0
    for r in both:
        if not parts or r[3] != parts[-1][-1][3] or (held >= INDEX_PART and r[0] != parts[-1][-1][0]):
            parts.append([])
            held = 0
        parts[-1].append(r)
        held += len(r[4])
    for rows in parts:
        long, symbol = (words, np.uint64) if rows[0][3] else (length, np.uint8)
        index = RunIndex([r[4] for r in rows], symbol)
        again = index.statistics() >= long
        spans = [_runs_of(again[s : s + r[2]]) for s, r in zip(index.starts.tolist(), rows)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(spans, _SPANS)], names=["name", "seg", "spans"])


def _prints(batches: Iterator[pa.RecordBatch], length: int, words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for name, seg, n, w, data in zip(*(c.to_pylist() for c in b.columns)):
            view, long, size = memoryview(data), words if w else length, 8 if w else 1
            prints = [xxhash.xxh3_128_digest(view[i * size : (i + long) * size]) for i in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.int64()), pa.array([seg] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(prints, pa.binary())], names=["name", "seg", "i", "print"])


def repeated_bytes(rows: DataFrame, length: int = LENGTH, most_segments: int = MOST_SEGMENTS, words: int = 0) -> DataFrame:
    """(d, t, spans): per row key (d, t) the repeated windows, as (at, n); with
    ``words`` also passages, the repeated windows of so many words."""
    spark = rows.sparkSession
    marks = written(rows.select("d", "t", "text").mapInArrow(lambda b: _marks(b, length, words), "name bigint, seg bigint, d bigint, t bigint, at int, n int, w boolean"), "segments")
    # equal segments are counted before names are, so a passage that many documents share is one row of its name
    kinds = marks.groupBy("name", "seg").agg(F.count("*").alias("copies"), F.min(F.struct("d", "t")).alias("owner"), F.any_value("n").alias("n"))
    every = kinds = written(kinds, "segment-kinds")
    several = kinds.groupBy("name").agg(F.count("*").alias("kinds"), F.sum("copies").alias("total")).filter("total > 1")
    shared = kinds = written(kinds.join(several.select("name", "kinds"), "name"), "shared-segments")
    discard(every)
    whole = kinds.filter("copies > 1").select("name", "seg", F.array(F.struct(F.lit(0).alias("i"), "n")).cast(SPANS).alias("spans"))
    # one owner shows the bytes of each distinct segment that has others beside it
    asked = kinds.filter("kinds > 1").select("owner.d", "owner.t", F.struct("name", "seg").alias("x")).groupBy("d", "t").agg(F.collect_list("x").alias("asked"))
    shown = rows.join(asked, ["d", "t"]).select("text", "asked").mapInArrow(lambda b: _wanted(b, length, words), "name bigint, seg bigint, n int, w boolean, data binary")
    owned = written(shown, "segment-bytes")
    shown = owned.join(kinds.filter("kinds > 1").select("name", "seg", "kinds", "copies"), ["name", "seg"])
    shown = indexed = written(shown.dropDuplicates(["name", "seg"]), "index-input")
    discard(owned)
    size = shown.agg(F.sum(F.octet_length("data") + 1)).first()[0] or 0
    few = shown.filter(F.col("kinds") <= most_segments).select("name", "seg", "n", "w", "data")
    found = few.repartition(partitions_for(spark, size, INDEX_BYTES), "name").mapInArrow(lambda b: _index(b, length, words), f"name bigint, seg bigint, spans {SPANS}")
    prints = shown.filter(F.col("kinds") > most_segments).select("name", "seg", "n", "w", "data").mapInArrow(lambda b: _prints(b, length, words), "name bigint, seg bigint, i int, print binary")
    again = prints.groupBy("name", "print").agg(F.count("*").alias("c")).filter("c > 1").select("name", "print")
    crowd = prints.join(again, ["name", "print"]).groupBy("name", "seg").agg(F.collect_list(F.struct("i", F.lit(1).alias("n"))).cast(SPANS).alias("spans"))  # at most length windows
    found = written(whole.unionByName(found.join(whole.select("name", "seg"), ["name", "seg"], "left_anti").filter(F.size("spans") > 0)).unionByName(crowd), "repeated-segments")
    discard(shared)
    discard(indexed)
    hits = marks.join(found, ["name", "seg"]).select("d", "t", "w", F.expr("transform(spans, x -> named_struct('at', at + x.i, 'n', x.n))").alias("x"))
    # rows that repeat a (d, t) carry the same spans: each once, already within the tasks
    each = {"spans": ~F.col("w"), "passages": F.col("w")} if words else {"spans": F.lit(True)}
    out = hits.groupBy("d", "t").agg(*[F.array_sort(F.flatten(F.collect_set(F.when(which, F.col("x"))))).alias(k) for k, which in each.items()])
    out = written(out, "repeated-bytes")
    discard(marks)
    discard(found)
    return out


def _covered(spans: list[dict] | None, length: int) -> tuple[int, int]:
    """Runs and number of the symbols that windows of ``length`` symbols cover."""
    runs, total, stop = 0, 0, -1
    for s in spans or ():
        a, e = s["at"], s["at"] + s["n"] + length - 1
        runs += a > stop
        total += max(0, e - max(a, stop))
        stop = max(stop, e)
    return runs, total


def _kept(batches: Iterator[pa.RecordBatch], length: int, text_too: bool) -> Iterator[pa.RecordBatch]:
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 4 + text_too]
    for b in batches:
        out: list[tuple] = []
        k = b.num_columns
        for text, spans in zip(byte_texts(b.column(k - 2)), b.column(k - 1).to_pylist()):
            kept, at, gone = [], 0, 0
            stop = None  # end of the removed run so far
            for s in spans or ():
                a, e = s["at"], s["at"] + s["n"] + length - 1
                if stop is None or a > stop:
                    gone += 1
                    kept.append(text[at:a])
                stop = at = e if stop is None else max(stop, e)
            kept.append(text[at:])
            rest = b"".join(kept)
            out.append((len(text), len(text) - len(rest), gone, hashlib.sha256(rest).hexdigest(), *([rest.decode("utf-8", "ignore")] if text_too else [])))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([*b.columns[: k - 2], *[pa.array(c, x) for c, x in zip(columns, kinds)]], names=[*b.schema.names[: k - 2], *names])


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "t": F.xxhash64("text")})


def dedup(docs: DataFrame, length: int = LENGTH, with_text: bool = False, most_segments: int = MOST_SEGMENTS, words: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, with
    ``with_text`` what is left (halves of a character at a cut are dropped), and
    with ``words`` n_passage_words, words covered by a sequence of so many words
    that also starts elsewhere, and n_passages, their maximal runs."""
    ship(docs.sparkSession)
    rows = keyed(docs.select("doc_id", "text"))
    spans = repeated_bytes(rows, length, most_segments, words)
    passages = ["passages"] * bool(words)
    joined = rows.join(spans, ["d", "t"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), *passages, "text", "spans")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept string" * with_text
    more = ", n_passage_words bigint, n_passages bigint" * bool(words)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _kept(batches, length, with_text):
            if words:
                found = [_covered(x, words) for x in b.column(1).to_pylist()]
                both = [pa.array([x[i] for x in found], pa.int64()) for i in (1, 0)]
                b = pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *both], names=[b.schema.names[0], *b.schema.names[2:], "n_passage_words", "n_passages"])
            yield b

    return joined.mapInArrow(out, schema + more)


def strip_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with its columns, every text without its repeated bytes."""
    ship(docs.sparkSession)
    kd, kt, ks = free_name(docs, "_d"), free_name(docs, "_t"), free_name(docs, "_spans")
    rows = docs.withColumns({kd: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), kt: F.xxhash64("text")})
    spans = repeated_bytes(rows.select(F.col(kd).alias("d"), F.col(kt).alias("t"), "text"), length)
    spans = spans.select(F.col("d").alias(kd), F.col("t").alias(kt), F.col("spans").alias(ks))
    joined = rows.join(spans, [kd, kt], "left").select(*docs.columns, ks)
    names, at = docs.columns, docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            few = pa.RecordBatch.from_arrays([b.column(at), b.column(at), b.column(b.num_columns - 1)], names=["x", "text", "spans"])
            kept = next(_kept(iter([few]), length, True)).column("kept")
            text = pc.if_else(pc.is_null(b.column(at)), pa.scalar(None, pa.string()), kept)  # null stays null
            yield pa.RecordBatch.from_arrays([text if i == at else b.column(i) for i in range(b.num_columns - 1)], names=names)

    return joined.mapInArrow(cut, docs.schema)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest columns, the text that is left, and the passages of over 50 words that stand elsewhere too."""
    return dedup(table(spark, sf_dir, "documents"), with_text=True, words=WORDS).withColumnRenamed("kept", "text")
