"""Word-level substring dedup by recompression.

Each round of recompression renames a sequence of symbols: a run of equal
symbols becomes one symbol, the symbols fall into a left and a right class by
a hash of name and round, and every left symbol that is followed by a right one
merges with it into a symbol whose name is made of theirs.  Names are hashes of
names, so all tasks of all rounds give equal things equal names without asking
one another, and a merge depends on few words around it: equal passages get
equal symbols inside.

Every window of ``WIDTH`` words takes, of the merges that its own words settle,
the one of the highest round (of these the smallest name, then the leftmost) as
its symbol; equal windows therefore take equal symbols.  Windows in which
nothing merges (one word over and over) take a name of their whole content.

1. Every document's stretches of windows that took one symbol are written, named
   by symbol and content.  Symbols that occur in two or more documents are found by a
   partial aggregation; only their stretches go on (a join that AQE splits where a symbol is frequent).
2. Equal stretches are one from here on, with the smallest document that has
   them; all others that have them lose the whole stretch.
3. Where a symbol has different stretches, one owner of each shows the
   fingerprints of its windows, and the smallest document of each window is found.
4. Words covered by a window whose smallest document is not their own go.

Stretches and windows are compared by their symbol and their own name together,
two 64-bit names made with different seeds.

Null text has no words.  A null ``doc_id`` counts as larger than any other;
rows with equal ids are one document to the rule (neither is smaller), each
with its own result row.  Other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import as_long, byte_texts, discard, mix64, seed64, ship, table, window_names, word_names, written

WIDTH = 13
ROUNDS = 3
LAST_ID = 2**63 - 1
FAR = 1 << 30  # beyond any place
CHUNK_WORDS = 500_000
#: Steps that shuffle by symbol take the symbols in so many parts, one after
#: another, so that only one part's shuffle is on disk at a time.
SLICES = 4


def merges(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """All merges of a batch: round, name, place (first word of the right
    part), and the word range [lo, hi) that settles the merge.

    ``doc`` tells the document of each word; nothing merges across documents.
    """
    at = np.arange(len(names), dtype=np.int32)
    # what settles a symbol, seen from its right (llo, lhi) and from its left
    # (rlo, rhi): of a run only the end that is next to the onlooker counts
    far, zero = np.int32(FAR), np.int32(0)
    llo, lhi, rlo, rhi = at, at + np.int32(1), at, at + np.int32(1)
    found = []
    for r in range(1, rounds + 1):
        if len(names) < 2:
            break
        new = np.concatenate([[True], (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(names)) - 1
        names, doc, at, llo, lhi, rlo, rhi = names[starts], doc[starts], at[starts], llo[ends], lhi[ends], rlo[starts], rhi[starts]
        left = (mix64(names ^ seed64(100 + r)) >> np.uint64(63)) == 0
        same = doc[1:] == doc[:-1]
        pair = np.flatnonzero(left[:-1] & ~left[1:] & same)
        pair_lo, pair_hi = np.minimum(llo[pair], rlo[pair + 1]), np.maximum(lhi[pair], rhi[pair + 1])
        name = mix64(names[pair] * seed64(200 + r) + mix64(names[pair + 1] * seed64(300 + r)))
        found.append((np.full(len(pair), r, dtype=np.int32), name, at[pair + 1], pair_lo, pair_hi))
        if r == rounds:
            break
        # a symbol that stays alone does so because of its neighbour: a left
        # one of the next symbol, a right one of the previous symbol
        none_after, none_before = np.append(~same, True), np.append(True, ~same)
        by_lo = np.where(left, np.where(none_after, far, np.append(rlo[1:], zero)), np.where(none_before, -far, np.append(zero, llo[:-1])))
        by_hi = np.where(left, np.where(none_after, far, np.append(rhi[1:], zero)), np.where(none_before, -far, np.append(zero, lhi[:-1])))
        both_lo, both_hi = np.minimum(np.minimum(llo, rlo), by_lo), np.maximum(np.maximum(lhi, rhi), by_hi)
        llo, lhi = np.where(left, np.minimum(llo, by_lo), both_lo), np.where(left, np.maximum(lhi, by_hi), both_hi)
        rlo, rhi = np.where(left, both_lo, np.minimum(rlo, by_lo)), np.where(left, both_hi, np.maximum(rhi, by_hi))
        names = names.copy()
        names[pair] = name
        llo[pair] = rlo[pair] = pair_lo
        lhi[pair] = rhi[pair] = pair_hi
        keep = np.ones(len(names), dtype=bool)
        keep[pair + 1] = False
        names, doc, at, llo, lhi, rlo, rhi = names[keep], doc[keep], at[keep], llo[keep], lhi[keep], rlo[keep], rhi[keep]
    if not found:
        return tuple(np.empty(0, dtype=t) for t in (np.int32, np.uint64, np.int32, np.int32, np.int32))
    return tuple(np.concatenate(x) for x in zip(*found))


def _smallest_last(pick: np.ndarray, name: np.ndarray, place: np.ndarray) -> np.ndarray:
    """``pick`` by falling name, the leftmost last of equal ones."""
    order = np.argsort(~name)
    name = name[order]
    tied = np.flatnonzero(name[1:] == name[:-1])
    if len(tied):  # few of them need the second key
        among = np.zeros(len(name), dtype=bool)
        among[tied] = among[tied + 1] = True
        own = order[among]
        order[among] = own[np.lexsort((-place[own], ~name[among]))]
    return pick[order]


def symbols(names: np.ndarray, doc: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Stretches of windows that took the same merge: first window, number of
    windows, symbol, and the offset of the first window from the merge."""
    n = len(names) - width + 1
    if n <= 0:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.int64))
    valid = doc[: n] == doc[width - 1 :]
    rnd, name, place, lo, hi = merges(names, doc, rounds)
    fits = (hi - lo <= width) & (lo >= 0) & (hi <= len(names))
    rnd, name, place, lo, hi = rnd[fits], name[fits], place[fits], lo[fits], hi[fits]
    best = np.full(n, -1, dtype=np.int64)  # merge that each window takes
    for r in range(rounds, 0, -1):
        pick = np.flatnonzero(rnd == r)
        pick = _smallest_last(pick, name[pick], place[pick])
        first, last = np.maximum(hi[pick] - width, 0), np.minimum(lo[pick], n - 1)
        count = np.maximum(last - first + 1, 0)
        window = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        of = np.repeat(pick, count)
        free = best[window] < 0
        window, of = window[free], of[free]
        taken = np.full(n, -1, dtype=np.int64)
        taken[window] = of  # the last one written stays
        best = np.where(taken >= 0, taken, best)
    starts = np.flatnonzero(valid & np.concatenate([[True], (best[1:] != best[:-1]) | (best[1:] < 0) | ~valid[:-1]]))
    edge = np.flatnonzero(np.append(~valid | np.concatenate([[True], (best[1:] != best[:-1]) | (best[1:] < 0)]), True))
    ends = edge[np.searchsorted(edge, starts, side="right")]
    took = best[starts]
    whole = took < 0
    symbol = np.where(whole, np.uint64(0), name[took] if len(name) else np.uint64(0))
    if whole.any():
        symbol[whole] = mix64(window_names(names, width, 40)[starts[whole]])
    offset = np.where(whole, 0, (place[took] if len(place) else 0) - starts)
    return starts, ends - starts, symbol, offset


def _chunks(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows in chunks of about ``CHUNK_WORDS`` words: the rows, names of all
    words, the row of each word, and each row's first word (and the end)."""
    for b in batches:
        names, start, held = [], 0, 0
        texts = byte_texts(b.column(text_at))
        for i, t in enumerate(texts):
            x = word_names(t)
            names.append(x)
            held += len(x)
            if held >= CHUNK_WORDS or i == len(texts) - 1:
                ends = np.concatenate([[0], np.cumsum([len(x) for x in names])])
                yield b.slice(start, i + 1 - start), np.concatenate(names), np.repeat(np.arange(len(names)), np.diff(ends)), ends
                names, start, held = [], i + 1, 0


def _stretches_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """All stretches of every row (d, t, text)."""
    for rows, names, doc, ends in _chunks(batches, 2):
        starts, count, symbol, _ = symbols(names, doc, width)
        of = doc[starts]
        yield pa.RecordBatch.from_arrays(
            [as_long(symbol), as_long(_named(starts, count, symbol, window_names(names, width))), pa.array(rows.column(0).to_numpy(zero_copy_only=False)[of]),
             pa.array(rows.column(1).to_numpy(zero_copy_only=False)[of]), pa.array((starts - ends[of]).astype(np.int32)), pa.array(count.astype(np.int32))],
            names=["symbol", "stretch", "d", "t", "at", "n"])


def _windows_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The asked stretches of every row (d, text, asked), each once, with the names of
    their windows."""
    for rows, names, doc, _ in _chunks(batches, 1):
        starts, count, symbol, _ = symbols(names, doc, width)
        window = window_names(names, width)
        stretch = _named(starts, count, symbol, window)
        cut = np.searchsorted(doc[starts], np.arange(rows.num_rows + 1))
        keep = [np.empty(0, dtype=np.int64)]
        for i in range(rows.num_rows):
            own, at = np.unique(stretch[cut[i] : cut[i + 1]].view(np.int64), return_index=True)
            keep.append(cut[i] + at[np.isin(own, rows.column(2)[i].values.to_numpy(zero_copy_only=False), assume_unique=True)])
        kept = np.concatenate(keep)
        starts, count = starts[kept], count[kept]
        total = np.concatenate([[0], np.cumsum(count)])
        flat = window[np.repeat(starts - total[:-1], count) + np.arange(total[-1])]
        d = rows.column(0).to_numpy(zero_copy_only=False)[doc[starts]]
        yield pa.RecordBatch.from_arrays([as_long(symbol[kept]), as_long(stretch[kept]), pa.array(d, pa.int64()), pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), as_long(flat))],
                                         names=["symbol", "stretch", "least", "windows"])


def _named(starts: np.ndarray, count: np.ndarray, symbol: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Names of stretches: of their symbol, length and windows in order."""
    last = starts + count - 1
    middle = window[starts + count // 2]
    # windows overlap, so the first, a middle and the last spell out all words
    return mix64(symbol + window[starts] * seed64(61) + middle * seed64(62) + window[last] * seed64(63) + count.astype(np.uint64) * seed64(64))


def _removed(batches: Iterator[pa.RecordBatch], width: int, text_too: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[tuple] = []
        spans = b.column(2)
        ends = np.concatenate([[0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        flat = spans.flatten()
        at, n = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("at", "n"))
        for text, p, q in zip(byte_texts(b.column(1)), ends[:-1].tolist(), ends[1:].tolist()):
            words = text.split()
            gone = 0
            if q > p:
                edge = np.bincount(at[p:q], minlength=len(words) + 1) - np.bincount(at[p:q] + n[p:q] + width - 1, minlength=len(words) + 1)
                keep = np.cumsum(edge)[:-1] == 0
                gone = int(len(words) - np.count_nonzero(keep))
            kept = b" ".join(compress(words, keep.tolist()) if q > p else words)
            out.append((len(words), gone, hashlib.sha256(kept).hexdigest(), *([kept.decode()] if text_too else [])))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*out)) or [()] * (3 + text_too)
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: 4 + text_too])


def sliced(make: Callable[[Column], DataFrame], tag: str) -> tuple[DataFrame, list[DataFrame]]:
    """What ``make`` gives for each part of the symbols, written part by part: the
    whole, and the parts."""
    parts = [written(make(F.pmod(F.col("symbol"), F.lit(SLICES)) == i), tag) for i in range(SLICES)]
    return reduce(DataFrame.unionAll, parts), parts


def repeated_windows(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(d, t, spans): per row key, the stretches of windows to remove.

    ``rows``: d (the document), t (a hash of the text) and text.
    """
    spread = rows.select("d", "t", "text").mapInArrow(lambda b: _stretches_of(b, width), "symbol bigint, stretch bigint, d bigint, t bigint, at int, n int")
    spread = written(spread, "all-stretches")
    shared = spread.groupBy("symbol").agg(F.min("d").alias("a"), F.max("d").alias("b")).filter("a < b").select("symbol")
    shared = written(shared, "shared-symbols")
    found, _ = sliced(lambda part: spread.filter(part).join(shared, "symbol"), "stretches")
    discard(spread)
    discard(shared)
    # equal stretches are one from here on, however many documents have them
    own = found.groupBy("symbol", "stretch").agg(F.min(F.struct("d", "t")).alias("o")).select("symbol", "stretch", F.col("o.d").alias("least"), F.col("o.t").alias("t"))
    own = written(own, "stretch-owners")
    several = own.groupBy("symbol").agg(F.min("stretch").alias("x"), F.max("stretch").alias("y")).filter("x < y").select("symbol")
    asked = own.join(several, "symbol").groupBy(F.col("least").alias("d"), "t").agg(F.collect_list("stretch").alias("asked"))
    # rows that repeat an owner show the same windows: one is enough
    shown = rows.join(asked, ["d", "t"]).dropDuplicates(["d", "t"]).select("d", "text", "asked")
    shown = written(shown.mapInArrow(lambda b: _windows_of(b, width), "symbol bigint, stretch bigint, least bigint, windows array<bigint>"), "windows")

    def late_windows(part: Column) -> DataFrame:
        """Per stretch the windows that a smaller document has too."""
        windows = shown.filter(part).select("symbol", "stretch", "least", F.posexplode("windows").alias("i", "window"))
        first = windows.groupBy("symbol", "window").agg(F.min("least").alias("first"), F.max("least").alias("last")).filter("first < last").select("symbol", "window", "first")
        late = windows.join(first, ["symbol", "window"]).filter("first < least")
        return late.groupBy("symbol", "stretch").agg(F.collect_list("i").alias("late"))  # at most width windows a stretch

    late, parts = sliced(late_windows, "late-windows")
    discard(shown)
    # late windows of a stretch mostly follow one another: one span then
    runs = F.expr("""if(array_max(late) - array_min(late) + 1 = size(late), array(named_struct('i', array_min(late), 'n', size(late))),
        transform(late, i -> named_struct('i', i, 'n', 1)))""")
    known = written(own.drop("t").join(late.withColumn("late", runs), ["symbol", "stretch"], "left"), "stretches-known")
    for table_ in (own, *parts):
        discard(table_)
    hits = found.join(known, ["symbol", "stretch"]).filter("least < d or late is not null")
    gone = F.expr("if(least < d, array(named_struct('at', at, 'n', n)), transform(late, r -> named_struct('at', at + r.i, 'n', r.n)))")
    # rows that repeat a (d, t) carry the same spans: each once, already within the tasks
    return hits.select("d", "t", gone.alias("spans")).groupBy("d", "t").agg(F.flatten(F.collect_set("spans")).alias("spans"))  # a document's own, no longer than its text


def dedup(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumns({"d": F.coalesce("doc_id", F.lit(LAST_ID)), "t": F.xxhash64("text")})
    spans = written(repeated_windows(rows, width), "repeated-windows")
    joined = rows.join(spans, ["d", "t"], "left").select("doc_id", "text", "spans")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text
    return joined.mapInArrow(lambda b: _removed(b, width, with_text), schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


OP10 = r"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM t, unnest(range(1, len(w) - 11)) AS u(i) WHERE len(w) >= 13),
late AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM late, unnest(range(0, 13)) AS v(j)),
words AS (SELECT doc_id, p, w[p] AS x FROM t, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""
