"""Cross-tokenizer alignment by diagonal run skipping.

A text is encoded by a byte-level BPE (A) and by a piece BPE (B) that start
from the same bytes, a space and the text.  The tokens' end offsets, one
ascending array per tokenizer, cut the bytes into groups wherever both end.

The arrays are compared along a diagonal: at the current shift between both
indexes, exponentially growing slices are compared whole, and halved again
where they differ, so a stretch of one-to-one tokens of any length takes a
logarithmic number of slice comparisons.  Where the next ends differ, the smaller one
advances until both meet: that group is irregular and sets the new shift.

Every A token of a group is linked with every B token of it.  For each id pair
Spark counts the documents that link it, and the highest count of each A id.
Documents travel in batches: a batch's distinct pairs are numbered, its
documents keep numbers with their multiplicities, and only distinct pairs of a
batch are shuffled to be counted; the counts come back by batch and are cogrouped with the
batch's documents.

Texts are encoded in stretches, cut at every single space between two
characters that are not space: no token of either tokenizer spans the place before such a
space (checked for B when it is loaded; A's pattern begins a new word there).
Most stretches are single words, so a worker encodes each distinct one once and remembers
it, in a memory of bounded size.

Null and empty texts have no tokens, nor have texts whose tokens do not spell
out the space and the text (a text with U+2581): zeros and an empty digest.  Rows
are documents: repeated rows count each, a null ``doc_id`` stays null.  Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import byte_texts, ship, table, written

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: How a byte-level BPE of this kind splits text before its merges (fixed by the tokenizer).
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of stretches that a worker remembers.
REMEMBERED_CHARS = 4_000_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Tokens compared by the first probe of a run; later ones double.
FIRST_PROBE = 1
#: Irregular groups with more links than this are linked id by id.
_MANY = 4_096
_BATCH = "batch bigint, is_doc boolean, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: the
    printable characters of Latin-1 for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _digits(n_ids: int) -> np.ndarray:
    """Decimal ids as bytes, followed by ',', then by '|', then by ';'."""
    out = np.empty(3 * n_ids, dtype=object)
    out[:] = [b"%d%s" % (i, end) for end in (b",", b"|", b";") for i in range(n_ids)]
    return out


@dataclass(frozen=True)
class Side:
    """One tokenizer: ids of stretches, and what each id spells out."""

    encode: object  # stretches -> all their ids in order, and how many ids each has
    spelled: list[bytes]
    lengths: np.ndarray
    digits: np.ndarray


def _side(encode, spelled: list[bytes]) -> Side:
    return Side(encode, spelled, np.array([len(x) for x in spelled], dtype=np.int64), _digits(len(spelled)))


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(list(chain.from_iterable(ids)), dtype=np.int32), np.array([len(x) for x in ids], dtype=np.int64)


def _loose(x: str) -> bool:
    """Begins or ends with a space (or is empty), so that it cannot be joined
    with others by single spaces."""
    return not x or x[0].isspace() or x[-1].isspace()


@functools.cache
def side_a(path: str = TOKENIZER_A) -> Side:
    """The byte-level BPE of a tokenizer file, run by its ranks: the id of a
    merged piece must follow the order of the merges."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before, byte_of = spec["model"], spec["pre_tokenizer"], _byte_of()
    special = {t["content"] for t in spec["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or [model["vocab"][x + y] for x, y in merges] != list(range(256, 256 + len(merges))):
        raise ValueError(f"{path}: only a plain byte-level BPE whose ids follow its merges is supported")
    spelled = [b""] * (max(model["vocab"].values()) + 1)
    for piece, i in model["vocab"].items():
        spelled[i] = piece.encode() if piece in special else bytes(byte_of[c] for c in piece)
    ranks = {spelled[i]: i for p, i in model["vocab"].items() if p not in special}
    bpe = tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
    lengths = np.array([len(x) for x in spelled], dtype=np.int64)

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if any(map(_loose, texts)):
            return _flat([bpe.encode_ordinary(" " + x) for x in texts])
        ids = np.array(bpe.encode_ordinary("".join([" " + x for x in texts])), dtype=np.int32)
        ends = np.cumsum([len(x.encode()) + 1 for x in texts])
        return ids, np.diff(np.searchsorted(np.cumsum(lengths[ids]), ends, side="right"), prepend=0)

    return _side(encode, spelled)


@functools.cache
def side_b(path: str = TOKENIZER_B) -> Side:
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
    if any(re.search(f"[^{MARK}]{MARK}", x) for x in pieces):
        raise ValueError(f"{path}: a piece spans the start of a word, so texts cannot be cut there")
    spelled = [bytes([int(x[1:-1], 16)]) if p.is_byte(i) else x.replace(MARK, " ").encode() for i, x in enumerate(pieces)]
    return _side(lambda texts: _flat(p.encode(texts, num_threads=1)), spelled)


def stretches(text: str) -> list[str]:
    """The text cut at single spaces, which go: every stretch is encoded with a
    leading space of its own."""
    return _CUT.split(text)


def run_cuts(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """For each group, how many tokens of A and of B end with it.  Both lists
    ascend and have the same last entry."""
    cut_a: list[int] = []
    cut_b: list[int] = []
    i = j = 0
    n, m = len(ends_a), len(ends_b)
    while i < n and j < m:
        if ends_a[i] == ends_b[j]:
            k, step = 1, FIRST_PROBE
            while i + k < n and j + k < m and ends_a[i + k : i + k + step] == ends_b[j + k : j + k + step]:
                k += step
                step *= 2
            k = min(k, n - i, m - j)  # the last slices may have ended early, both at once
            while step > 1 and i + k < n and j + k < m:
                step //= 2
                if i + k < n and j + k < m and ends_a[i + k : i + k + step] == ends_b[j + k : j + k + step]:
                    k = min(k + step, n - i, m - j)
            cut_a.extend(range(i + 1, i + k + 1))
            cut_b.extend(range(j + 1, j + k + 1))
            i, j = i + k, j + k
        else:
            a, b = ends_a[i], ends_b[j]
            while a != b:
                if a < b:
                    i += 1
                    a = ends_a[i]
                else:
                    j += 1
                    b = ends_b[j]
            i, j = i + 1, j + 1
            cut_a.append(i)
            cut_b.append(j)
    return cut_a, cut_b


def _links(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs (A's id in the upper half) and how often each is linked."""
    from_a, from_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
    x, y = cut_a - from_a, cut_b - from_b
    few = x * y <= _MANY
    count = np.where(few, x * y, 0)
    group = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)
    pairs, times = np.unique(a[from_a[group] + nth // y[group]] << 32 | b[from_b[group] + nth % y[group]], return_counts=True)
    if few.all():
        return pairs, times
    parts, repeats = [pairs], [times]
    for g in np.flatnonzero(~few):
        (p, s), (q, t) = (np.unique(v, return_counts=True) for v in (a[from_a[g] : cut_a[g]], b[from_b[g] : cut_b[g]]))
        parts.append((p[:, None] << 32 | q).ravel())
        repeats.append((s[:, None] * t).ravel())
    pairs, at = np.unique(np.concatenate(parts), return_inverse=True)
    times = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(times, at, np.concatenate(repeats))
    return pairs, times


def _digest(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, sa: Side, sb: Side) -> str:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3``."""
    from_a, from_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
    last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    last_a[cut_a - 1] = last_b[cut_b - 1] = 1
    out = np.empty(len(a) + len(b), dtype=object)
    out[np.arange(len(a)) + np.repeat(from_b, cut_a - from_a)] = sa.digits[a + last_a * len(sa.spelled)]
    out[np.arange(len(b)) + np.repeat(cut_a, cut_b - from_b)] = sb.digits[b + 2 * last_b * len(sb.spelled)]
    return hashlib.sha256(b"".join(out.tolist())[:-1]).hexdigest()


@dataclass(frozen=True)
class Alignment:
    """Token ids, and per group how many tokens of each side end with it."""

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray

    @property
    def groups(self) -> list[tuple[list[int], list[int]]]:
        """The ids of each group."""
        ca, cb = [0, *self.cut_a.tolist()], [0, *self.cut_b.tolist()]
        return [(self.a[p:q].tolist(), self.b[r:s].tolist()) for p, q, r, s in zip(ca, ca[1:], cb, cb[1:])]


class Aligner:
    """Encodes and aligns texts; remembers the ids of stretches."""

    def __init__(self, sa: Side, sb: Side):
        self.sa, self.sb = sa, sb
        self.known: dict[str, tuple[bytes, bytes] | None] = {}  # None: not spelled out by both
        self.chars = 0

    def _learn(self, new: list[str]) -> None:
        if not new:
            return
        spelled = [(" " + x).encode() for x in new]
        together, found = b"".join(spelled), []
        whole = np.ones(len(new), dtype=bool)
        for side in (self.sa, self.sb):
            ids, counts = side.encode(new)
            ends = np.cumsum(counts).tolist()
            if b"".join([side.spelled[i] for i in ids.tolist()]) != together:
                own = [b"".join([side.spelled[i] for i in ids[p:q].tolist()]) for p, q in zip([0, *ends], ends)]
                whole &= np.array([x == y for x, y in zip(own, spelled)])
            data = ids.tobytes()
            found.append([data[4 * p : 4 * q] for p, q in zip([0, *ends], ends)])
        self.known.update((x, (a, b) if ok else None) for x, a, b, ok in zip(new, *found, whole.tolist()))
        self.chars += sum(map(len, new))

    def align(self, texts: list[str]) -> list[Alignment | None]:
        """The alignment of every text; None: no tokens."""
        pieces = [stretches(t) if t else [] for t in texts]
        if self.chars > REMEMBERED_CHARS:
            self.known, self.chars = {}, 0
        new = [x for x in dict.fromkeys(chain.from_iterable(pieces)) if x not in self.known]
        self._learn([x for x in new if not _loose(x)])
        self._learn([x for x in new if _loose(x)])
        out: list[Alignment | None] = []
        for p in pieces:
            parts = [self.known[x] for x in p]
            if not parts or None in parts:
                out.append(None)
                continue
            a, b = (np.frombuffer(b"".join([x[side] for x in parts]), dtype=np.int32).astype(np.int64) for side in (0, 1))
            cut_a, cut_b = run_cuts(np.cumsum(self.sa.lengths[a]).tolist(), np.cumsum(self.sb.lengths[b]).tolist())
            out.append(Alignment(a, b, np.array(cut_a, dtype=np.int64), np.array(cut_b, dtype=np.int64)))
        return out


_SOME_CHARS = 2_000_000


def _some(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts in lots of bounded length."""
    lot, held = [], 0
    for t in texts:
        lot.append(t or "")
        held += len(lot[-1])
        if held >= _SOME_CHARS:
            yield lot
            lot, held = [], 0
    if lot:
        yield lot


def _aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """Per batch, a row for each document and one with all distinct pairs and
    the number of documents that link each."""
    sa, sb = side_a(path_a), side_b(path_b)
    aligner = Aligner(sa, sb)
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        facts, pairs, times = [], [], []
        for lot in _some([None if x is None else x.decode() for x in byte_texts(batch.column(1))]):
            for r in aligner.align(lot):
                if r is None:
                    facts.append((0, 0, 0, 0, ""))
                    p = t = np.empty(0, dtype=np.int64)
                else:
                    p, t = _links(r.a, r.b, r.cut_a, r.cut_b)
                    facts.append((len(r.a), len(r.b), len(r.cut_a), int(t.sum()), _digest(r.a, r.b, r.cut_a, r.cut_b, sa, sb)))
                pairs.append(p)
                times.append(t)
        known, at, docs = np.unique(np.concatenate(pairs) if pairs else np.empty(0, dtype=np.int64), return_inverse=True, return_counts=True)
        ends = np.cumsum([0, *map(len, pairs), len(known)])
        n = batch.num_rows
        columns = [pa.array([number] * (n + 1), pa.int64()), pa.array([True] * n + [False]), pa.array([*batch.column(0).to_pylist(), None], pa.int64())]
        columns += [pa.array([*c, None], k) for c, k in zip(zip(*facts) if n else [()] * 5, [pa.int64()] * 4 + [pa.string()])]
        offsets = pa.array(ends.astype(np.int32))
        columns += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([at, known]))), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*times, docs]).astype(np.int64)))]
        yield pa.RecordBatch.from_arrays(columns, names=["batch", "is_doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
        number += 1


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """One batch: its documents with the sums over their links."""
    n = counts.num_rows
    count, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    at = counts["at"].to_numpy()
    count[at], best[at] = counts["docs"].to_numpy(), counts["best"].to_numpy().astype(np.int64)
    pairs, times = docs["pairs"].combine_chunks(), docs["times"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
    links = pairs.flatten().to_numpy()
    weight = times.flatten().to_numpy()
    n_best, total = (np.concatenate([[0], np.cumsum(weight * v[links])])[ends] for v in (best, count))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return out.append_column("n_best", pa.array(np.diff(n_best))).append_column("count_sum", pa.array(np.diff(total))).append_column("groups_sha256", docs["groups_sha256"])


def pair_counts(batches: DataFrame) -> DataFrame:
    """(pair, docs, best): for every linked id pair the documents that link it,
    and whether no pair of its A id has more."""
    each = batches.filter(~F.col("is_doc")).select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("docs"))
    counts = each.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    batches = written(rows.mapInArrow(lambda b: _aligned(b, path_a, path_b), _BATCH), "aligned")
    counts = written(pair_counts(batches), "pair-counts")
    asked = batches.filter(~F.col("is_doc")).select(F.col("batch").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts, "pair").select("of", "at", "docs", "best")
    lists = batches.filter("is_doc").drop("is_doc")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return lists.groupBy("batch").cogroup(answers.groupBy("of")).applyInArrow(_cogrouped, schema)


def _cogrouped(docs: pa.Table, counts: pa.Table) -> pa.Table:
    if not counts.num_rows:  # no document of the batch has tokens
        counts = pa.table({"at": pa.array([], pa.int32()), "docs": pa.array([], pa.int64()), "best": pa.array([], pa.bool_())})
    return _scored(docs, counts)


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))
