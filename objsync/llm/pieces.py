"""SentencePiece unigram segmentation: token counts, encoding and decoding.

An Aho-Corasick automaton over the pieces reports, at each position of a text,
every piece that ends there, longest first; Viterbi keeps the best score per
position.  Tie rules are the tokenizer's: of equal scores the path whose last
piece starts first wins (the longest piece), a character that is no piece
costs the lowest score less 10, and with byte fallback it counts as one piece
per UTF-8 byte.  Scores are added exactly (in 64 bits), where the reference
tokenizer rounds sums to 32 bits, so they can part ways once a path's score
passes 2**24.

A text is cut where no piece can span: before a word mark that follows
another character, and around line ends, provided that the vocabulary has no
piece across such a place (checked when it is loaded).  The best path of a text is
the best paths of its parts, so each distinct part is solved once per worker
and remembered, in a memory of bounded size.

Null and empty texts have no pieces.  Rows are handled one by one, so repeated
rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from objsync.llm.common import ship, table

#: A public vocabulary; any SentencePiece model without a character map works.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed by the tokenizer
MOST_REMEMBERED = 100_000
#: Parts from this length on are solved in typed arrays, a few bytes per character.
LONG = 10_000


def _cells(kind: str, value, n: int) -> list | array:
    return [value] * n if n < LONG else array(kind, [value]) * n


@dataclass(frozen=True)
class Vocabulary:
    """What a unigram segmentation needs of a model file."""

    pieces: dict[str, tuple[int, float]]  # piece -> id, score
    byte_ids: tuple[int, ...]  # ids of the 256 byte pieces; empty: no fallback
    unknown: int
    unknown_score: float
    surface: list[bytes] = field(repr=False)  # per id, what it decodes to
    add_prefix: bool = True

    @property
    def cuts(self) -> re.Pattern | None:
        """Matches the parts of a text that no piece spans; None: the whole text."""
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces):
            return None
        if any("\n" in p for p in self.pieces):
            return re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        return re.compile(f"{MARK}+[^{MARK}\n]*|\n+|[^{MARK}\n]+")


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file, its scores read as unigram scores."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, kind = model.normalizer_spec, pb.ModelProto.SentencePiece
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: only models that keep every character are supported")
    normal = [p.score for p in model.pieces if p.type == kind.NORMAL]
    pieces, surface, unknown, bytes_at = {}, [], 0, {}
    for i, p in enumerate(model.pieces):
        out = p.piece.replace(MARK, " ").encode()
        if p.type == kind.NORMAL:
            pieces[p.piece] = (i, p.score)
        elif p.type == kind.USER_DEFINED:
            pieces[p.piece] = (i, len(p.piece.encode()) * max(normal) - 0.1)
        elif p.type == kind.UNKNOWN:
            unknown, out = i, model.trainer_spec.unk_surface.encode()
        elif p.type == kind.BYTE:
            out = bytes([int(p.piece[1:-1], 16)])
            bytes_at[out[0]] = i
        else:
            out = b""
        surface.append(out)
    if model.trainer_spec.byte_fallback and len(bytes_at) != 256:
        raise ValueError(f"{path}: byte fallback needs 256 byte pieces")
    byte_ids = tuple(bytes_at[b] for b in range(256)) if model.trainer_spec.byte_fallback else ()
    return Vocabulary(pieces, byte_ids, unknown, min(normal) - UNKNOWN_PENALTY, surface, norm.add_dummy_prefix)


class Segmenter:
    """Best paths of texts, part by part."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.cuts = vocabulary.cuts
        self.counts: dict[str, tuple[int, float]] = {}
        self.ids: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(" ", MARK)
        if self.v.add_prefix:
            text = MARK + text
        return self.cuts.findall(text) if self.cuts else [text]

    def count(self, part: str) -> tuple[int, float]:
        """Number of pieces and score of the best path: no path is kept."""
        n, unk = len(part), self.v.unknown_score
        score, pieces = _cells("d", -inf, n + 1), _cells("q", 0, n + 1)
        score[0] = 0.0
        # a run of unknown characters is one piece unless bytes stand for it
        open_run = _cells("b", False, n + 1)
        at = 1
        single = False

        def close(end: int) -> None:  # the unknown character comes last, and only if no piece is that character
            if not single:
                new = score[end - 1] + unk
                if new > score[end]:
                    score[end] = new
                    if self.v.byte_ids:
                        pieces[end] = pieces[end - 1] + len(part[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        pieces[end] = pieces[end - 1] + (not open_run[end - 1])
                        open_run[end] = True

        for last, (length, _, s) in self.automaton.iter(part):
            end = last + 1
            while at < end:
                close(at)
                at, single = at + 1, False
            start = end - length
            single = single or length == 1
            new = score[start] + s
            if new > score[end]:
                score[end], pieces[end], open_run[end] = new, pieces[start] + 1, False
        while at <= n:
            close(at)
            at, single = at + 1, False
        return pieces[n], score[n]

    def path(self, part: str) -> bytes:
        """Ids of the best path, as int32 bytes."""
        n, unk = len(part), self.v.unknown_score
        score, back, via = _cells("d", -inf, n + 1), _cells("i", 0, n + 1), _cells("i", 0, n + 1)
        score[0] = 0.0
        at, single = 1, False
        for last, (length, i, s) in self.automaton.iter(part):
            end = last + 1
            while at < end:
                if not single and score[at - 1] + unk > score[at]:
                    score[at], back[at], via[at] = score[at - 1] + unk, at - 1, -1
                at, single = at + 1, False
            start = end - length
            single = single or length == 1
            if score[start] + s > score[end]:
                score[end], back[end], via[end] = score[start] + s, start, i
        while at <= n:
            if not single and score[at - 1] + unk > score[at]:
                score[at], back[at], via[at] = score[at - 1] + unk, at - 1, -1
            at, single = at + 1, False
        out = array("i")
        end, after_unknown = n, False
        while end:
            start, i = back[end], via[end]
            if i >= 0:
                out.append(i)
            elif self.v.byte_ids:
                out.extend([self.v.byte_ids[b] for b in reversed(part[start:end].encode("utf-8", "surrogatepass"))])
            elif not after_unknown:
                out.append(self.v.unknown)
            after_unknown = i < 0
            end = start
        out.reverse()
        return out.tobytes()

    def count_text(self, text: str) -> tuple[int, float]:
        known = self.counts
        if len(known) > MOST_REMEMBERED:
            known.clear()
        n, total = 0, 0.0
        for part in self.parts(text):
            got = known.get(part)
            if got is None:
                got = self.count(part)
                if len(part) < 100:
                    known[part] = got
            n += got[0]
            total += got[1]
        return n, total

    def encode_text(self, text: str) -> np.ndarray:
        known = self.ids
        if len(known) > MOST_REMEMBERED:
            known.clear()
        out = []
        for part in self.parts(text):
            got = known.get(part)
            if got is None:
                got = self.path(part)
                if len(part) < 100:
                    known[part] = got
            out.append(got)
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode_ids(self, ids: np.ndarray) -> str:
        """The text of a row of ids; bytes that are no UTF-8 become U+FFFD."""
        out = b"".join(map(self.v.surface.__getitem__, ids.tolist()))
        if self.v.add_prefix and out.startswith(b" "):
            out = out[1:]
        return out.decode("utf-8", "replace")


_SEGMENTERS: dict[str, Segmenter] = {}


def _segmenter(key: str, shared) -> Segmenter:
    """One per worker process and vocabulary; tasks that follow reuse it."""
    if key not in _SEGMENTERS:
        _SEGMENTERS.clear()
        _SEGMENTERS[key] = Segmenter(shared.value)
    return _SEGMENTERS[key]


def _shared(spark: SparkSession, path: str):
    """A model file has a bounded vocabulary, which is broadcast."""
    ship(spark)
    vocabulary = load(path)
    return hashlib.sha256(repr((vocabulary.pieces, vocabulary.byte_ids)).encode()).hexdigest(), spark.sparkContext.broadcast(vocabulary)


def token_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(id, n_pieces, score) of every row: pieces and score of its best path."""
    key, shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = _segmenter(key, shared)
        for b in batches:
            got = [seg.count_text(x or "") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array([s for _, s in got], pa.float64())], names=[id, "n_pieces", "score"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, n_pieces bigint, score double")


def encode(docs: DataFrame, keep: list[str], text: str = "text", model: str = MODEL) -> DataFrame:
    """Columns ``keep`` of every row, and its ``ids``."""
    key, shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = _segmenter(key, shared)
        for b in batches:
            for part in _slices(b, len(keep)):
                rows = [seg.encode_text(x or "") for x in part.column(len(keep)).to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[*keep, "ids"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(run, f"{kinds}ids array<int>")


def decode(coded: DataFrame, keep: list[str], ids: str = "ids", model: str = MODEL) -> DataFrame:
    """Columns ``keep`` of every row, and the text of its ids; null ids: null."""
    key, shared = _shared(coded.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = _segmenter(key, shared)
        for b in batches:
            rows = b.column(len(keep))
            texts = [None if rows[i].values is None else seg.decode_ids(rows[i].values.to_numpy(zero_copy_only=False)) for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    kinds = "".join(f"`{c}` {coded.schema[c].dataType.simpleString()}, " for c in keep)
    return coded.select(*keep, ids).mapInArrow(run, f"{kinds}decoded string")


def _slices(batch: pa.RecordBatch, at: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` text bytes (a longer row alone)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def round_trip(docs: DataFrame, keep: list[str], model: str = MODEL) -> DataFrame:
    """``encode`` and back: keep, ids, n_pieces, decoded_sha256, round_trip.

    ``round_trip`` tells whether decoding gives the text again; only a text
    that has the word mark itself (U+2581) does not, as in the tokenizer.
    """
    key, shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, k = _segmenter(key, shared), len(keep)
        for b in batches:
            for part in _slices(b, k):
                texts = [x or "" for x in part.column(k).to_pylist()]
                rows = [seg.encode_text(x) for x in texts]
                back = [seg.decode_ids(r) for r in rows]
                ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:k], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(np.diff(ends).astype(np.int64)),
                     pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back]), pa.array([x == y for x, y in zip(texts, back)], pa.bool_())],
                    names=[*keep, "ids", "n_pieces", "decoded_sha256", "round_trip"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, docs["text"].alias("_text")).mapInArrow(run, f"{kinds}ids array<int>, n_pieces bigint, decoded_sha256 string, round_trip boolean")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), ["doc_id"])
