"""Chat formatting by columnar byte assembly.

A conversation's turns, in order, become one text.  Control strings mark the
turns; inside texts and role names they are broken up reversibly.  A batch of
turns is formatted at once: numpy computes the lengths of all segments, their
offsets and the scatter indices, and headers, contents and endings are copied
into one Arrow buffer that was sized beforehand.

Template (fixed values)::

    user        <s>[INST] text [/INST]
    assistant    text</s>                      (with a leading space)
    other role  <s>[ROLE]role[/ROLE]text</s>

Escape: a backslash doubles, and a control string gets a backslash after its
first character, so no control string is left in an escaped text.

The output has one row per ``chunk`` of a conversation; a conversation has
many chunks only if it is longer than a batch, so that no conversation has to
fit into a task's memory.  ``loss`` lists (start, length) code-point spans of
a chunk: the assistants' texts as they stand there, without the leading
space and the ending.

Order: by turn (null first); repeated turns by role, then text.  Null role and
text count as empty; rows with a null ``conv_id`` form one conversation.
Other columns are ignored.  No rows, no output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import ship, table

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
USER = (b"<s>[INST] ", b" [/INST]")
ASSISTANT = (b" ", b"</s>")
OTHER = (b"<s>[ROLE]", b"[/ROLE]", b"</s>")

FORMATTED = "conv_id bigint, chunk bigint, formatted string, loss array<struct<start:bigint,length:bigint>>"
_TURN = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<s>\[ROLE\](?P<role>.*?)\[/ROLE\](?P<other>.*?)</s>| (?P<assistant>.*?)</s>", re.S)


def escape(texts: pa.Array) -> pa.Array:
    texts = pc.replace_substring(texts, "\\", "\\\\")
    for c in CONTROL:
        texts = pc.replace_substring(texts, c, c[0] + "\\" + c[1:])
    return texts


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _lengths(a: pa.Array) -> np.ndarray:
    return pc.binary_length(a).to_numpy(zero_copy_only=False).astype(np.int64)


def _bytes(a: pa.Array) -> np.ndarray:
    """The bytes of all values of a (large) string array, one after the other."""
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]] if len(a) else data[:0]


def scatter(out: np.ndarray, at: np.ndarray, source: np.ndarray, lengths: np.ndarray) -> None:
    """Copy consecutive runs of ``source`` to the places ``at`` of ``out``."""
    starts = np.cumsum(lengths) - lengths
    out[np.repeat(at - starts, lengths) + np.arange(len(source))] = source


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all formatted turns; each turn's offset (and the end),
    and the code-point (start, length) of its text within the turn."""
    roles, texts = escape(roles.cast(pa.large_string())), escape(texts.cast(pa.large_string()))
    user = pc.equal(roles, "user").to_numpy(zero_copy_only=False)
    assistant = pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)
    kind = np.where(user, 0, np.where(assistant, 1, 2))
    names = pc.if_else(pa.array(kind == 2), roles, pa.scalar("", pa.large_string()))
    heads = (USER[0], ASSISTANT[0], OTHER[0])
    mids = (b"", b"", OTHER[1])
    tails = (USER[1], ASSISTANT[1], OTHER[2])
    segments = []  # per segment of a turn: bytes of all turns, and lengths
    for part in (heads, names, mids, texts, tails):
        if isinstance(part, tuple):
            lengths = np.array([len(x) for x in part])[kind]
            flat = np.concatenate([np.frombuffer(part[k], dtype=np.uint8) for k in kind.tolist()]) if len(kind) else np.empty(0, np.uint8)
        else:
            lengths, flat = _lengths(part), _bytes(part)
        segments.append((flat, lengths))
    sizes = np.sum([n for _, n in segments], axis=0).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.empty(offsets[-1], dtype=np.uint8)
    at = offsets[:-1].copy()
    for flat, lengths in segments:
        scatter(out, at, flat, lengths)
        at += lengths
    chars = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(np.int64)
    start = segments[0][1] + chars + segments[2][1]
    return out, offsets, start, pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, chunk = object(), 0
    for b in batches:
        if not b.num_rows:
            continue
        roles, texts = (pc.fill_null(b.column(i), "") for i in (1, 2))
        out, offsets, start, length = assemble(roles, texts)
        ids = b.column(0).to_pylist()
        first = np.array([i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]] + [len(ids)], dtype=np.int64)
        lead = (out & 0xC0) != 0x80
        char_at = np.concatenate([[0], np.cumsum(lead)])[offsets]  # code points before each turn
        loss_turn = pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)
        group = np.searchsorted(first, np.arange(len(ids)), side="right") - 1
        begin = char_at[:-1] + start - char_at[first[group]]
        spans = pa.StructArray.from_arrays([pa.array(begin[loss_turn]), pa.array(length[loss_turn])], names=["start", "length"])
        ends = np.concatenate([[0], np.cumsum(np.add.reduceat(loss_turn.astype(np.int64), first[:-1]))]).astype(np.int32)
        formatted = pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets[first].astype(np.int64)), pa.py_buffer(out))
        keys = [ids[i] for i in first[:-1].tolist()]
        chunks = [0] * len(keys)
        chunks[0] = chunk + 1 if keys[0] == last else 0
        last, chunk = keys[-1], chunks[-1]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(chunks, pa.int64()), formatted.cast(pa.string()), pa.ListArray.from_arrays(pa.array(ends), spans)],
                                         names=["conv_id", "chunk", "formatted", "loss"])


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, formatted, loss) of all conversations.

    Rows are dealt by conversation and sorted within their task on disk where
    needed; a task streams through them, so a conversation of any size passes.
    """
    ship(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"), "turn")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn in a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        if m["user"] is not None:
            out.append(("user", unescape(m["user"])))
        elif m["assistant"] is not None:
            out.append(("assistant", unescape(m["assistant"])))
        else:
            out.append((unescape(m["role"]), unescape(m["other"])))
        at = m.end()
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    state: list | None = None

    def done() -> tuple:
        return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

    for b in batches:
        rows = []
        for conv, _, formatted, loss in zip(*(c.to_pylist() for c in b.columns)):
            if state is None or state[0] != conv:
                if state is not None:
                    rows.append(done())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"] : span["start"] + span["length"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) if i else pa.array(x, pa.int64()) for i, x in enumerate(zip(*rows))], names=names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) if i else pa.array([x], pa.int64()) for i, x in enumerate(done())], names=names)


def read_chats(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say: turns and loss mask, digested.

    Chunks of a conversation must be in one partition, in order, as
    ``format_chats`` leaves them.
    """
    return formatted.select("conv_id", "chunk", "formatted", "loss").mapInArrow(
        _read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return read_chats(format_chats(turns.unionByName(probe)))
