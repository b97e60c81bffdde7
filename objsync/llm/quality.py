"""Quality rules with adaptive thresholds.

Every text gets a few whole-number measures.  For each language and source the
measures are summarised by a mergeable quantile sketch: counts per bucket,
where a bucket keeps the seven leading bits of a value (values under 128 are
exact, others within 1/64).  Sketches merge by adding counts, so they are a
plain partial aggregation and give the same answer in any order.

A group's cut-offs come from its median and its 10 % point, which bad
documents hardly move as long as they are fewer than the good ones: the
median plus a multiple of the distance between both, and at least plus a slack.
Twice the slack above the larger of the group's and its language's median is the
most, so that no cut-off leaves a measure's range.  A group's median and distance
are averaged with its language's, which count as ``WEIGHT`` rows, and the language's
with the whole corpus's likewise, so that small groups lean on wider ones and no size
is a threshold; a wider group's figures are the means of its groups' over
their documents, so that differences between sources do not widen any of them.  Documents are then joined with their group's cut-offs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.llm.common import byte_texts, table, window_names, free_name, written, ship

#: Fixed by the rule: characters that count as symbols, words of a window,
#: fewest words, largest percentage of repeated words.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: measure -> slack: by how much at least a value must exceed its group's
#: median to be rejected, whatever the spread (measures are per mille, word
#: lengths in hundredths of a character).
MEASURES = {"symbol_share": 60, "dup_line_share": 400, "repeat_share": 300, "stutter_share": 200,
            "upper_share": 300, "mark_share": 200, "digit_share": 500, "word_length": 300}
SPREAD = 6
WEIGHT = 200

BASE = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *MEASURES)])

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
for _c in b"!\"'()+,-./:;=?@[\\]^_`{}~":
    _KIND[_c] = 3


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by runs of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    names = window_names(np.array(list(map(hash, words)), dtype=np.int64).view(np.uint64), width)
    order = np.sort(names)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(names, twice)).tolist():  # equal names: compare the words themselves
        at.setdefault(tuple(words[i : i + width]), []).append(i)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for starts in at.values():
        if len(starts) > 1:
            starts = np.array(starts)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def measure(text: bytes) -> tuple[int, ...]:
    """The values of ``BASE`` for one text."""
    words = text.split()  # of bytes: at exactly space and 09-0D
    joined = b"".join(words)
    at = np.frombuffer(joined, dtype=np.uint8)
    chars = len(at) - int(np.count_nonzero((at & 0xC0) == 0x80))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = repeated_words(words)
    stutter = sum(map(bytes.__eq__, words, words[1:]))
    kinds = np.bincount(_KIND[at], minlength=4) if len(at) else (0, 0, 0, 0)
    n, c = len(words), max(chars, 1)
    return (n, chars, symbols, dup, repeat, 1000 * symbols // c, 1000 * dup // max(lines, 1), 1000 * repeat // max(n, 1), 1000 * stutter // max(n, 1),
            int(1000 * kinds[1] // c), int(1000 * kinds[3] // c), int(1000 * kinds[2] // c), 100 * chars // max(n, 1))


def _measured(batches: Iterator[pa.RecordBatch], text_at: int, out: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(x) for x in byte_texts(batch.column(text_at))]
        values = np.array(rows, dtype=np.int64).reshape(len(rows), len(BASE))
        measures = pa.StructArray.from_arrays([pa.array(values[:, i]) for i in range(len(BASE))], names=BASE.names)
        yield pa.RecordBatch.from_arrays([*batch.columns, measures], names=out)


def with_measures(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` holding the values of ``BASE``."""
    ship(docs.sparkSession)
    names, at = [*docs.columns, name], docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, BASE)])
    return docs.mapInArrow(lambda batches: _measured(batches, at, names), schema)


def bucket(value: Column) -> Column:
    """Lower end of the sketch bucket of a value: its seven leading bits."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - 7)
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the sketch of every group.

    Partial sums leave each task, so a source with a third of all rows costs
    no more than another.  Documents without a word say nothing about a group.
    """
    stack = ", ".join(f"'{m}', m.{m}" for m in MEASURES)
    long = measured.filter("m.n_words > 0").select("lang", "source", F.expr(f"stack({len(MEASURES)}, {stack})").alias("measure", "value"))
    return long.groupBy("lang", "source", "measure", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, by: list[str], points: dict[str, float]) -> DataFrame:
    """Rows ``by`` + n_rows + one column per point, merged from ``sketch``."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    # a sketch has a bounded number of buckets, so one row can hold it
    rows = merged.groupBy(*by, "measure").agg(F.sum("n").alias("n_rows"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("h"))
    running = F.expr("aggregate(h, named_struct('c', 0L, 'a', cast(array() as array<struct<b:bigint,c:bigint>>)),"
                     " (s, x) -> named_struct('c', s.c + x.n, 'a', array_append(s.a, named_struct('b', x.bucket, 'c', s.c + x.n)))).a")  # fmt: skip
    rows = rows.withColumn("run", running)
    point = {k: F.expr(f"element_at(filter(run, x -> x.c * 1000 >= {round(p * 1000)} * n_rows), 1).b") for k, p in points.items()}
    return rows.select(*by, "measure", "n_rows", *[c.alias(k) for k, c in point.items()])


def cutoffs(measured: DataFrame, weight: int = WEIGHT, spread: int = SPREAD) -> DataFrame:
    """(lang, source, cut): upper cut-off of every measure per group."""
    q = quantiles(sketches(measured), ["lang", "source"], {"low": 0.1, "mid": 0.5}).withColumn("far", F.col("mid") - F.col("low"))

    def means(by: list[str], tag: str) -> DataFrame:
        parts = [F.expr(f"sum(n_rows * {x}) div sum(n_rows)").alias(f"{tag}_{x}") for x in ("mid", "far")]
        return q.groupBy(*by, "measure").agg(F.sum("n_rows").alias(f"{tag}_rows"), *parts)

    lang = means(["lang"], "l").withColumnRenamed("lang", "l_lang").withColumnRenamed("measure", "l_measure")
    joined = q.join(lang, F.expr("lang <=> l_lang and measure = l_measure")).join(means([], "w"), "measure")
    mean = lambda n, own, wide: F.expr(f"({n} * {own} + {weight} * {wide}) div ({n} + {weight})")
    joined = joined.withColumns({f"l_{x}": mean("l_rows", f"l_{x}", f"w_{x}") for x in ("mid", "far")}).withColumns({x: mean("n_rows", x, f"l_{x}") for x in ("mid", "far")})
    slack = F.element_at(F.create_map(*[F.lit(x) for kv in MEASURES.items() for x in kv]), F.col("measure"))
    cut = F.least(F.col("mid") + F.greatest(slack, spread * F.col("far")), F.greatest("mid", "l_mid") + 2 * slack)
    return joined.select("lang", "source", "measure", cut.alias("cut")).groupBy("lang", "source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("measure", "cut")))).alias("cut"))


def base_failed(m: str = "m") -> Column:
    return F.expr(f"`{m}`.n_words < {MIN_WORDS} or 100 * `{m}`.n_repeat_words > {MAX_REPEAT_PERCENT} * `{m}`.n_words")


def verdict(measured: DataFrame, cuts: DataFrame, m: str = "m", lang: str = "lang", source: str = "source", name: str = "kept") -> DataFrame:
    """``measured`` and a column ``name``, by a join with the cut-offs.

    ``cuts`` has one row per language and source; it was written, so the
    planner knows its size and broadcasts it only while it is small.
    """
    cl, cs, cut = (free_name(measured, c) for c in ("_cut_lang", "_cut_source", "_cut"))
    c = cuts.select(F.col("lang").alias(cl), F.col("source").alias(cs), F.col("cut").alias(cut))
    joined = measured.join(c, F.expr(f"`{lang}` <=> `{cl}` and `{source}` <=> `{cs}`"), "left")
    over = F.expr(" or ".join(f"coalesce(`{m}`.{x} > `{cut}`['{x}'], false)" for x in MEASURES))
    return joined.withColumn(name, ~base_failed(m) & ~over).drop(cl, cs, cut)


def quality_report(docs: DataFrame) -> DataFrame:
    """Quality figures and verdict of every document.

    Null text counts as no words and fails; null ``lang`` or ``source`` forms
    a group of its own; repeated rows are judged each by itself; other columns
    of ``docs`` are ignored.  An empty table gives an empty result.
    """
    measured = written(with_measures(docs.select("doc_id", "text", "lang", "source"), "text", "m").drop("text"), "quality-measures")
    cuts = written(cutoffs(measured), "quality-cutoffs")
    return verdict(measured, cuts).select("doc_id", "m.*", base_failed().alias("base_failed"), "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    Texts are measured once for the sketches and once more for the verdict,
    which spares a shuffle of all texts.
    """
    measured = with_measures(docs.select("text", "lang", "source"), "text", "m").drop("text")
    cuts = written(cutoffs(measured), "quality-cutoffs")
    name, good = free_name(docs, "_quality"), free_name(docs, "_good")
    judged = verdict(with_measures(docs, "text", name), cuts, name, name=good)
    return judged.filter(F.col(good)).select(*docs.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *MEASURES)
