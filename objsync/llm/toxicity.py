"""Toxicity scores from a counterfactual-regularised linear classifier.

Inputs of a score are the distinct words of the whole text, lower-cased, and
their beginnings (which find the compounds of a stem).  From
a bounded sample of labelled rows (``max_rows``, the smallest hashes of their
ids) Spark counts, per word, the toxic and other documents that have it; the
``max_features`` words that tell the classes apart best, and all identity
terms, become features of a logistic regression.

Identity terms name groups of people.  For every sampled text that has some,
counterfactual texts are formed in which a term, with those of its beginnings
that no other word of the text has, gives way to another of its
kind, and the fit is charged for the squared change of the score, so a neutral
mention of one group scores like that of any other.  Terms that differ only by
whom they name end with (nearly) the same weight, and a shared weight that the
labels do not ask for is drawn to zero by the ordinary penalty.

A null text counts as empty and scores the intercept alone.  Repeated rows get
equal scores.  Of several labels of a document the largest counts; null labels
are ignored.  With no labelled rows, or labels of one kind only, all scores are
the share of toxic labels (0 without labels).  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import ship, table, written

MAX_ROWS = 12_000
MAX_FEATURES = 1_000
MIN_CHI = 20.0  # of a word's chi-squared statistic: chance passes it about once in 100,000 words
THRESHOLD = 0.3  # fixed by the rule
WORD = re.compile(r"[^\W_]+")

#: Groups of people, by kind; terms of a kind stand for one another.
IDENTITY = {
    "religion": "christian muslim jewish hindu buddhist atheist catholic protestant sikh mormon christen muslime juden chrétien musulman juif cristiano musulmán judío",
    "origin": "american african asian european mexican chinese indian arab german french spanish turkish polish russian immigrant refugee deutscher français español inmigrante réfugié",
    "colour": "black white brown latino hispanic schwarz weiß noir blanc negro blanco",
    "gender": "woman man women men female male girl boy transgender frau mann femme homme mujer hombre",
    "orientation": "gay straight lesbian bisexual heterosexual homosexual queer",
    "ability": "disabled blind deaf autistic elderly young behindert aveugle ciego",
}


def words_of(text: str | None) -> set[str]:
    """Distinct words, and their beginnings of 5, 6 and 7 letters (``abcde*``)."""
    words = set(WORD.findall((text or "").lower()))
    return words | {b for w in words for b in beginnings(w)}


def beginnings(word: str) -> list[str]:
    return [f"{word[:k]}*" for k in (5, 6, 7) if len(word) >= k]


def shared_beginnings(text: str | None) -> set[str]:
    """Beginnings of two or more distinct words: they outlast the loss of one."""
    counts = Counter(b for w in set(WORD.findall((text or "").lower())) for b in beginnings(w))
    return {b for b, n in counts.items() if n > 1}


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(toxic, text) of at most ``max_rows`` labelled rows that are not held out."""
    of = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    of = of.filter(~held_out(F.col("doc_id")))
    few = written(of.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "toxicity-labels")
    # at most max_rows pairs of numbers, whatever the input: the one table that is broadcast here
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("toxic", "text")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = list(words_of(text))
            if words:
                yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(words), pa.int32()), pa.array(words, pa.string())], names=["toxic", "word"])


def pick_features(sample: DataFrame, n_toxic: int, n_other: int, most: int = MAX_FEATURES) -> list[str]:
    """The words with the largest chi-squared statistic, and the identity terms."""
    counts = sample.mapInArrow(_words, "toxic int, word string").groupBy("word").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).filter("n >= 3")
    n = n_toxic + n_other
    a, b, has = F.col("a").cast("double"), (F.col("n") - F.col("a")).cast("double"), F.col("n").cast("double")
    chi = (a * (n_other - b) - b * (n_toxic - a)) ** 2 * n / (F.lit(float(n_toxic)) * n_other * has * F.greatest(n - has, F.lit(1.0)))
    top = [r.word for r in counts.withColumn("chi", chi).filter(F.col("chi") >= MIN_CHI).orderBy(F.desc("chi"), "word").limit(most).select("word").collect()]
    terms = [t for kind in IDENTITY.values() for t in kind.split()]
    return list(dict.fromkeys([*top, *terms]))


def matrices(sample: DataFrame, features: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature matrix (rows x features, 0/1) and labels of the sample, and
    which features are beginnings of several words of the row."""
    at = {w: i for i, w in enumerate(features)}

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = lambda words: sorted(at[w] for w in words & at.keys())
        for b in batches:
            texts = b.column(1).to_pylist()
            columns = [pa.array([numbers(of(t)) for t in texts], pa.list_(pa.int32())) for of in (words_of, shared_beginnings)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["toxic", "hits", "shared"])

    rows = sample.mapInArrow(hits, "toxic int, hits array<int>, shared array<int>").collect()  # at most max_rows short lists
    rows.sort()
    x, shared = np.zeros((len(rows), len(features)), dtype=np.float32), np.zeros((len(rows), len(features)), dtype=bool)
    for i, r in enumerate(rows):
        x[i, r.hits] = 1
        shared[i, r.shared] = True
    return x, np.array([r.toxic for r in rows], dtype=np.float32), shared


def design(sample: DataFrame, features: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature matrix (rows x features, 0/1) and labels of the sample."""
    return matrices(sample, features)[:2]


def partners(n: int, k: int) -> tuple[int, int]:
    """The terms that stand for term ``k`` of ``n``: the next and a farther one, never itself."""
    return (k + 1) % n, (k + (7 if n > 8 else n // 2)) % n


class Swaps:
    """Counterfactual rows as differences: swap ``i`` adds row ``change[i]`` of
    ``changes`` (+1, 0 or -1 per feature) to its row of the sample."""

    def __init__(self, change: np.ndarray, changes: np.ndarray):
        self.change, self.changes = change, changes

    def __len__(self) -> int:
        return len(self.change)


def counterfactuals(x: np.ndarray, features: list[str], shared: np.ndarray | None = None) -> tuple[np.ndarray, Swaps]:
    """Row numbers of ``x`` and their versions with one identity term swapped
    for two others of its kind: the features of the swapped set of words.
    Without ``shared`` no other word is taken to have a beginning of the term."""
    at = {w: i for i, w in enumerate(features)}
    rows, change, changes, n_changes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty((0, len(features)), np.float32)], 0
    for kind in IDENTITY.values():
        terms = kind.split()
        for k, term in enumerate(terms):
            having = np.flatnonzero(x[:, at[term]])
            if not len(having):
                continue
            for other in partners(len(terms), k):
                old = [at[b] for b in beginnings(term) if b in at]
                new = [at[w] for w in (terms[other], *beginnings(terms[other])) if w in at]
                columns = sorted({at[term], *old, *new})
                place = {c: i for i, c in enumerate(columns)}
                before = x[np.ix_(having, columns)]
                after = before.copy()
                after[:, [place[c] for c in old]] = 0 if shared is None else shared[np.ix_(having, old)]
                after[:, place[at[term]]] = 0
                after[:, [place[c] for c in new]] = 1
                kinds, which = np.unique(after - before, axis=0, return_inverse=True)
                wide = np.zeros((len(kinds), len(features)), dtype=np.float32)
                wide[:, columns] = kinds
                rows.append(having)
                change.append(which.reshape(-1) + n_changes)
                changes.append(wide)
                n_changes += len(kinds)
    return np.concatenate(rows), Swaps(np.concatenate(change), np.concatenate(changes))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, rows: np.ndarray, swapped: Swaps, l2: float = 2e-4, fairness: float = 5.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept: logistic loss + l2 |w|^2 + fairness * mean squared
    change of the score under the swaps; Adam from zero."""
    n, k = x.shape
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, steps + 1):
        score = x @ w + b
        p = sigmoid(score)
        g = np.append(x.T @ (p - y) / n + 2 * l2 * w, (p - y).mean())
        if len(rows):
            q = sigmoid(score[rows] + (swapped.changes @ w)[swapped.change])
            d = 2 * fairness * (p[rows] - q) / len(rows)
            dp, dq = d * p[rows] * (1 - p[rows]), -d * q * (1 - q)
            by_row, by_change = np.bincount(rows, dp + dq, n), np.bincount(swapped.change, dq, len(swapped.changes))
            g += np.append(x.T @ by_row + swapped.changes.T @ by_change, dp.sum() + dq.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) * min(1, 4 * (1 - step / (steps + 1)))
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> tuple[dict[str, float], float]:
    """Word weights and intercept."""
    ship(docs.sparkSession)
    sample = written(training_sample(docs, labels, max_rows), "toxicity-sample")
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        share = min(max(float(n.get(1, 0) > 0), 1e-9), 1 - 1e-9)
        return {}, float(np.log(share / (1 - share)))
    features = pick_features(sample, n[1], n[0], max_features)
    x, y, shared = matrices(sample, features)
    w, b = fit(x, y, *counterfactuals(x, features, shared))
    return {f: float(c) for f, c in zip(features, w) if abs(c) > 1e-4}, b


def score(docs: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """(doc_id, score) of every row; the weights are at most a few thousand."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            z = np.array([intercept + sum(known[w] for w in sorted(words_of(t) & known.keys())) for t in b.column(1).to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigmoid(z))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights, intercept = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, weights, intercept).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
