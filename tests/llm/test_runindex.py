import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from objsync.llm import runindex as R


def brute(rows, length):
    seen = {}
    for k, (_, t) in enumerate(rows):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_index_against_brute_force():
    rng = random.Random(8)
    for alphabet in (1, 2, 4, 50):
        for _ in range(25):
            base = bytes(rng.randint(1, alphabet) for _ in range(rng.randint(1, 60)))
            parts = [bytes(rng.randint(1, alphabet) for _ in range(rng.randint(0, 5))) + base[rng.randint(0, 5) : rng.randint(5, 60)] for _ in range(rng.randint(1, 7))]
            index = R.RunIndex(parts)
            suffixes = [(k, p[i:]) for k, p in enumerate(parts) for i in range(len(p) + 1)]
            common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            want = [max([common(s, o) for j, (_, o) in enumerate(suffixes) if j != i], default=0) for i, (_, s) in enumerate(suffixes)]
            assert index.statistics().tolist() == want
            assert index.runs <= len(index.text)


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    core = rng.integers(97, 100, 300, dtype=np.uint8)
    a, b = (np.concatenate([rng.integers(97, 100, n, dtype=np.uint8), core, rng.integers(97, 100, 50, dtype=np.uint8)]) for n in (7, 120))
    (pa_, na), (pb_, nb) = R.anchors(a, 100), R.anchors(b, 100)
    for s in range(201):
        assert pa_[7 + s] - 7 == pb_[120 + s] - 120 and na[pa_[7 + s]] == nb[pb_[120 + s]]


def corpus(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    pool = [" ".join(word() for _ in range(rng.randint(20, 60))) for _ in range(8)]
    rows = []
    for d in range(70):
        parts = [rng.choice(pool) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(0, 6))]
        rows.append((d, "\n".join(parts)))
    near = " ".join(word() for _ in range(200))
    for d in range(100, 115):
        words = near.split()
        words[rng.randint(0, 199)] = word()
        rows.append((d, " ".join(words)))
    return [*rows, (200, rows[0][1]), (200, "other text"), (None, rows[1][1]), (None, None), (201, ""), (202, "a" * 3000), (203, "ab" * 500), (204, "x" * 99), (205, "x" * 100), (206, "x" * 101)]


@pytest.mark.parametrize("most", [R.MOST_SEGMENTS, 1])
def test_against_brute_force(spark, monkeypatch, most):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, name string")
    out = R.dedup(df, 100, True, most).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == brute(rows, 100)


def test_long_text_in_pieces():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abc") for _ in range(5000))
    whole = [(int(a), int(n), int(x)) for _, at, c, nm, _, _ in R.segments([text], 100) for a, n, x in zip(at, c, nm)]
    old, R.CHUNK = R.CHUNK, 700
    try:
        cut = [(int(a), int(n), int(x)) for _, at, c, nm, _, _ in R.segments([text], 100) for a, n, x in zip(at, c, nm)]
    finally:
        R.CHUNK = old
    each = lambda parts: {a + i: x for a, n, x in parts for i in range(n)}
    assert each(whole) == each(cut) and len(each(whole)) == 4901


def brute_passages(rows, width):
    """doc_id, words covered by repeated sequences of ``width`` words, and their runs."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        hit = {i + j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(width)}
        out.append((d, len(hit), sum(1 for i in hit if i - 1 not in hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [R.MOST_SEGMENTS, 1])
def test_passages_against_brute_force(spark, most):
    rows = [*corpus(9), (300, " \t\n" + "a " * 40 + "b\v"), (301, "a\n" * 45), (302, "\u00a0a" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = R.dedup(df, 100, False, most, 15).collect()
    assert sorted(((r.doc_id, r.n_passage_words, r.n_passages) for r in out), key=str) == brute_passages(rows, 15)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == brute(rows, 100)


def test_short_words(spark, tmp_path):
    """A passage of over 50 words is reported also where it is shorter than 400 bytes; the bytes stay as they are."""
    rng = random.Random(5)
    words = lambda n: [f"{rng.randrange(10_000):04d}" for _ in range(n)]
    passage, fifty = words(51), words(50)
    rows = [(d, " ".join(words(80) + passage + words(80))) for d in range(3)]
    rows += [(3, "\n".join(words(9) + passage)), (4, " ".join(words(200))), (5, " ".join(words(60) + fifty)), (6, " ".join(fifty + words(60))), (7, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in R.op1_suffix_array_dedup(spark, str(tmp_path)).collect()}
    assert {d: (r.n_passage_words, r.n_passages) for d, r in out.items()} == {d: (51, 1) if d < 4 else (0, 0) for d in range(8)}
    assert all(r.n_removed == 0 and r.text == (rows[d][1] or "") for d, r in out.items())


def test_index_over_words():
    rng = random.Random(3)
    for alphabet in (1, 2, 9):
        for _ in range(20):
            base = [rng.randint(0, alphabet) * (2**56 + 1) for _ in range(rng.randint(1, 40))]
            parts = [[rng.randint(0, alphabet) for _ in range(rng.randint(0, 4))] + base[rng.randint(0, 4) : rng.randint(4, 40)] for _ in range(rng.randint(1, 6))]
            suffixes = [p[i:] for p in parts for i in range(len(p) + 1)]
            common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            want = [max([common(s, o) for j, o in enumerate(suffixes) if j != i], default=0) for i, s in enumerate(suffixes)]
            assert R.RunIndex([np.array(p, dtype=np.uint64).tobytes() for p in parts], np.uint64).statistics().tolist() == want


def test_names_of_texts_in_parts(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab \n\u00e9") for _ in range(rng.choice((0, 1, 5, 40, 300)))).encode() for _ in range(200)]
    monkeypatch.setattr(R, "NAMED_BYTES", 64)
    for whole, parts in zip(map(R.word_names, texts), R.named(texts), strict=True):
        assert whole.tolist() == parts.tolist()


def test_empty(spark):
    assert R.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_empty_passages(spark):
    assert R.dedup(spark.createDataFrame([], "doc_id long, text string"), words=R.WORDS).count() == 0
    assert R.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
