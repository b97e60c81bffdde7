import hashlib
import random

import numpy as np

from objsync.llm import recompress as R


def brute(rows, width):
    """doc_id -> windows, by direct comparison."""
    first = {}
    key = lambda d: R.LAST_ID if d is None else d
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            first[k] = min(first.get(k, R.LAST_ID), key(d))
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < key(d):
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_equal_windows_take_equal_symbols():
    rng = random.Random(1)
    for alphabet in (1, 2, 3, 8, 1000):
        docs = [[rng.randint(1, alphabet) for _ in range(rng.randint(0, 60))] for _ in range(60)]
        docs += [[rng.randint(1, alphabet) for _ in range(rng.randint(0, 5))] + d[3:40] + [rng.randint(1, alphabet) for _ in range(rng.randint(0, 5))] for d in docs]
        names = np.array([x * 7919 for d in docs for x in d], dtype=np.uint64)
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        starts, count, symbol, offset = R.symbols(names, doc)
        seen, windows = {}, 0
        for s, c, y, o in zip(starts.tolist(), count.tolist(), symbol.tolist(), offset.tolist()):
            for k in range(c):
                w = tuple(names[s + k : s + k + 13].tolist())
                assert doc[s + k] == doc[s + k + 12]
                windows += 1
                assert seen.setdefault(w, (y, o - k)) == (y, o - k), (alphabet, w)
        assert windows == sum(max(0, len(d) - 12) for d in docs)  # every window has its symbol


def rows_of(seed, n=80, words=400):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randint(0, words)}" for _ in range(rng.randint(10, 40))) for _ in range(12)]
    rows = []
    for d in range(n):
        parts = [rng.choice(pool) if rng.random() < 0.4 else " ".join(f"w{rng.randint(0, words)}" for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 6))]
        rows.append((d, " \n".join(parts)))
    return rows


def test_against_brute_force(spark):
    rows = rows_of(3) + [(None, rows_of(3)[5][1]), (5, rows_of(3)[5][1]), (5, "other " * 20), (200, None), (201, ""), (202, "same " * 30), (203, "same " * 14), (204, "same " * 12),
                         (205, "a b " * 20), (206, "b a " * 20), (300, "long word " * 40000)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, symbol string")
    out = R.dedup(df, with_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out), key=str) == brute(rows, 13)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in out)


def test_empty(spark):
    assert R.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
