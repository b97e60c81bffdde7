import math
import random
import re
from collections import Counter

import pytest

from objsync.llm import ranked as R


def terms(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(items, docs, top=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            n = sum(b.values())
            m = 100 - 90 + ((90 * n * n_docs) // n_terms if n_terms else 0)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if t in b)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def rows_of(seed, n, words):
    rng = random.Random(seed)
    pick = lambda k: " ".join(f"W{min(int(rng.expovariate(1 / (words / 6))), words)}" for _ in range(k))
    docs = [(d, pick(rng.randint(0, 60))) for d in rng.sample(range(10 * n), n)]
    items = [(i, pick(rng.randint(1, 25))) for i in range(30)]
    return items, docs


@pytest.mark.parametrize("block", [256, 7])
def test_against_brute_force(spark, block):
    items, docs = rows_of(1, 400, 300)
    same = docs[3][1] + " w1 w2"
    docs += [(90000 + i, same) for i in range(25)] + [(5, same), (5, same), (None, same), (None, "w1"), (None, None), (91000, None), (91001, ""), (91002, "?! ..."), (91003, "w9 " * 30000)]
    items += [(None, "w1 w2"), (3, "W3 and W9"), (3, "W3 and W9"), (50, None), (51, ""), (52, "unheard of"), (53, same)]
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in docs], "doc_id long, text string, term string, bucket int").repartition(5)
    it = spark.createDataFrame([(i, t, 1.5) for i, t in items], "item_id long, text string, score double")
    out = R.rank(it, df, block=block).collect()
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in out), key=str) == brute(items, docs)


def test_letters_beyond_ascii_and_marks(spark):
    docs = [(1, "Éa b ÀB"), (2, "éa"), (3, "x_y-z 007"), (4, "🙂 smile")]
    items = [(1, "Éa b"), (2, "éA"), (3, "Y 007"), (4, "🙂")]
    out = R.rank(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in out), key=str) == brute(items, docs)


def test_bundles_drop_only_what_cannot_win(spark):
    """With one owner nothing is dropped early; the results are the same."""
    items, docs = rows_of(4, 600, 60)
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    it = spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, R.rank(it, d, top=3, shares=s).collect())) for s in ((), (0.02, 0.1, 0.2, 0.3)))
    assert one == many and [tuple(r) for r in sorted(brute(items, docs, 3))] == one


def test_empty_tables(spark):
    items, docs = (spark.createDataFrame([(1, "a")], f"{c} long, text string") for c in ("item_id", "doc_id"))
    assert R.rank(items, docs.limit(0)).count() == 0
    assert R.rank(items.limit(0), docs).count() == 0
