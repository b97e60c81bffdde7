import random

import numpy as np
import pytest

from objsync.llm import jaccard as J


def brute(rows, words, percent):
    key = lambda d: J.LAST_ID if d is None else d
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        k = min(words, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), J.LAST_ID), key(d))
    return sorted(((d, len(sets[i]), None if least[find(i)] == J.LAST_ID else least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, words=60):
    rng = random.Random(seed)
    pick = lambda n: [f"w{rng.randint(0, 300)}" for _ in range(n)]
    bases = [pick(rng.randint(20, words)) for _ in range(8)]
    rows = []
    for d in range(150):
        w = list(rng.choice(bases)) if rng.random() < 0.7 else pick(rng.randint(1, words))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
            w[rng.randint(0, len(w) - 1)] = f"x{rng.randint(0, 10**6)}"
        rows.append((d, " ".join(w)))
    return rows


@pytest.mark.parametrize("words, percent", [(3, 90), (2, 70)])
def test_against_brute_force(spark, words, percent):
    rows = corpus(words) + [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "two one"), (None, "one"), (None, "lonely words here"), (507, "Größe ÄÖ x"),
                            (508, "größe ÄÖ x"), (509, "GRÖßE ÄÖ x")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, token string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.link(df, words, percent).collect()), key=str)
    assert got == brute(rows, words, percent)


def test_prefixes_meet_under_every_order():
    rng = np.random.default_rng(3)
    rarity = rng.integers(0, 4, 1 << J.SKETCH_BITS).astype(np.uint8)
    for _ in range(200):
        core = rng.integers(0, 2**63, rng.integers(5, 80), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([core, rng.integers(0, 2**63, rng.integers(0, 5), dtype=np.uint64)])) for _ in range(2))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            for order in (1, 2, 3):
                assert len(np.intersect1d(J.ordered_prefix(a, rarity, order, 80), J.ordered_prefix(b, rarity, order, 80)))
                assert len(np.intersect1d(J.ordered_prefix(a, rarity, order, 80, 3), J.ordered_prefix(b, rarity, order, 80, 3))) >= min(3, both)


def test_components_of_a_chain(spark):
    n = 40
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (101, 100)], "a long, b long")
    assert {(r.node, r.component) for r in J.components(links).collect()} == {(i, 0) for i in range(1, n)} | {(101, 100)}


def test_keep_one_and_empty(spark):
    df = spark.createDataFrame([(3, "a b c d e f", 1), (1, "A b c d e f", 2), (2, "x y z", 3), (None, "x y z", 4), (7, None, 5)], "doc_id long, text string, n int")
    assert sorted(r.n for r in J.keep_one(df, 5, 80).collect()) == [2, 3, 4, 5]
    assert J.link(df.limit(0)).count() == 0 and J.keep_one(df.limit(0), 5, 80).count() == 0
