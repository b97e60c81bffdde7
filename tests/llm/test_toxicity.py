import numpy as np
import pytest

from objsync.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = X.op8_toxicity(spark, SF).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([[(p > n) + 0.5 * (p == n) for n in neg] for p in pos])
    assert auc > 0.95, auc
    assert np.mean([(s >= 0.3) == bool(y) for s, y in held]) > 0.97


def frame(spark, n=300):
    docs, labels = [], []
    for i in range(n):
        group = ("muslim", "christian", "jewish")[i % 3]
        toxic = i % 4 == 0 or (group == "muslim" and i % 2 == 0)  # labels that hold one group against it
        docs.append((i, f"the {group} neighbour went home {'awful insult' if i % 4 == 0 else 'to a nice dinner'} {i}", "x"))
        labels.append((i, int(toxic), 0.5))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, extra double")


def test_counterfactuals_level_groups(spark):
    docs, labels = frame(spark)
    sample = X.training_sample(docs, labels)
    features = X.pick_features(sample, 100, 125)
    x, y = X.design(sample, features)
    rows, swapped = X.counterfactuals(x, features)
    assert len(rows) == 2 * len(x)
    at = {f: i for i, f in enumerate(features)}
    gap = []
    for fairness in (0.0, 200.0):
        w, b = X.fit(x, y, rows, swapped, fairness=fairness)
        say = lambda g: X.sigmoid(np.array([b + sum(w[at[t]] for t in X.words_of(f"the {g} neighbour went home to a nice dinner") if t in at)]))[0]
        gap.append(abs(say("muslim") - say("christian")))
    assert gap[0] > 0.3 and gap[1] < 0.1, gap


def test_odd_inputs(spark):
    docs, labels = frame(spark)
    odd = spark.createDataFrame([(None, "awful insult", None), (1000, None, None), (1000, None, None), (1001, "", None), (1002, "word " * 100000, None)], docs.schema)
    w, b = X.train(docs.union(odd), labels.union(labels).union(spark.createDataFrame([(1000, None, None)], labels.schema)))
    got = X.score(odd, w, b).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1
    assert got[0].score > 0.5
    assert X.score(docs, *X.train(docs, labels.limit(0))).agg({"score": "max"}).collect()[0][0] < 1e-6
    assert X.score(docs.limit(0), w, b).count() == 0


def test_swaps_take_the_beginnings_along(spark):
    """With enough biased rows the beginnings of a term are features too."""
    docs, labels = frame(spark, 3000)
    sample = X.training_sample(docs, labels)
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    assert {"muslim", "musli*", "muslim*"} <= set(X.pick_features(sample, n[1], n[0]))
    features = X.pick_features(sample, n[1], n[0])
    x, y = X.design(sample, features)
    spread = []
    for fairness in (5.0, 200.0):  # as shipped, and as above
        w, b = X.fit(x, y, *X.counterfactuals(x, features), fairness=fairness)
        known = dict(zip(features, w))
        scores = [X.sigmoid(np.array([b + sum(known.get(t, 0) for t in X.words_of(f"the {g} neighbour went home to a nice dinner"))]))[0] for g in ("muslim", "christian", "jewish")]
        spread.append(max(scores) - min(scores))
    assert spread[0] < X.THRESHOLD and spread[1] < 0.1, spread


def test_swapped_words():
    terms = [t for kind in X.IDENTITY.values() for t in kind.split()]
    features = [*terms, *{b: 0 for t in terms for b in X.beginnings(t)}]
    texts = [f"the {t} choir and a {u}" for t in terms for u in ("muslims", "americana", "friend")]
    x = np.array([[f in X.words_of(t) for f in features] for t in texts], dtype=np.float32)
    shared = np.array([[f in X.shared_beginnings(t) for f in features] for t in texts])
    rows, swaps = X.counterfactuals(x, features, shared)
    got, at = (rows, x[rows] + swaps.changes[swaps.change]), 0
    for kind in X.IDENTITY.values():
        names = kind.split()
        for k, t in enumerate(names):
            others = X.partners(len(names), k)
            assert k not in others and others[0] != others[1]
            for other in others:
                for i in np.flatnonzero(x[:, features.index(t)]):
                    words = (set(X.WORD.findall(texts[i])) - {t}) | {names[other]}
                    want = [f in X.words_of(" ".join(words)) for f in features]
                    assert got[0][at] == i and (got[1][at] == want).all()
                    at += 1
    assert at == len(got[0])


def test_every_mention_is_charged():
    """Many mentions of the first kinds leave the last ones their swaps."""
    kinds = [kind.split() for kind in X.IDENTITY.values()]
    terms = [t for kind in kinds for t in kind]
    x = np.zeros((4000, len(terms)), dtype=np.float32)
    for i in range(len(x)):
        for kind in kinds:
            x[i, terms.index(kind[i % len(kind)])] = 1
    rows, swaps = X.counterfactuals(x, terms)
    assert len(rows) == len(swaps) == 2 * x.sum() == 48_000
    blind, deaf = terms.index("blind"), terms.index("deaf")
    y = np.maximum(x[:, blind], np.arange(len(x)) % 4 == 0)
    w, b = X.fit(x, y, rows, swaps, fairness=200.0)
    assert abs(X.sigmoid(w[blind] + b) - X.sigmoid(w[deaf] + b)) < 0.1


def brute_scores(docs, labels):
    """The whole method in plain loops: sample, features, swapped texts, descent, scores."""
    import math
    import zlib
    from collections import Counter

    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    toxic = {d: y for d, y in labels if not held(d)}
    sample = sorted((toxic[d], t) for d, t in docs if d in toxic)
    n, n1 = len(sample), sum(y for y, _ in sample)
    all_of, of_toxic = Counter(), Counter()
    for y, t in sample:
        all_of.update(X.words_of(t))
        of_toxic.update(X.words_of(t) if y else ())

    def chi(w):
        a, b, has = of_toxic[w], all_of[w] - of_toxic[w], all_of[w]
        return (a * (n - n1 - b) - b * (n1 - a)) ** 2 * n / (n1 * (n - n1) * has * max(n - has, 1))

    top = sorted((w for w in all_of if all_of[w] >= 3 and chi(w) >= X.MIN_CHI), key=lambda w: (-chi(w), w))[: X.MAX_FEATURES]
    features = list(dict.fromkeys([*top, *(t for kind in X.IDENTITY.values() for t in kind.split())]))
    row = lambda words: np.array([f in words for f in features], dtype=float)
    x, y = np.array([row(X.words_of(t)) for _, t in sample]), np.array([y for y, _ in sample], dtype=float)
    pairs = []  # a text and its version with one term swapped
    for i, (_, t) in enumerate(sample):
        for kind in X.IDENTITY.values():
            terms = kind.split()
            for k, term in enumerate(terms):
                if term in X.words_of(t):
                    for other in X.partners(len(terms), k):
                        words = [terms[other] if w == term else w for w in X.WORD.findall(t.lower())]
                        pairs.append((i, row(X.words_of(" ".join(words)))))
    w, b = np.zeros(len(features)), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    at, other = np.array([i for i, _ in pairs], dtype=int), np.array([r for _, r in pairs]).reshape(len(pairs), len(features))
    s = lambda z: 1 / (1 + np.exp(-z))
    for step in range(1, 401):
        p = s(x @ w + b)
        g, gb = x.T @ (p - y) / n + 4e-4 * w, (p - y).mean()
        if pairs:
            q = s(other @ w + b)
            d = 10 * (p[at] - q) / len(pairs)
            dp, dq = d * p[at] * (1 - p[at]), d * q * (1 - q)
            g, gb = g + x[at].T @ dp - other.T @ dq, gb + dp.sum() - dq.sum()
        g = np.append(g, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) * min(1, 4 * (1 - step / 401))
        w, b = w - move[:-1], b - move[-1]
    weights = {f: c for f, c in zip(features, w) if abs(c) > 1e-4}
    return {d: float(s(b + sum(weights[f] for f in X.words_of(t) & weights.keys()))) for d, t in docs}


def test_against_brute_force(spark):
    docs, labels = frame(spark, 160)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(9000, None), (9001, ""), (9002, "an awful christian woman met a black man")]
    want = brute_scores(rows, [(r.doc_id, r.toxic) for r in labels.collect()])
    weights, intercept = X.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    got = {r.doc_id: r.score for r in X.score(spark.createDataFrame(rows, "doc_id long, text string"), weights, intercept).collect()}
    assert got.keys() == want.keys() and max(abs(got[d] - want[d]) for d in want) < 1e-3
