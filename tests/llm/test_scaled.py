import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from objsync.llm import scaled as S


def brute_sketch(text, scale=S.SCALE, floor=S.FLOOR):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = max(len(w) - 4, 1) if w else 0
    h = sorted({hashlib.md5(" ".join(w[i : i + 5]).encode()).hexdigest()[:16] for i in range(n)})
    return [x for i, x in enumerate(h) if i < floor or int(x, 16) < 2**64 // scale]


def brute_bound(k, scale=S.SCALE, floor=S.FLOOR):
    return "g" if len(k) < floor else max(k[-1], S._top(scale))


def brute_like(a, b):
    m = min(brute_bound(a), brute_bound(b))
    x, y = {h for h in a if h <= m}, {h for h in b if h <= m}
    like = 1.0 if not x | y else len(x & y) / len(x | y)
    held = 1.0 if not a else (len(x & y) / len(x) if x else None)
    return like, held


def prose(rng, n, words=4000):
    return " ".join(f"w{rng.randint(0, words)}" for _ in range(n))


def test_next_document_and_sketches(spark):
    rng = random.Random(2)
    texts = ["", None, "one", "two words", "ünï 🙂 c\todé x\ny z", " \n\t ", prose(rng, 4000), prose(rng, 900), "same " * 3000]
    texts += [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    rows = list(zip(rng.sample(range(-500, 5000), len(texts)), texts))
    out = {r.doc_id: r for r in S.with_edits(spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, own string, next string")).collect()}
    rows = sorted((d, t or "") for d, t in rows)
    assert len(out) == len(rows)
    for (d, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        k, r = len(t) // 4, out[d]
        assert r.text == t and r.edited == t[: len(t) - k] + u[:k]
        assert r.own == brute_sketch(t) and r.changed == brute_sketch(r.edited) and r.next == brute_sketch(u)


def test_likeness_and_containment(spark):
    rng = random.Random(5)
    base = prose(rng, 6000).split()
    texts = ["", "a b", " ".join(base[:50]), " ".join(base[:3000]), " ".join(base), " ".join(base[3000:]), prose(rng, 70), " ".join(base[100:190])]
    pairs = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", S.sketch(F.col("a")).alias("x"), S.sketch(F.col("b")).alias("y"))
    for r in df.select("a", "b", "x", "y", S.likeness(F.col("x"), F.col("y")).alias("like"), S.containment(F.col("x"), F.col("y")).alias("held"), S.merge(F.col("x"), F.col("y")).alias("both")).collect():
        assert (r.like, r.held) == pytest.approx(brute_like(r.x, r.y), nan_ok=True)
        whole = {" ".join(w[i : i + 5]) for w in (r.a.split(), r.b.split()) if w for i in range(max(len(w) - 4, 1))}
        names = sorted(hashlib.md5(s.encode()).hexdigest()[:16] for s in whole)
        assert r.both == [x for i, x in enumerate(names) if i < S.FLOOR or x <= S._top(S.SCALE)]  # merging is exact
        if len(r.a.split()) >= 3000 and len(r.b.split()) >= 3000:  # estimates are close
            exact = {" ".join(r.a.split()[i : i + 5]) for i in range(len(r.a.split()) - 4)}
            other = {" ".join(r.b.split()[i : i + 5]) for i in range(len(r.b.split()) - 4)}
            assert abs(r.like - len(exact & other) / len(exact | other)) < 0.1 and abs(r.held - len(exact & other) / len(exact)) < 0.1


def test_ties_nulls_and_empty_tables(spark):
    rows = [(None, "last one of all here"), (3, "three words long text"), (3, "another third"), (3, "another third"), (1, "first"), (2**63 - 1, "largest id that there is"), (None, None)]
    out = S.with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    nexts = {}
    for r in out:
        nexts.setdefault(r.doc_id, set()).add(tuple(r.next))
    assert all(len(v) == 1 for v in nexts.values())  # rows of one id agree
    sk = lambda t: tuple(brute_sketch(t))
    assert nexts[1] <= {sk("three words long text"), sk("another third")} and nexts[3] == {sk("largest id that there is")}
    assert nexts[2**63 - 1] <= {sk("last one of all here"), sk("")} and nexts[None] == {sk("first")}
    alone = S.with_edits(spark.createDataFrame([(7, "all alone here")], "doc_id long, text string")).collect()
    assert alone[0].edited == "all alone h" + "all"
    assert S.with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_groups(spark):
    rng = random.Random(9)
    big = [prose(rng, 3000) for _ in range(3)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(big)], "doc_id long, text string, source string")
    half = big[1].split()[500:2500] + prose(rng, 2000).split()
    probe = spark.createDataFrame([(10, " ".join(half)), (11, prose(rng, 500)), (12, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in S.contained(probe, S.merged(docs, "source"), "source").collect()}
    assert set(out) == {10} and abs(out[10].share - 0.5) < 0.1 and out[10].n_hashes > 100


def test_only_built_in_functions(spark):
    plan = S.op11_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
