import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(__file__))

import test_decontaminate  # noqa: E402
import test_jaccard  # noqa: E402
import test_pieces  # noqa: E402

import corpus_pipeline as C  # noqa: E402
from objsync.llm import decontaminate as D  # noqa: E402
from objsync.llm import pieces as P  # noqa: E402
from objsync.llm import quality_sql  # noqa: E402

SF = "/root/testdata/sf0.001"


def without_repeats(rows, length):
    """Texts without the bytes of windows that occur twice or more."""
    seen = {}
    for r in rows:
        b = r["text"].encode()
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for r in rows:
        b = r["text"].encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        text = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        out.append(r | {"text": text, "n_chars": len(text)})
    return out


def covers(text, items):
    split = lambda t: [w for w in (x.strip(D.OUTER) for x in t.lower().split()) if w]
    words = split(text)
    for item in map(split, items):
        width = min(D.SEED, len(item))
        if width and sum(n for _, _, n in test_decontaminate.brute_tiles(item, words, width)) >= D.COVERAGE * len(item):
            return True
    return False


def test_stages_against_brute_force(spark):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    rows = spark.read.parquet(f"{SF}/documents.parquet").toPandas().to_dict("records")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    keep = {d for d, k in db.execute(f"select doc_id, kept from ({quality_sql.OP6})").fetchall() if k}
    good = [r for r in rows if r["doc_id"] in keep]
    least = {d: c for d, _, c in test_jaccard.brute([(r["doc_id"], r["text"]) for r in good], 5, 80)}
    single = [r for r in good if least[r["doc_id"]] == r["doc_id"]]
    cut = without_repeats(single, C.PASSAGE_BYTES)
    clean = [r for r in cut if not covers(r["text"], items[:8])]  # brute tiling is slow: a few items

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    same = lambda df, want: sorted(tuple(r) for r in df.collect()) == sorted(tuple(r[c] for c in cols) for r in want)
    got = {}
    for name, stage in C.STAGES[:3]:
        docs = C.written(stage(spark, docs, SF), name)
        got[name] = docs
    assert same(got["quality_rules"], good) and same(got["near_duplicates"], single) and same(got["suffix_array_dedup"], cut)
    few = spark.createDataFrame([(i, t) for i, t in enumerate(items[:8])], "item_id long, text string")
    assert same(D.keep_clean(docs, few), clean)

    vocabulary = P.load()
    for r in C.sentencepiece(spark, docs, SF).limit(5).collect():
        text = next(x["text"] for x in cut if x["doc_id"] == r.doc_id)
        assert r.round_trip and r.ids == test_pieces.brute(vocabulary, text)[1]


def test_odd_tables(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", None, 5, "a", 1), (None, text + " x", None, None, None, None, 2), (2, None, "en", "s", 0, "b", 3), (3, "", "en", "s", 0, "b", 4), (3, "", "en", "s", 0, "b", 4)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, d int")
    df = odd
    for name, stage in C.STAGES[:4]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        out.count()
    for name, stage in C.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0, name
    assert C.sentencepiece(spark, odd, SF).count() == 5
