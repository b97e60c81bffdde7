import random

import duckdb
import pytest

from objsync.llm import quality as Q
from objsync.llm import quality_sql


def test_repeated_words_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        hit = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(3)}
        assert Q.repeated_words(words, 3) == len(hit)


def rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeéßX.!#7") for _ in range(rng.randint(1, 9)))
    line = lambda: " ".join(word() for _ in range(rng.randint(1, 12)))
    out = []
    for d in range(700):
        lines = [line() for _ in range(rng.randint(0, 9))]
        lines += rng.sample(lines, min(len(lines), rng.choice((0, 0, 0, 3))))
        out.append((d, "\n".join(lines), rng.choice(("en", "de", None)), rng.choice(("a", "a", "a", "b", None)), 0))
    out += [(1, out[1][1], "en", "a", 0)] * 2
    return [*out, (800, None, "en", "a", 0), (801, "", "xx", None, 0), (None, "##" * 50, None, None, 0), (802, "   nbsp", "en", "a", 0), (803, "word " * 30000, "en", "a", 0),
            (804, "\x0b\x0c\r\n a\tb", "en", "a", 0)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, kept int")


def test_report_against_sql(spark, frame, tmp_path):
    path = str(tmp_path / "documents.parquet")
    frame.write.parquet(path)
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{path}/*.parquet'")
    want = db.execute(quality_sql.OP6)
    cols = [d[0] for d in want.description]
    got = Q.op6_quality_rules(spark, str(tmp_path)).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)


def test_filter_keeps_what_the_report_keeps(spark, frame):
    report = {(r.doc_id, r.n_words) for r in Q.quality_report(frame).collect() if r["kept"]}
    out = Q.keep_good(frame)
    assert out.columns == frame.columns
    assert {(r.doc_id, len((r.text or "").encode().split())) for r in out.collect()} == report
    assert Q.keep_good(frame.limit(0)).count() == 0 and Q.quality_report(frame.limit(0)).count() == 0


def test_cutoffs_follow_the_group(spark):
    """A share of symbols that is usual in one source is an outlier in another."""
    plain, marked = (" ".join(f"word{i}{c}" for i in range(40)) for c in ("", "#"))
    docs = [(i, plain if i % 2 else marked, "en", "plain" if i % 2 else "marked") for i in range(1000)] + [(5000, marked, "en", "plain")]
    got = {r.doc_id: r["kept"] for r in Q.quality_report(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert not got.pop(5000) and all(got.values())


@pytest.mark.parametrize("junk", [9, 15, 35])
def test_bad_rows_do_not_raise_their_own_cut(spark, junk):
    plain, marked = (" ".join(f"word{i}{c}" for i in range(40)) for c in ("", "#####"))
    docs = [(i, marked if i % 100 < junk else plain, "en", "hot") for i in range(1000)]
    got = {r.doc_id: r["kept"] for r in Q.quality_report(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept == (d % 100 >= junk) for d, kept in got.items())


def test_no_size_is_a_threshold(spark):
    """A group's cut-offs move little from one row more."""
    rng = random.Random(8)
    rows = [(" ".join("x" * rng.randint(2, 9) + "#" * (rng.random() < 0.1) for _ in range(40)), "en", "big") for _ in range(900)]
    tail = [(" ".join("x" * (5 + i % 7) + "#" * (i % 3 == 0) for i in range(40)), "en", "small")] * 201
    cuts = []
    for n in (199, 200, 201):
        measured = Q.with_measures(spark.createDataFrame(rows + tail[:n], "text string, lang string, source string"), "text", "m")
        cuts.append(next(r.cut for r in Q.cutoffs(measured).collect() if r.source == "small"))
    assert all(abs(a[m] - b[m]) <= 2 for a, b in zip(cuts, cuts[1:]) for m in Q.MEASURES)


def test_clashing_names(spark):
    names = ["_cut", "_cut_lang", "kept", "_caller_kept", "_quality", "_good", "m"]
    text = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(text, "en", "s", *range(7)), (None, None, None, *range(7))], "text string, lang string, source string, " + ", ".join(f"{n} int" for n in names))
    out = Q.keep_good(df)
    assert out.columns == df.columns and [tuple(r)[3:] for r in out.collect()] == [tuple(range(7))]


def test_sql_states_the_same_slack():
    assert Q.MEASURES == quality_sql.MEASURES
