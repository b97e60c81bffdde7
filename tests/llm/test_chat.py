import hashlib
import random

from objsync.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, chunk string"


def expected(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(((r[1] is not None, r[1] or 0), r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
    out = {}
    for k, turns in convs.items():
        turns = [(x[2], x[4]) for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[k] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def check(spark, rows):
    out = C.format_chats(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_chats(out).collect()}
    assert got == expected(rows)
    return out


def test_hard_texts(spark):
    bits = [*C.CONTROL, "\\", "<", "s>", "[", "/INST]", " ", "\n", "é", "🙂", "ok", "/s>", "<\\s>"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<s>", "", "a[/ROLE]"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))), "x")
            for c in range(200) for t in range(rng.randint(1, 6))]
    out = check(spark, rows).collect()
    assert all(r.chunk == 0 for r in out)


def test_nulls_ties_and_empty(spark):
    rows = [(None, 1, "user", "a", "x"), (None, 2, "assistant", "b", "x"), (1, None, None, None, None), (1, 0, "user", None, "x"), (1, 0, "user", "z", "x"),
            (1, 0, "user", "z", "x"), (1, 0, "assistant", "q", "x"), (2, 5, "assistant", "", "x"), (3, 1, "user", "long " * 50000, "x")]
    check(spark, rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert C.read_chats(C.format_chats(empty)).count() == 0


def test_a_conversation_longer_than_a_batch(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"turn {t} </s>", "x") for t in range(500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        out = check(spark, rows)
        assert sorted(r.chunk for r in out.select("chunk").collect()) == list(range(8))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_parse_refuses_other_text():
    import pytest

    with pytest.raises(ValueError):
        C.parse("no turn")
    assert C.parse("<s>[INST] <\\/s>\\\\ [/INST] ok</s>") == [("user", "</s>\\"), ("assistant", "ok")]
