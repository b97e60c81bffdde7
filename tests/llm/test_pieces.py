import random

import pytest

from objsync.llm import pieces as P


@pytest.fixture(scope="module")
def seg():
    return P.Segmenter(P.load())


def brute(v, text):
    """Whole-text Viterbi over every piece and start, by the tokenizer's rules."""
    s = P.MARK + text.replace(" ", P.MARK) if text else ""
    longest = max(map(len, v.pieces))
    best = [None] * (len(s) + 1)
    best[0] = (0.0, [])
    for i in range(len(s)):
        score, path = best[i]
        for k in range(1, min(longest, len(s) - i) + 1):
            if s[i : i + k] in v.pieces:
                n, x = v.pieces[s[i : i + k]]
                if best[i + k] is None or score + x > best[i + k][0]:
                    best[i + k] = (score + x, [*path, n])
        if s[i] not in v.pieces and (best[i + 1] is None or score + v.unknown_score > best[i + 1][0]):
            best[i + 1] = (score + v.unknown_score, [*path, *(v.byte_ids[b] for b in s[i].encode())])
    return best[len(s)]


TEXTS = ["", " ", "a", "Hello world", "two  spaces   three", "line\nbreak\n\nmore\t tab", "ünïcödé 執 𝔘 🙂🙂 x", "aaaaaaaaaaaaaaaaaaaa", " lead and trail ", "=" * 40, "\n", "a\n b"]


def test_against_brute_force(seg):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("aeinstrl  .\nz🙂") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    for t in texts:
        score, ids = brute(seg.v, t)
        assert seg.encode_text(t).tolist() == ids, t
        assert seg.count_text(t) == (len(ids), score), t
        assert seg.decode_ids(seg.encode_text(t)) == t


def test_against_the_library(tmp_path):
    """The same vocabulary read as a unigram model by the library itself.

    The file's two scores of -1e9 are lifted: beside them the library's 32-bit
    sums lose the differences between all other pieces.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open(P.MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40000)
    (tmp_path / "unigram.model").write_bytes(model.SerializeToString())
    sp = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    seg = P.Segmenter(P.load(str(tmp_path / "unigram.model")))
    rng = random.Random(6)
    words = ["the", "of", "thshing", "ciónado", "reality", "Ünge", "pathetic", "x", "können.", "123", "a\nb", "  ", "🙂", "torail"]
    for _ in range(400):
        t = " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))
        assert seg.encode_text(t).tolist() == sp.encode(t), t
        assert seg.decode_ids(seg.encode_text(t)) == sp.decode(sp.encode(t)) == t


def test_vocabulary_with_pieces_across_words():
    v = P.Vocabulary({"a": (0, -1.0), "b": (1, -1.0), P.MARK: (2, -1.0), "a" + P.MARK + "b": (3, -1.0)}, (), 9, -11.0, [b"a", b"b", b" ", b"a b"])
    s = P.Segmenter(v)
    assert s.cuts is None and s.encode_text("a b").tolist() == [2, 3] and s.count_text("a b") == (2, -2.0)
    assert s.encode_text("xyb").tolist() == [2, 9, 1] and s.count_text("xyb") == (3, -24.0)  # a run of unknowns is one piece


def test_ties_take_the_longer_last_piece():
    v = P.Vocabulary({"a": (0, -1.0), "b": (1, -1.0), "ab": (2, -2.0), P.MARK: (3, 0.0)}, (), 9, -11.0, [b"a", b"b", b"ab", b" "])
    assert P.Segmenter(v).encode_text("ab").tolist() == [3, 2]


def test_frames(spark):
    rows = [(1, "two words", "x"), (1, "two words", "x"), (2, None, "y"), (3, "", "z"), (None, "word " * 30000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pieces string")
    got = sorted(P.token_counts(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [r.n_pieces for r in got] == [3, 3, 0, 0, 60001]
    out = P.round_trip(df, ["doc_id"]).collect()
    assert all(r.round_trip for r in out) and sorted(len(r.ids) for r in out) == [0, 0, 3, 3, 60001]
    back = P.decode(P.encode(df, ["doc_id"]), ["doc_id"]).collect()
    assert sorted(r.decoded for r in back) == sorted(t or "" for _, t, _ in rows)
    assert P.token_counts(df.limit(0)).count() == 0 and P.round_trip(df.limit(0), ["doc_id"]).count() == 0


def test_long_texts_without_blanks(seg, monkeypatch):
    """Typed arrays give the paths of lists, in a few bytes per character."""
    import tracemalloc

    rng = random.Random(9)
    texts = ["".join(rng.choice("aeinstrl.\n執🙂") for _ in range(3000)), "ab" * 2000, "執" * 1500]
    want = [(P.Segmenter(seg.v).count_text(t), P.Segmenter(seg.v).encode_text(t).tolist()) for t in texts]
    monkeypatch.setattr(P, "LONG", 1)
    other = P.Segmenter(seg.v)
    assert [(other.count_text(t), other.encode_text(t).tolist()) for t in texts] == want
    tracemalloc.start()
    ids = other.encode_text("abcdefgh" * 50_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert other.decode_ids(ids) == "abcdefgh" * 50_000 and peak < 50 * 400_000
