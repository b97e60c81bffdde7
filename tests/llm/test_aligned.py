import hashlib
import random
from collections import Counter

import pytest

from objsync.llm import aligned as L


@pytest.fixture(scope="module")
def sides():
    return L.side_a(), L.side_b()


def brute_tokens(text):
    """Ids and bytes of both tokenizers on the whole text, from the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(brute_tokens, "t"):
        brute_tokens.t, brute_tokens.p = Tokenizer.from_file(L.TOKENIZER_A), sentencepiece.SentencePieceProcessor(model_file=L.TOKENIZER_B)
        brute_tokens.t.encode_special_tokens = True
    t, p = brute_tokens.t, brute_tokens.p
    a = t.encode(" " + text, add_special_tokens=False)
    back = {c: b for b, c in enumerate_bytes()}
    bytes_a = [bytes(back[c] for c in x) for x in a.tokens]
    ids_b = p.encode(text)
    bytes_b = [bytes([int(x[1:-1], 16)]) if p.is_byte(i) else x.replace("▁", " ").encode() for i, x in zip(ids_b, map(p.id_to_piece, ids_b))]
    return a.ids, bytes_a, ids_b, bytes_b


def enumerate_bytes():
    """(byte, its character) of a byte-level vocabulary."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in shown]
    return [(b, chr(b)) for b in shown] + [(b, chr(256 + i)) for i, b in enumerate(hidden)]


def brute_groups(text):
    if not text:
        return []
    a, ba, b, bb = brute_tokens(text)
    whole = (" " + text).encode()
    if b"".join(ba) != whole or b"".join(bb) != whole:
        return []

    def ends(parts):
        n, out = 0, []
        for x in parts:
            n += len(x)
            out.append(n)
        return out

    ea, eb = ends(ba), ends(bb)
    cuts, groups, start = sorted(set(ea) & set(eb)), [], 0
    for c in cuts:
        groups.append(([i for i, e in zip(a, ea) if start < e <= c], [i for i, e in zip(b, eb) if start < e <= c]))
        start = c
    return groups


def brute(rows):
    all_groups = [brute_groups(t) for _, t in rows]
    counts = Counter(p for groups in all_groups for p in {(x, y) for a, b in groups for x in a for y in b})
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (d, _), groups in zip(rows, all_groups):
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((d, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


TEXTS = ["", None, " ", "a", "Hello world", "  two  spaces ", "tab\tand\r\nlines\n\n\n end", "ünïcödé 執筆 𝔘 🙂🙂 x", "a▁b", "<|endoftext|> </s> <unk> <0x41>", "'s don't I'll 1234567 3.14159",
         "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x01 \x1c x \x85 y\xa0z", "==========----------__________", "é combining"]


def test_runs_against_sets():
    rng = random.Random(1)
    for _ in range(3000):
        n = rng.randint(1, 80)
        share = rng.choice([0.05, 0.5, 0.95, 1])
        common = sorted(rng.sample(range(1, 400), n))
        a = sorted({x for x in common if rng.random() < share} | {400})
        b = sorted({x for x in common if rng.random() < share} | {400})
        cut_a, cut_b = L.run_cuts(a, b)
        both = sorted(set(a) & set(b))
        assert cut_a == [a.index(x) + 1 for x in both] and cut_b == [b.index(x) + 1 for x in both]


def test_groups(sides, monkeypatch):
    rng = random.Random(4)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(["the ", "of", " ", "\n", "x", "Ωmega", "🙂", "ing", "9", "執", "  "]) for _ in range(rng.randint(1, 40))) for _ in range(120)]
    want = [brute_groups(t) for t in texts]
    aligner = L.Aligner(*sides)
    assert [r.groups if r else [] for r in aligner.align(texts)] == want
    monkeypatch.setattr(L, "REMEMBERED_CHARS", 10)  # forgetting changes nothing
    assert [r.groups if r else [] for t in texts for r in aligner.align([t])] == want
    monkeypatch.setattr(L, "stretches", lambda t: [t])  # nor does cutting
    assert [r.groups if r else [] for r in L.Aligner(*sides).align(texts)] == want


def test_links_of_large_groups(sides, monkeypatch):
    r = L.Aligner(*sides).align(["mixed words ünïcödé 🙂🙂 executing tokenization " * 5])[0]
    small = L._links(r.a, r.b, r.cut_a, r.cut_b)
    monkeypatch.setattr(L, "_MANY", 1)
    large = L._links(r.a, r.b, r.cut_a, r.cut_b)
    assert all((x == y).all() for x, y in zip(small, large))


def test_long_text_without_blanks(sides):
    text = "abcdefghij" * 30_000
    r = L.Aligner(*sides).align([text])[0]
    assert sum(len(a) for a, _ in r.groups) == len(r.a) and r.cut_b[-1] == len(r.b)


def test_against_brute_force(spark):
    rng = random.Random(6)
    words = ["alpha", "tokenization", "Zürich", "x1y2", "of", "the", "executing", "pneumonoultramicroscopic", "🙂", "\n"]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(None, "of the alpha"), (7, "of the alpha"), (7, "of the alpha")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, pairs string, batch int").repartition(4)
    out = sorted((tuple(r) for r in L.align_documents(df).collect()), key=str)
    assert out == brute(rows)


def test_empty(spark):
    assert L.align_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    none = L.align_documents(spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in none) == [(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2)]
