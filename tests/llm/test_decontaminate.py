import random

from objsync.llm import decontaminate as D


def brute_tiles(item, text, width):
    """Greedy string tiling as stated: scan all pairs for the longest unmarked match."""
    mi, mt, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and i + n not in mi and j + n not in mt:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < width:
            return tiles
        tiles.append((i, j, n))
        mi.update(range(i, i + n))
        mt.update(range(j, j + n))


def test_tiles_against_brute_force():
    rng = random.Random(2)
    for _ in range(120):
        item = [rng.randint(1, 5) for _ in range(rng.randint(1, 14))]
        text = [rng.randint(1, 5) for _ in range(rng.randint(0, 25))]
        width = min(3, len(item))
        pairs = [(i, j) for i in range(len(item) - width + 1) for j in range(len(text) - width + 1) if item[i : i + width] == text[j : j + width]]
        assert D.greedy_tiles(pairs, width) == brute_tiles(item, text, width)


WORDS = [f"w{i}" for i in range(400)]


def test_matches():
    rng = random.Random(4)
    items = [(i, " ".join(rng.sample(WORDS, 30))) for i in range(20)] + [(50, "One two three."), (51, None), (52, " . "), (53, "one TWO, three")]
    block = D.Block(items)
    a = items[3][1].split()
    filler = ["zz"] * 25
    found = lambda words: [m[0] for m in block.matches(" ".join(words))]
    assert found(filler + a + filler) == [3]
    assert found(filler + [w.upper() + "," for w in a]) == [3]
    assert found(a[20:] + ["zz"] + a[10:20] + ["zz"] + a[:10]) == [3]  # passages in another order
    assert found(a[:10] + filler) == [] and found(a[:18] + filler) == [3]
    assert found([w for x in a for w in (x, "zz")]) == []
    assert found(a[:10] + filler * 20 + a[10:]) == [3] and found([x for i in range(0, 30, 10) for x in a[i : i + 10] + filler * 20]) == [3]  # passages far apart
    assert found([x for i in (20, 0, 10) for x in a[i : i + 10] + filler * 200]) == [3]  # and in another order
    assert found([x for i in (20, 10) for x in a[i : i + 8] + filler * 200]) == []  # 16 of 30 words
    assert found("say: one, two three!".split()) == [50, 53]
    assert block.matches("") == [] and D.Block([]).matches("x y") == []


def test_frames(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta", 9), (1, "alpha beta gamma delta epsilon zeta", 9), (2, None, 9)], "item_id long, text string, doc_id int")
    docs = spark.createDataFrame([(10, "x alpha beta gamma delta epsilon zeta y", "a"), (10, "x alpha beta gamma delta epsilon zeta y", "a"), (11, None, "a"), (12, "", "b"),
                                  (None, "clean " * 100000, None)], "doc_id long, text string, item_id string")
    assert [(r.doc_id, r.item_id, r.covered_words) for r in D.contaminated(docs, items).collect()] == [(10, 1, 6)] * 4
    assert sorted(str(r.doc_id) for r in D.keep_clean(docs, items).collect()) == ["11", "12", "None"]
    assert D.keep_clean(docs, items).columns == docs.columns
    assert D.contaminated(docs, items.limit(0)).count() == 0 and D.contaminated(docs.limit(0), items).count() == 0
    assert len(list(D.blocks(items, 40))) == 2 and list(D.blocks(items.limit(0))) == []
    more = items.unionByName(spark.createDataFrame([(i, f"alpha beta gamma delta epsilon zeta item{i}", 9) for i in range(5, 9)], items.schema))
    assert sorted(r.item_id for r in D.contaminated(docs, more, 60).collect()) == sorted(r.item_id for r in D.contaminated(docs, more).collect())
    assert sorted(str(r.doc_id) for r in D.keep_clean(docs, more, 60).collect()) == ["11", "12", "None"]


def test_far_copies_take_no_words_from_one_another():
    item = [f"v{i}" for i in range(100)]
    change = lambda at: [w if i != at else "zz" for i, w in enumerate(item)]
    block = D.Block([(7, " ".join(item))])
    for words in (change(50) + ["zz"] * 900 + change(45), change(45) + ["zz"] * 900 + change(50)):
        assert [m[:4] for m in block.matches(" ".join(words))] == [(7, 100, 100, 2)]  # the tiles of both copies
    assert [m[2] for m in block.matches(" ".join(change(50) + ["zz"] * 900 + item))] == [100]
    assert block.matches(" ".join(item[:50] + ["zz"] * 900 + item[:50])) == []


def test_best_cover_against_brute_force():
    rng = random.Random(6)
    more = 0
    for _ in range(300):
        item = [rng.randint(1, 6) for _ in range(rng.randint(2, 9))]
        text = [x for _ in range(5) for x in (item[rng.randint(0, 3) :] + [0] * rng.randint(0, 12))]
        width, reach = 2, 2 * len(item)
        seeds = [(i, j) for i in range(len(item) - 1) for j in range(len(text) - 1) if item[i : i + 2] == text[j : j + 2]]
        if not seeds:
            continue
        whole = sum(n for _, _, n in brute_tiles(item, text, width))
        parts = [sum(n for _, _, n in brute_tiles(item, text[j : j + reach], width)) for j in range(len(text))]
        assert D.best_cover(seeds, width, reach, 0)[0] == max(whole, *parts)
        more += max(parts) > whole
    assert more
