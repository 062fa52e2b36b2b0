import random

import numpy as np

from plumbline.llm import leakage


def words(n, rng, stock):
    return " ".join(rng.choice(stock) for _ in range(n))


STOCK = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "su", "ta", "ve", "zo") for b in ("ran", "lig", "mon", "pert", "dak", "fil")]


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as item_id", "'x' as ids")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "2 as doc_id")
    return sorted(map(tuple, leakage.find_leaks(d, i, "doc_id", "text", "item_id", "text").collect()))


def test_settings_and_alterations(spark):
    rng = random.Random(5)
    item, other = words(60, rng, STOCK), words(60, rng, STOCK)
    w = item.split()
    part = w[20:40]
    typo = part.copy()
    typo[5], typo[14] = "strange", typo[14][:-1] + "1"
    split = part.copy()
    split[9] = split[9][:3] + " " + split[9][3:]
    docs = {
        1: " ".join(part).upper(),
        2: "Intro words here. <p>" + "</p>\n<p>".join(["> " + ", ".join(part[:9]), "– ".join(part[9:])]) + "</p> and more",
        3: " ".join(typo),
        4: " ".join(split),
        5: " ".join(part[:11]),
        6: " ".join(w[:9]) + " and then " + " ".join(w[30:39]),
        7: None,
        8: "",
        9: words(400, rng, STOCK),
        10: words(9000, rng, STOCK) + " " + " ".join(part) + " " + words(9000, rng, STOCK),
        11: " ".join(part[:10]) + "-\n" + " ".join(part[10:]).replace(" ", "\r\n"),
        12: item + " " + other,
    }
    got = found(spark, list(docs.items()) + [(1, docs[1])], [(100, item), (101, other), (100, item), (102, None), (103, " "), (104, item)])
    want = [(d, i) for d in (1, 2, 3, 4, 10, 11) for i in (100, 104)] + [(12, 100), (12, 101), (12, 104)]
    assert got == sorted(want)
    assert found(spark, list(docs.items()), []) == [] and found(spark, [], [(1, item)]) == []


def test_patterns_with_other_words_are_none(spark):
    item = "records from may show 126 entries on how the harbor assessor leased the painted toll booth by lantern light near the gate"
    other = "records from june show 95 entries on how the harbor assessor taxed the cider press hall using river clay after a vote"
    assert found(spark, [(1, other), (2, item)], [(7, item), (8, other)]) == [(1, 8), (2, 7)]


def test_short_items(spark):
    assert found(spark, [(1, "so it was said that one two three four five"), (2, "one two six four five")], [(1, "One two, three four five")]) == [(1, 1)]


def test_recall_against_brute_force(spark):
    rng = random.Random(9)
    items = [(i, words(50, rng, STOCK)) for i in range(30)]
    docs, want = [], set()
    for k in range(150):
        text = words(60, rng, STOCK).split()
        if k % 2:
            i, item = rng.choice(items)
            a, n = rng.randrange(0, 30), rng.randrange(18, 21)
            text[20:20] = item.split()[a : a + n]
            want.add((k, i))
        docs.append((k, " ".join(text)))
    assert set(found(spark, docs, items)) >= want


def test_long_items(spark):
    """A stretch anywhere in an item of thousands of words is found; pieces hold every stretch whole."""
    rng = np.random.default_rng(7)
    words = [f"w{i}x" for i in rng.integers(0, 4000, 3000)]
    for n in (1, 15, 16, 31, 32, 33, 224, 256, 257, 300, 480, 3000):
        pieces = leakage.pieces_of(list(range(n)))
        assert max(map(len, pieces)) <= leakage.PIECE_WORDS and (len(pieces) == 1 or min(map(len, pieces)) >= 2 * leakage.STRETCH)
        for a in range(max(1, n - 31)):
            assert any(set(range(a, min(n, a + 32))) <= set(p) for p in pieces)
    starts = [0, 100, 213, 250, 700, 1500, 2976]
    docs = spark.createDataFrame([(k, "before this " + " ".join(words[a : a + 24]) + " and after") for k, a in enumerate(starts)] + [(99, " ".join(words[5:15]))], "d long, t string")
    items = spark.createDataFrame([(7, " ".join(words)), (8, "short item of words")], "i long, x string")
    got = leakage.find_leaks(docs, items, "d", "t", "i", "x")
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(k, 7) for k in range(len(starts))]
