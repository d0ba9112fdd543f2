import itertools
import random

from faultweave.llm import leakage
from faultweave.llm.leakage import Block, tile, words
from faultweave.llm.mail import visible_text
from faultweave.llm.queries import p8_found
from faultweave.sources.tables import table


def longest_common(a, b):
    best = 0
    for i, j in itertools.product(range(len(a)), range(len(b))):
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        best = max(best, n)
    return best


def test_hashes_are_positional():
    import numpy as np

    ids = np.array([1, 2, 3, 1, 2, 3, 4], np.int64)
    for k in range(1, 8):
        h = leakage._hashes(ids, k)
        assert len(h) == 8 - k
        for i, j in itertools.product(range(len(h)), repeat=2):
            assert (h[i] == h[j]) == (list(ids[i : i + k]) == list(ids[j : j + k]))
    assert len(leakage._hashes(ids, 9)) == 0


def test_tiles_against_brute_force():
    r = random.Random(0)
    vocabulary = "abcdefg"
    for _ in range(150):
        item = [r.choice(vocabulary) for _ in range(r.randrange(3, 30))]
        doc = [r.choice(vocabulary + "xyz") for _ in range(r.randrange(0, 60))]
        if r.random() < 0.7:
            a, n = r.randrange(len(item)), r.randrange(1, len(item) + 1)
            at = r.randrange(len(doc) + 1)
            doc[at:at] = item[a : a + n]
        k = 3
        b = Block([("i", item)], k)
        got = dict(b.tiles(b.numbers(doc)))
        most = longest_common(item, doc)
        assert (most >= k) == ("i" in got)
        if "i" in got:
            ts = got["i"]
            assert max(t[2] for t in ts) == most
            used_a, used_b = set(), set()
            for x, y, n in ts:
                assert item[x : x + n] == doc[y : y + n] and n >= k
                assert not used_a & set(range(x, x + n)) and not used_b & set(range(y, y + n))
                used_a |= set(range(x, x + n))
                used_b |= set(range(y, y + n))


def test_many_pairs_are_taken_in_parts(monkeypatch):
    """Items that share their seeds, and a document full of them: parts of the items give the same tiles."""
    r = random.Random(3)
    base = [r.choice("ab") for _ in range(40)]
    items = [(i, base[r.randrange(10) :] + [r.choice("abc") for _ in range(20)]) for i in range(17)]
    b = Block(items, 3)
    doc = b.numbers(base * 3 + [r.choice("abcx") for _ in range(60)])
    whole = {k: sorted(ts) for k, ts in b.tiles(doc)}
    monkeypatch.setattr(leakage, "PAIRS", 50)
    parts = [(k, sorted(ts)) for k, ts in b.tiles(doc)]
    assert len(parts) == len(dict(parts)) == 17 and dict(parts) == whole


def test_greedy_order():
    assert sorted(tile([(0, 0, 10), (8, 20, 9)], 3)) == [(0, 0, 10), (10, 22, 7)]
    assert tile([(0, 0, 5), (0, 9, 5)], 3) == [(0, 0, 5)]


def test_words():
    assert words("L'ÉTÉ d’été, 13.5 STRASSE straße_x") == ["l", "été", "d", "été", "13", "5", "strasse", "strasse", "x"]
    assert words("été") == ["été"]


def test_leaks_with_reordering_and_edges(spark, monkeypatch):
    passage = [f"w{i}" for i in range(40)]
    mixed = passage[20:40] + ["zz"] + passage[0:19]
    docs = [
        (1, "pre " + " ".join(passage[5:18]) + " post"), (2, " ".join(passage[5:17])), (3, "\n> ".join(passage)), (4, None), (5, ""), (6, "Subject: x\nContent-Type: text/html\n\n<p>" + "<br>".join(passage[:14]).upper() + "</p>"),
        (7, " ".join(mixed)), (8, "filler " * 60_000 + " ".join(passage[:20])), (3, "\n> ".join(passage)), (9, "a b"),
    ]
    items = [(10, " ".join(passage)), (11, None), (12, ""), (13, "a b"), (10, " ".join(passage)), (14, " ".join(passage[:13]))]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc long, item string, longest int")
    e = spark.createDataFrame(items, "tiles long, covered string")
    for block, at_once in ((leakage.BLOCK_WORDS, 8), (5, 8), (5, 1)):
        monkeypatch.setattr(leakage, "PASS_BLOCKS", at_once)
        got = {(r.doc, r.item): r for r in leakage.leaks(d, "doc", "item", e, "tiles", "covered", block_words=block).collect()}
        assert {k for k, r in got.items() if r.longest >= 13} == {(1, 10), (3, 10), (3, 14), (6, 10), (6, 14), (7, 10), (7, 14), (8, 10), (8, 14)}
        assert got[2, 10].longest == 12 and got[7, 10].coverage > 0.9 and got[7, 10].tiles == 2 and not any(i in (11, 12, 13) for _, i in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k long, t string")
    some = spark.createDataFrame([(1, "x " * 30)], "k long, t string")
    for a, b in ((none, some), (some, none), (none, none)):
        assert leakage.leaks(a, "k", "t", b, "k", "t").count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    grams = {}
    for r in table(spark, sf, "eval_items").collect():
        w = words(r.text)
        for i in range(len(w) - 12):
            grams.setdefault(tuple(w[i : i + 13]), set()).add(r.item_id)
    want = set()
    for r in table(spark, sf, "documents").select("doc_id", "text").collect():
        w = words(visible_text(r.text))
        for i in range(len(w) - 12):
            want |= {(r.doc_id, x) for x in grams.get(tuple(w[i : i + 13]), ())}
    assert want and {tuple(r) for r in p8_found(spark, sf).collect()} == want
