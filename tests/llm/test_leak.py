"""Leaks against brute force over all windows, both ways of joining, and edges."""

import unicodedata

import pytest

from tidelog.llm import leak as L
from tidelog.runtime import scan


def plain_words(t):
    t = "".join(c for c in unicodedata.normalize("NFKC", t) if unicodedata.category(c) != "Cf").casefold()
    t = unicodedata.normalize("NFKC", t)
    return "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in t).split()


def brute(docs, items, run=12):
    where = {}
    for i, t in items:
        w = plain_words(t or "")
        for k in range(len(w) - run + 1):
            where.setdefault(tuple(w[k : k + run]), set()).add(i)
    out = set()
    for d, t in docs:
        w = plain_words(t or "")
        for k in range(len(w) - run + 1):
            out |= {(d, i) for i in where.get(tuple(w[k : k + run]), ())}
    return out


def pairs(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


@pytest.mark.parametrize("windows", [L.WINDOWS, 10])
def test_table(spark, windows):
    docs, items = scan(spark, "/root/testdata/sf0.01", "documents"), scan(spark, "/root/testdata/sf0.01", "eval_items")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert pairs(L.leaks(docs, items, windows=windows)) == want and want


ITEM = "Suppose Sogasoth sends 7311 lots to Kireper and the apportionment delineates Koduvath within 14 seconds."


@pytest.mark.parametrize("windows", [L.WINDOWS, 1])
def test_edges(spark, windows):
    docs = [
        (1, "x " + ITEM.upper().replace(" ", " -- ") + " y"), (2, "ﬁrst. " + ITEM.replace("lots", "lo­ts").replace("the", "t​he")), (3, None), (4, ""), (5, "Suppose Sogasoth sends"),
        (6, ITEM.replace("7311", "99").replace("Kireper", "Someone")), (7, ITEM.replace("apportionment", "other")), (8, " ".join(["filler"] * 50000) + " " + ITEM), (1, "again " + ITEM),
        (9, ITEM.replace("1", "１")),
    ]
    items = [(10, ITEM), (11, "Read the case. " + ITEM), (12, None), (13, "short one"), (14, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as item_id")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 as doc_id")
    got = pairs(L.leaks(d, i, windows=windows))
    assert got == {(x, y) for x in (1, 2, 8, 9) for y in (10, 11)} == brute(docs, items)
    assert pairs(L.leaks(d.limit(0), i, windows=windows)) == set() == pairs(L.leaks(d, i.limit(0), windows=windows))


def test_exchanged(spark):
    item = "Suppose Sogasoth sends 7311 lots to Kireper and then Sogasoth sends 7311 lots back within 14 seconds to Kireper"
    docs = [
        (1, item), (2, item.replace("7311", "50").replace("Sogasoth", "Anna")), (3, item.replace("7311", "50", 1)), (4, item.replace("lots", "units")), (5, item.replace("Kireper", "Sogasoth")), (6, item.replace("back", "home")),
    ]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(10, item)], "item_id long, text string")
    for windows in (L.WINDOWS, 1):
        assert pairs(L.leaks(d, i, run=18, exchanged=True, windows=windows)) == {(2, 10)}
        assert pairs(L.leaks(d, i, run=18, windows=windows)) == {(1, 10)}


def test_exchanged_whatever_the_filter(spark):
    docs, items = scan(spark, "/root/testdata/sf0.01", "documents"), scan(spark, "/root/testdata/sf0.01", "eval_items")
    many, few = (pairs(L.leaks(docs, items, exchanged=True, windows=w)) for w in (L.WINDOWS, 1))
    assert many == few and many


def test_crowded_lexicon(spark, monkeypatch):
    """Words that share their bits make templates coarser, not results."""
    docs, items = scan(spark, "/root/testdata/sf0.01", "documents"), scan(spark, "/root/testdata/sf0.01", "eval_items")
    want = pairs(L.leaks(docs, items))
    small = L.lexicon_of
    monkeypatch.setattr(L, "lexicon_of", lambda items: small(items, 1 << 6))
    assert pairs(L.leaks(docs, items)) == want
