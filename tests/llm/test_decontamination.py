"""Operator 13 against plain Python, both joins, both ways of removing."""

import hashlib
import re

import pytest

from wafercast.llm import decontamination as D

from .conftest import BASE, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    """(n_words, hit word numbers, item ids)"""
    ws, hit, found = words(text), set(), set()
    for item, body in items:
        bs = words(body)
        k = min(window, len(bs))
        grams = {tuple(bs[i:i + k]) for i in range(len(bs) - k + 1)} if bs else set()
        for i in range(len(ws) - k + 1):
            if grams and tuple(ws[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                found.add("" if item is None else str(item))
    return len(ws), hit, sorted(found)


ITEM = " ".join(f"q{i}" for i in range(25))
ITEMS = [(1, ITEM), (2, "Short ONE, here!"), (3, None), (4, " ... "), (10, ITEM.replace("q3 ", "r3 ")), (None, "étude İ x"),
         (5, "rare"), (5, " ".join(f"alpha{i}" for i in range(30, 45)))]
TEXTS = ["Before it. " + ITEM.replace(" ", ", ").upper() + " after", "short one; HERE and short one here", "étude İ x", "ÉTUDE İ X",
         "q5 " * 30, " ".join(f"q{i}" for i in range(9)), " ".join(f"q{i}" for i in range(12)) + " gap " + " ".join(f"q{i}" for i in range(8, 22)),
         "rare", "rarer rare, rare", ITEM + " " + ITEM, None, "", "1/2", "clean words only " * 20]


def tables(spark, extra):
    docs = extra.unionByName(documents(spark, [(100 + i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(100, TEXTS[0], "en", "s"), (None, ITEM, None, None)]))
    bench = spark.createDataFrame([(i, t, "clash", "clash") for i, t in ITEMS], "item_id long, text string, k string, gram string")
    return docs, bench


@pytest.mark.parametrize("small", [True, False])
def test_matches_brute_force(spark, edge, small, monkeypatch):
    if not small:       # the salted join, and a table so small that most runs need verification
        monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
        monkeypatch.setattr(D, "MAX_SLOTS", 64)
    docs, bench = tables(spark, edge)
    got = sorted((str(r.doc_id), r.copy, r.n_words, r.n_hit, tuple(map(tuple, r.spans)), tuple(r.items))
                 for r in D.contamination(docs, bench).collect())
    want = []
    for r in docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) as copy").collect():
        n, hit, found = brute(r.text, ITEMS)
        spans = [p for p in sorted(hit) if p - 1 not in hit]
        ends = [p for p in sorted(hit) if p + 1 not in hit]
        want.append((str(r.doc_id), r.copy, n, len(hit), tuple(zip(spans, ends)), tuple(found)))
    assert got == sorted(want) and sum(w[3] > 0 for w in want) >= 9


def test_removal(spark, edge):
    docs, bench = tables(spark, edge)
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    clean = [r for r in docs.collect() if not brute(r.text, ITEMS)[1]]
    key = lambda r: (str(r.doc_id), str(r.text))
    assert sorted(map(key, kept.collect())) == sorted(map(key, clean))
    cut = D.decontaminate(docs, bench, spans=True)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    by = {}
    for r in cut.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[100] == ["Before it after"] * 2 and by[101] == [" and"] and by[113] == [TEXTS[13]] and by[110] == [None]
    for r in docs.collect():
        _, hit, _ = brute(r.text, ITEMS)
        left = [w for i, w in enumerate(words(r.text)) if i not in hit]
        assert any(words(t) == left for t in by[r.doc_id])


def test_empty_tables_and_digest(spark, edge, empty):
    docs, bench = tables(spark, edge)
    assert D.contamination(empty, bench).count() == 0
    none = D.contamination(docs, bench.limit(0))
    assert none.count() == docs.count() and none.where("n_hit > 0 or size(spans) > 0").isEmpty()
    assert D.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert brute(BASE, ITEMS)[2] == ["5"] and hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_window_is_a_parameter(spark, empty):
    docs = documents(spark, [(1, "a b c d e f", None, None)])
    bench = spark.createDataFrame([(7, "x b c d y")], "item_id long, text string")
    assert D.contamination(docs, bench).first().n_hit == 0
    assert D.contamination(docs, bench, window=3).first().n_hit == 3
