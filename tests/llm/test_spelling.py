"""Operator 12 against all pairs by deletion lists, and its machine against all pairs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest

from wafercast.llm import spelling as S

from .conftest import SMALL, documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_vocabulary(rows, every=97, least=5, count=3):
    words = Counter()
    for doc_id, text in rows:
        for w in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least:
                words[w] += 1
    return {w: n for w, n in words.items() if n >= count}


def brute_forms(words):
    gone, near = defaultdict(set), {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            gone[i, w[:i] + w[i + 1:]].add(w)
    for (_, rest), group in gone.items():
        for w in group:
            near[w] |= group - {w}
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    best = {w: min(c, key=lambda x: (-words[x], x)) for w, c in near.items() if c}
    form = {w: b for w, b in best.items() if words[b] >= 2 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words}


def as_dict(df):
    none = lambda v: None if pd.isna(v) else v
    return {r.word: (none(r.form), r.root, r.n, r.n_near, none(r.form_n)) for r in df.toPandas().itertuples()}


def test_query_matches_brute_force(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    want = brute_forms(brute_vocabulary(zip(docs.doc_id, docs.text)))
    assert as_dict(S.op12_spelling_variants(spark, SMALL)) == want


def letters(rng, k, n):
    return "".join(rng.choice("abcd"[:k]) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_machine_gives_each_pair_once(seed):
    rng = random.Random(seed)
    n, first = rng.randint(1, 5), rng.randint(0, 2)
    short = sorted({letters(rng, 3, n) for _ in range(60)})
    long = sorted({letters(rng, 3, n + 1) for _ in range(90)})
    got = Counter((short[i], (short, long)[k][j]) for i, j, k in S.accepted_pairs(short, long, first, first + n + 1))
    same = {(u, v) for u in short for v in short if u < v and sum(a != b for a, b in zip(u, v)) == 1}
    more = {(u, v) for u in short for v in long if any(v[:i] + v[i + 1:] == u for i in range(n + 1))}
    assert set(got) == same | more and set(got.values()) == {1}


def test_acceptor_is_minimal():
    acc = S.Acceptor()
    start = acc.add(sorted(a + b + c for a in "xyz" for b in "uvw" for c in "st"))
    assert len(acc.arcs) == 4 and acc.count[start] == 18
    assert acc.add([]) != start and acc.add(["abst", "abss"][::-1])


@pytest.mark.parametrize("limit", [2, 30, 10_000])
def test_hot_groups_are_split_without_losing_links(spark, limit, monkeypatch):
    rng = random.Random(limit)
    # a third of the words share all but their end, and many their end
    words = {"commonbeginning" + letters(rng, 4, rng.randint(3, 5)) for _ in range(80)}
    words |= {letters(rng, 4, rng.randint(2, 3)) + "commonend" for _ in range(80)} | {letters(rng, 2, rng.randint(1, 6)) for _ in range(80)}
    counted = {w: rng.randint(1, 40) for w in words}
    vocab = spark.createDataFrame(list(counted.items()), "word string, n long")
    monkeypatch.setattr(S.partitions, "__defaults__", (limit,))
    got = as_dict(S.spelling_groups(vocab).select("word", "form", "root", "n", "n_near", "form_n"))
    assert got == brute_forms(counted)


def test_edge_cases(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want = brute_vocabulary(rows)
    vocab = S.vocabulary(edge, delete_every=97)
    assert {r.word: r.n for r in vocab.collect()} == want
    assert as_dict(S.spelling_groups(vocab)) == brute_forms(want)
    assert S.spelling_groups(S.vocabulary(empty)).count() == 0
    long = "a" * 5000
    odd = documents(spark, [(i, f"{long} {long}b {long[:2500]}b{long[2500:]} Éclair× éclair× ÉCLAIR×", None, None) for i in range(3)])
    got = as_dict(S.spelling_groups(S.vocabulary(odd)))
    assert got == brute_forms(brute_vocabulary([(r.doc_id, r.text) for r in odd.collect()], every=None))
    assert got[long][3] == 2 and "Éclair×" in got and "éclair×" in got
