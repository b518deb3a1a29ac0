"""Exact, near, byte-string and line deduplication against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from wafercast.llm import exact_dedup, line_dedup, near_dedup, suffix_dedup
from wafercast.llm.queries import queries

from .conftest import BASE, ROWS, SMALL, documents


# ---- exact

def test_exact_edge_cases(edge, empty):
    got = exact_dedup.exact_groups(edge).collect()
    assert len(got) == len(ROWS)
    kept = Counter(r.doc_id for r in got if r.kept)
    by = {r.doc_id: r for r in got}
    assert by[1].group_size == 3 and {by[i].keep_id for i in (1, 2, 3)} == {1}
    assert kept[1] == 1 and kept[2] == kept[3] == 0
    assert kept[5] == 1 and by[5].group_size == 2             # a repeated row stays once
    assert by[8].keep_id == 8 and by[8].group_size == 3       # null, empty and white are equal; the longest stays
    assert kept[None] == 1
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_deduplicate_keeps_rows_unchanged(edge, empty):
    got = exact_dedup.deduplicate(edge)
    assert got.columns == edge.columns
    ids = Counter(r.doc_id for r in got.select("doc_id").collect())
    assert ids == Counter({1: 1, 4: 1, 5: 1, 8: 1, 9: 1, 10: 1, 11: 1, 12: 1, 13: 1, 14: 1, 15: 1, 16: 1, 17: 1,
                           18: 1, 19: 1, None: 1})
    assert exact_dedup.deduplicate(empty).count() == 0


def test_exact_with_a_full_filter(spark, small, monkeypatch):
    """A filter with far too few slots sends more rows, and changes nothing."""
    want = queries()["op4_exact_dedup"](spark, SMALL).toPandas().sort_values("doc_id", ignore_index=True)
    monkeypatch.setattr(exact_dedup, "MAX_SLOTS", 64)
    got = queries()["op4_exact_dedup"](spark, SMALL).toPandas().sort_values("doc_id", ignore_index=True)
    assert got.equals(want)


# ---- near

_LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))
    n = min(k, len(w))
    return frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if w else frozenset()


def brute_components(docs, k, threshold=80):
    sets = {i: shingles(t, k) for i, t in docs}
    up = {}

    def root(v):
        while up.get(v, v) != v:
            v = up[v]
        return v

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both) and root(i) != root(j):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_equals_brute_force(spark, small):
    got = queries()["op2_minhash_dedup"](spark, SMALL).collect()
    want = brute_components(list(small.items()), 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(small)


def test_near_edge_cases(edge, empty):
    got = near_dedup.near_groups(edge, k=5).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert {by[i].component_id for i in (1, 2, 3, 4)} == {1}
    assert by[10].component_id == 9 and by[12].component_id == 11
    assert all(by[i].n_shingles == 0 and by[i].kept for i in (6, 7, 8))
    assert by[None].component_id is None
    kept = near_dedup.keep_one(edge)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {1, 5, 6, 7, 8, 9, 11, 13, 14, 15, 16, 17, 18, 19, None}
    assert near_dedup.near_groups(empty).count() == 0


def test_near_chain_and_blocks(spark, monkeypatch):
    """A family whose members are linked only through others, in blocks of a few."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(120)]
    rows, text = [], list(words)
    for i in range(60):
        text = list(text)
        for p in rng.integers(0, 120, 30 if i % 9 == 8 else 2):
            text[p] = f"edit{i}x{p}"
        rows.append((int(rng.permutation(1000)[0]) * 100 + i, " ".join(text), "en", "s"))
    got = near_dedup.near_groups(documents(spark, rows), k=4).collect()
    want = brute_components([(r[0], r[1]) for r in rows], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 1 < len({c for _, c in want.values()}) < 60


def test_circulant_signature_estimates_similarity():
    a = near_dedup.shingle_set(BASE.encode(), 1)
    rng = np.random.default_rng(1)
    est = []
    for _ in range(30):
        s = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
        x, y = near_dedup.signature(s[:1000]), near_dedup.signature(s[200:1200])
        est.append((x == y).mean())
    assert abs(np.mean(est) - 800 / 1200) < 0.03 and len(a) == 100


# ---- byte strings

def brute_bytes(docs):
    docs = sorted(docs, key=lambda r: r[0])
    first = {}
    for i, b in docs:
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    out = []
    for i, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result_rows(df):
    return sorted(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect())


@pytest.mark.parametrize("hot", [{}, {"hot_blocks": 2, "block_bytes": 1 << 16}])
def test_bytes_equal_brute_force(spark, small, hot):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = result_rows(suffix_dedup.remove_repeats(docs, **hot))
    assert got == brute_bytes([(i, t.encode()) for i, t in small.items()])


def test_bytes_edge_cases(edge, empty):
    got = suffix_dedup.remove_repeats(edge, texts=True)
    named = [(r[0], (r[1] or "").encode()) for r in ROWS if r[0] is not None]
    assert result_rows(got.where("doc_id is not null")) == brute_bytes(named)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_sort_is_lexicographic():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    sfx = suffix_dedup.Suffixes(data)
    at = rng.integers(0, 2900, 500)
    group = np.sort(rng.integers(0, 5, 500))
    raw = data.tobytes()
    order = sfx.sort(at, group)
    keys = [(int(group[i]), raw[at[i]:at[i] + 50]) for i in order]
    assert keys == sorted(keys)
    order, run = sfx.equal_runs(at, group)
    plain, run2 = sfx._byte_runs(at, group)
    assert run.max() == run2.max()


def test_hash_collisions_are_caught(monkeypatch):
    """With a hash that says yes to everything the bytes still decide."""
    data = np.frombuffer(b"a" * 60 + b"b" * 60, np.uint8)
    sfx = suffix_dedup.Suffixes(data)
    monkeypatch.setattr(sfx, "part", lambda at, length: np.zeros(len(at), np.uint64))
    assert (sfx.part(np.array([0, 60]), 50) == 0).all()
    order, run = sfx.equal_runs(np.array([0, 60, 1]), np.zeros(3, np.int64))
    assert len(set(run.tolist())) == 2


# ---- lines

def brute_lines(rows, min_run, min_words):
    """(n_removed, n_runs, kept text) by comparing every run of every length."""
    seen, out = {}, []
    docs = [(i, (t or "").split("\n") if t is not None else []) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    for at, (_, lines) in enumerate(docs):
        for p in range(len(lines)):
            for n in range(1, len(lines) - p + 1):
                seen.setdefault(tuple(lines[p:p + n]), (at, p))
    for at, (i, lines) in enumerate(docs):
        gone = set()
        for p in range(len(lines)):
            for n in range(1, len(lines) - p + 1):
                run = lines[p:p + n]
                if (n >= min_run or sum(len(x.split()) for x in run) > min_words) and seen[tuple(run)] < (at, p):
                    gone |= set(range(p, p + n))
        out.append((i, len(gone), sum(p - 1 not in gone for p in gone), "\n".join(x for p, x in enumerate(lines) if p not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_run,min_words", [(4, 50), (4, 5), (3, 6), (1, 0), (6, 4)])
def test_lines_match_every_run_compared(spark, min_run, min_words):
    rng = np.random.default_rng(min_run * 10 + min_words)
    pool = ["a", "b", "c d", "e f g h", "", "i " * 60, "j k l m n o p q", "r s t"]
    rows = [(i, "\n".join(pool[j] for j in rng.integers(0, len(pool), rng.integers(1, 14)))) for i in range(25)]
    rows += [(100, None), (101, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_removed, r.n_runs, r.kept_text) for r in line_dedup.remove_runs(df, min_run, min_words).collect()), key=str)
    assert got == brute_lines(rows, min_run, min_words)


def test_long_lines_and_short_documents_are_found(spark):
    long = " ".join(f"w{i}" for i in range(51))
    rows = [(1, long), (2, long), (3, f"own\n{long}\nmore"), (4, " ".join(f"w{i}" for i in range(50))), (5, " ".join(f"w{i}" for i in range(50)))]
    by = {r.doc_id: r for r in line_dedup.remove_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [by[i].n_removed for i in range(1, 6)] == [0, 1, 1, 0, 0]
    assert by[3].kept_text == "own\nmore"


def test_lines_edge_cases(edge, empty):
    by = {r.doc_id: r for r in line_dedup.remove_runs(edge, min_run=4).collect()}
    assert (by[17].n_lines, by[17].n_removed, by[17].n_runs, by[17].kept_text) == (10, 4, 1, "a\nb\nc\nd\ne\nz")
    assert (by[18].n_removed, by[18].kept_text) == (4, "q")
    assert (by[6].n_lines, by[7].n_lines, by[6].kept_text) == (0, 1, "")
    assert by[3].n_removed == 0 and (by[2].n_removed, by[2].kept_text) == (1, "")
    assert line_dedup.remove_runs(edge).count() == len(ROWS)
    assert line_dedup.remove_runs(empty).count() == 0
    one = {r.doc_id: r for r in line_dedup.remove_runs(edge, min_run=1).collect()}
    assert one[18].kept_text == "q" and one[2].kept_text == ""


def test_suffix_dedup_takes_ids_of_any_type(spark):
    rng = np.random.default_rng(8)
    part = "".join(chr(97 + c) for c in rng.integers(0, 26, 80))
    rows = [("b9", "x" + part + "y"), ("b10", part), ("a", "own text " + part), (None, part), ("c", "short")]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": 0, "b10": 80, "b9": 80, "c": 0, None: 0}      # ids in string order
