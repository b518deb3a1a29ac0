"""Quality rules, language, mixing, sharding, the SQL twins and the pipeline."""

import zlib
from math import comb

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tools.check_oracle import TABLES, digest
from wafercast.llm import language_id, mixing, quality, sharding
from wafercast.llm.queries import oracle_sql, queries

from .conftest import ROWS, SMALL, documents
from .test_dedup import brute_components
from .test_tokens_packing import check_packing, tok  # noqa: F401


@pytest.mark.parametrize("key", ["op4_exact_dedup", "op6_mixing", "op7_line_runs", "op9_quality_rules",
                                 "op13_decontamination"])
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got, want = queries()[key](spark, SMALL).toPandas(), con.execute(oracle_sql()[key]).fetchdf()
    assert digest(got) == digest(want)


# ---- quality rules

def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_edge_cases(spark, edge, empty):
    lab = labels(spark, [(1, 1, 0), (2, None, 0), (None, 1, 0), (999, 0, 0)])
    by = {r.doc_id: r for r in quality.verdicts(edge, lab).collect()}
    assert all(by[i].n_words == 0 and by[i].base_failed and not by[i].kept for i in (6, 7, 8))
    assert by[1].n_words == 100 and by[1].kept
    assert by[19].n_repeat_words == 80 and by[19].base_failed
    assert by[17].n_dup_lines == 4 and by[13].n_symbols == 0
    kept = quality.keep_good(edge, lab)
    assert kept.columns == edge.columns
    assert quality.verdicts(empty, lab).count() == 0
    assert quality.verdicts(edge, labels(spark, [])).count() == len(ROWS)


def test_binomial_tail(spark):
    df = spark.createDataFrame([(50, 0), (50, 3), (400, 7), (5000, 40)], "n long, x long")
    for r in df.withColumn("p", quality.binomial_tail("n", "x", F.lit(0.01))).collect():
        want = sum(comb(r.n, i) * 0.01**i * 0.99**(r.n - i) for i in range(r.x + 1))
        assert abs(r.p - want) < 1e-9


def test_thresholds_need_enough_good_documents(spark):
    """A rule turns on only when its bound holds; then junk goes and good stays."""
    good = " ".join(f"plain{i}" for i in range(60))
    junk = " ".join(f"bad{i}###" for i in range(60))
    for n, on in ((100, False), (1200, True)):
        rows = [(i, good + f" x{i}", "en", "s") for i in range(n)] + [(10**6 + i, junk + f" y{i}###", "en", "s") for i in range(50)]
        lab = labels(spark, [(r[0], int(r[0] < 10**6), 0) for r in rows])
        got = quality.verdicts(documents(spark, rows, extra=False), lab).groupBy((F.col("doc_id") < 10**6).alias("good"), "kept").count().collect()
        assert {(r.good, r.kept): r["count"] for r in got} == {(True, True): n, (False, not on): 50}


# ---- language

def test_language_held_out_accuracy(spark):
    got = queries()["op8_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    m = got.merge(docs, on="doc_id")
    assert (m.held_out == m.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = m[m.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.98
    assert m.score.between(0, 1).all()


def test_language_edge_cases(edge, empty):
    fold = language_id.fold()
    got = language_id.identify(edge, edge, fold == 2).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (6, 7, 8, 13))
    assert by[None].lang_pred in {"en", "de", "fr", "es"} and by[None].held_out is False
    assert {r.lang_pred for r in language_id.identify(edge, empty, fold == 2).collect()} == {"und"}
    assert language_id.identify(empty, edge, fold == 2).count() == 0


def test_masks_return_every_language(spark):
    langs, masks = language_id.learn(documents(spark, [(i, w, lang, "s") for i, (w, lang) in enumerate(
        [("aaaa bbbb", "x"), ("bbbb cccc", "y"), ("bbbb dddd", "z")])]))
    model = language_id.Identifier(langs, masks)
    assert langs == ["x", "y", "z"]
    assert [model.predict(t)[0] for t in ("aaaa", "cccc", "dddd")] == ["x", "y", "z"]
    assert len({round(v) for v in model.corrected("bbbb")}) == 1


# ---- language masks against plain sets

def test_language_filters_against_plain_sets(spark):
    """Corrected popcounts are the counts of plain set membership, up to the
    filters' false positives, and so are the predictions."""
    rng = np.random.default_rng(3)
    words = {lang: ["".join(rng.choice(list(letters), 5)) for _ in range(40)] for lang, letters in
             (("aa", "bcdfgx"), ("bb", "hjklmx"), ("cc", "npqrsx"))}
    rows = [(i, " ".join(rng.choice(words[lang], 30)), lang, "s") for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    langs, masks = language_id.learn(documents(spark, rows))
    model = language_id.Identifier(langs, masks)
    kept = {}
    for lang in langs:
        for n in range(len(language_id.SIZES)):
            g, c = np.unique(np.concatenate([language_id.grams(t)[n] for _, t, x, _ in rows if x == lang]), return_counts=True)
            kept[lang, n] = set(g[c >= c.sum() * language_id.SHARE].tolist())
    mixed = [" ".join(rng.choice(words["aa"], 20).tolist() + rng.choice(words["bb"], 5).tolist()) for _ in range(20)]
    for text in mixed + [t for _, t, _, _ in rows[:30]]:
        per = language_id.grams(text)
        plain = np.array([sum(x in kept[lang, n] for n, g in enumerate(per) for x in g.tolist()) for lang in langs])
        got, size = model.corrected(text), sum(map(len, per))
        # nothing learned is missed, and hardly anything else is counted
        assert (np.abs(got - plain) <= 0.02 * size + 2).all()
        if sorted(plain)[-1] > sorted(plain)[-2] + 0.1 * size:
            assert model.predict(text)[0] == langs[int(plain.argmax())]
    assert model.predict("xyz" * 3)[0] in langs and model.predict("123")[0] == "und"


# ---- mixing

def water_fill(budget, nodes):
    """nodes: {name: (weight, cap)}; exact shares by repeated saturation."""
    got, left = {}, dict(nodes)
    while left:
        w = sum(x for x, _ in left.values())
        full = [n for n, (x, c) in left.items() if c * w <= x * budget]
        if not full:
            return {**got, **{n: x * budget / w for n, (x, _) in left.items()}}
        for n in full:
            got[n] = left.pop(n)[1]
            budget -= got[n]
    return got


def test_budgets_follow_the_tree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mix = mixing.Mix(budget_permille=900, max_epochs=1)
    leaves = mixing.leaf_budgets(mixing.documents_with_tokens(docs), mix).toPandas()
    cap = leaves.groupby("domain").tokens.sum()
    total = int(leaves.tokens.sum()) * 900 // 1000
    want = water_fill(total, {d: (mix.domains.get(d, 10), c) for d, c in cap.items()})
    got = leaves.groupby("domain").budget.sum()
    assert got.sum() == total
    assert all(abs(got[d] - want[d]) <= 4 for d in want)
    assert (leaves.budget <= leaves.tokens).all()


def test_mixing_edge_cases(edge, empty):
    got = mixing.select_mix(edge, mixing.Mix(budget_permille=1000, max_epochs=1)).collect()
    named = {r[0] for r in ROWS if (r[1] or "").split()}
    assert {r.doc_id for r in got} == named                # a budget of all tokens selects all of them
    twice = mixing.select_mix(edge, mixing.Mix(budget_permille=2000, max_epochs=2)).collect()
    assert len(twice) == 2 * len(got)
    kept = mixing.keep_mix(edge, mixing.Mix(budget_permille=1000, max_epochs=1))
    assert kept.columns == edge.columns
    assert mixing.select_mix(empty).count() == 0


def test_a_mix_of_all_tokens_keeps_null_ids(edge):
    kept = mixing.keep_mix(edge, mixing.Mix(budget_permille=1000, max_epochs=1)).collect()
    assert sorted(r.doc_id or -1 for r in kept) == sorted(r[0] or -1 for r in ROWS if (r[1] or "").split())


# ---- sharding

def test_shards(spark, small):
    got = queries()["op10_kd_sharding"](spark, SMALL).toPandas().set_index("doc_id")
    assert len(got) == len(small) and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    for i, t in small.items():
        assert (got["size"][i], got.text_crc32[i]) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
    assert set(got.shard) == set(range(16))
    for _, s in got.groupby("shard").slot:
        assert sorted(s) == list(range(len(s)))
    load = got.groupby("shard")["size"].sum()
    assert load.max() - load.min() <= 2 * got["size"].max()


def plain_shards(rows, depth):
    """Recursive weighted medians over (doc_id, size, coordinates, tie) rows, one by one."""
    def split(part, level, node, out):
        if level == depth:
            out.update({r[0]: node for r in part})
            return
        if not part:
            return
        spans = [max(r[2][i] for r in part) - min(r[2][i] for r in part) for i in range(3)]
        dim = spans.index(max(spans))
        part = sorted(part, key=lambda r: (r[2][dim], r[3]))
        goal, run, keys = sum(r[1] for r in part) / 2, 0, {}
        for r in part:
            keys.setdefault((r[2][dim], r[3]), []).append(r)
        left = []
        for group in keys.values():
            b = sum(r[1] for r in group)
            if run + b >= goal:
                if run + b - goal <= goal - run:
                    left += group
                break
            run += b
            left += group
        ids = {id(r) for r in left}
        split(left, level + 1, 2 * node, out)
        split([r for r in part if id(r) not in ids], level + 1, 2 * node + 1, out)
    out = {}
    split(rows, 0, 0, out)
    return out


def test_shards_equal_recursive_medians(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ties = (sharding.DIGITS - 1) * sharding.BITS
    meta = sharding.metadata(docs).withColumn("tie", F.pmod(F.xxhash64("h", F.lit("tie")), F.lit(1 << ties))).collect()
    want = plain_shards([(r.doc_id, r["size"], (r.c_lang, r.c_source, r.c_size), r.tie) for r in meta], 4)
    got = {r.doc_id: r.shard for r in sharding.kd_shards(docs).collect()}
    assert got == want


def test_shards_equal_dimensions_and_edges(spark, edge, empty):
    rows = [(i, "x" * 99, "en", "s") for i in range(640)]
    load = sharding.kd_shards(documents(spark, rows)).groupBy("shard").count().toPandas()["count"]
    assert len(load) == 16 and load.max() - load.min() <= 8
    got = sharding.kd_shards(edge).toPandas()
    assert len(got) == len(ROWS) and (got["size"][got.doc_id == 6] == 1).all()
    assert sharding.kd_shards(empty).count() == 0
    few = sharding.kd_shards(documents(spark, rows), shards=None, target_bytes=20000).toPandas()
    assert few.shard.nunique() == 4
    with pytest.raises(ValueError):
        sharding.kd_shards(edge, shards=12)


# ---- the pipeline

def test_pipeline_against_brute_force(spark, tok):  # noqa: F811
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    plain = docs.toPandas()
    first = stages["quality_rules"](spark, docs, SMALL).toPandas()
    good = queries()["op9_quality_rules"](spark, SMALL).toPandas().set_index("doc_id").kept
    assert sorted(first.doc_id) == sorted(i for i in plain.doc_id if good[i])
    second = stages["exact_dedup"](spark, spark.createDataFrame(first), SMALL).toPandas()
    squeezed = first.assign(k=first.text.map(lambda t: "".join(t.split())), n=first.text.map(len))
    want = squeezed.sort_values(["n", "doc_id"], ascending=[False, True]).drop_duplicates("k")
    assert sorted(second.doc_id) == sorted(want.doc_id)
    third = stages["near_dedup"](spark, spark.createDataFrame(second), SMALL).toPandas()
    comp = brute_components(list(zip(second.doc_id, second.text)), 5)
    assert sorted(third.doc_id) == sorted(i for i, (_, c) in comp.items() if c == i)
    fourth = stages["mixing"](spark, spark.createDataFrame(third), SMALL).toPandas()
    assert list(fourth.columns) == list(plain.columns) and 0.8 * len(third) < len(fourth) < len(third)
    last = corpus_pipeline.run(spark, SMALL).toPandas()
    check_packing(last, list(zip(fourth.doc_id, fourth.text)), tok)
    assert np.isfinite(last.offset).all()
