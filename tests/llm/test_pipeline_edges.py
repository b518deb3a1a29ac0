"""The pipeline's stages on odd rows and on no rows; the helpers they share."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from wafercast.llm import common as C
from wafercast.llm import mixing

from .conftest import FAR, NEAR, SMALL, documents

WORDS = [f"plain{i}" for i in range(400)]
TEXT = " ".join(WORDS[:120])


@pytest.fixture(scope="module")
def odd(spark, edge):
    """Rows that pass the quality rules beside those that do not, with clashing columns."""
    rows = [(200, TEXT, "en", "a"), (200, TEXT, "en", "a"), (201, TEXT.replace(" ", "  "), "en", "a"), (202, TEXT + " more", "en", None),
            (None, " ".join(WORDS[130:240]), None, None), (None, " ".join(WORDS[250:360]), None, None), (203, NEAR, "en", "b"), (204, FAR, "de", "b")]
    return edge.unionByName(documents(spark, rows))


def test_stages_keep_columns_and_odd_rows(spark, odd):
    docs, counts = odd, {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == odd.columns
        docs = C.shared_table(out, "edge-stage")
        counts[name] = docs.count()
    left = docs.collect()
    ids = [r.doc_id for r in left]
    # of the equal texts the longest stays, and no near copy beside it
    assert counts["quality_rules"] < odd.count() and [i for i in ids if i in (200, 201, 202)] == [201]
    assert all(r.kept == "clash" and r.node == "clash" for r in left)
    packed = P.pack(spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == set(ids)


def test_exact_and_near_stages(spark, odd):
    exact = P.exact(spark, odd, SMALL).collect()
    same = [r for r in exact if r.text and "".join(r.text.split()) == "".join(TEXT.split())]
    assert [r.doc_id for r in same] == [201]            # the longest original text
    assert sum(not (r.text or "").split() for r in exact) == 1
    assert sum(r.doc_id is None for r in exact) == 3
    near = P.near(spark, odd, SMALL).collect()
    ids = [r.doc_id for r in near]
    # copies under one id stay together, near copies under later ids go
    assert ids.count(200) == 2 and 201 not in ids and 202 not in ids and ids.count(None) == 3


def test_stages_without_rows(spark, empty):
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, empty, SMALL)
        assert out.columns == empty.columns and out.count() == 0
    assert P.pack(spark, empty, SMALL).count() == 0


def test_run_on_an_empty_table(spark, empty, tmp_path):
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_without_listed(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, f"t{i}") for i in range(300)], "doc_id long, text string")
    gone = spark.createDataFrame([(i,) for i in range(0, 300, 3)] + [(None,)], "doc_id long")
    left = C.without_listed(rows, "doc_id", gone)
    assert left.columns == rows.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(300) if i % 7 and i % 3]
    assert C.without_listed(rows, "doc_id", gone.limit(0)).count() == 300


def test_mixing_keeps_the_selected_rows(spark, odd):
    mix = mixing.Mix(budget_permille=600, max_epochs=1)
    chosen = {r.doc_id for r in mixing.select_mix(odd, mix).select("doc_id").distinct().collect()}
    kept = mixing.keep_mix(odd, mix).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r.doc_id) for r in odd.collect() if r.doc_id in chosen)


def test_byte_cache_is_bounded():
    rng, cache = random.Random(1), C.ByteCache(100_000)
    for _ in range(20_000):
        k = rng.randint(0, 3000)
        got = cache.get(k, 10)
        assert got in (None, -k)
        if got is None:
            cache.put(k, -k, 10)
    assert (len(cache.young) + len(cache.old)) * (10 + cache.ENTRY) <= 100_000 + 200
    assert len(cache.old) > 100


def test_slices_cover_a_batch():
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(1100))], names=["x"])
    parts = list(C.slices(batch))
    assert [p.num_rows for p in parts] == [512, 512, 76] and parts[2].column("x")[75].as_py() == 1099


def test_listed_rows_alone_are_marked(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"))
    marked = C.mark_listed(rows, ["doc_id"], rows.where("doc_id < 20"), "hit")
    hits = {r.doc_id for r in marked.where("hit").collect()}
    assert set(range(20)) <= hits and len(hits) < 300
