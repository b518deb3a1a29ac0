"""Operator 2: near-duplicates by circulant MinHash, banding and exact Jaccard.

Words are the runs without white space of the text with A-Z in lower case; a
document's set is its distinct shingles of ``k`` words (all its words as one
shingle when there are fewer).  Two documents are linked when
``100 * |A & B| >= threshold * |A | B|``.

**Signature.**  Two permutations of the 2**32 hash values serve all
coordinates: sigma shuffles the shingle hashes once, pi is applied after a
circular shift by i, so coordinate i is ``min pi(sigma(x) + i mod 2**32)``.

**Candidates.**  ``BANDS`` bands of ``ROWS`` coordinates.  A pair at
similarity 0.8 shares no band with probability (1 - 0.8**ROWS)**BANDS =
5e-8.  One byte of each coordinate is kept as a sketch; a pair is dropped
when it agrees in fewer than ``AGREE`` of 128 bytes, which a pair at 0.8 does
with probability below 1e-9.  Neither test accepts a pair: all links are
confirmed on the full sets of 64-bit shingle hashes.

**No pairs within a group.**
1. Documents with the same set are one class; its smallest doc_id stands for
   it, so thousands of copies are one row from here on.
2. Stars: in each bucket (band, key) every member meets the bucket's leader, a
   different one in each band.  Verified links give components.
3. Rest: a bucket is settled once its members are in one component.  The
   members of the other buckets are compared in blocks of ``BLOCK`` (a bucket's
   blocks against each other, each pair of blocks a group of its own), first by
   sketch, which leaves the members with a possible partner in another
   component, then on their sets.  A group yields the links that join
   components, at most one less than its members, never its pairs.

So every candidate pair is verified or already in one component, no matter
how large the bucket.  Components are found by label propagation with
pointer jumping over the class representatives.

Edge cases: a null, empty or white text has an empty set and is linked with
nothing; repeated rows of one doc_id with the same text are one class; if a
doc_id has several texts, it is linked through each of them; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ByteCache, mark_listed, read_table, shared_table, slices, without_listed

BANDS = 32
ROWS = 4
COORDS = BANDS * ROWS
AGREE = 74
BLOCK = 512
WORD_BYTES = 32 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# ---- sets and signatures

class WordHashes:
    """Hashes of words, the frequent ones kept: one for each task, so that
    nothing of it is left when the task ends."""

    def __init__(self):
        self.known = ByteCache(WORD_BYTES)

    def _hash(self, w: bytes) -> int:
        if len(w) > 64:
            return xxhash.xxh3_64_intdigest(w)
        h = self.known.get(w, len(w))
        return self.known.put(w, xxhash.xxh3_64_intdigest(w), len(w)) if h is None else h

    def __call__(self, text: bytes) -> np.ndarray:
        known, miss = self.known, self._hash
        return np.array([miss(w) if (h := known.young.get(w)) is None else h
                         for w in text.translate(_LOWER).split()], np.uint64)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, k: int, word_hashes: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    w = (word_hashes or WordHashes())(text or b"")
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = _mix64(h + w[i:len(w) - n + 1 + i])
    return np.unique(h)


def _pi(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit values, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


_SHIFT = np.arange(COORDS, dtype=np.uint32)[:, None]


def signature(s: np.ndarray) -> np.ndarray:
    sigma = _pi((_mix64(s) >> np.uint64(32)).astype(np.uint32) * np.uint32(0x9E3779B1))
    out = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(sigma), 1024):
        out = np.minimum(out, _pi(sigma[at:at + 1024][None, :] + _SHIFT).min(axis=1))
    return out


def features(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n, fp (set fingerprint), sketch (128 bytes), bands (32 longs)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words = WordHashes()
        for batch in (part for whole in batches for part in slices(whole)):
            n, fp, sketch, bands = [], [], [], []
            for t in batch.column("text").to_pylist():
                s = shingle_set(t, k, words)
                n.append(len(s))
                fp.append(hashlib.md5(s.tobytes()).digest())
                if len(s):
                    sig = signature(s)
                    sketch.append((sig >> np.uint32(24)).astype(np.uint8).tobytes())
                    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
                    h = np.arange(BANDS, dtype=np.uint64)
                    for j in range(ROWS):
                        h = _mix64(h + rows[:, j])
                    bands.append(h.view(np.int64))
                else:
                    sketch.append(b"")
                    bands.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                 pa.array(sketch, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n", "fp", "sketch", "bands"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n long, fp binary, sketch binary, bands array<long>")


def linked(n_a: int, n_b: int, both: int, threshold: int) -> bool:
    return 100 * both >= threshold * (n_a + n_b - both)


# ---- connected components

def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(v, comp) for every vertex of ``edges`` (a, b): comp is the smallest
    vertex reachable.  Every round takes the smallest label among neighbours
    and then the label's own label, so rounds grow with the logarithm of the
    diameter in practice.  Tables are written in the shared folder."""
    both = shared_table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = shared_table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp"))
                          .withColumnRenamed("a", "v"), label)
    while True:
        near = (both.join(labels.withColumnRenamed("v", "b"), "b").groupBy("a")
                .agg(F.min("comp").alias("m")).withColumnRenamed("a", "v"))
        step = labels.join(near, "v").select("v", "comp", F.least("comp", "m").alias("new"))
        jump = labels.select(F.col("v").alias("new"), F.col("comp").alias("up"))
        moved = shared_table(step.join(jump, "new", "left").select(
            "v", F.least("new", F.coalesce("up", "new")).alias("comp"),
            (F.col("comp") != F.least("new", F.coalesce("up", "new"))).alias("changed")), label)
        labels = moved.select("v", "comp")
        if moved.where("changed").isEmpty():
            return labels


# ---- exact checks

def shingle_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc, shingles) of the listed documents, and of a few others."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    texts = mark_listed(rows, ["doc_id"], ids.select(F.col("doc").alias("doc_id")), "listed").where("listed").drop("listed")

    def run(batches):
        words = WordHashes()
        for batch in (part for whole in batches for part in slices(whole)):
            sets = [shingle_set(t, k, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())],
                                             names=["doc", "shingles"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc {id_type}, shingles binary")


def star_links(reps: DataFrame, members: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """Verified links (a, b) between bucket leaders and members."""
    pairs = (members.where("doc <> leader")
             .select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct())
    side = lambda x: reps.select(F.col("doc").alias(x), F.col("n").alias(f"n_{x}"),
                                 F.col("sketch").alias(f"s_{x}"))
    likely = (pairs.join(side("a"), "a").join(side("b"), "b")
              .where(f"100 * least(n_a, n_b) >= {threshold} * greatest(n_a, n_b)"))
    likely = shared_table(sketch_filter(likely), "pairs")
    ids = likely.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    sets = shared_table(shingle_sets(docs, ids, k), "sets")
    return shared_table(verify(likely, sets, threshold), "links")


def sketch_filter(pairs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.frombuffer(b"".join(batch.column("s_a").to_pylist()), np.uint8).reshape(-1, COORDS)
            b = np.frombuffer(b"".join(batch.column("s_b").to_pylist()), np.uint8).reshape(-1, COORDS)
            keep = pa.array((a == b).sum(axis=1) >= AGREE)
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(keep)

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.mapInArrow(run, f"a {kind}, b {kind}, n_a long, n_b long")


def verify(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    full = (pairs.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y")), "b"))

    def run(batches):
        for batch in batches:
            keep = [linked(len(x) // 8, len(y) // 8, len(np.intersect1d(
                np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)), threshold)
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return full.mapInArrow(run, f"a {kind}, b {kind}")


# ---- the buckets that stars leave open

def _groups(batches, key: list[str]):
    """Row groups of equal ``key`` from sorted batches, one pandas frame each."""
    rest = None
    for batch in batches:
        pdf = batch.to_pandas()
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if pdf.empty:
            continue
        keys = pdf[key].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        at = [0, *cuts.tolist()]
        for x, y in zip(at, at[1:]):
            yield pdf.iloc[x:y]
        rest = pdf.iloc[at[-1]:]
    if rest is not None and len(rest):
        yield rest


KEY = ["bucket", "b_i", "b_j"]


def _likely_pairs(g: pd.DataFrame, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row positions (x, y) and agreement of the group's pairs that are in two
    components, of fitting sizes and sketches, and meet here first."""
    none = np.empty(0, np.int64)
    if g.comp.nunique() < 2:
        return none, none, none
    comp, n, block = g.comp.to_numpy(), g.n.to_numpy(), g.block.to_numpy()
    sketch = np.frombuffer(b"".join(g.sketch), np.uint8).reshape(-1, COORDS)
    bands = np.stack(g.bands.to_list())
    b_i, b_j, band = int(g.b_i.iloc[0]), int(g.b_j.iloc[0]), int(g.band.iloc[0])
    found = []
    for x in range(len(g) - 1):
        ok = (comp[x + 1:] != comp[x]) & (100 * np.minimum(n[x + 1:], n[x]) >= threshold * np.maximum(n[x + 1:], n[x]))
        if b_i != b_j:
            ok &= block[x + 1:] != block[x]
        y = np.flatnonzero(ok) + x + 1
        if len(y):
            agree = (sketch[y] == sketch[x]).sum(axis=1)
            y, agree = y[agree >= AGREE], agree[agree >= AGREE]
            if len(y):
                first = (bands[y] == bands[x]).argmax(axis=1) == band
                found.append((np.full(first.sum(), x), y[first], agree[first]))
    if not found:
        return none, none, none
    return tuple(np.concatenate(f) for f in zip(*found))


def _flag(threshold: int):
    def run(batches):
        for g in _groups(batches, KEY):
            x, y, _ = _likely_pairs(g, threshold)
            if len(x):
                hit = g.iloc[np.union1d(x, y)]
                yield pa.RecordBatch.from_pandas(hit, preserve_index=False)
    return run


def _join_links(threshold: int, schema: pa.Schema):
    def run(batches):
        for g in _groups(batches, KEY):
            g = g.drop_duplicates(["doc", "shingles"], ignore_index=True)
            sets = [np.frombuffer(s, np.uint64) for s in g.shingles]
            all_hashes, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            shared = np.bincount(owner, weights=count[inverse] > 1, minlength=len(sets))
            # a document shares at most these shingles with any one member
            g = g[100 * shared >= threshold * g.n.to_numpy()]
            sets = [np.frombuffer(s, np.uint64) for s in g.shingles]
            x, y, agree = _likely_pairs(g, threshold)
            comp, doc, up = g.comp.tolist(), g.doc.tolist(), {}

            def root(v, up=up):
                while up.get(v, v) != v:
                    v = up[v]
                return v

            links = []
            for i in np.argsort(-agree, kind="stable"):
                p, q = int(x[i]), int(y[i])
                rp, rq = root(comp[p]), root(comp[q])
                if rp != rq and linked(len(sets[p]), len(sets[q]), len(np.intersect1d(
                        sets[p], sets[q], assume_unique=True)), threshold):
                    up[rp] = rq
                    links.append((doc[p], doc[q]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*links), schema.types)],
                                                 names=["a", "b"])
    return run


def bucket_members(reps: DataFrame) -> DataFrame:
    """(bucket, band, doc, leader) of the buckets with several documents."""
    buckets = reps.select("doc", F.posexplode("bands").alias("band", "bucket"))
    leaders = (buckets.groupBy("bucket").agg(F.min("doc").alias("leader"), F.count(F.lit(1)).alias("size"))
               .where("size > 1").select("bucket", "leader"))
    # 32 rows a document, which Spark counts as one when it sizes a table for a broadcast
    return buckets.join(leaders.hint("merge"), "bucket").select("bucket", "band", "doc", "leader")


def open_members(own: DataFrame) -> DataFrame:
    """(bucket, band, doc, comp, blocks) of the buckets with several components."""
    opened = (own.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        F.count(F.lit(1)).alias("size"))
              .where("lo <> hi").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    return own.join(opened.hint("merge"), "bucket")     # as above: the files are small, the rows many


def rest_links(reps: DataFrame, members: DataFrame, labels: DataFrame, docs: DataFrame, k: int,
               threshold: int) -> DataFrame:
    """Verified links that join components, from the buckets with several."""
    own = (members.select("bucket", "band", "doc").join(labels, members["doc"] == labels["v"], "left")
           .select("bucket", "band", "doc", F.coalesce("comp", "doc").alias("comp")))
    own = shared_table(own, "members")
    rows = (open_members(own).join(reps.select("doc", "n", "sketch", "bands"), "doc")
            .withColumn("block", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("b_i", F.least("block", "other")).withColumn("b_j", F.greatest("block", "other"))
            .select(*KEY, "band", "block", "doc", "comp", "n", "sketch", "bands"))
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = rows.schema
    flagged = shared_table(rows.repartition(n_parts, *KEY).sortWithinPartitions(*KEY)
                           .mapInArrow(_flag(threshold), schema), "flagged")
    sets = shared_table(shingle_sets(docs, flagged.select("doc").distinct(), k), "sets")
    kind = schema["doc"].dataType.simpleString()
    arrow = pa.schema([("a", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()),
                       ("b", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string())])
    full = flagged.join(sets, "doc").repartition(n_parts, *KEY).sortWithinPartitions(*KEY, "doc")
    return shared_table(full.mapInArrow(_join_links(threshold, arrow), f"a {kind}, b {kind}"), "links")


# ---- the operator

def near_groups(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, kept."""
    feats = shared_table(features(docs, k), "features")
    classes = feats.where("n > 0 and doc_id is not null").groupBy("fp").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.first("bands").alias("bands"))
    classes = shared_table(classes, "classes")
    reps = classes.select("doc", "n", "sketch", "bands")
    members = shared_table(bucket_members(reps), "buckets")
    stars = star_links(reps, members, docs, k, threshold)
    labels = components(stars)
    rest = rest_links(reps, members, labels, docs, k, threshold)
    labels = components(stars.unionByName(rest)) if not rest.isEmpty() else labels
    comp = classes.select("fp", "doc").join(labels, F.col("doc") == F.col("v"), "left").select(
        "fp", F.coalesce("comp", "doc").alias("component_id"))
    # a doc_id with several texts can stand for several classes: one row a class
    comp = shared_table(comp, "class_components")
    out = feats.select("doc_id", "n", "fp").join(comp, "fp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def keep_one(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, rows
    unchanged.  Rows of one doc_id stay or go together, and stay if any does;
    rows without doc_id stay."""
    groups = near_groups(docs, k, threshold).where("doc_id is not null")
    gone = groups.groupBy("doc_id").agg(F.max("kept").alias("stays")).where("not stays").select("doc_id")
    return without_listed(docs, "doc_id", shared_table(gone, "gone"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"), k=4, threshold=80)
