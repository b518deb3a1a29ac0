"""Operator 8: language identification with bit-sliced n-gram Bloom filters.

**Filter.**  One table of ``SLOTS`` language bitmasks is the Bloom filters of
all languages side by side: slot s of language l is bit l of mask s.  Adding
an n-gram sets its language's bit in ``HASHES`` slots; the AND of an n-gram's
slots returns, in one look, every language that (probably) has it.

**Learning.**  From at most about ``SAMPLE_DOCS`` documents of each language
(a documented bound; the sample is drawn by a hash of doc_id, spread over all
rows), counts of byte n-grams (2 to 4, words with their edges) are summed in
Spark; an n-gram belongs to a language if it makes up ``SHARE`` of its n-grams
of that length or more, so at most 3 / SHARE n-grams a language.  The table
has SLOTS entries whatever the corpus: that is all the driver gets and sends.

**Decision.**  The popcount of bit l over a text's n-grams is the number that
language l seems to know.  A filter with a share f of its bits set claims an
n-gram that it lacks with probability f**HASHES, so the count is corrected:
(hits - n * fp) / (1 - fp).  The largest corrected count wins, ties go to the
language with more learned documents; ``score`` is its share of the two largest.

Edge cases: null texts and texts without any letter are ``und`` with score 0;
so is every text if nothing could be learned; a text whose n-grams no language
knows gets the most frequent language with score 0; rows with a null doc_id
or lang are predicted but never learned from; whole texts are read; repeated
rows are predicted each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

SIZES = (2, 3, 4)
HASHES = 2
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
SHARE = 2e-5
SAMPLE_DOCS = 4000
HELD_OUT = 2

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def grams(text: str) -> list[np.ndarray]:
    """Per size the text's n-grams, each as an integer of its bytes."""
    words = b" ".join(text.lower().encode("utf-8", "replace").translate(_TABLE).split())
    b = np.frombuffer(b" " + words + b" ", np.uint8).astype(np.uint64)
    out = []
    for n in SIZES:
        g = np.full(max(0, len(b) - n + 1), n, np.uint64)
        for i in range(n):
            g = (g << np.uint64(8)) | b[i:len(b) - n + 1 + i]
        out.append(g)
    return out


def slots(g: np.ndarray) -> list[np.ndarray]:
    out = []
    for odd in _ODD[:HASHES]:
        h = g * odd
        out.append(((h ^ (h >> np.uint64(29))) * odd >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return out


def fold(n: int = 4) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """(languages, most frequent first; masks of shape (planes, SLOTS))."""
    known = docs.where("lang is not null and doc_id is not null").select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = known.groupBy("lang").count().collect()          # a row a language
    langs = [r["lang"] for r in sorted(sizes, key=lambda r: (-r["count"], r["lang"]))]
    if not langs:
        return [], np.zeros((1, SLOTS), np.uint64)
    number = {lang: i for i, lang in enumerate(langs)}
    part = F.lit(0)
    for r in sizes:
        part = F.when(F.col("lang") == r["lang"],
                      F.lit(min(1 << 20, -(-(sample_docs << 20) // r["count"])))).otherwise(part)
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < part)

    def count(batches):
        for batch in batches:
            total: dict[str, list[list[np.ndarray]]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if text and has_letter(text):
                    per = total.setdefault(lang, [[] for _ in SIZES])
                    for k, g in enumerate(grams(text)):
                        per[k].append(g)
            for lang, per in total.items():
                for n, parts in zip(SIZES, per):
                    g, c = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number[lang]] * len(g), pa.int32()), pa.array([n] * len(g), pa.int32()),
                         pa.array(g.view(np.int64)), pa.array(c.astype(np.int64))], names=["l", "n", "gram", "c"])

    counts = (sample.select("lang", "text").mapInArrow(count, "l int, n int, gram long, c long")
              .groupBy("l", "n", "gram").agg(F.sum("c").alias("c")))
    sums = counts.groupBy("l", "n").agg(F.sum("c").alias("total"))
    kept = counts.join(F.broadcast(sums), ["l", "n"]).where(F.col("c") >= F.col("total") * SHARE)   # languages x 3 rows

    def place(batches):
        for batch in batches:
            g = batch.column("gram").to_numpy().view(np.uint64)
            lang = batch.column("l").to_numpy()
            for s in slots(g):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang // 64, pa.int32()), pa.array(s, pa.int64()),
                     pa.array(np.left_shift(np.uint64(1), (lang % 64).astype(np.uint64)).view(np.int64))],
                    names=["plane", "slot", "bit"])

    masks = (kept.select("l", "gram").mapInArrow(place, "plane int, slot long, bit long")
             .groupBy("plane", "slot").agg(F.bit_or("bit").alias("mask")))
    table = np.zeros((-(-len(langs) // 64), SLOTS), np.uint64)
    got = masks.toPandas()                                   # at most SLOTS rows a plane of 64 languages
    table[got["plane"].to_numpy(int), got["slot"].to_numpy(int)] = got["mask"].to_numpy("int64").view(np.uint64)
    return langs, table


class Identifier:
    def __init__(self, langs: list[str], masks: np.ndarray):
        self.langs = langs
        # a plane of up to 8 languages fits bytes, which fit the processor's cache
        self.masks = masks.astype(np.uint8) if len(langs) <= 8 else masks
        bits = [(self.masks[i // 64] >> self.masks.dtype.type(i % 64)) & self.masks.dtype.type(1)
                for i in range(len(langs))]
        self.false = np.array([b.mean() ** HASHES for b in bits])

    def corrected(self, text: str) -> np.ndarray:
        g = np.concatenate(grams(text))
        at = slots(g)
        hits = np.zeros(len(self.langs))
        for p, plane in enumerate(self.masks):
            m = plane[at[0]]
            for s in at[1:]:
                m = m & plane[s]
            if m.dtype == np.uint8:
                n = np.bincount(m, minlength=256)
                values = np.arange(256)
                for i in range(len(self.langs)):
                    hits[i] = n[(values >> i) & 1 == 1].sum()
            else:
                for i in range(64 * p, min(64 * p + 64, len(self.langs))):
                    hits[i] = ((m >> np.uint64(i % 64)) & np.uint64(1)).sum()
        return np.maximum(0.0, (hits - len(g) * self.false) / np.maximum(1e-9, 1.0 - self.false))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return "und", 0.0
        c = self.corrected(text)
        best = int(c.argmax())
        if c[best] <= 0:
            return self.langs[0], 0.0
        second = float(np.partition(c, -2)[-2]) if len(c) > 1 else 0.0
        return self.langs[best], float(c[best] / (c[best] + second))


def identify(docs: DataFrame, train: DataFrame, held_out: Column, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    langs, masks = learn(train, sample_docs)
    shared = docs.sparkSession.sparkContext.broadcast((langs, masks))   # SLOTS masks
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = Identifier(*shared.value)
        for batch in batches:
            got = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, docs.where(fold() != HELD_OUT), fold() == HELD_OUT)
