"""Operator 4: exact deduplication by two-pass Bloom filtering (native).

Texts are equal when identical after deleting white space (0x20, 0x09-0x0D).

* Digest: one read of the texts leaves (doc_id, sha-256 of the normalised
  text, code points, 64-bit hash, row number) in the shared folder.
* Pass 1, filter: every hash sets ``HASHES`` slots of a counting Bloom
  filter; slots hit by two rows or more are packed into 64-bit words.
* Pass 2: a row can only be repeated if all its slots are hit twice.  Those
  rows alone shuffle, grouped by the full sha-256 (so a filter collision
  costs a shuffle and never a wrong answer); all others pass straight through.

The filter has ``SLOTS_PER_ROW`` slots a row, at most ``MAX_SLOTS``: the
broadcast never holds more than MAX_SLOTS / 64 words (2**20 rows of 16
bytes), whatever the input.  Beyond about MAX_SLOTS / 4 rows the filter fills
and more unrepeated rows shuffle; results stay exact.

Groups of copies are pre-aggregated before their shuffle, and the join back
on the digest can be split by Spark's skew handling.

Edge cases: a null text counts as empty; all empty and all-white texts are
equal to each other.  Ties in length go to the smallest doc_id.  If a doc_id
is listed more than once inside a group, ``group_size`` counts each row and
exactly one row (the longest text first) is kept.  A null doc_id sorts after
every other.  An empty table gives no rows; extra columns are ignored by
:func:`exact_groups` and kept by :func:`deduplicate`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, mark_listed, read_table, shared_table, text_or_empty

HASHES = 3
SLOTS_PER_ROW = 16
MAX_SLOTS = 1 << 26


def digests(docs: DataFrame) -> DataFrame:
    squeezed = docs.select("doc_id", text_or_empty().alias("t")).select(
        "doc_id", F.char_length("t").alias("n_points"), F.regexp_replace("t", SPACE, "").alias("s"))
    return squeezed.select("doc_id", "n_points", F.sha2("s", 256).alias("text_sha256"),
                           F.xxhash64("s").alias("h"), F.monotonically_increasing_id().alias("row"))


def slot_count(rows: int) -> int:
    wanted = max(1 << 12, rows * SLOTS_PER_ROW)
    return min(MAX_SLOTS, 1 << (wanted - 1).bit_length())


def _slots(m: int):
    return [F.pmod(F.xxhash64("h", F.lit(j)), F.lit(m)) for j in range(HASHES)]


def repeated_filter(dig: DataFrame, m: int) -> DataFrame:
    """(word, bits): the slots that at least two rows have hit."""
    hits = dig.select(F.explode(F.array_distinct(F.array(*_slots(m)))).alias("slot"))
    twice = hits.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (twice.select(F.expr("slot div 64").alias("word"),
                         F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"))
            .groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")))


def mark_possible(dig: DataFrame, bloom: DataFrame, m: int) -> DataFrame:
    """Adds ``possible``: all slots of the row are set in the filter."""
    bloom = F.broadcast(bloom)   # at most MAX_SLOTS / 64 rows
    out = dig.withColumns({f"_s{j}": s for j, s in enumerate(_slots(m))})
    seen = F.lit(True)
    for j in range(HASHES):
        words = bloom.select(F.col("word").alias(f"_w{j}"), F.col("bits").alias(f"_b{j}"))
        out = out.join(words, F.expr(f"_s{j} div 64") == F.col(f"_w{j}"), "left")
        seen = seen & F.expr(f"coalesce(shiftright(_b{j}, cast(_s{j} % 64 as int)) & 1L, 0L) = 1L")
    return out.select(*dig.columns, seen.alias("possible"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    dig = shared_table(digests(docs), "digest")
    m = slot_count(dig.count())
    bloom = shared_table(repeated_filter(dig, m), "bloom")
    marked = mark_possible(dig, bloom, m)

    single = marked.where(~F.col("possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")

    maybe = marked.where("possible").select("doc_id", "n_points", "text_sha256", "row")
    best = F.min(F.struct((-F.col("n_points")).alias("neg"), F.col("doc_id").isNull().alias("no_id"),
                          F.col("doc_id").alias("id"), "row")).alias("best")
    # written, so that the join below has plain exchanges, which skew handling can split
    groups = shared_table(maybe.groupBy("text_sha256")
                          .agg(best, F.count(F.lit(1)).cast("long").alias("group_size")), "groups")
    grouped = (maybe.join(groups, "text_sha256")
               .select("doc_id", F.col("best.id").alias("keep_id"), "group_size",
                       (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"))
    return single.unionByName(grouped)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not kept, all columns unchanged.

    Only rows whose doc_id has a row that goes, and few others, are digested
    again and joined; all others pass straight through.  Of a doc_id that lists
    one text more than once, the longest row stays."""
    repeated = exact_groups(docs).where("group_size > 1")
    flags = (repeated.groupBy("doc_id", "text_sha256")
             .agg(F.max("kept").alias("_x_stays"), F.count(F.lit(1)).alias("_x_n"))
             .where("not _x_stays or _x_n > 1"))
    flags = shared_table(flags, "flags").withColumnsRenamed({"doc_id": "_x_id", "text_sha256": "_x_digest"})
    marked = mark_listed(docs, ["doc_id"], flags.select(F.col("_x_id").alias("doc_id")), "_x_listed")
    key = F.sha2(F.regexp_replace(text_or_empty(), SPACE, ""), 256)
    joined = marked.where("_x_listed").withColumn("_x_sha", key).join(
        flags, F.col("doc_id").eqNullSafe(F.col("_x_id")) & (F.col("_x_sha") == F.col("_x_digest")), "left")
    plain = marked.where("not _x_listed").select(*docs.columns).unionByName(
        joined.where("_x_stays is null").select(*docs.columns))
    first = Window.partitionBy("doc_id", "_x_sha").orderBy(F.desc(F.char_length(text_or_empty())), "text")
    listed = (joined.where("_x_stays").withColumn("_x_k", F.row_number().over(first))
              .where("_x_k = 1").select(*docs.columns))
    return plain.unionByName(listed)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
