"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The white space of the word rules (space and 0x09-0x0D).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` without computing the rows twice;
    the files lie where every executor sees them, so a lost executor loses
    nothing.  The folder's owner removes them (``spark.checkpoint.dir``)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


OFFSETS = 1 << 20


def hash_rank(df: DataFrame, group: str, order: list[Column], out: str, groups: int, buckets: int = 4096) -> DataFrame:
    """Gapless rank from 0 within ``group`` without a task per group.

    Level one counts rows per (group, hash bucket), at most ``buckets`` rows a
    group, and turns counts into offsets; level two numbers rows inside a
    bucket.  ``order[0]`` must be a long hash; it also names the bucket.  The
    offsets are broadcast if ``groups`` times ``buckets`` is at most OFFSETS."""
    df = df.withColumn("_hr_key", order[0]).withColumn("_hr_b", F.pmod("_hr_key", F.lit(buckets)))
    counts = df.groupBy(group, "_hr_b").agg(F.count(F.lit(1)).alias("_hr_n"))
    before = F.expr(f"coalesce(sum(_hr_n) over (partition by {group} order by _hr_b "
                    "rows between unbounded preceding and 1 preceding), 0)")
    offsets = counts.withColumn("_hr_off", before).drop("_hr_n")
    inside = Window.partitionBy(group, "_hr_b").orderBy("_hr_key", *order[1:])
    ranked = df.withColumn("_hr_rn", F.row_number().over(inside))
    return (ranked.join(F.broadcast(offsets) if groups * buckets <= OFFSETS else offsets, [group, "_hr_b"])
            .withColumn(out, (F.col("_hr_off") + F.col("_hr_rn") - 1).cast("long"))
            .drop("_hr_key", "_hr_b", "_hr_off", "_hr_rn"))


MAX_SLOTS = 1 << 26
TEXTS_AT_ONCE = 512


def slices(batch, rows: int = TEXTS_AT_ONCE):
    """An Arrow batch in parts of at most ``rows`` rows, so that few texts are
    Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


class ByteCache:
    """A dictionary of at most ``limit`` bytes in two generations: when the
    young one holds half of that, it becomes the old one and the one before it
    goes; an old entry that is asked for is young again."""

    ENTRY = 150     # bytes of a dictionary slot and of two small objects' heads, about

    def __init__(self, limit: int):
        self.limit, self.young, self.old, self.size = limit, {}, {}, 0

    def put(self, key, value, size: int):
        self.size += size + self.ENTRY
        if self.size > self.limit // 2:
            self.young, self.old, self.size = {}, self.young, size + self.ENTRY
        self.young[key] = value
        return value

    def get(self, key, size: int):
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got, size)
        return got


def mark_listed(rows: DataFrame, key: list[str], listed: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: true for all rows whose key ``listed`` has, and for a few
    others.  Nothing moves: a bit table of the listed keys' hashes is broadcast,
    at most MAX_SLOTS / 64 words of it however long the list."""
    n = listed.count()
    m = min(MAX_SLOTS, 1 << max(12, (16 * n).bit_length()))
    slot = F.pmod(F.xxhash64(*key, F.lit("listed")), F.lit(m))
    bits = (listed.select(slot.alias("s"))
            .select(F.expr("s div 64").alias("_x_word"), F.expr("shiftleft(1L, cast(s % 64 as int))").alias("bit"))
            .groupBy("_x_word").agg(F.bit_or("bit").alias("_x_bits")))
    marked = rows.withColumn("_x_slot", slot).join(
        F.broadcast(bits), F.expr("_x_slot div 64") == F.col("_x_word"), "left")
    hit = F.expr("coalesce(shiftright(_x_bits, cast(_x_slot % 64 as int)) & 1L, 0L) = 1L")
    return marked.select(*rows.columns, hit.alias(out))


def without_listed(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``rows`` without those whose ``key`` the column ``key`` of ``gone`` has
    (null equals null); only listed rows move, and few others."""
    marked = mark_listed(rows, [key], gone.select(key), "_x_listed")
    listed = marked.where("_x_listed").select(*rows.columns)
    ids = gone.select(F.col(key).alias("_x_id"))
    return marked.where("not _x_listed").select(*rows.columns).unionByName(
        listed.join(ids, listed[key].eqNullSafe(F.col("_x_id")), "left_anti"))
