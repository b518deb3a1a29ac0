"""Operator 7: repeated runs of lines by distributed prefix doubling (native).

A text's lines (cut at ``\\n``) become line ids, and every line starts a suffix
of its document's id sequence.  Prefix doubling ranks the suffixes by their
first 1, 2, 4, ... ids: the rank of 2n ids is the rank of the pair (rank of n
ids here, rank of n ids n lines on).  A rank is the suffix's place in a
distributed sort of the distinct pairs (range partitions, numbered in order),
so ranks keep the suffixes' order, and equal ranks are an interval of the
suffix array with a longest common prefix of at least that length.  A length
between two powers of two is the pair of two ranks that overlap.

**Rule.**  A run of lines is deleted if it occurs earlier, by (doc_id, line),
and has at least ``min_run`` lines or more than ``min_words`` words.  Every such
run is a union of runs of exactly ``min_run`` lines, or is one of fewer lines with
enough words; both occur earlier wherever the whole run does.  So the intervals
of 1 to ``min_run`` lines decide every deletion, and doubling ends there: the
intervals of longer prefixes only say how far runs reach, and the runs deleted
in a document are joined to maximal ones whatever their length.

In each interval the first suffix by (doc_id, line) is the original; the lines
at every other one are later copies and are deleted.

Only lines that occur twice take part; a line that does not ends every run.
The lines' ids are 128-bit hashes of the whole line, made in the row.  The
first round joins on them: counting a line is pre-aggregated, and a line that a
third of the documents hold is a hot key of that one join, on narrow rows, which
Spark's skew handling splits; after it has been paired its neighbours tell
copies apart.

Edge cases: a null text has no line; an empty text has one empty line; empty
and blank lines are lines like others; rows with the same doc_id are told
apart by their text, and rows that repeat both are one document with one
result; a null doc_id comes first; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, mark_listed, read_table, shared_table, shuffle_partitions

MIN_RUN = 4
MIN_WORDS = 50


def line_table(docs: DataFrame) -> DataFrame:
    """(row, doc_id, pos, l1, l2, w): a row per line; ``row`` tells rows apart, w counts words."""
    lines = docs.select("row", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.select("row", "doc_id", "pos", F.xxhash64("line").alias("l1"),
                        F.xxhash64(F.lit("second"), "line").alias("l2"),
                        F.regexp_count("line", F.lit(WORD)).alias("w"))


def rank_pairs(suffixes: DataFrame, pair: list[str], rank: str) -> DataFrame:
    """Adds ``rank``: the place of the suffix's ``pair`` among the distinct
    pairs that occur twice, ascending in the order of the pairs; suffixes
    whose pair occurs once leave."""
    n = shuffle_partitions(suffixes.sparkSession)
    pairs = suffixes.groupBy(*pair).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    # the number of a row in sorted range partitions ascends with the pair
    ranked = shared_table(pairs.repartitionByRange(n, *pair).sortWithinPartitions(*pair)
                          .withColumn(rank, F.monotonically_increasing_id()), "ranks")
    return suffixes.join(ranked, pair).drop(*pair)


def repeated_starts(lines: DataFrame, min_run: int, min_words: int) -> DataFrame:
    """(row, doc_id, pos, length) of the later copies: runs of ``min_run`` lines, and
    shorter ones of more than ``min_words`` words."""
    if min_run < 1:
        raise ValueError("min_run must be at least 1")
    ranks = shared_table(rank_pairs(lines, ["l1", "l2"], "r"), "ranked")
    down = Window.partitionBy("row").orderBy("pos")
    # words of the runs of 1, 2, ... lines from here on; a repeated run has no gap in this table
    words = {f"s{n}": F.sum("w").over(down.rangeBetween(0, n - 1)) for n in range(1, min_run)}
    ranks = ranks.withColumns(words).drop("w")
    found, n = [], 1

    def paired(shift: int) -> DataFrame:
        pairs = ranks.withColumn("r2", F.first("r").over(down.rangeBetween(shift, shift))).where("r2 is not null")
        return pairs.withColumnRenamed("r", "r1")

    for length in range(1, min_run + 1):
        if length == 2 * n:
            ranks, n = shared_table(rank_pairs(paired(n), ["r1", "r2"], "r"), "ranked"), length
        table = ranks if length == n else paired(length - n)
        enough = table if length == min_run else table.where(F.col(f"s{length}") > min_words)
        pair = [F.col("r1"), F.col("r2")] if "r1" in enough.columns else [F.col("r"), F.lit(0).cast("long")]
        found.append(enough.select(F.lit(length).alias("length"), pair[0].alias("k1"), pair[1].alias("k2"), "row", "doc_id", "pos"))
    runs = found[0]
    for more in found[1:]:
        runs = runs.unionByName(more)
    runs = shared_table(runs, "runs")
    first = shared_table(runs.groupBy("length", "k1", "k2").agg(F.min(F.struct("doc_id", "row", "pos")).alias("first")), "first")
    later = (F.col("row") != F.col("first.row")) | (F.col("pos") != F.col("first.pos"))
    return runs.join(first, ["length", "k1", "k2"]).where(later).select("row", "doc_id", "pos", "length").distinct()


def repeated_runs(starts: DataFrame) -> DataFrame:
    """(row, doc_id, first, last): the maximal runs of lines to delete."""
    w = Window.partitionBy("row").orderBy("pos")
    ends = starts.groupBy("row", "doc_id", "pos").agg(F.max(F.col("pos") + F.col("length") - 1).alias("end"))
    marked = ends.withColumn("reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "new", F.coalesce((F.col("pos") > F.col("reach") + 1).cast("int"), F.lit(1)))
    runs = marked.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("row", "doc_id", "run").agg(F.min("pos").alias("first"), F.max("end").alias("last")).drop("run")


def remove_runs(docs: DataFrame, min_run: int = MIN_RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """A row per row: doc_id, n_lines, n_removed, n_runs, kept_text."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", "text", F.struct("doc_id", F.xxhash64("text").alias("copy")).alias("row"))
    lines = line_table(rows)
    runs = repeated_runs(repeated_starts(lines, min_run, min_words))
    cuts = shared_table(runs.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("runs")), "runs")
    # only rows with runs to delete move; all others pass straight through
    marked = mark_listed(rows, ["row"], cuts.select("row"), "has_runs")
    moved = marked.where("has_runs").select("row", "doc_id", "text").join(cuts, "row", "left")
    still = marked.where("not has_runs").select("row", "doc_id", "text", F.lit(None).cast(cuts.schema["runs"].dataType).alias("runs"))
    joined = still.unionByName(moved)
    pieces = F.split("text", "\n", -1)
    inside = lambda i: F.exists("runs", lambda r: (r["first"] <= i) & (i <= r["last"]))
    kept = F.when(F.col("runs").isNull(), pieces).otherwise(F.filter(pieces, lambda x, i: ~inside(i)))
    gone = F.coalesce(F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + (r["last"] - r["first"] + 1)), F.lit(0))
    return joined.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(pieces)).cast("long").alias("n_lines"),
                         gone.cast("long").alias("n_removed"),
                         F.when(F.col("runs").isNull(), 0).otherwise(F.size("runs")).cast("long").alias("n_runs"),
                         F.coalesce(F.array_join(kept, "\n"), F.lit("")).alias("kept_text"))


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_runs(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = rf"""
with l as (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos,
             unnest(string_split(text, chr(10))) as line from documents where text is not null),
win as (select doc_id, pos, m, list(line) over (partition by doc_id, m order by pos
          rows between current row and 3 following)[1:m] as run from l, (values (1), (2), (3), (4)) as t(m)),
dup as (select doc_id, pos, m from (select doc_id, pos, m, run, row_number() over (partition by run order by doc_id, pos) as k
          from win where len(run) = m) where k > 1
          and (m >= {MIN_RUN} or len(regexp_extract_all(array_to_string(run, ' '), '{WORD}')) > {MIN_WORDS})),
gone as (select distinct doc_id, unnest(range(pos, pos + m)) as pos from dup),
m as (select l.*, g.pos is not null as cut from l left join gone g using (doc_id, pos)),
e as (select *, cut and not coalesce(lag(cut) over (partition by doc_id order by pos), false) as head from m)
select d.doc_id, count(e.pos) as n_lines, count(*) filter (cut) as n_removed, count(*) filter (head) as n_runs,
  sha256(coalesce(string_agg(line, chr(10) order by e.pos) filter (not cut), '')) as kept_sha256
from documents d left join e using (doc_id) group by d.doc_id
"""
