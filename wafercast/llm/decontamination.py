"""Operator 13: benchmark decontamination with a broadcast hash set (native).

Words are the maximal runs of digits, letters and everything above ASCII of the
text with A-Z in lower case.  A benchmark item's windows are its runs of
``window`` consecutive words; an item of fewer words, but not none, is one
window as it is.

* Hash set: the distinct windows' hashes set ``PROBES`` slots each of a bit
  table of ``SLOTS_PER_WINDOW`` slots a window, at most ``MAX_SLOTS`` slots
  (16 MB).  The table reaches the tasks as the value of a scalar subquery, so
  it is one shared array of words and nothing is joined to find candidates.
* Scan: every text is read once.  Its words are hashed, each run of as many
  words as some benchmark window has is hashed from those, and looked up in
  the table inside the row.  Only the runs that are found leave the row, as
  text; all others never become rows.
* Verification: found runs are joined with the windows on their whole text.
  The windows are broadcast when they are few enough (``BROADCAST_WINDOWS``
  and ``BROADCAST_BYTES``, both counted first); beyond that the join is a
  shuffle whose keys are salted, so a passage that a third of the documents
  hold is no hot key.
* Spans: the verified runs of a document are joined to maximal hit spans of
  words by a window over its own runs.

:func:`decontaminate` removes the spans or the whole documents; only documents
with candidates move.

Beyond ``MAX_SLOTS / SLOTS_PER_WINDOW`` windows the table fills and more runs go
to verification; results stay exact.

Edge cases: null, empty and wordless texts have no words and no hits; a null
item_id counts as the item ``''``, and rows that repeat an item_id are one item
with several texts; rows that repeat a doc_id each get their own result; an
empty table of documents gives no rows, an empty benchmark no hits; extra
columns are ignored by :func:`scan` and kept by :func:`decontaminate`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mark_listed, read_table, shared_table, text_or_empty

WINDOW = 10
SLOTS_PER_WINDOW = 64
PROBES = 4
MAX_SLOTS = 1 << 27
BROADCAST_WINDOWS = 200_000
BROADCAST_BYTES = 32 << 20
SALTS = 16

#: What a word consists of, in lower-cased and in original texts.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ``lower`` does just that to ASCII texts."""
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


# ---- the benchmark's side

@dataclass
class Benchmark:
    windows: DataFrame      # wid, k, gram: a row per distinct window
    items: DataFrame        # wid, item
    bits: DataFrame         # one row: bits array<long>
    slots: int
    lengths: list[int]      # the window lengths that occur, at most WINDOW of them
    small: bool             # few enough to broadcast


def _run(words: str, at: str, k: str) -> str:
    return f"slice({words}, {at} + 1, {k})"


def _slot(run: str, probe: int, slots: int) -> str:
    return f"(xxhash64({run}, {probe}) & {slots - 1}L)"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> Benchmark:
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             word_list(text_or_empty()).alias("ws")).where(F.size("ws") > 0)
    runs = words.select("item", F.expr(
        f"transform(array(named_struct('ws', ws, 'k', least(size(ws), {window}))), t -> "
        f"transform(sequence(0, size(t.ws) - t.k), i -> named_struct('k', t.k, "
        f"'gram', array_join({_run('t.ws', 'i', 't.k')}, ' '))))[0]").alias("runs"))
    grams = runs.select("item", F.inline("runs")).distinct()
    windows = shared_table(grams.select("k", "gram").distinct()
                           .withColumn("wid", F.monotonically_increasing_id()), "bench_windows")
    items = shared_table(grams.join(windows, ["k", "gram"]).select("wid", "item"), "bench_items")
    n, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("gram")), F.lit(0))).first()
    slots = min(MAX_SLOTS, 1 << max(12, (SLOTS_PER_WINDOW * n - 1).bit_length() if n else 0))
    lengths = sorted(r["k"] for r in windows.select("k").distinct().collect())    # at most ``window`` numbers

    hashed = windows.select(F.expr("transform(split(gram, ' '), w -> xxhash64(w))").alias("h"))
    hits = hashed.select(F.explode(F.array(*[F.expr(_slot("h", p, slots)) for p in range(PROBES)])).alias("s"))
    words64 = (hits.select(F.expr("s div 64").alias("word"), F.expr("shiftleft(1L, cast(s % 64 as int))").alias("bit"))
               .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    # dense, at most MAX_SLOTS / 64 entries
    dense = windows.sparkSession.range(slots // 64).join(words64, F.col("id") == F.col("word"), "left").agg(
        F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).cast("long").alias("bits")))).alias("all"))
    bits = shared_table(dense.select(F.expr("transform(all, x -> x.bits)").alias("bits")), "bench_bits")
    return Benchmark(windows, items, bits, slots, lengths, n <= BROADCAST_WINDOWS and size <= BROADCAST_BYTES)


# ---- the documents' side

def _candidates(lengths: list[int], slots: int) -> str:
    """Array of the (pos, k, gram) of one row ``t`` whose run of words the table may hold."""
    def found(k: int, probe: int) -> str:
        return (f"exists(array({_slot(_run('t.h', 'i', str(k)), probe, slots)}), s -> "
                "getbit(get(t.bits, cast(s div 64 as int)), cast(s % 64 as int)) = 1)")

    parts = []
    for k in lengths:
        test = " and ".join(found(k, p) for p in range(PROBES))
        parts.append(f"transform(filter(if(size(t.h) >= {k}, sequence(0, size(t.h) - {k}), array()), i -> {test}), "
                     f"i -> named_struct('pos', i, 'k', {k}, 'gram', array_join({_run('t.ws', 'i', str(k))}, ' ')))")
    return f"concat({', '.join(parts)})" if parts else "cast(array() as array<struct<pos: int, k: int, gram: string>>)"


def scan(docs: DataFrame, bench: Benchmark) -> DataFrame:
    """(row, doc_id, copy, n_words, found) of every row, written; ``copy`` is a hash
    of the text, by which rows of one doc_id are told apart later."""
    base = docs.select("doc_id", text_or_empty().alias("text"))
    words = base.select("doc_id", F.xxhash64("text").alias("copy"), word_list(F.col("text")).alias("ws"),
                        bench.bits.scalar().alias("bits"))
    # words and hashes are bound to lambda variables, so they are made once a row
    row = (f"transform(transform(array(named_struct('ws', ws, 'bits', bits)), "
           "r -> named_struct('ws', r.ws, 'bits', r.bits, 'h', transform(r.ws, w -> xxhash64(w)))), "
           f"t -> named_struct('n', cast(size(t.ws) as long), 'found', {_candidates(bench.lengths, bench.slots)}))")
    one = words.select("doc_id", "copy", F.inline(F.expr(row)))
    return shared_table(one.select(F.monotonically_increasing_id().alias("row"), "doc_id", "copy",
                                   F.col("n").alias("n_words"), "found"), "scan")


def verified(scanned: DataFrame, bench: Benchmark) -> DataFrame:
    """(row, pos, k, wid): the candidates whose text is a benchmark window."""
    runs = scanned.where(F.size("found") > 0).select("row", F.inline("found"))
    if bench.small:
        hits = runs.join(F.broadcast(bench.windows), ["k", "gram"])
    else:
        salted = bench.windows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = runs.withColumn("salt", F.pmod(F.xxhash64("row", "pos"), F.lit(SALTS)).cast("int")).join(
            salted, ["k", "gram", "salt"])
    return shared_table(hits.select("row", "pos", "k", "wid"), "hits")


def hit_spans(hits: DataFrame) -> DataFrame:
    """(row, n_hit, spans): maximal runs of hit words, ``spans`` sorted (first, last)."""
    w = Window.partitionBy("row").orderBy("pos")
    ends = hits.groupBy("row", "pos").agg(F.max(F.col("pos") + F.col("k") - 1).alias("end"))
    marked = ends.withColumn("reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "new", F.coalesce((F.col("pos") > F.col("reach") + 1).cast("int"), F.lit(1)))
    runs = (marked.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "run").agg(F.min("pos").alias("first"), F.max("end").alias("last")))
    return runs.groupBy("row").agg(F.sum(F.col("last") - F.col("first") + 1).cast("long").alias("n_hit"),
                                   F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


def hit_items(hits: DataFrame, bench: Benchmark) -> DataFrame:
    """(row, items): the sorted ids of the items that a row has windows of."""
    items = F.broadcast(bench.items) if bench.small else bench.items
    pairs = hits.select("row", "wid").distinct().join(items, "wid").select("row", "item").distinct()
    return pairs.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per row: doc_id, copy, n_words, n_hit, spans, items; ``spans`` counts
    words from 0 and is empty, like ``items``, where nothing is hit."""
    bench = benchmark_windows(benchmark, window)
    scanned = scan(docs, bench)
    hits = verified(scanned, bench)
    out = ["doc_id", "copy", "n_words", "n_hit", "spans", "items"]
    no_spans = F.expr("cast(array() as array<struct<first: int, last: int>>)")
    no_items = F.expr("cast(array() as array<string>)")
    clean = scanned.where(F.size("found") == 0).select(
        "doc_id", "copy", "n_words", F.lit(0).cast("long").alias("n_hit"), no_spans.alias("spans"), no_items.alias("items"))
    rest = (scanned.where(F.size("found") > 0).select("row", "doc_id", "copy", "n_words")
            .join(hit_spans(hits), "row", "left").join(hit_items(hits, bench), "row", "left")
            .withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
                          "spans": F.coalesce("spans", no_spans), "items": F.coalesce("items", no_items)}))
    return clean.unionByName(rest.select(*out))


def cut_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans``; a word goes with what stands before it."""
    cell = F.struct(F.regexp_extract_all(text, F.lit(CASED_WORD), F.lit(0)).alias("w"),
                    F.split(text, CASED_WORD, -1).alias("s"), spans.alias("x"))

    def rebuilt(t):
        kept = F.transform(t["w"], lambda w, i: F.when(
            F.exists(t["x"], lambda x: (x["first"] <= i) & (i <= x["last"])), F.lit("")).otherwise(F.concat(F.get(t["s"], i), w)))
        return F.concat(F.array_join(kept, ""), F.get(t["s"], F.size(t["w"])))

    return F.get(F.transform(F.array(cell), rebuilt), 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, spans: bool = False) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, or, with
    ``spans``, with the hit words cut out of their texts.  All other rows and
    columns are unchanged and pass straight through."""
    hit = shared_table(contamination(docs, benchmark, window).where("n_hit > 0")
                       .select("doc_id", "copy", "spans").dropDuplicates(["doc_id", "copy"]), "contaminated")
    copy = F.xxhash64(text_or_empty())
    keyed = docs.withColumn("_x_copy", copy).withColumn("_x_id", F.col("doc_id"))
    hit = hit.select(F.col("doc_id").alias("_x_id"), F.col("copy").alias("_x_copy"), F.col("spans").alias("_x_spans"))
    marked = mark_listed(keyed, ["_x_id", "_x_copy"], hit, "_x_listed")
    rest = marked.where("not _x_listed").select(*docs.columns)
    own, other = marked.where("_x_listed").alias("a"), hit.alias("b")
    match = F.col("a._x_id").eqNullSafe(F.col("b._x_id")) & (F.col("a._x_copy") == F.col("b._x_copy"))
    if not spans:
        return rest.unionByName(own.join(other, match, "left_anti").select(*docs.columns))
    joined = own.join(other, match, "left")
    text = F.when(F.col("b._x_spans").isNull(), F.col("a.text")).otherwise(cut_spans(F.col("a.text"), F.col("b._x_spans")))
    return rest.unionByName(joined.select(*[text.alias("text") if c == "text" else F.col(f"a.`{c}`") for c in docs.columns]))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') as ws
             from documents),
b as (select coalesce(item_id::varchar, '') as item,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') as ws from benchmark),
bw as (select item, ws, least(len(ws), {WINDOW}) as k, unnest(range(0, len(ws) - least(len(ws), {WINDOW}) + 1)) as i
         from b where len(ws) > 0),
g as (select distinct item, k, array_to_string(ws[i + 1:i + k], ' ') as gram from bw),
dw as (select doc_id, ws, k, unnest(range(0, greatest(len(ws) - k + 1, 0))) as pos from d, (select distinct k from g)),
h as (select doc_id, pos, k, item from (select doc_id, pos, k, array_to_string(ws[pos + 1:pos + k], ' ') as gram from dw)
        join g using (k, gram)),
w as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(pos, pos + k)) as p from h) group by 1),
i as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
        from (select distinct doc_id, item from h) group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, n_hit is not null as contaminated
from d left join w using (doc_id) left join i using (doc_id)
"""
