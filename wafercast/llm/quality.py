"""Operator 9: quality rules with risk-controlled thresholds (native).

Base counts of a text (words ``[^\\x20\\x09-\\x0D]+``): n_words, word_chars,
n_symbols, n_dup_lines, n_repeat_words.  From them come the rule scores, high
is bad (``RULES``).

**Thresholds.**  Every rule has a fixed list of cutoffs, strictest last.  On
the labelled holdout, per stratum (language), a cutoff with x rejections among
n good documents is *safe* when the exact binomial tail
``P(Bin(n, ALPHA / rules) <= x)`` is at most ``DELTA / (strata * rules)``:
the false-rejection rate then exceeds ALPHA / rules with no more than that
probability.  A rule's cutoffs are tested from lenient to strict and testing
ends at the first failure (fixed-sequence testing), the correction over
strata and rules is Bonferroni's.  So with probability 1 - DELTA every
stratum rejects at most ALPHA of its good documents, all rules together.
Among safe cutoffs the one with the best gain (share of bad documents
rejected less COST times the share of good ones) is taken; without a safe
cutoff of positive gain the rule is off for the stratum.

**Plan.**  Texts are read once; counts go to the shared folder.  Labels join
the counts (never texts), each (stratum, rule) needs one pre-aggregated count
per cutoff, and the chosen cutoffs (strata x rules rows, a count of languages)
are broadcast.  All expressions are DataFrame functions.

Edge cases: a null or white text has no words and is base-failed; a null
language is the stratum ``none``; a null label or a label without a document
is left out of the holdout; a labelled doc_id listed twice counts once per
document row; without labels no rule is on; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, read_table, shared_table, text_or_empty

MIN_WORDS = 50
ALPHA = 0.05
DELTA = 0.05
COST = 5.0
#: Rule name -> (count, count it is divided by, cutoffs from lenient to
#: strict).  A document is rejected when its score is above the cutoff.
RULES = {
    "symbols": ("n_symbols", "n_words", (2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    "repeats": ("n_repeat_words", "n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05)),
    "capitals": ("n_capitals", "word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    "marks": ("n_marks", "word_chars", (0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _bind(value: Column, body) -> Column:
    """``body(x)`` with ``value`` computed once (a lambda that read the column
    itself would compute it at every access)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside any 3-word window that the text has twice or more."""
    def windows(ws):
        return F.when(F.size(ws) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(ws) - 3),
            lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(ws):
        order = F.array_sort(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s):
            again = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j:
                             (F.get(s, j)["h"].eqNullSafe(F.get(s, j - 1)["h"]) & (j > 0))
                             | F.get(s, j)["h"].eqNullSafe(F.get(s, j + 1)["h"]))
            starts = F.transform(again, lambda j: F.get(s, j)["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(
                starts, lambda p: F.array(p, p + 1, p + 2)))))
        return _bind(order, positions)

    return _bind(_bind(words, windows), lambda hs: F.when(
        F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(covered(hs)))


def count_struct(text: Column) -> Column:
    """All counts of a text as one struct, its words and lines cut once."""
    def of_text(t):
        words = F.array_remove(F.split(t, SPACE + "+"), "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.regexp_replace(t, SPACE, "").alias("s"),
            _bind(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))).alias("w"),
            _bind(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("l"))

    def of_parts(p):
        chars = F.char_length(p["s"])
        without = lambda rx: chars - F.char_length(F.regexp_replace(p["s"], rx, ""))
        counts = {"n_words": p["w"]["n"], "word_chars": chars, "n_symbols": without(r"[#*$%&|<>]"),
                  "n_dup_lines": p["l"]["n"] - p["l"]["d"], "n_repeat_words": p["w"]["r"], "n_lines": p["l"]["n"],
                  "n_capitals": without(r"[A-Z]"), "n_marks": without(r"[!-/:-@\[-`{-~0-9]")}
        return F.struct(*[c.cast("long").alias(n) for n, c in counts.items()])

    return _bind(_bind(text, of_text), of_parts)


def _stratum() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("none"))


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and the counts of every row."""
    return docs.select("doc_id", _stratum().alias("stratum"), count_struct(text_or_empty()).alias("c")).select(
        "doc_id", "stratum", "c.*")


def base_failed(c=F.col) -> Column:
    """Of the counts that ``c`` names."""
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def over_cutoff(c=F.col) -> Column:
    """Is any score above its cutoff (columns ``_cut_<rule>``, null: off)?"""
    over = F.lit(False)
    for rule, (part, whole, _) in RULES.items():
        score = F.when(c("n_words") > 0, c(part) / c(whole))
        over = over | F.coalesce(score > F.col(f"_cut_{rule}"), F.lit(False))
    return over


def binomial_tail(n: str, x: str, p: Column) -> Column:
    """P(Bin(n, p) <= x), terms summed in logarithms from the ratio of
    neighbours; ``x`` terms, so call it for counts near n * p only."""
    p_odds = F.log(p) - F.log(F.lit(1.0) - p)
    first = F.col(n) * F.log(F.lit(1.0) - p)
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(acc, i):
        term = acc["term"] + F.log((F.col(n) - i + 1).cast("double")) - F.log(i.cast("double")) + p_odds
        high = F.greatest(acc["total"], term)
        total = high + F.log(F.exp(acc["total"] - high) + F.exp(term - high))
        return F.struct(term.alias("term"), total.alias("total"))

    upto = F.when(F.col(x) > 0, F.sequence(F.lit(1).cast("long"), F.col(x))).otherwise(
        F.array().cast("array<bigint>"))
    return F.exp(F.aggregate(upto, start, step, lambda a: a["total"]))


def thresholds(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """(stratum, rule, cutoff): the safe cutoffs with the best gain."""
    lab = (labels.where("quality is not null").groupBy("doc_id")
           .agg((F.min("quality") == 1).alias("good")))
    held = counts.where(~base_failed()).join(lab, "doc_id")
    steps = range(max(len(cuts) for _, _, cuts in RULES.values()))
    first = [F.struct(F.lit(rule).alias("rule"), F.expr("case " + " ".join(
        f"when {part} / {whole} > {c} then {k}" for k, c in enumerate(cuts)) + " end").alias("k0"))
        for rule, (part, whole, cuts) in RULES.items()]   # cutoffs fall: above one means above all later ones
    over = held.select("stratum", "good", F.explode(F.array(*first)).alias("f")).select("stratum", "good", "f.*")
    cells = over.groupBy("stratum", "rule").agg(
        F.count(F.when(F.col("good"), 1)).alias("n_good"), F.count(F.when(~F.col("good"), 1)).alias("n_bad"),
        *[F.count(F.expr(f"case when k0 <= {k} and {'good' if g else 'not good'} then 1 end")).alias(f"{'x' if g else 'hits'}_{k}")
          for k in steps for g in (True, False)])
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"x_{k}").alias("x"), F.col(f"hits_{k}").alias("hits"))
                     for k in steps])
    rule_risk = ALPHA / len(RULES)
    cutoff = F.expr("case " + " ".join(f"when rule = '{rule}' and k = {k} then {float(c)}D"
                                       for rule, (_, _, cuts) in RULES.items() for k, c in enumerate(cuts)) + " end")
    # a table of one row for each language and rule, so its windows are small
    cells = (cells.withColumn("n_strata", F.size(F.collect_set("stratum").over(_all())))
             .select("stratum", "rule", "n_good", "n_bad", "n_strata", F.explode(rows).alias("c"))
             .select("stratum", "rule", "n_good", "n_bad", "n_strata", "c.*")
             .withColumn("cutoff", cutoff).where("cutoff is not null"))
    near = F.col("x") <= F.col("n_good") * rule_risk   # above its mean the tail is no small number
    safe = F.when(near, binomial_tail("n_good", "x", F.lit(rule_risk))
                  <= F.lit(DELTA) / (F.col("n_strata") * len(RULES))).otherwise(F.lit(False))
    upto = Window.partitionBy("stratum", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    gain = (F.coalesce(F.try_divide("hits", "n_bad"), F.lit(0.0))
            - COST * F.coalesce(F.try_divide("x", "n_good"), F.lit(0.0)))
    tested = cells.withColumn("safe", F.min(safe.cast("int")).over(upto)).withColumn("gain", F.round(gain, 12))
    best = (tested.where("safe = 1 and gain > 0").groupBy("stratum", "rule")
            .agg(F.max_by("cutoff", F.struct("gain", -F.col("k"))).alias("cutoff")))
    return best


def _all():
    return Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def with_cutoffs(rows: DataFrame, cut: DataFrame, stratum: Column) -> DataFrame:
    """Adds the stratum's ``_cut_<rule>`` columns; ``cut`` has a few rows a language."""
    wide = cut.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    wide = wide.select(F.col("stratum").alias("_cut_stratum"), *[F.col(r).alias(f"_cut_{r}") for r in RULES])
    return rows.join(F.broadcast(wide), stratum == F.col("_cut_stratum"), "left")


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept."""
    counts = shared_table(text_counts(docs), "counts")
    cut = shared_table(thresholds(counts, labels), "cutoffs")
    judged = with_cutoffs(counts, cut, F.col("stratum"))
    return judged.select("doc_id", *COUNTS, base_failed().alias("base_failed"),
                         (~base_failed() & ~over_cutoff()).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged.  The texts are read a
    second time rather than shuffled against the verdicts; the verdict is one
    expression, so a text is counted once."""
    counts = shared_table(text_counts(docs), "counts")
    cut = shared_table(thresholds(counts, labels), "cutoffs")
    keep = _bind(count_struct(text_or_empty()),
                 lambda c: ~base_failed(lambda n: c[n]) & ~over_cutoff(lambda n: c[n]))
    return with_cutoffs(docs, cut, _stratum()).where(keep).select(*docs.columns)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _oracle() -> str:
    cells = "\nUNION ALL\n".join(
        f"SELECT stratum, '{rule}' AS rule, {k} AS k, {float(c)!r}::DOUBLE AS cutoff, "
        f"count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad, "
        f"count(*) FILTER (good AND {part} / {whole} > {c}) AS x, "
        f"count(*) FILTER (NOT good AND {part} / {whole} > {c}) AS hits FROM held GROUP BY stratum"
        for rule, (part, whole, cuts) in RULES.items() for k, c in enumerate(cuts))
    risk = ALPHA / len(RULES)
    rejected = " OR ".join(f"coalesce({part} / {whole} > c.{rule}, false)" for rule, (part, whole, _) in RULES.items())
    wide = ", ".join(f"max(cutoff) FILTER (rule = '{r}') AS {r}" for r in RULES)
    return rf"""
WITH t AS (SELECT doc_id, coalesce(lang, 'none') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, stratum, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM t),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g
        FROM w, unnest(generate_series(1, len(ws) - 2)) AS u(i) WHERE len(ws) >= 3),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM t),
dl AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM ln
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT w.doc_id, stratum, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
        length(t) - length(regexp_replace(t, '[!-/:-@\[-`{{-~0-9]', '', 'g')) AS n_marks
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dl USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
held AS (SELECT b.*, good FROM b JOIN (SELECT doc_id, min(quality) = 1 AS good FROM labels
         WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id) WHERE NOT base_failed),
cells AS ({cells}),
tail AS (SELECT *, CASE WHEN x <= n_good * {risk} THEN (
           SELECT sum(exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({risk})
                          + (n_good - i) * ln(1 - {risk}))) FROM range(0, x + 1) AS r(i)) ELSE 1 END AS p
         FROM cells),
safe AS (SELECT *, max(p) OVER (PARTITION BY stratum, rule ORDER BY k) AS worst,
           round(coalesce(hits / nullif(n_bad, 0), 0) - {COST} * coalesce(x / nullif(n_good, 0), 0), 12) AS gain
         FROM tail),
pick AS (SELECT * FROM safe WHERE worst <= {DELTA} / ((SELECT count(DISTINCT stratum) FROM held) * {len(RULES)})
         AND gain > 0 QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, k) = 1),
cut AS (SELECT stratum, {wide} FROM pick GROUP BY stratum)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words > 0 AND ({rejected})) AS kept
FROM b LEFT JOIN cut c USING (stratum)
"""


ORACLE = _oracle()
