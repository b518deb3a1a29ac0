"""Operator 12: spelling variants by finite-state composition.

Words are near if they differ by exactly one inserted, deleted or replaced code
point.  The pairs are the accepted pairs of A o T o A, where A is the minimised
acceptor of the vocabulary and T the transducer that copies, makes one edit
and copies on.

**Vocabulary.**  Runs of ASCII and Latin-1 letters (U+00C0 to U+00FF, as they
stand) are counted a document at a time and pre-aggregated in tasks, in tables
of at most ``HELD`` words, before they are summed in one shuffle.

**Partitions by initial state.**  The composed machine's states before the
edit are pairs of equal prefixes, those after it pairs that must accept one and
the same rest.  A class holds the words of ``ell`` and ``ell + 1`` code points
(its replacements are among the first, its insertions between both), and a
group of a class, the words that agree up to position ``a`` and in what follows
position ``b``: in it lies every pair of the class that agrees there and is
edited in ``[a, b)``, the edit's place being the length of the common prefix.
So a group is the composed machine started at the state of its prefix, with
T's edit held to ``[a, b)``; every pair belongs to exactly one group of a class.
All classes are cut in half once (front: equal back halves, back: equal front
halves), and groups of more than ``GROUP_WORDS`` words again and again, until
all are below that or ``[a, b)`` is one position, where a group has at most one
word a letter and, longer by one, a word a pair of letters.

**A group** registers the states of the minimised acceptor of what lies between
prefix and suffix (both lengths share one register, states are numbered by
their right language, words by the arcs that lead to them), walks the pairs of
equal prefixes, takes every pair of arcs with different letters (replacement)
or one arc beside none (insertion), and lists the words that both states reached
accept; equal states accept the same.  Only counts and the best near word of
each word leave a group, no pairs.

**Forms and roots.**  A word's form has at least twice its count, so a chain has
at most 63 words and pointer jumping ends after six rounds.

Edge cases: a null text has no words, a null doc_id reads as the empty string
in the deletion rule; repeated rows count each; words of any length are taken
(nothing recurses); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shared_table, shuffle_partitions, text_or_empty

MIN_POINTS = 5
MIN_COUNT = 3
HELD = 200_000
SLICE = 256
GROUP_WORDS = 8192

#: A byte of Latin-1 text is a letter (A-Z as a-z) or a gap.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


# ---- the vocabulary

def runs(text: str) -> list[bytes]:
    """The lower-cased runs of letters, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def doc_words(doc_id: str, text: str, every: int | None, least: int):
    """(word, count) of one document; with ``every``, a run whose crc32 with
    the doc_id is a multiple of it loses one code point."""
    head = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(runs(text)).items():
        if len(run) < least:
            continue
        if every:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < least:
                    continue
        yield run, n


def _rows(counts: dict[bytes, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                       pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, min_points: int = MIN_POINTS, min_count: int = MIN_COUNT,
               delete_every: int | None = None) -> DataFrame:
    """(word, n), written: the words of enough code points and occurrences."""
    def run(batches):
        counts: dict[bytes, int] = {}
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    for w, n in doc_words(doc_id, text, delete_every, min_points):
                        known = counts.get(w)
                        if known is None:
                            counts[w], size = n, size + len(w)
                            if len(counts) >= HELD or size > 64 * HELD:
                                yield _rows(counts)
                                counts, size = {}, 0
                        else:
                            counts[w] = known + n
        if counts:
            yield _rows(counts)

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), text_or_empty().alias("text"))
    words = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return shared_table(words.where(F.col("n") >= min_count), "vocabulary")


# ---- partitions of the composed machine

def _halves(rows: DataFrame) -> DataFrame:
    cut = "array(named_struct('a', a, 'b', (a + b) div 2), named_struct('a', (a + b) div 2, 'b', b))"
    half = F.expr(f"transform({cut}, x -> named_struct('a', cast(x.a as int), 'b', cast(x.b as int)))")
    return rows.select("word", "n", "ell", F.inline(half))


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds ``grp``, a hash of the group; the group itself is checked where it is worked on."""
    return rows.withColumn("grp", F.expr(
        "xxhash64(ell, a, b, left(word, a), right(word, greatest(ell - b, 0)))"))


def partitions(vocab: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, ell, a, b, grp): a word's row in each of its groups."""
    size = F.char_length("word")
    classes = vocab.select("word", "n", F.explode(F.array(size, size - 1)).alias("ell")).where("ell > 0")
    whole = classes.select("word", "n", "ell", F.lit(0).alias("a"), (F.col("ell") + 1).alias("b"))
    rows = shared_table(_grouped(_halves(whole)), "spelling")
    done = []
    while True:
        hot = shared_table(rows.where("b - a > 1").groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
                           .where(F.col("size") > group_words).select("grp"), "hot")
        if hot.isEmpty():
            break
        done.append(rows.join(hot, "grp", "left_anti"))
        rows = shared_table(_grouped(_halves(rows.join(hot, "grp", "left_semi"))), "spelling")
    for part in done:
        rows = rows.unionByName(part)
    return rows


# ---- the composed machine of one group

class Acceptor:
    """Minimised acceptors of sets of equally long words, in one register.  A
    state is known by its arcs; arcs carry how many words go before theirs."""

    def __init__(self):
        self.register: dict[tuple, int] = {(): 0}
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.count = [1]

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        got = self.register.get(key)
        if got is None:
            got = self.register[key] = len(self.arcs)
            out, before = {}, 0
            for c, child in key:
                out[c] = (child, before)
                before += self.count[child]
            self.arcs.append(out)
            self.count.append(before)
        return got

    def add(self, words: list[str]) -> int:
        """The initial state for ``words``, sorted, distinct and of one length."""
        path: list[list[tuple[str, int]]] = [[]]
        last = ""
        for w in words:
            k = 0
            while k < len(last) and w[k] == last[k]:
                k += 1
            self._close(path, last, k)
            path.extend([] for _ in range(len(w) - k))
            last = w
        self._close(path, last, 0)
        return self._state(path[0])

    def _close(self, path, last: str, k: int) -> None:
        for d in range(len(last), k, -1):
            done = self._state(path.pop())
            path[-1].append((last[d - 1], done))


def accepted_pairs(short: list[str], long: list[str], first: int, stop: int):
    """The pairs of the composed machine whose edit is at ``first <= place < stop``
    of the words: (i, j, kind) with numbers in ``short`` and, for kind 1, ``long``."""
    acc = Acceptor()
    s0, l0 = acc.add(short), acc.add(long) if long else -1
    arcs, count = acc.arcs, acc.count
    known: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def both(x: int, y: int) -> list[tuple[int, int]]:
        """Numbers of the words that the states x and y both accept."""
        got = known.get((x, y))
        if got is None:
            got, todo = [], [(x, y, 0, 0)]
            while todo:
                p, q, i, j = todo.pop()
                if p == q:
                    got.extend((i + t, j + t) for t in range(count[p]))
                    continue
                other = arcs[q]
                for c, (child, at) in arcs[p].items():
                    hit = other.get(c)
                    if hit is not None:
                        todo.append((child, hit[0], i + at, j + hit[1]))
            known[x, y] = got
        return got

    todo = [(s0, l0, 0, 0, 0)]
    while todo:
        s, l, depth, i, j = todo.pop()
        own = list(arcs[s].items())
        longer = arcs[l] if l >= 0 else {}
        if depth + first < stop:
            for m, (_, (x, at)) in enumerate(own):
                for _, (y, bt) in own[m + 1:]:
                    for p, q in both(x, y):
                        yield i + at + p, i + bt + q, 0
            for c, (y, bt) in longer.items():
                if s == 0 and y == 0:
                    yield i, j + bt, 1
                for d, (x, at) in own:
                    # the inserted letter differs from the next one, so each pair has one place
                    hit = arcs[y].get(d) if d != c else None
                    if hit is not None:
                        for p, q in both(x, hit[0]):
                            yield i + at + p, j + bt + hit[1] + q, 1
        for c, (x, at) in own:
            hit = longer.get(c)
            todo.append((x, hit[0] if hit else -1, depth + 1, i + at, j + hit[1] if hit else 0))


def group_links(words: list[tuple[str, int]], ell: int, a: int, b: int):
    """(word, near words, count of the best, the best) of a group's words that have any."""
    tail = max(0, ell - b)
    parts: dict[tuple[str, str], list[tuple[str, int]]] = {}
    for w, n in words:      # one part, unless the groups' hashes collide
        parts.setdefault((w[:a], w[len(w) - tail:]), []).append((w, n))
    for part in parts.values():
        short = sorted(x for x in part if len(x[0]) == ell)
        if not short or len(part) < 2:
            continue
        long = sorted(x for x in part if len(x[0]) != ell)
        sides = [x[a:len(x) - tail] for x, _ in short], [x[a:len(x) - tail] for x, _ in long]
        best = sorted(short + long, key=lambda x: (-x[1], x[0]))
        place = {w: k for k, (w, _) in enumerate(best)}
        ranks = [place[w] for w, _ in short], [place[w] for w, _ in long]
        near, form = Counter(), {}
        for i, j, kind in accepted_pairs(*sides, a, b):
            u, v = ranks[0][i], ranks[kind][j]
            near[u] += 1
            near[v] += 1
            form[u] = min(form.get(u, v), v)
            form[v] = min(form.get(v, u), u)
        for k, n in near.items():
            yield best[k][0], n, best[form[k]][1], best[form[k]][0]


def near_words(rows: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words with near words, a row a group."""
    schema = "word string, n_near long, best_n long, best string"

    def out(links):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*links), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "best_n", "best"])

    def run(batches):
        key, words, links = None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("grp", "ell", "a", "b", "word", "n")]
            for g, ell, a, b, w, n in zip(*cols):
                if (g, ell, a, b) != key:
                    if len(words) > 1:
                        links.extend(group_links(words, *key[1:]))
                        if len(links) >= 4096:
                            yield out(links)
                            links = []
                    key, words = (g, ell, a, b), []
                words.append((w, n))
        if len(words) > 1:
            links.extend(group_links(words, *key[1:]))
        if links:
            yield out(links)

    keys = ["grp", "ell", "a", "b"]
    dealt = rows.select(*keys, "word", "n").repartition(shuffle_partitions(rows.sparkSession), "grp")
    return dealt.sortWithinPartitions(*keys).mapInArrow(run, schema)


# ---- forms and roots

def forms(vocab: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n), written."""
    links = near_words(partitions(vocab))
    none = F.lit(None)
    rows = vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("long").alias("best_n"),
                        none.cast("string").alias("best")).unionByName(
        links.withColumn("n", none.cast("long")))
    merged = rows.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
        F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("neg"), "best"))).alias("top"))
    big = -F.col("top.neg") >= ratio * F.col("n")
    return shared_table(merged.select("word", "n", "n_near", F.when(big, F.col("top.best")).alias("form"),
                                      F.when(big, -F.col("top.neg")).alias("form_n")), "forms")


def roots(table: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the end of its chain of forms."""
    links = table.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = shared_table(links.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_groups(vocab: DataFrame) -> DataFrame:
    """A row per word: word, n, n_near, form, form_n, root."""
    table = forms(vocab)
    return table.join(roots(table), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = vocabulary(read_table(spark, sf_dir, "documents"), delete_every=97)
    return spelling_groups(vocab).select("word", "form", "root", "n", "n_near", "form_n")
