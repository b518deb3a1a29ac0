"""Operator 1: token counts by heap-and-linked-list byte-pair merging.

A piece starts as one symbol a byte (the last carries the word end).  All
adjacent pairs with a rank are put on a heap; the lowest rank (leftmost first)
is popped, its two symbols are merged in a doubly linked list, and the new
neighbours' pairs are pushed.  An entry whose symbols have changed since is
skipped.  The count is the initial symbols less the merges; no identifier is
made.  A piece of n bytes costs O(n log n), so a text without any white
space is no problem.

Spark deals the documents out as they lie in the files: one narrow pass,
nothing shuffles, and a lost task is simply read again.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); strings of added
tokens inside a text are one token each, as the library has it by default;
repeated rows are counted each; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, slices
from .vocab import ChunkReader, load_tokenizer

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048


class MergeCounter:
    """Counts the symbols that are left of a piece after all merges."""

    def __init__(self, model: dict):
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.end = model.get("end_of_word_suffix") or ""

    def count(self, piece: str) -> int:
        n = len(piece)
        sym: list[str | None] = list(piece)
        sym[-1] += self.end
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1)
                if (r := rank((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if sym[i] != left or j >= n or sym[j] != right:
                continue
            sym[i], sym[j] = left + right, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            merges += 1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((sym[a], sym[b]))) is not None:
                    heapq.heappush(heap, (r, a, sym[a], sym[b]))
        return n - merges


@lru_cache(maxsize=4)
def _reader(path: str) -> ChunkReader:
    with open(path, encoding="utf-8") as f:
        counter = MergeCounter(json.load(f)["model"])
    return ChunkReader(load_tokenizer(path), counter.count, lambda _: 1, sum)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; ``path`` is a
    vocabulary file that every executor has."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        reader = _reader(path)
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column("text").to_pylist()
            counts = [sum(reader.values(t)) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t or b"") for t in texts], pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), vocabulary_path())
