"""All numbers of neighbours and all tracks are scored from one table of confusion cells."""

from pyspark.sql import functions as F

from wafercast.operators import metrics as M
from wafercast.plans import report_queries as RQ

NN = "qid long, nn array<struct<d: double, id: long, label: int>>"


def _majority(labels, k):
    some = labels[:k]
    return min(set(some), key=lambda c: (-some.count(c), c))


def test_votes_of_several_k_at_once(spark):
    lists = {1: [2, 1, 1, 2, 2], 2: [3, 3, 1, 1, 1], 3: [5], 4: []}
    nn = spark.createDataFrame([(q, [(float(i), i, c) for i, c in enumerate(v)]) for q, v in lists.items()], NN)
    rows = spark.createDataFrame([(1, 2), (2, 3), (2, 1), (3, 0), (4, 1), (None, 1)], "id long, label int")
    got = sorted(tuple(r) for r in RQ._votes(RQ._labels(nn), rows, (1, 2, 4)).select("id", "label", "k", "prediction").collect())
    assert got == sorted((i, y, k, _majority(lists[i], k)) for i, y in ((1, 2), (2, 3), (2, 1), (3, 0)) for k in (1, 2, 4))


def test_scores_by_key_equal_those_of_each_part(spark):
    rows = [("a", y % 3, (y * y) % 4) for y in range(30)] + [("b", y % 2, 1) for y in range(11)]
    pred = spark.createDataFrame(rows, "part string, label int, prediction int")
    by = {r["part"]: r for r in M.macro_scores(M.confusion(pred, ["part"]), ["part"]).collect()}
    for part in "ab":
        one = M.macro_metrics(pred.where(F.col("part") == part)).first()
        assert all(abs(one[c] - by[part][c]) < 1e-12 for c in ("accuracy", "f1_macro", "recall_macro", "precision_macro", "n"))
