"""The closed loop against overfitting.

A model is fitted and its gap between train and test macro F1 taken.  While the
gap is above the trigger, a tactic changes the training rows: pruning drops a
tenth of each class (L18), jitter blurs the synthetic rows (L19), harder each
time.  The model is refitted; the new rows are taken if the gap has shrunk and
test macro F1 has not fallen by more than ``COST``, else they are dropped again.
The loop ends when the gap is below the trigger, when all tactics have failed in
a row, or after ``rounds`` rounds.  Every round is recorded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import OVERFIT_GAP
from ..operators import balance as B
from ..operators import metrics as M
from ..operators import sampling as S
from ..session import write_shared

ROUNDS = 6
FRACTION = 0.10
SIGMA = 0.05
COST = 0.02
SCHEMA = ("round int, action string, n_train long, train_f1 double, test_f1 double, gap double, taken boolean, "
          "next string")


def prune(rows: DataFrame, fraction: float) -> DataFrame:
    """Each class without the last ``fraction`` of its rows by hash rank."""
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))        # a row a class
    ranked = S.class_rank(rows, "label", "id").join(F.broadcast(sizes), "label")
    return ranked.where(F.col("rk") <= F.col("_n") - F.floor(F.col("_n") * fraction)).select(*rows.columns)


TACTICS: list[tuple[str, Callable[[DataFrame, int], DataFrame]]] = [
    ("prune", lambda rows, times: prune(rows, FRACTION)),
    ("jitter", lambda rows, times: B.jitter(rows, SIGMA * times)),
]


def tuning_loop(train: DataFrame, test: DataFrame, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
                trigger: float = OVERFIT_GAP, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(record, final train rows).  ``train`` has id, label, features and
    is_synthetic; ``fit`` gives a function from rows to predictions."""
    def measure(rows: DataFrame) -> tuple[int, float, float]:
        predict = fit(rows)
        tr, te = (M.macro_metrics(predict(x)).first() for x in (rows, test))
        return int(tr["n"] or 0), float(tr["f1_macro"] or 0.0), float(te["f1_macro"] or 0.0)

    n, tr, te = measure(train)
    record = [[0, "none", n, tr, te, tr - te, True]]
    failed = 0
    for i in range(1, rounds + 1):
        if record and tr - te <= trigger or failed == len(TACTICS):
            break
        name, tactic = TACTICS[(i - 1) % len(TACTICS)]
        rows = write_shared(tactic(train, (i + 1) // len(TACTICS)), "tuned")
        n_new, tr_new, te_new = measure(rows)
        taken = tr_new - te_new < tr - te and te_new >= te - COST
        record.append([i, name, n_new, tr_new, te_new, tr_new - te_new, taken])
        failed = 0 if taken else failed + 1
        if taken:
            train, tr, te = rows, tr_new, te_new
    ends = "stop: below trigger" if tr - te <= trigger else "stop: no tactic helps" if failed == len(TACTICS) else "stop: rounds used"
    out = [(*r, "go on" if k + 1 < len(record) else ends) for k, r in enumerate(record)]
    return train.sparkSession.createDataFrame(out, SCHEMA), train
