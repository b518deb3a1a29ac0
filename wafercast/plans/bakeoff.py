"""Stages 4-5: selection tracks and the model bake-off.

* tracks: 4A the base features, 4B RFE and 4D Lasso on the ANOVA top-1000, 4C
  forest importance on all columns (top 25);
* bake-off: each model's grid is searched with 3 hash-assigned stratified
  folds scored by macro F1, the best point is refit on all train rows and
  evaluated on the locked test rows.  One leaderboard row per (track, model);
  a failing model is recorded with NULL scores and its error.

Fits of MLlib models run side by side and are kept in a :class:`.ledger.Ledger`
by (track, model, grid point, fold).  The joint solvers search a whole grid in
one fit; theirs is one entry a track."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import IllegalArgumentException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import N_FOLDS, N_RF, N_RFE, RATIO_EPS, RFE_STEP
from ..operators import anova as A
from ..operators import boosting as BO
from ..operators import knn as K
from ..operators import linear as L
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import sampling as S
from ..operators.expand import chosen_features, project
from ..operators.leaderboard import LEADERBOARD_SCHEMA
from ..operators.moments import expanded_moments
from ..session import write_shared
from .ledger import Ledger

#: The grids of the seven models.
LOGISTIC_C = (0.001, 0.01, 0.1)
NEIGHBOURS = (15, 25, 35)
TREE_DEPTHS, TREE_LEAF = (4, 6), 20
FOREST_TREES, FOREST_DEPTHS, FOREST_LEAF = 150, (6, 8), 10
MACHINE_C = (0.1, 1.0)
GAMMAS, ALPHAS = (1.0, 5.0), (1.0, 10.0)
MODELS = ("LogisticReg", "KNN", "DecisionTree", "RandomForest", "GradBoosting", "XGBoost", "SVM")


def expanded_array(df: DataFrame, d: int, features: str = "features") -> DataFrame:
    if d < 2:       # no pairs
        return df
    pairs = (f"flatten(transform(sequence(0, {d - 2}), i -> transform(sequence(i + 1, {d - 1}), j -> "
             f"array({features}[i] + {features}[j], {features}[i] - {features}[j], "
             f"try_divide({features}[i], {features}[j] + {RATIO_EPS}D), {features}[i] * {features}[j]))))")
    return df.withColumn(features, F.concat(F.col(features), F.flatten(F.expr(pairs))))


def with_folds(train: DataFrame) -> DataFrame:
    r = S.class_rank(train, "label", "id")
    return r.withColumn("fold", ((F.col("rk") - 1) % N_FOLDS).cast("int")).drop("rk")


def select_columns(df: DataFrame, ids: list[int]) -> DataFrame:
    return df.withColumn("features", F.array(*[F.col("features")[i] for i in ids]))


def tracks(spark: SparkSession, mr: DataFrame, d: int) -> dict[str, list[int]]:
    """Feature ids of each selection track (column order kept)."""
    train = mr.where(F.col("split") == "train_balanced")
    pre = sorted(r["feature_id"] for r in A.top_k(A.anova_f(expanded_moments(train, group="label"))).collect())
    # any feature with a NULL value (undefined ratio) was dropped by the ANOVA scorer
    pre_rows = ML.compact(write_shared(project(train.select("id", "label", "features"), chosen_features(pre, d)), "survivors"))
    lasso = ML.lasso_support(pre_rows)
    lasso_ids = [pre[i] for i in lasso] if len(lasso) >= 2 else pre[:25]
    imp = ML.rf_importance(train)
    rf_ids = sorted(range(len(imp)), key=lambda i: (imp[i], i))[-N_RF:]
    rfe_pos = ML.rfe(pre_rows, N_RFE, RFE_STEP)
    return {"4A_Base": list(range(d)), "4B_RFE": [pre[i] for i in rfe_pos], "4C_RF_Importance": rf_ids, "4D_Lasso": lasso_ids}


# ---- the models

@dataclass
class Fitted:
    """A fitted model: its grid point, and rows to (id, label, prediction, share)."""
    params: dict
    predict: Callable[[DataFrame], DataFrame]


def with_share(pred: DataFrame) -> DataFrame:
    """MLlib's ``probability`` vector as a map of class to probability."""
    p = vector_to_array("probability")
    return pred.select("id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
                       F.map_from_arrays(F.sequence(F.lit(0), F.size(p) - 1), p).alias("share"))


def _best(grid: list[dict], scores: list[float]) -> int:
    return max(range(len(grid)), key=lambda i: (scores[i], -i))


def _mllib(make: Callable, grid: list[dict], train: DataFrame, ledger: Ledger, name: str) -> Fitted:
    """The grid's points and folds side by side, the best one refit on all rows."""
    tv = ML.with_vector(train)
    n = train.count()
    part = max(1, int(n * (N_FOLDS - 1) / N_FOLDS))

    def score(params: dict, fold: int) -> dict:
        tr, va = ML.fold_split(tv, fold)
        model = make(n=part, **params).fit(tr)
        return {"f1": ML.MacroF1Evaluator().evaluate(model.transform(va).select("label", "prediction"))}

    units = {f"{name}|{sorted(p.items())}|{f}": (lambda p=p, f=f: score(p, f)) for p in grid for f in range(N_FOLDS)}
    got = list(ledger.run(units).values())
    means = [sum(r["f1"] for r in got[i * N_FOLDS:(i + 1) * N_FOLDS]) / N_FOLDS for i in range(len(grid))]
    best = grid[_best(grid, means)]
    model = make(n=n, **best).fit(tv)
    return Fitted(best, lambda rows: with_share(model.transform(ML.with_vector(rows))))


def _neighbours(train: DataFrame, ledger: Ledger, name: str) -> Fitted:
    def score(k: int, fold: int) -> dict:
        tr, va = ML.fold_split(train, fold)
        return {"f1": float(M.macro_metrics(K.knn_predict(tr, va, k)).first()["f1_macro"])}

    units = {f"{name}|{k}|{f}": (lambda k=k, f=f: score(k, f)) for k in NEIGHBOURS for f in range(N_FOLDS)}
    got = list(ledger.run(units).values())
    means = [sum(r["f1"] for r in got[i * N_FOLDS:(i + 1) * N_FOLDS]) / N_FOLDS for i in range(len(NEIGHBOURS))]
    k = NEIGHBOURS[_best(NEIGHBOURS, means)]
    return Fitted({"k": k}, lambda rows: K.knn_predict(train, rows, k).select("id", "label", "prediction", "share"))


def _machine(train: DataFrame, d: int) -> Fitted:
    w, b = ML.rff_columns(d)
    m = L.search_machine(train, list(MACHINE_C), N_FOLDS, len(b), ML.rff_map(w, b))
    return Fitted({"C": m.C}, lambda rows: m.predict(rows).select("id", "label", "prediction", "share"))


def boosted(train: DataFrame, grid: list[dict], make: Callable[..., BO.Booster]) -> Fitted:
    """All grid points, each on all rows and without each fold, in one fit."""
    folds = [*(range(N_FOLDS) if len(grid) > 1 else ()), L.NO_FOLD]
    model = BO.fit_boosters(train, [make(skip=f, **p) for p in grid for f in folds])
    means = [0.0] * len(grid)
    if len(grid) > 1:
        held = model.scores(train, held_out=True).groupBy("fit", "fold", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
        cells = held.collect()      # fits x classes x classes
        means = [L.mean_fold_f1([r for r in cells if r["fit"] // len(folds) == i]) for i in range(len(grid))]
    best = _best(grid, means)
    fit = best * len(folds) + len(folds) - 1
    return Fitted(grid[best], lambda rows: model.scores(rows, [fit]).select("id", "label", "prediction", "share"))


def fit_model(name: str, train: DataFrame, d: int, ledger: Ledger, at: str = "") -> Fitted:
    """One of the seven models, searched and refit on ``train`` (id, label, features, fold)."""
    if name == "LogisticReg":
        return _mllib(lambda n, C: ML.logistic(C, n), [{"C": c} for c in LOGISTIC_C], train, ledger, at + name)
    if name == "KNN":
        return _neighbours(train, ledger, at + name)
    if name == "DecisionTree":
        return _mllib(lambda n, max_depth: ML.tree(max_depth, TREE_LEAF), [{"max_depth": m} for m in TREE_DEPTHS], train, ledger, at + name)
    if name == "RandomForest":
        return _mllib(lambda n, max_depth: ML.forest(FOREST_TREES, max_depth, FOREST_LEAF),
                      [{"max_depth": m} for m in FOREST_DEPTHS], train, ledger, at + name)
    if name == "GradBoosting":
        return boosted(train, [{}], BO.Booster)
    if name == "XGBoost":
        return boosted(train, [{"gamma": g, "alpha": a} for g in GAMMAS for a in ALPHAS], BO.regularised)
    if name == "SVM":
        return _machine(train, d)
    raise ValueError(f"no model {name}")


def evaluate(fitted: Fitted, train: DataFrame, test: DataFrame) -> dict:
    te = M.macro_metrics(fitted.predict(test)).first()
    tr = M.macro_metrics(fitted.predict(train)).first()
    return {"Test_F1_Macro": float(te["f1_macro"]), "Test_Recall_Macro": float(te["recall_macro"]),
            "Train_F1_Macro": float(tr["f1_macro"]), "Overfit_Gap": float(tr["f1_macro"] - te["f1_macro"]),
            "Test_Accuracy": float(te["accuracy"]), "Best_Params": str(fitted.params)}


def bake_off(spark: SparkSession, mr: DataFrame, track_ids: dict[str, list[int]], d: int,
             models: list[str] | None = None, path: str | None = None) -> DataFrame:
    """A leaderboard row for every track and model; with ``path``, fits that
    an earlier run has finished are not repeated."""
    ledger, rows = Ledger(spark, path), []
    for track, ids in track_ids.items():
        data = project(mr, chosen_features(ids, d))
        train = ML.compact(write_shared(with_folds(data.where(F.col("split") == "train_balanced").select("id", "label", "features")), "track-train"))
        test = write_shared(data.where(F.col("split") == "test").select("id", "label", "features"), "track-test")
        for name in models or MODELS:
            def one(name=name, train=train, test=test, ids=ids, track=track) -> dict:
                try:
                    return evaluate(fit_model(name, train, len(ids), ledger, f"{track}|"), train, test)
                except (IllegalArgumentException, ValueError) as e:
                    # a model that cannot be fitted to these data is a row of NULLs with its message; anything
                    # else, such as a lost executor, ends the job
                    return {"Best_Params": f"error: {e}"}

            key = f"{track}|{name}"
            if key not in ledger.done:
                ledger._keep(key, one())
            rows.append({"Track": track, "Model": name, **ledger.done[key]})
    names = [c.split()[0] for c in LEADERBOARD_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], LEADERBOARD_SCHEMA)
