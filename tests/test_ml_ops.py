"""Sampling, scaling, expansion, metrics and report tables."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wafercast.functions.constants import MODEL_ORDER
from wafercast.operators import balance as B
from wafercast.operators import expand as X
from wafercast.operators import knn as K
from wafercast.operators import leaderboard as LB
from wafercast.operators import linear as L
from wafercast.operators import metrics as M
from wafercast.operators import models as ML
from wafercast.operators import sampling as S
from wafercast.operators.moments import expanded_moments, width
from wafercast.operators.pivots import pruned_neighbours
from wafercast.operators.scale import ScalerModel, scaler_fit
from wafercast.plans import model_queries as MD
from wafercast.sources.features import embedding_matrix

from .conftest import SMALL


def test_two_level_rank_equals_global_rank(spark):
    fm = embedding_matrix(spark, SMALL)
    got = S.class_rank(fm).select("id", "rk")
    w = Window.partitionBy("label").orderBy(F.md5(F.concat(F.lit("42|"), F.col("id").cast("string"))), "id")
    want = fm.withColumn("rk2", F.row_number().over(w)).select("id", "rk2")
    assert got.join(want, "id").where("rk <> rk2").count() == 0


def test_split_counts(spark):
    sp = S.stratified_split(embedding_matrix(spark, SMALL))
    n = sp.count()
    assert sp.where("split = 'test'").count() == -(-n * 2 // 10)   # ceil(0.2 n)
    per = {r["label"]: r["c"] for r in sp.where("split='train'").groupBy("label").agg(F.count("*").alias("c")).collect()}
    assert max(per.values()) - min(per.values()) <= max(per.values())  # every class present
    folds = S.kfold(sp).groupBy("label", "fold").count().collect()
    by = {}
    for r in folds:
        by.setdefault(r["label"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by.values())


def test_scaler_constant_feature_scale_is_one(spark):
    df = spark.createDataFrame([(i, 0, [5.0, float(i)]) for i in range(6)], "id long, label int, features array<double>")
    m = ScalerModel(scaler_fit(df))
    assert m.std[0] == 1.0 and m.mean[0] == 5.0
    out = m.transform(df).collect()
    assert all(r["features"][0] == 0.0 for r in out)


def test_expansion_reference_example(spark):
    df = spark.createDataFrame([(1, 0, [10.0, 2.0])], "id long, label int, features array<double>")
    long = {r["feature_id"]: r["value"] for r in X.expand_long(df, 2).collect()}
    dim = {r["name"]: r["feature_id"] for r in X.expansion_dim(spark, ["A", "B"]).collect()}
    assert long[dim["A_PLUS_B"]] == 12.0
    assert long[dim["A_MINUS_B"]] == 8.0
    assert long[dim["A_DIV_B"]] == pytest.approx(5.0, abs=1e-4)
    assert long[dim["A B"]] == 20.0


def test_moments_equal_the_expanded_rows(spark):
    rows = [(i, i % 2, [float(i), (i * 7) % 5 - 1e-6 * (i % 3 == 0), 0.5 * i * i]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, label int, features array<double>").repartition(3)
    long = X.expand_long(df, 3).groupBy("label", "feature_id").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
    want = {(r["label"], r["feature_id"]): r for r in long.collect()}
    got = expanded_moments(df, group="label").collect()
    assert len(got) == len(want) == 2 * (3 + 4 * 3)
    for r in got:
        w = want[(r["grp"], r["feature_id"])]
        assert r["n"] == w["n"] and r["mean"] == pytest.approx(w["mean"], rel=1e-9)
        assert r["m2"] == pytest.approx(w["var"] * w["n"], rel=1e-9, abs=1e-9)
    with pytest.raises(ValueError):
        width(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "features array<double>"))


def test_small_variance_is_still_scaled(spark):
    df = spark.createDataFrame([(i, 0, [1e-8 * (i % 2)]) for i in range(6)], "id long, label int, features array<double>")
    assert ScalerModel(scaler_fit(df)).std[0] == pytest.approx(0.5e-8)


def test_roc_with_an_absent_class_and_ranges(spark):
    rows = [(i, i % 2, {0: 1 - s, 1: s}) for i, s in enumerate([0.1, 0.9, 0.35, 0.35, 0.8, 0.4, 0.4, 0.999, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, label int, share map<int,double>")
    auc = {r["cls"]: r["auc"] for r in M.auc(df, [0, 1, 2]).collect()}
    pos, neg = [r[2][1] for r in rows if r[1] == 1], [r[2][1] for r in rows if r[1] == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc[1] == pytest.approx(want) and auc[0] == pytest.approx(want) and auc[2] is None
    pts = M.roc_points(df, [0, 1, 2]).collect()
    for c in (0, 1):
        xy = sorted((r["fpr"], r["tpr"]) for r in pts if r["cls"] == c)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(xy, xy[1:]))
        assert xy[0] == (0, 0) and xy[-1] == (1, 1) and area == pytest.approx(want)
    assert {r["tpr"] for r in pts if r["cls"] == 2} == {0.0, None}


def test_dense_confusion(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (3, 2, 0)], "id long, label int, prediction int")
    got = {(r["label"], r["prediction"]): r["n"] for r in M.dense_confusion(df).collect()}
    assert len(got) == 9 and sum(got.values()) == 3 and got[(0, 1)] == 1 and got[(1, 2)] == 0


def test_knn_spreads_one_block(spark):
    """One block of train rows is no hot key: query rows meet it under several salts."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(400).select("id", (F.col("id") % 3).cast("int").alias("label"),
                                   F.array(F.col("id").cast("double"), F.lit(1.0)).alias("features"))
    one = K.neighbours(rows, rows, 3)
    many = K.neighbours(rows, rows, 3, block_rows=50)
    a = {r["qid"]: [x["id"] for x in r["nn"]] for r in one.collect()}
    assert a == {r["qid"]: [x["id"] for x in r["nn"]] for r in many.collect()}
    assert all(a[i][0] == i for i in a)
    salts = rows.select(F.pmod(F.xxhash64("id", F.lit("salt")), F.lit(n)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == n and max(r["count"] for r in salts) < 2 * 400 / n


def test_class_neighbours_in_blocks_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 7 > 0) + int(i % 7 > 4), rng.integers(0, 6, 3).astype(float).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, label int, features array<double>").repartition(3)
    want = {i: [o for _, o in sorted((sum((p - q) ** 2 for p, q in zip(f, g)), o)
                                     for o, m, g in rows if m == c and o != i)[:3]] for i, c, f in rows}
    for block_rows in (16, 4096):
        got = B.class_neighbours(df, 3, block_rows)
        assert {r["id"]: [x["id"] for x in r["nn"]] for r in got.collect()} == want


def test_expansion_size_for_66(spark):
    names = [f"f{i}" for i in range(66)]
    assert X.expansion_dim(spark, names).count() == 66 + 4 * 2145 == 8646


def _lb(spark):
    rows = []
    tracks = ["4B_RFE", "4C_RF_Importance", "4D_Lasso"]
    models = MODEL_ORDER
    v = 0.40
    for t in tracks:
        for m in models:
            if t == "4D_Lasso" and m == "DecisionTree":
                continue                      # the missing model -> NULL pivot cell
            v += 0.01
            rows.append((t, m, round(v, 4), 0.5, round(v + 0.2, 4), 0.2, 0.6, "{}"))
    rows[3] = (rows[3][0], rows[3][1], rows[4][2]) + rows[3][3:]    # one tie in Test_F1_Macro
    return spark.createDataFrame(rows, LB.LEADERBOARD_SCHEMA)


def test_leaderboard_tables(spark):
    lb = _lb(spark)
    assert lb.count() == 20
    best = {r["Track"]: r["Model"] for r in LB.best_per_track(lb).collect()}
    assert set(best) == {"4B_RFE", "4C_RF_Importance", "4D_Lasso"}
    piv = LB.f1_pivot(spark, lb, ["4B_RFE", "4C_RF_Importance", "4D_Lasso"]).collect()
    assert [r["Model"] for r in piv][:3] == ["SVM", "LogisticReg", "KNN"]
    dt = [r for r in piv if r["Model"] == "DecisionTree"][0]
    assert dt["4D_Lasso"] is None
    gap = LB.gap_table(spark, lb).collect()
    assert [r["Model"] for r in gap] == ["SVM", "Logistic Regression", "XGBoost", "Gradient Boosting"]
    assert LB.overfit_trigger(lb).count() == 20
    assert LB.winner(lb).count() == 1


def test_importance_of_linear_and_tree_models(spark):
    rows = [(i, i % 2, [float(i % 2) * 5, float(i % 3), 1.0]) for i in range(60)]
    df = ML.compact(ML.with_vector(spark.createDataFrame(rows, "id long, label int, features array<double>")))
    names = ["a", "b", "c"]
    for model in (ML.tree(3, 1).fit(df), ML.logistic(1.0, 60).fit(df)):
        table = ML.importance_table(spark, model, names)
        top = [(r["feature"], r["rank"]) for r in ML.top_importance(table, 2).collect()]
        assert top[0] == ("a", 1) and len(top) == 2 and table.count() == 3
    coef = np.abs(np.array(ML.coefficient_table(model))).mean(axis=0)
    got = {r["feature"]: r["importance"] for r in table.collect()}
    assert got["a"] == pytest.approx(coef[0]) and got["c"] == pytest.approx(coef[2])


def test_rfe_query_starts_from_1000_and_drops_50(spark, monkeypatch):
    seen = {}

    def survivors(train, k):
        seen["start"] = k
        return list(range(k)), train

    monkeypatch.setattr(MD, "_base", lambda *a: (None, None))
    monkeypatch.setattr(MD, "_survivors", survivors)
    monkeypatch.setattr(ML, "rfe", lambda rows, n, step: seen.update(n=n, step=step) or list(range(n)))
    assert MD.q_rfe_select(spark, SMALL).count() == 25 and seen == {"start": 1000, "n": 25, "step": 50}


def test_rfe_fits_one_model_a_class(spark, monkeypatch):
    fits = []
    fit = L.fit_joint
    monkeypatch.setattr(L, "fit_joint", lambda rows, problems, *a, **k: fits.append([p.cls for p in problems]) or fit(rows, problems, *a, **k))
    rows = [(i, i % 3, [float(i % 3), float(i % 5), float(i % 3 == 1) * 4, 1.0, float(i % 7), float(i % 2)]) for i in range(90)]
    df = ML.compact(spark.createDataFrame(rows, "id long, label int, features array<double>"))
    assert len(ML.rfe(df, 2, 2)) == 2 and fits == [[0, 1, 2]] * 2


def test_rows_without_features_leave_the_moments(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, None), (3, [1.0, 2.0, 4.0]), (4, [3.0, None, 5.0])]
    df = spark.createDataFrame(rows, "id long, features array<double>").coalesce(1)
    got = {r.feature_id: r for r in expanded_moments(df).collect()}
    assert len(got) == 15 and [got[i].n for i in range(3)] == [3, 2, 3] and got[1].n_null == 1
    assert got[0].mean == pytest.approx(5 / 3) and got[1].mean == 2.0 and got[2].mean == 4.0
    ragged = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "features array<double>").coalesce(1)
    with pytest.raises(Exception, match="between 1 and 2 features"):
        expanded_moments(ragged).collect()


@pytest.mark.parametrize("same_label", [True, False])
def test_pruned_neighbours_equal_brute_force(spark, same_label):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(24, 6)) * 20
    x = centres[rng.integers(0, 24, 1500)] + rng.normal(size=(1500, 6))
    x[:400] = x[0]                      # one point holds more than a quarter of the rows
    x = np.round(x, 3)                  # ties
    y = rng.integers(0, 3, 1500)
    df = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(1500)], "id long, label int, features array<double>").repartition(3)
    query = df.where("id % 5 = 0")
    block = 50
    got = {r.qid: [n.id for n in r.nn] for r in K.neighbours(df, query, 4, block, exclude_self=True, same_label=same_label).collect()}
    assert len(got) == 300
    for q in range(0, 1500, 5):
        pool = [i for i in range(1500) if i != q and (not same_label or y[i] == y[q])]
        d = ((x[pool] - x[q]) ** 2).sum(1)
        want = [pool[j] for j in np.lexsort((pool, np.round(d, 9)))[:4]]
        dist = lambda ids: [round(((x[i] - x[q]) ** 2).sum(), 6) for i in ids]
        assert dist(got[q]) == dist(want)
        if dist(want)[-1] == 0:
            assert got[q] == want
    if not same_label:
        local = ("element_at(transform(array(named_struct('p', pool, 'f', qf)), t -> slice(array_sort(transform(t.p, o -> named_struct('d', "
                 f"{K._dist2('o.features', 't.f')}, 'id', o.id, 'label', o.label))), 1, 4)), 1)")
        nn, met = pruned_neighbours(df, query, 4, block, 1500, local=local)
        blocks = 1500 / block
        assert nn.count() == 300 and met.agg(F.avg("met")).first()[0] < 0.4 * blocks


def test_jitter_moves_synthetic_rows_only(spark):
    rows = [(i, 0, i % 2 == 0, [1.0, 2.0, 3.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label int, is_synthetic boolean, features array<double>")
    got = {r["id"]: r for r in B.jitter(df, 0.1).collect()}
    assert all(got[i]["features"] == [1.0, 2.0, 3.0] for i in range(1, 200, 2))
    moved = np.array([np.array(got[i]["features"]) - [1, 2, 3] for i in range(0, 200, 2)])
    assert (moved != 0).all() and abs(moved.mean()) < 0.03 and moved.std() == pytest.approx(0.1, rel=0.2)
    assert got == {r["id"]: r for r in B.jitter(df, 0.1).collect()}


def test_balance_falls_back_when_a_class_is_too_small(spark):
    rows = [(i, i // 10, [float(i), 1.0], 10, i % 10 + 1) for i in range(20)] + [(90 + i, 2, [0.5, float(i)], 2, i + 1) for i in range(2)]
    df = spark.createDataFrame(rows, "id long, label int, features array<double>, n_train long, trk int")
    assert B.class_sizes(df) == [2, 10, 10] and B.median_size([2, 10, 10]) == 10
    out = B.balance(df, 10)
    assert out.count() == 22 and out.where("is_synthetic").count() == 0


def test_moments_leave_one_row_a_task_and_feature(spark, monkeypatch):
    from wafercast.operators import moments
    x = np.random.default_rng(4).normal(size=(1500, 3)) + 1e3
    df = spark.createDataFrame([(i % 2, v.tolist()) for i, v in enumerate(x)], "label int, features array<double>").coalesce(1)
    got = {(r.grp, r.feature_id): r for r in moments.expanded_moments(df, group="label").collect()}
    for g in (0, 1):
        own = x[g::2]
        for f, v in ((0, own[:, 0]), (2, own[:, 2]), (3, own[:, 0] + own[:, 1])):
            assert got[g, f].n == 750 and got[g, f].mean == pytest.approx(v.mean(), rel=1e-12)
            assert got[g, f].m2 == pytest.approx(((v - v.mean()) ** 2).sum(), rel=1e-9)
    monkeypatch.setattr(moments, "merge", lambda parts, keys: parts)
    assert moments.expanded_moments(df, group="label").count() == 2 * (3 + 4 * 3)
