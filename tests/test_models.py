import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor

from quarry.operators.explain import leaf_paths, linear_shap, tree_shap, tree_tables
from quarry.operators.models import Penalized, regression_metrics


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(400, 3)) * [1.0, 3.0, 0.5]
    y = 1.5 * X[:, 0] - 0.7 * X[:, 1] + 0.2 * X[:, 2] + rng.normal(scale=0.5, size=400) + 4
    df = spark.createDataFrame([(i, *map(float, x), float(v)) for i, (x, v) in enumerate(zip(X, y))],
                               "row_id long, a double, b double, c double, label double")
    return X, y, df


def _fit(df, est):
    return Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), est]).fit(df)


def test_ridge_mapping_matches_closed_form(data):
    X, y, df = data
    for alpha in (0.1, 10.0, 1000.0):
        lm = _fit(df, Penalized(kind="ridge", alpha=alpha)).stages[-1]
        Xc, yc = X - X.mean(0), y - y.mean()
        w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
        assert np.allclose(lm.coefficients.toArray(), w, atol=1e-7)


def _enet_cd(X, y, alpha, rho, iters=5000):
    n = len(y)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.zeros(X.shape[1])
    for _ in range(iters):
        for j in range(X.shape[1]):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            z = Xc[:, j] @ r / n
            w[j] = np.sign(z) * max(abs(z) - alpha * rho, 0) / (Xc[:, j] @ Xc[:, j] / n + alpha * (1 - rho))
    return w


@pytest.mark.parametrize("kind,alpha,rho", [("lasso", 0.1, 1.0), ("lasso", 1.0, 1.0), ("elastic", 0.1, 0.5),
                                            ("elastic", 1.0, 0.1), ("elastic", 10.0, 0.9)])
def test_l1_mappings_match_coordinate_descent(data, kind, alpha, rho):
    X, y, df = data
    est = Penalized(kind=kind, alpha=alpha, l1_ratio=rho)
    lm = _fit(df, est).stages[-1]
    assert np.allclose(lm.coefficients.toArray(), _enet_cd(X, y, alpha, rho), atol=1e-4)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    r = regression_metrics(df).first()
    assert r["mse"] == pytest.approx((0.25 + 0 + 1) / 3) and r["mae"] == pytest.approx(0.5)
    assert r["r2"] == pytest.approx(1 - 1.25 / 2.0)


def _brute_shap(nodes, x, d):
    by = {r["id"]: r for r in nodes}

    def ev(nid, S):
        n = by[nid]
        if n["leftChild"] < 0:
            return n["prediction"]
        f, t = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]
        L, R = by[n["leftChild"]], by[n["rightChild"]]
        if f in S:
            return ev(L["id"] if x[f] <= t else R["id"], S)
        return (L["rawCount"] * ev(L["id"], S) + R["rawCount"] * ev(R["id"], S)) / n["rawCount"]

    root = min(by)
    phi = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for k in range(d):
            for S in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                phi[i] += w * (ev(root, set(S) | {i}) - ev(root, set(S)))
    return phi


@pytest.mark.parametrize("kind", ["dt", "rf", "gbt"])
def test_tree_shap_additive_and_exact(spark, data, kind):
    X, y, df = data
    est = {"dt": lambda: DecisionTreeRegressor(maxDepth=4, seed=1),
           "rf": lambda: RandomForestRegressor(numTrees=4, maxDepth=3, seed=1),
           "gbt": lambda: GBTRegressor(maxIter=4, maxDepth=3, seed=1)}[kind]()
    model = _fit(df, est)
    shap, base = tree_shap(model, df, ["a", "b", "c"])
    phi = {}
    for r in shap.collect():
        phi.setdefault(r["row_id"], {})[r["feature"]] = r["shap"]
    preds = {r["row_id"]: r["prediction"] for r in model.transform(df).collect()}
    for rid in range(0, 400, 37):
        assert sum(phi[rid].values()) + base == pytest.approx(preds[rid], abs=1e-8)
    if isinstance(est, DecisionTreeRegressor):
        nodes, _ = tree_tables(model, spark)
        for rid in (0, 5, 99):
            want = _brute_shap(nodes[0], X[rid], 3)
            assert [phi[rid][f] for f in "abc"] == pytest.approx(list(want), abs=1e-9)
        leaves, ev = leaf_paths(nodes[0])
        assert ev == pytest.approx(sum(base for _ in [0]))


def test_linear_shap_sums_to_centered_prediction(spark, data):
    X, y, df = data
    coefs = {"a": 2.0, "b": -1.0, "c": 0.5}
    rows = linear_shap(coefs, df).groupBy("row_id").sum("shap").collect()
    mean = X.mean(0)
    got = {r[0]: r[1] for r in rows}
    for rid in (0, 10, 200):
        assert got[rid] == pytest.approx(float(np.dot([2.0, -1.0, 0.5], X[rid] - mean)))


def test_linear_grid_from_statistics_matches_direct_solutions(spark, data):
    from pyspark.sql import functions as F
    from quarry.operators.linear import gram_stats, linear_grid_search, solve, sse
    X, y, df = data
    folds = df.withColumn("fold", (F.col("row_id") % 5).cast("int"))
    st = gram_stats(folds, ["a", "b", "c"], "label", "fold")
    assert sum(s.n for s in st.values()) == 400
    total = st[0] + st[1] + st[2] + st[3] + st[4]
    w, b = solve("Ridge", {"alpha": 10.0}, total)
    Xc, yc = X - X.mean(0), y - y.mean()
    assert np.allclose(w, np.linalg.solve(Xc.T @ Xc + 10.0 * np.eye(3), Xc.T @ yc))
    w, b = solve("ElasticNet", {"alpha": 1.0, "l1_ratio": 0.1}, total)
    assert np.allclose(w, _enet_cd(X, y, 1.0, 0.1), atol=1e-8)
    assert sse(total, w, b) == pytest.approx(float(((y - b - X @ w) ** 2).sum()))
    res = linear_grid_search(folds, ["a", "b", "c"], stats=st)
    model, params, table = res["Ridge"]
    assert params == {"alpha": 0.1} or len(table) == 3
    pred = model.transform(df).select("prediction").first()[0]
    assert pred == pytest.approx(model.intercept + float(np.dot(model.coefficients, X[0])))


def test_elimination_spreads_its_fits(spark, monkeypatch):
    """RFE's rounds wait for one another: a matrix of 9 MB has a task for each 4 MB, one of a grid a single one."""
    from quarry.operators import selection
    from quarry.operators.models import FitMatrix
    from quarry.operators.selection import rfe
    n = 140_000
    rows = spark.range(n).selectExpr("id AS row_id", "cast(id % 7 as double) AS a", "cast(id % 11 as double) AS b", "cast(id % 7 as double) AS label", "0 AS fold")
    seen, fit = [], selection._importances
    monkeypatch.setattr(selection, "_importances", lambda df, *x: seen.append((df.rdd.getNumPartitions(), df.count())) or fit(df, *x))
    got = {r["feature"]: r["ranking"] for r in rfe(rows, ["a", "b"], n_select=1, step=1, num_trees=3, max_depth=3).collect()}
    assert got == {"a": 1, "b": 2}
    assert seen == [(-(-n * 64 // (4 << 20)), n)] == [(3, n)]
    grid = FitMatrix(rows, ["a", "b"])
    try:
        assert grid.of("plain", [VectorAssembler(inputCols=["a", "b"], outputCol="features")]).rdd.getNumPartitions() == 1
    finally:
        grid.release()


def test_grids_fill_the_cores_and_forests_keep_their_nodes(spark, data):
    """A forest keeps the node of every row between passes, with the same trees; a grid's fits follow the cores."""
    from types import SimpleNamespace as Namespace
    from quarry.operators.models import CONCURRENT_FITS, concurrent_fits, model_spec
    _, _, df = data
    forest = model_spec("Random Forest", ["a", "b", "c"])[0].getStages()[-1]
    assert forest.getCacheNodeIds()
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    trees = [[t.toDebugString.split("\n")[1:] for t in forest.copy({forest.numTrees: 5, forest.maxDepth: 6, forest.cacheNodeIds: c}).fit(rows).trees]
             for c in (True, False)]
    assert trees[0] == trees[1] and len(trees[0]) == 5
    for cores, fits, boosted in ((12, 12, 24), (4, CONCURRENT_FITS, 8), (1, CONCURRENT_FITS, CONCURRENT_FITS)):
        on = Namespace(sparkContext=Namespace(defaultParallelism=cores))
        assert (concurrent_fits(on, "Random Forest"), concurrent_fits(on, "Gradient Boosting")) == (fits, boosted)


def test_small_matrices_are_kept_on_several_executors(spark, monkeypatch):
    """Fits run where their rows are: a matrix of few partitions is kept on every executor, one for fits in a row once."""
    from types import SimpleNamespace as Namespace
    from quarry.operators import models
    session = lambda master, slots, **conf: Namespace(sparkContext=Namespace(master=master, defaultParallelism=slots, getConf=lambda: {f"spark.executor.{k}": v for k, v in conf.items()}))
    assert models.copies(session("spark://host:7077", 12, cores="4"), 1) == 3
    assert models.copies(session("spark://host:7077", 12), 1) == 6
    assert models.copies(session("spark://host:7077", 400, cores="4"), 2) == models.MOST_COPIES
    assert models.copies(session("spark://host:7077", 12, cores="4"), 12) == 1
    assert models.copies(spark, 1) == 1
    monkeypatch.setattr(models, "copies", lambda s, parts: 3)
    rows = spark.range(50).selectExpr("id AS row_id", "cast(id as double) AS a", "cast(id as double) AS label", "0 AS fold")
    for serial, kept in ((False, 3), (True, 1)):
        matrix = models.FitMatrix(rows, ["a"], serial=serial)
        try:
            df = matrix.of("plain", [VectorAssembler(inputCols=["a"], outputCol="features")])
            assert (df.storageLevel.replication, df.storageLevel.useMemory, df.storageLevel.useDisk, df.count()) == (kept, True, True, 50)
        finally:
            matrix.release()


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_elimination_keeps_node_ids_and_its_trees(spark, monkeypatch, kind):
    from quarry.operators import selection
    rows = spark.createDataFrame([(i, float(i % 7), float(i * 37 % 11), float(i % 3)) for i in range(300)], "row_id long, a double, b double, label double")
    made = {}
    for opts in (dict(selection.FOREST_OPTS), {}):
        monkeypatch.setattr(selection, "FOREST_OPTS", opts)
        matrix, df = selection._matrix(rows, ["a", "b"], "label", None)
        model, _ = selection._importances(df, [0, 1], "label", kind, 3, 5, 42)
        matrix.release()
        forest = model.stages[-1]
        made[forest.getCacheNodeIds()] = forest.toDebugString.split("\n", 1)[1]
    assert made[True] == made[False]
