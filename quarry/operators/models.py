"""Regression models, grid search and the benchmark table
(M11-M24, M29, M12, M13, A18).

Every learner is a Spark ML estimator, so each fit is a distributed job over
an explicit hash fold column (M10). A feature set is assembled once into a
persisted matrix with as many partitions as its size asks for (``FitMatrix``):
tree learners run a job per level and tree, and a job's cost on a small matrix is
its tasks. All fits of a grid, folds and points alike, are handed to a bounded
number of driver threads, each with a scheduler pool of its own.

Penalty scales differ from the analysed pipeline's learners; the
``Penalized`` estimator maps (alpha, l1_ratio) at fit time from the
training rows it is given (so every CV fold uses its own n and σ_y):

* ridge:   regParam = alpha·σ_y/n, elasticNetParam = 0, normal equations
* lasso:   regParam = alpha, elasticNetParam = 1
* elastic: regParam = alpha·ρ + alpha·(1−ρ)·σ_y, elasticNetParam = alpha·ρ/regParam

with ``standardization=False`` and σ_y the population std of the training
label. Spark standardises the label internally, which divides its L2
term by σ_y; the mapping undoes that (checked against closed forms and
coordinate descent in the tests).
"""

from __future__ import annotations

import logging
import math
import threading

from pyspark import keyword_only
from pyspark import InheritableThread, StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.columns import q
from quarry.operators.linear import LINEAR_FAMILIES, linear_grid_search

log = logging.getLogger("quarry.models")


class Penalized(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol,
                DefaultParamsReadable, DefaultParamsWritable):
    """Ridge / Lasso / ElasticNet with the analysed pipeline's alpha scale."""

    kind = Param(Params._dummy(), "kind", "ridge | lasso | elastic", typeConverter=TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty strength", typeConverter=TypeConverters.toFloat)
    l1_ratio = Param(Params._dummy(), "l1_ratio", "L1 share (elastic)", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, kind="ridge", alpha=1.0, l1_ratio=0.5, featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self._setDefault(kind="ridge", alpha=1.0, l1_ratio=0.5)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        kind, a, rho = self.getOrDefault(self.kind), self.getOrDefault(self.alpha), self.getOrDefault(self.l1_ratio)
        y = F.col(self.getLabelCol()).cast("double")
        r = dataset.agg(F.count(y).alias("n"), F.stddev_pop(y).alias("sp")).first()
        n, sp = r["n"], r["sp"] or 0.0
        common = dict(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                      predictionCol=self.getPredictionCol(), standardization=False, maxIter=1000, tol=1e-10)
        if kind == "ridge":
            lr = LinearRegression(regParam=a * sp / n if n else 0.0, elasticNetParam=0.0, solver="normal", **common)
        elif kind == "lasso":
            lr = LinearRegression(regParam=a, elasticNetParam=1.0, **common)
        else:
            reg = a * rho + a * (1 - rho) * sp
            lr = LinearRegression(regParam=reg, elasticNetParam=(a * rho / reg) if reg else 0.0, **common)
        return lr.fit(dataset)


def rff_transformer(n_features: int, gamma: float, n_components: int = 64, seed: int = C.RANDOM_STATE,
                    input_cols=None) -> SQLTransformer:
    """Random Fourier features for an RBF kernel as SQL expressions
    (cos(ω·x + b)·√(2/D)); ω ~ N(0, 2γ), b ~ U(0, 2π)."""
    import numpy as np
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_components, n_features))
    b = rng.uniform(0, 2 * math.pi, size=n_components)
    cols = input_cols
    exprs = []
    scale = math.sqrt(2.0 / n_components)
    for j in range(n_components):
        dot = " + ".join(f"({float(w[j, i])!r}) * `{cols[i]}`" for i in range(n_features))
        exprs.append(f"{scale!r} * cos({dot} + {float(b[j])!r}) AS `rff_{j}`")
    return SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__")


# Each tree level is one pass over the training rows; a larger statistics budget lets
# Spark split more nodes (of all trees of a forest) per pass.
TREE_PASS_OPTS = {"maxMemoryInMB": 1024}
# A forest's pass would else lead every row down every tree from its root again; the trees are the same.
FOREST_OPTS = TREE_PASS_OPTS | {"cacheNodeIds": True}
# A boosted fit's residuals depend on all trees before: their lineage is cut this often.
BOOSTING_CHECKPOINT = 20
#: Bytes of assembled training rows per partition.
PARTITION_BYTES = 32 << 20
#: Fits that run one behind another: bytes per partition, up to so many partitions. The number
#: follows the rows alone, not the cores, as a forest's draws are seeded per partition.
SERIAL_PARTITION_BYTES, SERIAL_PARTITIONS = 4 << 20, 8
#: Fits of a grid that run at the same time, at least.
CONCURRENT_FITS = 8
#: Cores of an executor where `spark.executor.cores` does not say (copies beyond the executors are not made), and the most copies of a matrix.
EXECUTOR_CORES, MOST_COPIES = 2, 8


def scale_gamma(train: DataFrame | None, features) -> float:
    """The 'scale' width of an RBF kernel: 1 / (columns · variance of the whole matrix)."""
    d = len(features)
    if train is None or not d:
        return 1.0 / max(d, 1)
    x = [F.col(q(f)).cast("double") for f in features]
    r = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)], *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(x)]).first()
    means = [r[f"m{i}"] or 0.0 for i in range(d)]
    grand = sum(means) / d
    total = sum((r[f"v{i}"] or 0.0) + (means[i] - grand) ** 2 for i in range(d)) / d
    return 1.0 / (d * total) if total else 1.0 / d


def _grid_str(params: dict) -> str:
    return "{" + ", ".join(f"'{k}': {v!r}" for k, v in params.items()) + "}"


def model_spec(name: str, features, train: DataFrame | None = None, label: str = "label"):
    """(estimator pipeline, [(sklearn-style params dict, ParamMap)], note) for one model family."""
    import itertools
    grid = C.PARAM_GRIDS.get(name, {})
    keys = list(grid)
    points = [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])] or [{}]
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    note = ""
    if name == "Linear Regression":
        est = LinearRegression(regParam=0.0, solver="normal", standardization=False, labelCol=label)
        maps = [(p, {}) for p in points]
    elif name in ("Ridge", "Lasso", "ElasticNet"):
        kind = {"Ridge": "ridge", "Lasso": "lasso", "ElasticNet": "elastic"}[name]
        est = Penalized(kind=kind, labelCol=label)
        maps = [(p, {est.alpha: p["alpha"], **({est.l1_ratio: p["l1_ratio"]} if "l1_ratio" in p else {})})
                for p in points]
    elif name == "SVR":
        # re-aimed: huber regression on the features (linear kernel) or on random
        # Fourier features (rbf kernel); C maps to regParam = 1/(C·n). Approximate.
        note = " [approximate: huber loss; rbf via random Fourier features]"
        n = train.count() if train is not None else 1
        d = len(features)
        gamma = scale_gamma(train, features)
        rff = rff_transformer(d, gamma, n_components=64, input_cols=list(features))
        rff_cols = [f"rff_{j}" for j in range(64)]
        va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
        est = LinearRegression(loss="huber", labelCol=label, maxIter=200)
        maps = [(p, {va.inputCols: list(features) if p["kernel"] == "linear" else rff_cols,
                     est.regParam: 1.0 / (p["C"] * max(n, 1))}) for p in points]
        return Pipeline(stages=[rff, va, est]), maps, note
    elif name == "Decision Tree":
        est = DecisionTreeRegressor(seed=C.RANDOM_STATE, labelCol=label, maxBins=64, **TREE_PASS_OPTS)
        maps = [(p, {est.maxDepth: p["max_depth"], est.minInstancesPerNode: p["min_samples_leaf"]}) for p in points]
    elif name == "Random Forest":
        est = RandomForestRegressor(seed=C.RANDOM_STATE, featureSubsetStrategy="all", labelCol=label, maxBins=64,
                                    **FOREST_OPTS)
        maps = [(p, {est.numTrees: p["n_estimators"], est.maxDepth: p["max_depth"],
                     est.minInstancesPerNode: p["min_samples_leaf"]}) for p in points]
    elif name == "Gradient Boosting":
        note = " [first tree unshrunk]"
        est = GBTRegressor(seed=C.RANDOM_STATE, labelCol=label, maxBins=64, checkpointInterval=BOOSTING_CHECKPOINT, **TREE_PASS_OPTS)
        maps = [(p, {est.maxIter: p["n_estimators"], est.stepSize: p["learning_rate"], est.maxDepth: p["max_depth"]})
                for p in points]
    elif name in C.BOOSTING_ALIASES:
        raise ValueError(f"{name} is another implementation of boosted trees; use Gradient Boosting")
    else:
        raise ValueError(f"unknown model {name}")
    pipe = Pipeline(stages=[va, est])
    return pipe, maps, note


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """R², MSE, MAE (and RMSE) in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    agg = pred.agg(F.count(F.lit(1)).alias("n"), F.sum((y - p) * (y - p)).alias("sse"),
                   F.var_pop(y).alias("vy"), F.avg(F.abs(y - p)).alias("mae"))
    return agg.select(
        (1 - F.try_divide(F.col("sse"), F.col("vy") * F.col("n"))).alias("r2"),
        (F.col("sse") / F.col("n")).alias("mse"), F.col("mae"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))


def copies(spark, parts: int) -> int:
    """Executors that keep a matrix of so many partitions. Spark runs a fit where its rows are
    kept: with one copy of a few partitions, a grid's fits would crowd on the executors that
    have them, and the others stay idle."""
    sc = spark.sparkContext
    if sc.master.split("[")[0] == "local" or parts >= sc.defaultParallelism:
        return 1
    cores = int(sc.getConf().get("spark.executor.cores", str(EXECUTOR_CORES)))
    return max(1, min(MOST_COPIES, -(-sc.defaultParallelism // cores)))


class FitMatrix:
    """Training rows of one feature set, assembled once: label, fold and the
    features (by the transformers of a model's pipeline before its learner).
    ``serial``: its fits wait for one another, so each is spread over more tasks;
    else a small matrix is kept on several executors, for its fits to spread over them."""

    def __init__(self, train: DataFrame, features, label: str = "label", fold_col: str = "fold", serial: bool = False):
        self.train, self.features, self.label, self.fold, self.serial = train, list(features), label, fold_col, serial
        self._made: dict[str, DataFrame] = {}
        self.rows = train.count()

    def of(self, name: str, stages) -> DataFrame:
        if name not in self._made:
            df = self.train
            for stage in stages:
                df = stage.transform(df)
            width = 8 * len(stages[-1].getInputCols()) + 48
            parts = max(1, -(-self.rows * width // PARTITION_BYTES))
            if self.serial:
                parts = max(parts, min(SERIAL_PARTITIONS, -(-self.rows * width // SERIAL_PARTITION_BYTES)))
            slim = df.select("features", F.col(self.label).cast("double").alias(self.label), self.fold)
            # fewer partitions without a shuffle; more by an even one
            slim = slim.coalesce(parts) if parts <= df.rdd.getNumPartitions() else slim.repartition(parts)
            level = StorageLevel(True, True, False, False, 1 if self.serial else copies(df.sparkSession, parts))
            self._made[name] = slim.persist(level)
        return self._made[name]

    def release(self) -> None:
        for df in self._made.values():
            df.unpersist()
        self._made.clear()


def concurrent_fits(spark, name: str) -> int:
    """Fits of a grid that run at the same time: a core each, as a small matrix is one
    partition; two boosted ones, whose short jobs leave a core idle between them."""
    return max(CONCURRENT_FITS, spark.sparkContext.defaultParallelism * (2 if name == "Gradient Boosting" else 1))


def run_fits(spark, jobs: list, concurrent: int = CONCURRENT_FITS) -> list:
    """Results of the calls in order, at most `concurrent` at a time, each thread
    in a scheduler pool of its own (with FAIR scheduling, pools share the executors evenly)."""
    results, errors, lock, at = [None] * len(jobs), [], threading.Lock(), iter(range(len(jobs)))

    def work(pool: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit{pool}")
        while not errors:
            with lock:
                k = next(at, None)
            if k is None:
                return
            try:
                results[k] = jobs[k]()
            except Exception as e:  # noqa: BLE001 - raised below, in the caller's thread
                errors.append(e)

    threads = [InheritableThread(target=work, args=(i,)) for i in range(min(concurrent, len(jobs)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return results


_LARGER_IS_BETTER = {"r2"}


def grid_search(name: str, train: DataFrame, features, label: str = "label", fold_col: str = "fold",
                n_folds: int = C.N_SPLITS_CV, metric: str = "mse", parallelism: int | None = None, matrix: FitMatrix | None = None):
    """Every grid point on every fold, mean score, best params, refit
    on all training rows; `parallelism` fits at a time (None: by the cores). Returns (best PipelineModel, params dict, cv table rows, note)."""
    pipe, maps, note = model_spec(name, features, train, label)
    own = matrix is None
    matrix = matrix or FitMatrix(train, features, label, fold_col)
    *before, learner = pipe.getStages()
    try:
        def staged(params: dict):
            """The transformers and the learner at a grid point, and the matrix they need."""
            stages = [stage.copy({p: v for p, v in params.items() if p.parent == stage.uid}) for stage in before]
            inputs = stages[-1].getInputCols()
            plain = list(inputs) == matrix.features
            return stages, learner.copy({p: v for p, v in params.items() if p.parent == learner.uid}), matrix.of("plain" if plain else name, stages[-1:] if plain else stages)

        points = [staged(m) for _, m in maps]
        for _, _, df in points:
            df.count()  # assembled before the fits begin, once per matrix

        def score(est, df, k):
            model = est.fit(df.where(F.col(fold_col) != k))
            return regression_metrics(model.transform(df.where(F.col(fold_col) == k)), label).first()[metric]

        scores = run_fits(train.sparkSession, [lambda e=e, d=d, k=k: score(e, d, k) for _, e, d in points for k in range(n_folds)],
                          parallelism or concurrent_fits(train.sparkSession, name))
        means = [sum(scores[i * n_folds : (i + 1) * n_folds]) / n_folds for i in range(len(points))]
        best = means.index(max(means) if metric in _LARGER_IS_BETTER else min(means))
        stages, est, df = points[best]
        return PipelineModel(stages=[*stages, est.fit(df)]), maps[best][0], [(_grid_str(p), v) for (p, _), v in zip(maps, means)], note
    finally:
        if own:
            matrix.release()


RESULT_SCHEMA = ("`Model` string, `Feature Set Name` string, `Number of Features` int, `Threshold Value` double, "
                 "`Best Params` string, `Test R2 Score` double, `Test MSE` double, `Test MAE` double, "
                 "`Position` int, `Error` string")


def benchmark(train: DataFrame, test: DataFrame, features, models=C.SPARK_MODEL_NAMES,
              thresholds=C.CLUSTERING_THRESHOLDS_TO_TEST, label: str = "label", fold_col: str = "fold",
              metric: str = "mse", store=None, assoc: DataFrame | None = None, parallelism: int | None = None,
              cv_out: list | None = None):
    """Thresholds × models sweep → result table.

    The linear families share one sufficient-statistics pass
    (``quarry.operators.linear``); the others share one assembled matrix.
    ``train`` must carry the fold column. Each threshold picks a feature
    set with M9+A17 on the training association table; a failing model
    keeps its row, with the error and no scores. Position numbers the rows
    in the order of the sweep. Returns (results DataFrame, {combo_key: model}).
    """
    from quarry.operators.assoc import association_matrix, select_by_clustering
    from quarry.operators.project import align_columns
    spark = train.sparkSession
    rows, fitted = [], {}
    train, matrix = train.persist(), None
    try:
        for t in thresholds:
            label_fs = "Original Features" if t is None else f"Clustered (Thresh={t})"
            if t is None:
                feats = list(features)
            else:
                a = assoc if assoc is not None else association_matrix(train.select(*[q(f) for f in features]), list(features))
                feats = select_by_clustering(a, features, t)
            test_fs = align_columns(test, feats, keep=("row_id", label))
            lin = [m for m in models if m in LINEAR_FAMILIES]
            lin_fits: dict = {}
            if matrix is not None:
                matrix.release()
            matrix = FitMatrix(train, feats, label, fold_col)
            for name in models:
                head = (name, label_fs, len(feats), None if t is None else float(t))
                try:
                    if name in lin and metric in ("mse", "rmse"):
                        lin_fits = lin_fits or linear_grid_search(train, feats, lin, label, fold_col)
                        model, params, table = lin_fits[name]
                        cv = [(_grid_str(p), v) for p, v in table]
                        note = ""
                    else:
                        model, params, cv, note = grid_search(name, train, feats, label, fold_col, metric=metric,
                                                              parallelism=parallelism, matrix=matrix)
                    if cv_out is not None:
                        cv_out += [(name, label_fs, p, float(v)) for p, v in cv]
                    m = regression_metrics(model.transform(test_fs), label).first()
                    key = f"{name}_{label_fs}"
                    fitted[key] = (model, feats)
                    if store is not None:
                        store.put(key, name, label_fs, model)
                    rows.append((*head, _grid_str(params) + note, m["r2"], m["mse"], m["mae"], len(rows), None))
                except Exception as e:  # noqa: BLE001 - the sweep keeps going; the row says what failed
                    log.error("model %s on %s failed: %s", name, label_fs, e)
                    rows.append((*head, None, None, None, None, len(rows), f"{type(e).__name__}: {e}"[:500]))
    finally:
        train.unpersist()
        if matrix is not None:
            matrix.release()
    return spark.createDataFrame(rows, RESULT_SCHEMA), fitted


def predict(model, df: DataFrame, features, keep=("row_id", "label")) -> DataFrame:
    """Align test columns to the training feature list, then score."""
    from quarry.operators.project import align_columns
    return model.transform(align_columns(df, features, keep=keep))


def cv_results(spark, cv_rows, metric: str = "mse") -> DataFrame:
    """Grid points with their mean validation error and the scoring value
    (C14: negative MSE / RMSE, larger is better)."""
    from quarry.functions.columns import neg_mse
    df = spark.createDataFrame(cv_rows, f"model string, feature_set string, params string, mean_{metric} double")
    return df.withColumn("mean_test_score", neg_mse(f"mean_{metric}"))
