"""End-to-end pipeline (M30) and the AutoML-style sweep.

One driver function chains the stages as DataFrame plans; each stage's
output is written as Parquet under ``out_dir`` (a shared folder: by
default under ``spark.checkpoint.dir``) and read back, which cuts the
lineage. A run that is started again with the same ``out_dir`` takes up after the
last complete stage (``plans.stages``); rows kept and dropped per step are
counted while the stages are written (P10).
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config as C
from quarry.config import PipelineConfig
from quarry.plans.stages import Stages, counted, table_signature
from quarry.session import scratch_path


def preprocess(cleaned: DataFrame, cfg: PipelineConfig = PipelineConfig()):
    """Target, leakage filter, exact split, column transformer fitted on
    train, optional elimination (M6) and balancing (M8).
    Returns (matrix with split/label, feature names, fitted transformer)."""
    from quarry.operators.features import fit_column_transformer, smote, train_test_split
    from quarry.operators.selection import rfe
    from quarry.plans.clean import prepare_target
    y = prepare_target(cleaned, cfg)
    s = train_test_split(y, cfg.row_id, cfg.test_size, cfg.seed)
    ct = fit_column_transformer(s.filter("split = 'train'"), exclude=(cfg.row_id, "split", "label"))
    x = ct.transform(s, keep=(cfg.row_id, "split", "label"))
    feats = ct.output_names
    if cfg.perform_rfe and len(feats) > cfg.n_features_to_select:
        sel = rfe(x.filter("split = 'train'"), feats, "label", cfg.n_features_to_select, cfg.rfe_step)
        feats = [r["feature"] for r in sel.filter("selected").collect()]
        x = x.select(cfg.row_id, "split", "label", *feats)
    if cfg.balancing == "SMOTE":
        tr = smote(x.filter("split = 'train'"), feats, "label", cfg.row_id)
        x = tr.drop("synthetic").withColumn("split", F.lit("train")).unionByName(
            x.filter("split = 'test'"), allowMissingColumns=True)
    return x, feats, ct


def importance_input(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Input of the importance stage: target and numbers with nulls as the
    median, text with missing values as a category of its own."""
    from quarry.functions.columns import as_category, nan_to_null, q
    from quarry.operators.project import columns_by_type
    from quarry.operators.stats import impute_median
    df = nan_to_null(raw.drop(cfg.row_id) if cfg.row_id in raw.columns else raw)
    numeric = columns_by_type(df, "numeric")
    df = impute_median(df.select(*[F.col(q(c)).cast("double").alias(c) if c in numeric else F.col(q(c)) for c in df.columns]), numeric)
    return df.select(*[F.col(q(c)) if c in numeric else as_category(F.col(q(c))).alias(c) for c in df.columns])


def label_distribution(cleaned: DataFrame, matrix: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """A6 of the whole table, the split before balancing, and the training rows after it."""
    from quarry.operators.features import train_test_split
    from quarry.operators.stats import class_distribution
    from quarry.plans.clean import prepare_target
    y = train_test_split(prepare_target(cleaned, cfg), cfg.row_id, cfg.test_size, cfg.seed).select("label", "split")
    return class_distribution({
        "original": y, "train_before_balancing": y.filter("split = 'train'"), "test": y.filter("split = 'test'"),
        "train_after_balancing": matrix.filter("split = 'train'")})


def run_pipeline(spark: SparkSession, raw: DataFrame, cfg: PipelineConfig = PipelineConfig(),
                 out_dir: str | None = None, models=None, explain: bool = True) -> dict:
    """Clean → preprocess → describe → importance → models → explain.

    Stops at the first failing stage (the exception propagates); a further call
    with the same ``out_dir``, input and configuration reads the complete stages
    and goes on from there. Returns a dict of result DataFrames; ``stages`` lists
    which were made and which read, ``filter_report`` the rows of each step."""
    from quarry.operators.assoc import mutual_information
    from quarry.operators.explain import linear_shap, shap_summary, top_original_features, tree_shap
    from quarry.operators.features import ColumnTransformerModel, kfold
    from quarry.operators.frames import feature_relationship
    from quarry.operators.models import benchmark, cv_results, predict
    from quarry.operators.rank import best_row, top_k
    from quarry.operators.stats import actual_vs_predicted, axis_range, describe_target, histogram, paired_ttest
    from quarry.plans import clean as cleaning
    from quarry.sources.io import ModelStore, load_json, save_json, write_csv

    out = (out_dir or scratch_path(spark, "pipeline")).rstrip("/")
    names = list(models or cfg.models)
    stages = Stages(spark, out, f"{table_signature(raw)}|{sorted(asdict(cfg).items())}|{names}|{explain}")
    res: dict[str, DataFrame] = {}
    steps: list[tuple] = []
    seen: dict = {}

    def cleaned_rows():
        model = cleaning.fit_cleaning(raw, cfg)
        before, seen["raw"] = counted(raw)
        after, seen["cleaned"] = counted(cleaning.apply_cleaning(before, model, cfg))
        return after

    def rows_of(*keys):
        return {k: seen[k].get["rows"] for k in keys}

    cleaned, n = stages.run("cleaned", cleaned_rows, lambda: rows_of("raw", "cleaned"))
    steps.append(("clean", n["raw"], n["cleaned"]))
    res["cleaned"] = cleaned

    def matrix_rows():
        x, seen["features"], ct = preprocess(cleaned, cfg)
        save_json(spark, ct.to_dict(), f"{out}/transformer")
        x, seen["matrix"] = counted(x)
        return x

    x, kept = stages.run("matrix", matrix_rows, lambda: rows_of("matrix") | {"features": list(seen["features"])})
    steps.append(("preprocess", n["cleaned"], kept["matrix"]))
    feats, ct = kept["features"], ColumnTransformerModel.from_dict(load_json(spark, f"{out}/transformer"))
    res["matrix"] = x
    res["class_distribution"] = label_distribution(cleaned, x, cfg)
    res["target"] = describe_target(raw, cfg.target)
    res["histogram"] = histogram(raw, cfg.target)
    if "simulated_damage" in raw.columns and "estimated" in raw.columns:
        res["paired_ttest"] = paired_ttest(raw, "simulated_damage", "estimated")
    imp, _ = stages.run("importance_input", lambda: importance_input(raw, cfg))
    res["mutual_information"], _ = stages.run("mutual_information", lambda: mutual_information(imp, cfg.target, k=C.N_TOP_MI))

    def fold_rows():
        train, seen["train"] = counted(kfold(x.filter("split = 'train'"), cfg.row_id, cfg.n_folds, cfg.seed))
        return train

    train, m = stages.run("train_folds", fold_rows, lambda: rows_of("train"))
    steps.append(("train split", kept["matrix"], m["train"]))
    test = x.filter("split = 'test'")
    store = ModelStore(spark, f"{out}/models")

    def fits():
        cv_rows: list = []
        results, fitted = benchmark(train, test, feats, models=names, thresholds=cfg.thresholds, store=store, cv_out=cv_rows)
        seen["cv"], seen["own"] = cv_rows, {key: list(own) for key, (_, own) in fitted.items()}
        return results

    results, fit = stages.run("results", fits, lambda: {"cv": [list(r) for r in seen["cv"]], "own": seen["own"]})
    own = fit["own"]
    res["cv_results"] = cv_results(spark, [tuple(r) for r in fit["cv"]])
    write_csv(results, f"{out}/results_csv", float_format="%.6f")
    res["results"] = results
    leaders = top_k(results.filter("Error is null"), "Test R2 Score", C.N_TOP_MODELS, tiebreak=("Position",)).collect()
    keys = [f"{r['Model']}_{r['Feature Set Name']}" for r in leaders]
    if keys:
        res["actual_vs_predicted"], _ = stages.run("actual_vs_predicted", lambda: actual_vs_predicted(
            {key: predict(store.get(key), test, own[key], keep=(cfg.row_id, "label")) for key in keys}))
        res["identity_range"] = axis_range(res["actual_vs_predicted"])
    if explain and own:
        best = best_row(results, "Test R2 Score", "Position").first()
        key = f"{best['Model']}_{best['Feature Set Name']}"

        def shap_rows():
            model, mfeats = store.get(key), own[key]
            last = model.stages[-1] if hasattr(model, "stages") else model
            if hasattr(last, "coefficients"):
                return linear_shap(dict(zip(mfeats, [float(c) for c in last.coefficients])), test, background=train)
            return tree_shap(model, test, mfeats, cfg.row_id)[0]

        shap, _ = stages.run("shap", shap_rows)
        summary = shap_summary(shap, ct.categorical_columns)
        res["shap_summary"] = summary
        res["feature_relationship"] = feature_relationship(cleaned, cfg.target, top_original_features(summary))
    res["filter_report"] = spark.createDataFrame([(k, s, a, b, max(0, a - b)) for k, (s, a, b) in enumerate(steps)],
                                                 "position int, step string, rows_before long, rows_after long, rows_dropped long")
    res["stages"] = spark.createDataFrame([(s, "read") for s in stages.read] + [(s, "made") for s in stages.made], "stage string, how string")
    return res


def model_sweep_kfold(train: DataFrame, test: DataFrame, features, label: str = "label", key: str = "row_id",
                      models=C.SPARK_MODEL_NAMES, n_folds: int = C.N_SPLITS_CV, seed: str = C.SEED_TEXT):
    """M29 (re-aimed AutoML sweep): the benchmark with RMSE and folds
    stratified by the (integer) target."""
    from quarry.operators.features import kfold
    from quarry.operators.models import benchmark
    tr = kfold(train, key, n_folds, seed, stratify_by=label)
    return benchmark(tr, test, features, models=models, metric="rmse")
