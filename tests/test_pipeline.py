import pytest

from quarry.plans.fixtures import d1
from quarry.session import scratch_path
from tests.conftest import SF


def test_run_pipeline_end_to_end(spark):
    from quarry.plans.pipeline import run_pipeline
    from quarry.sources.io import ModelStore
    out = scratch_path(spark, "pipe")
    res = run_pipeline(spark, d1(spark, SF), out_dir=out, models=["Linear Regression", "Decision Tree"])
    r = res["results"]
    assert r.columns == ["Model", "Feature Set Name", "Number of Features", "Threshold Value", "Best Params",
                         "Test R2 Score", "Test MSE", "Test MAE", "Position", "Error"]
    rows = {x["Model"]: x for x in r.collect()}
    assert set(rows) == {"Linear Regression", "Decision Tree"}
    assert rows["Decision Tree"]["Best Params"].startswith("{'max_depth':")
    m = res["matrix"]
    assert {"row_id", "split", "label"} <= set(m.columns)
    assert m.filter("split = 'test'").count() > 0
    summary = res["shap_summary"].collect()
    assert summary and all(s["Original_Feature"] and "__" not in s["Original_Feature"] for s in summary)
    assert res["feature_relationship"].count() > 0
    store = ModelStore(spark, f"{out}/models")
    lin = store.get("Linear Regression_Original Features")
    assert lin is not None and len(lin.coefficients) == rows["Linear Regression"]["Number of Features"]
    assert store.get("Decision Tree_Original Features") is not None
    cv = res["cv_results"].collect()
    assert len(cv) == 1 + 6 and all(r["mean_test_score"] == -r["mean_mse"] for r in cv)
    back = spark.read.option("header", True).csv(f"{out}/results_csv").collect()
    assert len(back) == 2 and len(back[0]["Test MSE"].split(".")[1]) == 6


def test_run_pipeline_is_taken_up_after_the_last_complete_stage(spark, monkeypatch):
    from quarry.operators import models
    from quarry.plans import clean, pipeline
    out = scratch_path(spark, "restart")
    real = models.benchmark

    def broken(*args, **kw):
        raise RuntimeError("lost")

    raw = d1(spark, SF)
    monkeypatch.setattr(models, "benchmark", broken)
    with pytest.raises(RuntimeError, match="lost"):
        pipeline.run_pipeline(spark, raw, out_dir=out, models=["Linear Regression"])
    monkeypatch.setattr(models, "benchmark", real)
    again = []
    for module, name in ((clean, "fit_cleaning"), (pipeline, "preprocess"), (pipeline, "importance_input")):
        monkeypatch.setattr(module, name, lambda *a, n=name, **k: again.append(n))
    res = pipeline.run_pipeline(spark, raw, out_dir=out, models=["Linear Regression"])
    how = {r["stage"]: r["how"] for r in res["stages"].collect()}
    assert again == [] and {s for s, h in how.items() if h == "read"} == {"cleaned", "matrix", "importance_input", "mutual_information", "train_folds"}
    assert how["results"] == how["shap"] == "made"
    steps = {r["step"]: (r["rows_before"], r["rows_after"], r["rows_dropped"]) for r in res["filter_report"].collect()}
    n, null = raw.count(), raw.filter("Difference is null").count()
    assert steps["clean"] == (n, n - null, null)
    assert steps["train split"][1] == res["matrix"].filter("split = 'train'").count()
    # all is read the third time; another input or configuration makes everything anew
    monkeypatch.setattr(models, "benchmark", broken)
    third = pipeline.run_pipeline(spark, raw.repartition(3), out_dir=out, models=["Linear Regression"])
    assert {r["how"] for r in third["stages"].collect()} == {"read"}
    assert sorted(map(str, third["results"].collect())) == sorted(map(str, res["results"].collect()))
    monkeypatch.undo()
    fewer = pipeline.run_pipeline(spark, raw.filter("row_id % 2 = 0"), out_dir=out, models=["Linear Regression"], explain=False)
    assert {r["how"] for r in fewer["stages"].collect()} == {"made"}
