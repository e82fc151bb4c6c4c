"""Inputs that look harmless: NaN outside CSV, code texts, ties, dotted names, reopened stores."""

import numpy as np
import pytest

NAN = float("nan")


def test_code_texts_are_no_numbers(spark):
    from quarry.functions.columns import to_numeric
    from quarry.sources.io import infer_schema
    df = spark.createDataFrame([("1d", "1"), ("2F", "-2.5e3"), ("0x1p3", " 7 "), ("1e", ".5")], "code string, n string")
    assert [r[0] for r in df.select(to_numeric("code")).collect()] == [None] * 4
    assert [r[0] for r in df.select(to_numeric("n")).collect()] == [1.0, -2500.0, 7.0, 0.5]
    kinds = {f.name: f.dataType.simpleString() for f in infer_schema(df).fields}
    assert kinds == {"code": "string", "n": "double"}


def test_nan_is_missing(spark):
    from quarry.operators.rank import best_row, top_k
    from quarry.operators.stats import describe_target, feature_target_corr, impute_mean
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, NAN, 4.0), (2, 5.0, NAN), (3, None, 1.0)], "i int, x double, y double")
    assert [r["x"] for r in impute_mean(df, ["x"]).orderBy("i").collect()] == [1.0, 3.0, 5.0, 3.0]
    assert [r["i"] for r in top_k(df, "x", 2, tiebreak=("i",)).collect()] == [2, 0]
    assert best_row(df, "x", "i").first()["i"] == 2
    two = describe_target(df, "x").first()
    assert two["n"] == 2 and two["skew"] is None and two["skew_verdict"] is None
    assert feature_target_corr(df.select("x", "y"), "x", k=None).first()["corr"] is None  # one complete pair


def test_large_doubles_as_text(spark):
    from quarry.functions.columns import as_category
    df = spark.createDataFrame([(1.5e7,), (1.0e7,), (0.0001,), (2.5,), (NAN,), (None,)], "x double")
    assert [r[0] for r in df.select(as_category("x")).collect()] == ["15000000.0", "10000000.0", "0.0001", "2.5", "nan", "nan"]
    assert spark.createDataFrame([("1E7",)], "s string").select(as_category("s")).first()[0] == "1E7"


def test_store_keeps_its_manifest_when_reopened(spark, tmp_path):
    from quarry.operators.linear import LinearExpressionModel
    from quarry.sources.io import ModelStore
    for key in ("a", "b"):
        ModelStore(spark, str(tmp_path / "s")).put(key, key, "all", LinearExpressionModel(["x"], [1.0], 2.0))
    assert {r["combo_key"] for r in ModelStore(spark, str(tmp_path / "s")).manifest().collect()} == {"a", "b"}


def test_wide_linear_expression_plans(spark):
    from quarry.operators.linear import LinearExpressionModel
    names = [f"x.{i}" for i in range(3000)]
    df = spark.createDataFrame([tuple([1.0] * 3000)], ", ".join(f"`{n}` double" for n in names))
    assert LinearExpressionModel(names, [2.0] * 3000, 1.0).transform(df).select("prediction").first()[0] == 6001.0


def test_smote_names_classes_without_neighbours(spark):
    from quarry.operators.features import smote
    df = spark.createDataFrame([(i, 0, float(i)) for i in range(10)] + [(10, 1, 0.0)], "row_id long, label int, x double")
    with pytest.raises(ValueError, match="one row"):
        smote(df, ["x"])


def test_neighbours_do_not_depend_on_blocks(spark):
    from quarry.operators.knn import knn_within_class
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, 0, float(rng.integers(2)), float(rng.integers(2))) for i in range(90)], "row_id long, label int, a double, b double")
    one, two = (sorted(map(tuple, knn_within_class(df, ["a", "b"], "label", "row_id", 5, n).collect())) for n in (4096, 16))
    assert one == two


def test_folds_of_few_rows(spark):
    from quarry.operators.features import kfold
    df = spark.createDataFrame([(i, None if i == 0 else i % 2) for i in range(9)], "row_id long, g int")
    assert sorted(r["fold"] for r in kfold(df.limit(3), "row_id", 5).collect()) == [0, 1, 2]
    out = kfold(df, "row_id", 5, stratify_by="g")
    assert out.columns == ["row_id", "g", "fold"] and out.count() == 9
    sizes = {(r["g"], r["fold"]): r["count"] for r in out.groupBy("g", "fold").count().collect()}
    assert max(sizes.values()) == 1


def test_box_stats_of_the_null_group(spark):
    from quarry.operators.stats import box_stats
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, NAN)], "g string, x double")
    assert {r["g"]: (r["n"], r["median"]) for r in box_stats(df, "x", ["g"]).collect()} == {"a": (2, 2.0), None: (1, 2.0)}


def test_sparse_matrix_has_no_column_per_category(spark):
    from pyspark.ml.functions import vector_to_array
    from quarry.operators.features import fit_sparse_matrix
    df = spark.createDataFrame([(i, float(i), f"St. {i % 40:02d}", None if i % 2 else "z") for i in range(80)],
                               "row_id long, x double, town string, t string")
    m = fit_sparse_matrix(df)
    rows = m.transform(df).select("row_id", vector_to_array("features").alias("v")).collect()
    for r in rows:
        assert len(r["v"]) == 42 and r["v"][1 + r["row_id"] % 40] == 1.0 and r["v"][41] == (r["row_id"] + 1) % 2
    other = spark.createDataFrame([(1, 2.0, "unseen", None)], df.schema)
    assert sum(m.transform(other).select(vector_to_array("features")).first()[0][1:]) == 0


def test_importance_input_keeps_missing_text_as_a_category(spark):
    from dataclasses import replace
    from quarry.config import PipelineConfig
    from quarry.plans.pipeline import importance_input
    df = spark.createDataFrame([(0, 1.0, "a"), (1, None, None), (2, 5.0, "b"), (3, NAN, "a")], "row_id long, y double, s string")
    out = importance_input(df, replace(PipelineConfig(), target="y")).collect()
    assert sorted((r["y"], r["s"]) for r in out) == [(1.0, "a"), (3.0, "a"), (3.0, "nan"), (5.0, "b")]
