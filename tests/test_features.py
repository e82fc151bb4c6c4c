import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.features import (fit_column_transformer, fit_standard_scaler, hash_key, hash_rank,
                                       kfold, label_encode, one_hot, smote, train_test_split)


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(1003).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("g"),
                                    (F.col("id") * 0.5).alias("x"))


def test_hash_rank_equals_global_window(spark, keyed):
    a = {r["row_id"]: r["_rank"] for r in hash_rank(keyed, "row_id", ":42", prefix_len=2).collect()}
    w = Window.orderBy(hash_key("row_id", ":42"), "row_id")
    b = {r["row_id"]: r["r"] for r in keyed.select("row_id", F.row_number().over(w).alias("r")).collect()}
    assert a == b


def test_split_exact_disjoint_complete(keyed):
    s = train_test_split(keyed, "row_id", 0.2)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"test": math.ceil(0.2 * 1003), "train": 1003 - math.ceil(0.2 * 1003)}
    assert s.select("row_id").distinct().count() == 1003


def test_folds_sizes(keyed):
    f = kfold(keyed, "row_id", 5)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1003
    fs = kfold(keyed, "row_id", 5, stratify_by="g")
    for g in range(3):
        sz = [r["count"] for r in fs.filter(F.col("g") == g).groupBy("fold").count().collect()]
        assert max(sz) - min(sz) <= 1


def test_scaler_population_std(keyed):
    m = fit_standard_scaler(keyed, ["x"])
    out = keyed.select(*m.exprs())
    r = out.agg(F.avg("x").alias("m"), F.var_pop("x").alias("v")).first()
    assert abs(r["m"]) < 1e-12 and r["v"] == pytest.approx(1.0)
    const = keyed.withColumn("c", F.lit(3.0))
    assert fit_standard_scaler(const, ["c"]).scales["c"] == 1.0


def test_one_hot_unseen_and_transformer(spark):
    train = spark.createDataFrame([(1, "b", 1.0, True), (2, "a", 3.0, False)], "row_id long, s string, x double, f boolean")
    test = spark.createDataFrame([(3, "zz", 2.0, True)], "row_id long, s string, x double, f boolean")
    oh = one_hot(test, ["s"], fit_on=train)
    assert oh.columns == ["row_id", "x", "f", "cat__s_a", "cat__s_b"]
    assert oh.first()["cat__s_a"] == 0.0 and oh.first()["cat__s_b"] == 0.0
    ct = fit_column_transformer(train, exclude=("row_id",))
    assert ct.output_names == ["num__x", "cat__s_a", "cat__s_b", "remainder__f"]
    row = ct.transform(train).orderBy("row_id").first()
    assert row["num__x"] == pytest.approx(-1.0) and row["cat__s_b"] == 1.0 and row["remainder__f"] == 1.0


def test_label_encode_sorted(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "a")], "row_id long, s string")
    got = {r["row_id"]: r["s"] for r in label_encode(df, ["s"]).collect()}
    assert got == {1: 1, 2: 0, 3: 2, 4: 0}


def test_smote_balances_with_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 0, float(v)) for i, v in enumerate(rng.normal(size=60))]
    rows += [(100 + i, 1, float(v)) for i, v in enumerate(rng.normal(10, 1, size=12))]
    df = spark.createDataFrame(rows, "row_id long, label int, x double")
    out = smote(df, ["x"], "label", "row_id", k=3, block_rows=5)
    counts = {(r["label"], r["synthetic"]): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts[(1, False)] + counts[(1, True)] == 60
    syn = [r["x"] for r in out.filter("synthetic").collect()]
    minority = [v for _, c, v in rows if c == 1]
    assert min(minority) <= min(syn) and max(syn) <= max(minority)


def test_split_edge_sizes(keyed):
    none = train_test_split(keyed, "row_id", 0.0)
    assert none.filter("split = 'test'").count() == 0
    every = train_test_split(keyed, "row_id", 1.0)
    assert every.filter("split = 'train'").count() == 0
    one = train_test_split(keyed, "row_id", 1 / 1003)
    first = keyed.select("row_id", hash_key("row_id", ":42").alias("h")).orderBy("h", "row_id").first()["row_id"]
    assert [r["row_id"] for r in one.filter("split = 'test'").collect()] == [first]
