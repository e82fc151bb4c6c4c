"""Known answers at sf0.01 (FIXTURES.md) for the D1-D3 views."""
import pytest
from pyspark.sql import functions as F

from quarry import config as C
from quarry.plans.fixtures import d1, d2, d3

SF01 = "/root/testdata/sf0.01"


def test_d1_cleaning_known_answers(spark):
    from quarry.functions.columns import replace_values, to_numeric
    from quarry.plans.clean import clean, fit_cleaning, prepare_target
    raw = d1(spark, SF01)
    m = fit_cleaning(raw)
    assert m.dropped_low_variation == ["const_col", "notes"]
    assert m.dropped_keyword == ["front_Photos"] and m.dropped_superseded == ["roof_shape_o"]
    cleaned = clean(raw)
    assert cleaned.count() == 13636
    wt = replace_values(raw.filter(F.col("Difference").isNotNull()), C.COLUMNS_FOR_VALUE_REPLACEMENT) \
        .select(to_numeric("wall_thickness").alias("w")).agg(F.count("w"), F.avg("w")).first()
    assert wt[0] == 10909 and wt[1] == pytest.approx(14.369878, abs=1e-6)
    assert m.means["wall_thickness"] == pytest.approx(14.369878, abs=1e-6)
    from quarry.functions.columns import blank_to_null, fill_constant
    un = raw.select(fill_constant(blank_to_null("foundation_type_u"), "un").alias("f")).filter("f = 'un'").count()
    assert un == 3132
    y = prepare_target(raw.filter(F.col("Difference").isNotNull())).agg(F.sum("label")).first()[0]
    assert y == 229


def test_d1_paired_t(spark):
    from quarry.operators.stats import paired_ttest
    r = paired_ttest(d1(spark, SF01), "simulated_damage", "estimated").first()
    assert r["n"] == 14117 and r["t_statistic"] == pytest.approx(-0.261030, abs=1e-6)


def test_d2_known_answers(spark):
    from quarry.operators.assoc import _mi_from_cells
    from quarry.operators.stats import feature_target_corr, histogram
    df = d2(spark, SF01)
    c = {r["feature"]: r["corr"] for r in feature_target_corr(df, "label", ["quantity", "const_num"], k=None).collect()}
    assert c["quantity"] == pytest.approx(0.00343580, abs=1e-8) and c["const_num"] is None
    cells = df.groupBy(F.lit("p").alias("feature"), F.col("returnflag").alias("a"), F.col("linestatus").alias("b")) \
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    r = _mi_from_cells(cells).first()
    assert r["mi"] == pytest.approx(7.96165e-07, rel=1e-5) and r["phi2"] == pytest.approx(1.59233e-06, rel=1e-5)
    ns = [r["n"] for r in histogram(df, "label").collect()]
    assert len(ns) == 10 and min(ns) == 5845 and max(ns) == 6116


def test_d3_known_answers(spark):
    from quarry.operators.assoc import _mi_from_cells
    from quarry.operators.features import kfold, train_test_split
    from quarry.operators.stats import describe_target
    df = d3(spark, SF01)
    s = train_test_split(df, "row_id", 0.2, ":42")
    t = s.filter("split = 'test'").agg(F.count(F.lit(1)), F.sum("row_id")).first()
    assert t[0] == 2000 and t[1] == 10087566
    f = kfold(df, "row_id", 5, "", stratify_by="minority").groupBy("minority", "fold").count().collect()
    sizes = {m: sorted(r["count"] for r in f if r["minority"] == m) for m in (0, 1)}
    assert sizes[0][0] >= 1597 and sizes[0][-1] <= 1598 and sizes[1][0] >= 402 and sizes[1][-1] <= 403
    assert df.filter("minority = 1").count() == 2014
    cells = df.select(F.lit("p").alias("feature"), F.floor(F.col("value") / 20).cast("int").alias("a"),
                      F.floor(F.col("label") / 40).cast("int").alias("b")) \
        .groupBy("feature", "a", "b").agg(F.count(F.lit(1)).cast("double").alias("n"))
    r = _mi_from_cells(cells).first()
    assert r["mi"] == pytest.approx(1.6324026, abs=1e-6) and r["phi2"] == pytest.approx(17.261548, abs=1e-5)
    assert describe_target(df, "value").first()["skew"] == pytest.approx(1.930182, abs=1e-6)
