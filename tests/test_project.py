from quarry.operators.project import (align_columns, columns_by_type, drop_columns_if_present,
                                      drop_columns_matching, drop_low_variation, superseded_columns)


def test_name_rules(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a_Photos int, b int, roof_o int, roof_u int, c_unc_x int")
    assert drop_columns_matching(df, ["photos", "_UNC"]).columns == ["b", "roof_o", "roof_u"]
    assert drop_columns_if_present(df, ["b", "nope"]).columns == ["a_Photos", "roof_o", "roof_u", "c_unc_x"]
    assert superseded_columns(["x_o", "x_u", "a_u_b", "a_o_b"], match="suffix") == ["x_o"]
    assert superseded_columns(["x_o", "x_u", "a_u_b", "a_o_b"], match="anywhere") == ["x_o", "a_o_b"]


def test_low_variation(spark):
    df = spark.createDataFrame([(1, "k", None, 1.0), (2, "k", None, 2.0)], "a int, b string, c double, d double")
    assert drop_low_variation(df).columns == ["a", "d"]
    assert drop_low_variation(df, threshold=2).columns == []


def test_align_and_types(spark):
    df = spark.createDataFrame([(1, 2.0, "s", True)], "row_id long, x double, s string, f boolean")
    assert columns_by_type(df, "numeric", exclude=("row_id",)) == ["x"]
    assert columns_by_type(df, "other") == ["f"]
    out = align_columns(df, ["missing", "x"], keep=("row_id",))
    assert out.columns == ["row_id", "missing", "x"] and out.first()["missing"] == 0.0
